"""Quantiles over data of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

# How many cuts a round of narrowing makes within a slice, and how well the sketch places them.
CUTS, CUT_ACCURACY = 256, 2_000


def approx_quantiles(df: DataFrame, value: str, probs, by=(), accuracy: int = 10_000, prefix="p") -> DataFrame:
    """Quantiles by a mergeable sketch of bounded size."""
    values = F.percentile_approx(value, [float(p) for p in probs], accuracy)
    out = df.groupBy(*by).agg(values.alias("_q"))
    return out.select(*by, *[F.col("_q")[i].alias(f"{prefix}{_label(p)}") for i, p in enumerate(probs)])


def exact_quantiles(
    df: DataFrame, value: str, probs, by=(), accuracy: int = 2_000, prefix="p", limit: int = 1_000_000, n: str | None = None,
    discrete: bool = False,
) -> DataFrame:
    """Interpolated quantiles, exact; no task ranks more than about ``limit`` values. Runs jobs.

    A sketch gives, around every wanted quantile, a lower and an upper bound whose ranks are
    within 2 / accuracy of it on either side. Values are counted, those between no bounds only by
    how many they are, and the few others are ranked. Bounds come as one more column: by a join
    on the groups, or as a single value where there are none. Where more than ``limit`` different
    values lie between bounds, the bounds are narrowed first. Groups with a null key are left out.
    ``n`` names a column that tells how often a row counts; then no sketch is taken, and narrowing
    begins with all values. With ``discrete`` a quantile is the smallest value that the share of
    values is not above, without interpolation.
    """
    by, probs = list(by), [float(p) for p in probs]
    places = F.explode(F.array(*map(F.lit, range(len(probs))))).alias("_i")
    if n is not None:
        known = df.filter(F.col(value).isNotNull() & (F.col(n) > 0))
        known = known.dropna(subset=by) if by else known
        counts = known.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.sum(n).alias("_n"))
        each = counts.select(*by, "_v", "_n", places, F.lit(1).alias("_side"))
        return _interpolated(narrowed(each, by, probs, limit), by, probs, prefix, discrete)
    margin = 2 / accuracy
    ends = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
    known = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    counts = known.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    bounds = known.groupBy(*by).agg(F.percentile_approx("_v", ends, accuracy).alias("_bounds"))
    if by:
        counts = counts.join(bounds, by)
    else:
        counts = counts.withColumn("_bounds", bounds.scalar())
    low, high = F.col("_bounds")[2 * F.col("_i")], F.col("_bounds")[2 * F.col("_i") + 1]
    # A row for each wanted quantile: inside its bounds the value itself; beyond them the nearest
    # value, which a wanted rank may fall on in small groups, and how many there are.
    each = counts.select(*by, "_v", "_n", "_bounds", places)
    side = F.when(F.col("_v") < low, 0).when(F.col("_v") <= high, 1).otherwise(2)
    return _interpolated(narrowed(_parts(each.withColumn("_side", side), by), by, probs, limit), by, probs, prefix, discrete)


def _interpolated(parts: DataFrame, by, probs, prefix: str, discrete: bool) -> DataFrame:
    frame = Window.partitionBy(*by, "_i").orderBy("_side", "_v")
    placed = parts.withColumns({"_to": F.sum("_n").over(frame), "_total": F.sum("_n").over(Window.partitionBy(*by, "_i"))})
    position = _position(probs)
    if discrete:
        position = F.greatest(F.ceil(F.element_at(F.array(*map(F.lit, probs)), F.col("_i") + 1) * F.col("_total")), F.lit(1)) - 1
    placed = placed.withColumn("_pos", position)
    begin, end = F.col("_to") - F.col("_n"), F.col("_to")

    def at(rank):
        here = F.when(F.col("_side") == 0, rank == end - 1).when(F.col("_side") == 2, rank == begin)
        return F.max(F.when(here.otherwise((rank >= begin) & (rank < end)), F.col("_v")))

    found = placed.groupBy(*by, "_i", "_pos").agg(at(F.floor("_pos")).alias("_a"), at(F.ceil("_pos")).alias("_b"))
    point = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_pos") - F.floor("_pos"))
    return found.groupBy(*by).agg(
        *[F.max(F.when(F.col("_i") == i, point)).alias(f"{prefix}{_label(p)}") for i, p in enumerate(probs)]
    ).select(*by, *[f"{prefix}{_label(p)}" for p in probs])


def _position(probs) -> Column:
    return F.element_at(F.array(*map(F.lit, probs)), F.col("_i") + 1) * (F.col("_total") - 1)


def _parts(each: DataFrame, by) -> DataFrame:
    """Per wanted quantile the values between its bounds with their counts, and one row for all values on either side."""
    own = F.when(F.col("_side") == 1, F.col("_v")).alias("_own")
    return each.groupBy(*by, "_i", "_side", own).agg(
        F.sum("_n").alias("_n"), F.when(F.col("_side") == 0, F.max("_v")).otherwise(F.min("_v")).alias("_v")
    ).drop("_own")


def narrowed(parts: DataFrame, by, probs, limit: int) -> DataFrame:
    """The parts with bounds so narrow that no quantile has more than ``limit`` values between them.

    Each round cuts the values between the bounds by a sketch, counts the rows between cuts exactly and
    keeps the stretch of the wanted ranks, so its result does not rest on the sketch's error. A round
    leaves about 1 / CUTS of the values; it is written to the shared folder, and one number goes to the driver.
    """
    keys, before = [*by, "_i"], None
    grid = [j / CUTS for j in range(CUTS + 1)]
    while True:
        parts = materialize(parts)
        inside = parts.filter("_side = 1")
        largest = inside.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if largest <= limit or largest == before:
            return parts
        before = largest
        cuts = inside.groupBy(*keys).agg(F.percentile_approx("_v", grid, CUT_ACCURACY).alias("_cuts"))
        cut = parts.join(cuts, keys, "left").withColumn("_at", F.when(F.col("_side") == 0, -1).when(F.col("_side") == 2, CUTS + 2).otherwise(
            F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
        ))
        stretches = cut.groupBy(*keys, "_at").agg(F.sum("_n").alias("_n"))
        frame = Window.partitionBy(*keys)
        stretches = stretches.withColumns({"_to": F.sum("_n").over(frame.orderBy("_at")), "_total": F.sum("_n").over(frame)})
        stretches = stretches.withColumn("_pos", _position(probs))
        holds = (F.col("_to") > F.floor("_pos")) & (F.col("_to") - F.col("_n") <= F.ceil("_pos"))
        wanted = stretches.filter(holds).groupBy(*keys).agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
        side = F.when(F.col("_at") < F.col("_first"), 0).when(F.col("_at") > F.col("_last"), 2).otherwise(F.col("_side"))
        parts = _parts(cut.join(wanted, keys, "left").withColumn("_side", side), by)


def counted_quantiles(counts: DataFrame, value: str, n: str, probs, by=(), prefix="p") -> DataFrame:
    """Interpolated quantiles of values with their counts, where a group has few different values (as prices of a list)."""
    by, probs = list(by), [float(p) for p in probs]
    rows = counts.filter(F.col(value).isNotNull() & (F.col(n) > 0)).select(*by, F.col(value).cast("double").alias("_v"), F.col(n).alias("_n"))
    frame = Window.partitionBy(*by)
    rows = rows.withColumns({"_to": F.sum("_n").over(frame.orderBy("_v")), "_total": F.sum("_n").over(frame)})

    def at(rank):
        return F.max(F.when((rank >= F.col("_to") - F.col("_n")) & (rank < F.col("_to")), F.col("_v")))

    out = []
    for p in probs:
        position = F.lit(p) * (F.col("_total") - 1)
        low, high = at(F.floor(position)), at(F.ceil(position))
        share = F.max(position - F.floor(position))
        out.append((low + (high - low) * share).alias(f"{prefix}{_label(p)}"))
    return rows.groupBy(*by).agg(*out)


def _label(p: float) -> str:
    return f"{p * 100:g}".replace(".", "_")


def one_row(df: DataFrame, values: DataFrame) -> DataFrame:
    """The rows with the columns of a table of one row, or none; its plan is a single subquery."""
    row = values.select(F.struct(*values.columns)).scalar()
    return df.withColumn("_row", row).select(*df.columns, *[F.col(f"_row.`{c}`").alias(c) for c in values.columns])
