"""Spans of months: choose, merge and count validity intervals without a row per month.

A span is a row with its first and last month, counted in months from year 0. Its two ends are
signed events; running sums over them give what holds in each month, so the work follows the
number of intervals and not their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

FIRST, LAST = "_first", "_last"


def month_number(day: Column | str) -> Column:
    """Months from year 0; the same as counting calendar months between two days."""
    return F.year(day) * 12 + F.month(day) - 1


def month_of(number: Column | str) -> Column:
    """First day of a numbered month."""
    number = F.col(number) if isinstance(number, str) else number
    return F.make_date(F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int"), F.lit(1))


def month_spans(df: DataFrame, start, end, valid_from="d_valid_from", valid_to="d_valid_to") -> DataFrame:
    """The rows with their span inside [start, end], as ``active_months`` expands it; rows without a start or a month are left out."""
    low, high = (month_number(F.lit(d).cast("date")) for d in (start, end))
    out = df.filter(F.col(valid_from).isNotNull()).withColumns({
        FIRST: F.greatest(month_number(valid_from), low),
        LAST: F.least(F.coalesce(month_number(valid_to), high), high),
    })
    return out.filter(F.col(FIRST) <= F.col(LAST))


def chosen_spans(df: DataFrame, keys, order, payload) -> DataFrame:
    """Per key spans that don't overlap, each with the row that is the largest by ``order`` among those that cover it.

    Of equal spans only the largest row is kept first, in partial groups; so a key has at most a row
    for each pair of months, however many intervals it has. Its ends cut the key's rows into pieces.
    """
    keys = list(keys)
    best = F.max(F.struct(*order, *[F.col(c).alias(f"_p_{c}") for c in payload])).alias("_best")
    rows = df.groupBy(*keys, FIRST, LAST).agg(best)
    frame = Window.partitionBy(*keys)
    cuts = F.array_union(F.collect_set(FIRST).over(frame), F.collect_set(F.col(LAST) + 1).over(frame))
    cut = cut_spans(rows.withColumn("_cuts", cuts), "_cuts").drop("_cuts")
    return cut.groupBy(*keys, FIRST, LAST).agg(F.max("_best").alias("_best")).select(
        *keys, FIRST, LAST, *[F.col(f"_best._p_{c}").alias(c) for c in payload]
    )


def cut_spans(df: DataFrame, cuts: str) -> DataFrame:
    """Each row once per piece of its span, cut before the months of an array column (null and other months cut nothing)."""
    inside = F.filter(cuts, lambda c: c.between(F.col(FIRST) + 1, F.col(LAST)))
    ends = F.array_sort(F.array_union(F.array(F.col(FIRST), F.col(LAST) + 1), inside))
    pieces = F.transform(
        F.slice("_ends", F.lit(1), F.size("_ends") - 1),
        lambda c, i: F.struct(c.alias(FIRST), (F.element_at("_ends", i + 2) - 1).alias(LAST)),
    )
    kept = [c for c in df.columns if c not in (FIRST, LAST)]
    return df.withColumn("_ends", ends).select(*kept, F.explode(pieces).alias("_piece")).select(*kept, f"_piece.{FIRST}", f"_piece.{LAST}")


def span_months(df: DataFrame, month: str = "month_start") -> DataFrame:
    """A row per month of each span. The rows expand in place, so whatever needs a shuffle should come before."""
    months = df.withColumn("_month", F.explode(F.sequence(FIRST, LAST))).withColumn(month, month_of("_month"))
    return months.drop(FIRST, LAST, "_month")


def span_months_with(spans: DataFrame, rows: DataFrame, key: str, month: str = "month_start") -> DataFrame:
    """A row per month of each span with what the key's rows of that month hold: a left join on key and month.

    A key's rows are one value when they meet its spans, and the months expand after that, so no month is shuffled.
    """
    values = [c for c in rows.columns if c not in (key, month)]
    held = rows.groupBy(key).agg(F.collect_list(F.struct(month_number(month).alias("_m"), *values)).alias("_held"))
    months = spans.join(held, key, "left").withColumn("_month", F.explode(F.sequence(FIRST, LAST)))
    here = months.withColumn("_here", F.explode_outer(F.filter("_held", lambda x: x["_m"] == F.col("_month"))))
    rest = [c for c in spans.columns if c not in (key, FIRST, LAST)]
    return here.select(key, month_of("_month").alias(month), *rest, *[F.col(f"_here.`{c}`").alias(c) for c in values])


def merged_spans(df: DataFrame, keys) -> DataFrame:
    """Spans that don't overlap and cover the same months of a key as its rows do."""
    rows = df.select(*keys, FIRST, LAST).distinct()
    before = Window.partitionBy(*keys).orderBy(FIRST, LAST).rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.col(FIRST), F.max(LAST).over(before) + 1)
    return rows.withColumn(FIRST, new).filter(F.col(FIRST) <= F.col(LAST))


def monthly_sums(spans: DataFrame, by, amounts, month: str = "month_start", label: str | None = None) -> DataFrame:
    """Sums of whole-number amounts over the spans that cover each month, for months where one is not 0.

    ``by`` may be empty. A group has at most a row for each month when its running sums are taken.
    """
    return span_months(stretched_sums(spans, by, amounts, label), month)


def stretched_sums(spans: DataFrame, by, amounts, label: str | None = None) -> DataFrame:
    """The same sums as spans without a row per month: they don't overlap within a group, and nothing changes inside one.

    ``label`` names a column of structs that belongs to the amounts from the month its span begins on;
    the spans of a group that have one (not null) must not overlap.
    """
    by, amounts, labels = list(by), list(amounts), [label] if label else []
    ends = F.array(
        F.struct(F.col(FIRST).alias("_month"), *[F.col(a) for a in amounts], *[F.col(x) for x in labels]),
        F.struct((F.col(LAST) + 1).alias("_month"), *[(-F.col(a)).alias(a) for a in amounts],
                 *[F.lit(None).cast(spans.schema[x].dataType).alias(x) for x in labels]),
    )
    events = spans.select(*by, F.explode(ends).alias("_e")).select(*by, "_e.*")
    net = events.groupBy(*by, "_month").agg(*[F.sum(a).alias(a) for a in amounts], *[F.max(x).alias(x) for x in labels])
    frame = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_month")
    held = net.withColumns({
        **{a: F.sum(a).over(frame) for a in amounts}, **{x: F.last(x, ignorenulls=True).over(frame) for x in labels},
        "_next": F.lead("_month").over(frame),
    })
    some = held.filter(" or ".join(f"`{a}` <> 0" for a in amounts))
    return some.select(*by, *amounts, *labels, F.col("_month").alias(FIRST), (F.col("_next") - 1).alias(LAST))
