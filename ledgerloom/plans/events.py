"""Which events precede a target event; cohorts by first event.

Events are counted per key and day before anything else, so one key with very
many events stays small, and earlier events are found by running sums over days:
no pair of events is ever formed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.classes import prefix_group
from ..functions.numbers import ratio
from ..operators.dedup import mode_per_key, top_per_key


def first_event_cohort(events: DataFrame, year: int, keys=("segment", "inn"), group: str | None = None) -> DataFrame:
    """Keys whose first event, or first event of a code group, falls in a year."""
    pool = events if group is None else events.filter(F.trim("code").startswith(group))
    first = pool.groupBy(*keys).agg(F.min("dt").alias("first_dt"))
    return first.filter(F.year("first_dt") == year)


def prior_events_before_each_target(events: DataFrame, target: str, groups, exact=None) -> DataFrame:
    """Target events and keys with earlier events, overall and per code group, by segment.

    Earlier means on an earlier day; events of the target's own group never count. The running
    sums see a key once a day, so its rows are bounded by the calendar.
    """
    is_target = F.trim("code").startswith(target)
    group = prefix_group("code", groups, exact)
    days = events.withColumns({"_t": is_target, "_g": F.when(~is_target, group)}).groupBy("segment", "inn", "dt").agg(
        F.count_if(F.col("_t")).alias("targets"),
        F.count_if(~F.col("_t")).alias("others"),
        F.count_if(F.col("_g").isNotNull()).alias("grouped"),
        *[F.count_if(F.col("_g") == g).alias(f"g_{g}") for g in groups],
    )
    earlier = Window.partitionBy("segment", "inn").orderBy("dt").rowsBetween(Window.unboundedPreceding, -1)
    names = ["others", "grouped", *[f"g_{g}" for g in groups]]
    before = days.withColumns({f"b_{n}": F.coalesce(F.sum(n).over(earlier), F.lit(0)) for n in names}).filter("targets > 0")
    labels = {"others": "any_other", "grouped": "any_group", **{f"g_{g}": g for g in groups}}
    per_key = before.groupBy("segment", "inn").agg(
        F.sum("targets").alias("targets"),
        *[F.sum(F.when(F.col(f"b_{n}") > 0, F.col("targets")).otherwise(0)).alias(f"e_{n}") for n in names],
        *[F.sum(F.col("targets") * F.col(f"b_{n}")).alias(f"p_{n}") for n in names],
    )
    totals = per_key.groupBy("segment").agg(
        F.sum("targets").alias("target_events"),
        F.count(F.lit(1)).alias("target_keys"),
        *[F.sum(f"e_{n}").alias(f"e_{n}") for n in names],
        *[F.count_if(F.col(f"e_{n}") > 0).alias(f"k_{n}") for n in names],
        *[F.sum(f"p_{n}").alias(f"p_{n}") for n in names],
    )
    parts = ", ".join(f"'{labels[n]}', e_{n}, k_{n}, p_{n}" for n in names)
    return totals.select(
        "segment", "target_events", "target_keys",
        F.expr(f"stack({len(names)}, {parts}) as (prior_group, events_with_prior, keys_with_prior, prior_pairs)"),
    )


def target_coverage(events: DataFrame, targets: DataFrame, date_from, date_to) -> DataFrame:
    """Events found per configured target, zero where there is none."""
    keys = ["segment", "type", "code"]
    found = events.filter(F.col("dt").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events_found")
    )
    return targets.select(*keys).distinct().join(found, keys, "left").withColumn(
        "events_found", F.coalesce("events_found", F.lit(0))
    )


def _reach(events: DataFrame, days: int) -> DataFrame:
    """Merged day ranges after each key's events of a code, in which a later event counts as preceded.

    An event on day d reaches d+1 ... d+days; ranges that touch are merged.
    """
    key = ["inn", "segment", "type", "code"]
    dated = events.select(*key, "dt").distinct()
    order = Window.partitionBy(*key).orderBy("dt")
    fresh = F.coalesce(F.datediff("dt", F.lag("dt").over(order)) > days, F.lit(True)).cast("int")
    runs = dated.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy(*key, "_run").agg(
        F.date_add(F.min("dt"), 1).alias("first_day"), F.date_add(F.max("dt"), days).alias("last_day")
    ).drop("_run")


def counted_to(marks: DataFrame, anchors: DataFrame, keys, sums, start, end, blocks: int) -> DataFrame:
    """Running sums of the anchors at every mark, by two levels, so that a key's marks lie in up to ``blocks`` tasks.

    The period is cut into blocks of days. An anchor day adds to its block's sums; running sums over
    blocks, of which a key has few, give what stands before each block and enter it as one row.
    Within a block the marks follow by day and step. Marks before or after the period belong to the
    first or last block, and a mark without a day counts nothing.
    """
    length = F.greatest(F.datediff(end, start) + 1, F.lit(1))
    place = F.floor(F.datediff("day", start) * blocks / length).cast("int")
    block = F.greatest(F.lit(0), F.least(F.lit(blocks - 1), place))
    totals = anchors.withColumn("day", F.col("dt")).groupBy(*keys, block.alias("_block")).agg(*[F.sum(c).alias(c) for c in sums])
    by_block = Window.partitionBy(*keys).orderBy("_block")
    upto = by_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seeds = totals.select(*keys, "_block", F.lead("_block").over(by_block).alias("_next"), *[F.sum(c).over(upto).alias(c) for c in sums])
    seeds = seeds.filter(F.col("_block") < blocks - 1).select(
        *keys, F.explode(F.sequence(F.col("_block") + 1, F.coalesce("_next", F.lit(blocks - 1)))).alias("_block"), *sums
    )
    both = marks.withColumn("_block", F.when(F.col("day").isNull(), 0).otherwise(block)).unionByName(seeds, allowMissingColumns=True)
    # A seed has no day and so comes first in its block.
    running = Window.partitionBy(*keys, "_block").orderBy("day", "step").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumns({f"c{c}": F.coalesce(F.sum(c).over(running), F.lit(0)) for c in sums})


def predecessor_stats(
    events: DataFrame, targets: DataFrame, date_from, date_to, days: int = 365, blocks: int = 16
) -> DataFrame:
    """Per preceding code: target cases, keys, and the rate of targets among all events it precedes.

    An event precedes another of the same key if it lies 1 to ``days`` days before
    it. Target codes are never predecessors. The number of events inside a range is
    the difference of running counts at its ends; they are taken in ``blocks`` parts of the period.
    """
    start, end = F.lit(date_from).cast("date"), F.lit(date_to).cast("date")
    wanted = targets.select("segment", "type", "code").distinct().withColumn("_wanted", F.lit(1))
    marked = events.select("inn", "segment", "dt", "type", "code").join(wanted, ["segment", "type", "code"], "left")
    pool = marked.filter("_wanted is null")
    anchors = marked.filter(F.col("dt").between(start, end)).groupBy("inn", "segment", "dt").agg(
        F.count(F.lit(1)).alias("n"), F.count("_wanted").alias("t")
    )
    ranges = _reach(pool, days)
    # At equal days a range starts before, and ends after, the events of that day.
    marks = (
        anchors.select("inn", "segment", F.col("dt").alias("day"), F.lit(1).alias("step"), "n", "t")
        .unionByName(
            ranges.select(
                "inn", "segment", "type", "code",
                F.explode(F.array(
                    F.struct(F.col("first_day").alias("day"), F.lit(0).alias("step"), F.lit(-1).alias("sign")),
                    F.struct(F.col("last_day").alias("day"), F.lit(2).alias("step"), F.lit(1).alias("sign")),
                )).alias("_m"),
            ).select("inn", "segment", "type", "code", "_m.day", "_m.step", "_m.sign"),
            allowMissingColumns=True,
        )
    )
    counted = counted_to(marks, anchors, ["inn", "segment"], ["n", "t"], start, end, blocks).filter("sign is not null")
    per_key = counted.groupBy("segment", "type", "code", "inn").agg(
        F.sum(F.col("sign") * F.col("ct")).alias("cases"), F.sum(F.col("sign") * F.col("cn")).alias("anchors")
    )
    stats = per_key.groupBy("segment", F.col("type").alias("pred_type"), F.col("code").alias("pred_code")).agg(
        F.sum("cases").alias("target_cases"),
        F.count_if(F.col("cases") > 0).alias("unique_inn"),
        F.sum("anchors").alias("anchors_with_pred"),
    )
    base = anchors.groupBy("segment").agg(F.sum("n").alias("_n"), F.sum("t").alias("_t")).select(
        "segment", ratio("_t", "_n").alias("base_target_rate")
    )
    out = stats.join(base, "segment", "left").withColumn(
        "target_rate_when_pred", ratio("target_cases", "anchors_with_pred")
    )
    return out.withColumn("lift", ratio("target_rate_when_pred", "base_target_rate"))


def predecessor_top_n(stats: DataFrame, n: int = 5) -> DataFrame:
    """The n most frequent predecessors per segment."""
    order = [F.col("target_cases").desc(), F.col("unique_inn").desc(), F.col("pred_type"), F.col("pred_code")]
    return top_per_key(stats.filter("target_cases > 0"), ["segment"], order, n, "rank_in_segment")


def predecessor_summary(events: DataFrame, targets: DataFrame, date_from, date_to, days: int = 365) -> DataFrame:
    """Target events and keys per segment, and target events with at least one predecessor."""
    start, end = F.lit(date_from).cast("date"), F.lit(date_to).cast("date")
    wanted = targets.select("segment", "type", "code").distinct().withColumn("_wanted", F.lit(1))
    marked = events.join(wanted, ["segment", "type", "code"], "left").groupBy("inn", "segment", "dt").agg(
        F.count("_wanted").alias("t"), F.max(F.when(F.col("_wanted").isNull(), F.col("dt"))).alias("_p")
    )
    earlier = Window.partitionBy("inn", "segment").orderBy("dt").rowsBetween(Window.unboundedPreceding, -1)
    seen = marked.withColumn("last", F.max("_p").over(earlier)).filter(F.col("dt").between(start, end) & (F.col("t") > 0))
    near = F.coalesce(F.datediff("dt", "last") <= days, F.lit(False))
    per_key = seen.groupBy("segment", "inn").agg(
        F.sum("t").alias("t"), F.sum(F.when(near, F.col("t")).otherwise(0)).alias("p")
    )
    return per_key.groupBy("segment").agg(
        F.sum("t").alias("target_events"), F.count(F.lit(1)).alias("target_inn"),
        F.sum("p").alias("target_events_with_predecessor"),
    )


def yearly_share_by_segment(population: DataFrame, events: DataFrame) -> DataFrame:
    """Share of a year's keys with an event in that year, overall and by segment."""
    hit = events.select(F.year("dt").alias("year"), "inn").distinct().withColumn("_hit", F.lit(1))
    pairs = population.select("year", "segment", "inn").filter("inn is not null").distinct().join(hit, ["year", "inn"], "left")
    by_segment = pairs.groupBy("year", "segment").agg(
        F.count(F.lit(1)).alias("all_unique_clients"), F.count("_hit").alias("event_unique_clients")
    )
    overall = pairs.groupBy("year", "inn").agg(F.max("_hit").alias("_hit")).groupBy("year").agg(
        F.count(F.lit(1)).alias("all_unique_clients"), F.count("_hit").alias("event_unique_clients")
    )
    both = by_segment.unionByName(overall.withColumn("segment", F.lit("all")))
    return both.withColumn("share", ratio("event_unique_clients", "all_unique_clients"))


def overlap_by_segment(a: DataFrame, b: DataFrame, key="inn", segment="segment", empty="без сегмента") -> DataFrame:
    """Keys of both sets by their most frequent segment in the second."""
    shared = b.join(a.select(key).distinct(), key, "left_semi")
    modes = mode_per_key(shared, [key], segment)
    labelled = shared.select(key).distinct().join(modes, key, "left")
    return labelled.groupBy(F.coalesce(segment, F.lit(empty)).alias(segment)).agg(F.count(F.lit(1)).alias("count_inn"))


def overlap_sizes(a: DataFrame, b: DataFrame, key="inn") -> DataFrame:
    """Sizes of two key sets, of their intersection and of both differences."""
    tagged = reduce(
        DataFrame.unionByName,
        [df.select(F.col(key).alias("k"), F.lit(x).alias("a"), F.lit(1 - x).alias("b")) for df, x in ((a, 1), (b, 0))],
    )
    per_key = tagged.filter("k is not null").groupBy("k").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return per_key.agg(
        F.sum("a").alias("size_a"), F.sum("b").alias("size_b"), F.sum(F.col("a") * F.col("b")).alias("both"),
        F.sum(F.col("a") * (1 - F.col("b"))).alias("only_a"), F.sum(F.col("b") * (1 - F.col("a"))).alias("only_b"),
    )
