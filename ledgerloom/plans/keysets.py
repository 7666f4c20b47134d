"""Sets of keys per month as bitmaps: stored once, then compared by bit operations only.

A dictionary gives each key a whole number for good. A set is then, per block of 32,768 numbers, one
bitmap of 4 KB, and sets are merged and counted without their keys: sizes of unions give the sizes
of all intersections and differences. Bitmaps of different months, tables and runs fit together as
long as they use one dictionary.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize
from ..sources.writers import month_entries, read_months, read_or_compute_month, write_month

BLOCK = 32_768
SCHEMA = "key string, number long"


def numbered_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The dictionary at ``path`` after the keys that it lacks got numbers. Runs jobs.

    ``keys`` has one text column; nulls get no number. New keys are entered as one batch, numbered
    within the tasks that write them, so no task sees all keys; a writer that another one has
    overtaken gets an error and enters nothing. Numbers that were given never change.
    """
    wanted = keys.toDF("key").filter("key is not null").distinct()
    known = read_months(spark, path, "batch")
    last = 0
    if known is not None:
        wanted = wanted.join(known.select("key"), "key", "left_anti")
        last = known.agg(F.max("number")).first()[0] or 0
    # Numbers follow the order of written rows, which a task that is run again finds unchanged.
    wanted = materialize(wanted)
    # A batch starts a block of its own, so that its bitmaps don't share one with earlier keys.
    start = -(-last // BLOCK) * BLOCK + 1
    batch = f"{len(month_entries(spark, path)):06d}"
    fresh = wanted.withColumn("number", F.monotonically_increasing_id() + F.lit(start))
    write_month(fresh.withColumn("batch", F.lit(batch)), path, "batch", months=[batch], seen={})
    return read_months(spark, path, "batch").select("key", "number")


def key_bitmaps(rows: DataFrame, numbers: DataFrame, by) -> DataFrame:
    """Bitmaps of the numbers of ``key`` per ``by`` and block; keys without a number are left out.

    A key that fills many rows is one row per set before it meets the dictionary.
    """
    by = list(by)
    found = rows.select(*by, "key").distinct().join(numbers, "key")
    return found.groupBy(*by, F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def month_key_sets(
    spark: SparkSession, path: str, months: list[str], rows: Callable[[list[str]], DataFrame], fingerprint: str | None = None
) -> DataFrame:
    """Stored bitmaps (``report_month``, ``set``, ``block``, ``bits``) of the months; those missing are drawn from ``rows``.

    ``rows`` gives ``report_month``, ``set`` and ``key`` of the months it is asked for. A month is read
    from its rows once, and again only after its inputs' fingerprint has changed.
    """

    def compute(missing: list[str]) -> DataFrame:
        wanted = rows(missing).select("report_month", "set", F.col("key").cast("string").alias("key"))
        numbers = numbered_keys(spark, f"{path}/keys", wanted.select("key"))
        return key_bitmaps(wanted, numbers, ["report_month", "set"])

    return read_or_compute_month(spark, f"{path}/sets", months, compute, ["set", "block", "bits"], fingerprint=fingerprint)


def _name(group) -> str:
    return "|".join(sorted(group))


def union_sizes(bitmaps: DataFrame, sets, by=()) -> DataFrame:
    """Number of keys in the union of every group of the sets (at most four), one column per group (``a|b``), per ``by``.

    A bitmap goes to the groups that hold its set and is merged there block by block.
    """
    sets, by = sorted(sets), list(by)
    if len(sets) > 4:
        raise ValueError("at most four sets can be compared at once")
    groups = [g for n in range(1, len(sets) + 1) for g in combinations(sets, n)]
    holding = F.create_map(*[x for s in sets for x in (F.lit(s), F.array(*[F.lit(_name(g)) for g in groups if s in g]))])
    rows = bitmaps.filter(F.col("set").isin(sets)).select(*by, "block", "bits", F.explode(F.element_at(holding, F.col("set"))).alias("_group"))
    merged = rows.groupBy(*by, "_group", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("_group") == _name(g), F.bitmap_count("bits"))), F.lit(0)).alias(_name(g)) for g in groups
    ])


def keys_in(inside, outside=()) -> Column:
    """Number of keys in all sets of ``inside`` and none of ``outside``, from the columns of ``union_sizes``."""
    inside, outside = list(inside), list(outside)
    total = F.lit(0)
    for n in range(len(inside) + 1):
        for part in combinations(inside, n):
            if part or outside:
                size = F.col(f"`{_name({*part, *outside})}`")
                total = total + size if n % 2 else total - size
    return total


def month_flows(bitmaps: DataFrame, of: str) -> DataFrame:
    """Keys of a set per month: all, new against the month before, kept from it, and gone since it.

    A month between the first and the last one that holds no key has sizes of 0.
    """
    own = bitmaps.filter(F.col("set") == of)
    month = F.concat("report_month", F.lit("-01")).try_cast("date")
    after = F.date_format(F.add_months(month, 1), "yyyy-MM")
    sides = F.array(
        F.struct(F.lit("now").alias("set"), F.col("report_month").alias("month")),
        F.struct(F.lit("before").alias("set"), after.alias("month")),
    )
    rows = own.select("block", "bits", F.inline(sides)).withColumnRenamed("month", "report_month")
    sizes = union_sizes(rows, ["now", "before"], ["report_month"])
    first_last = own.agg(F.struct(F.min(month).alias("a"), F.max(month).alias("b")))
    calendar = first_last.toDF("_p").filter("_p.a is not null").select(
        F.explode(F.sequence("_p.a", "_p.b", F.expr("interval 1 month"))).alias("_d")
    ).select(F.date_format("_d", "yyyy-MM").alias("report_month"))
    flows = sizes.select(
        "report_month",
        keys_in(["now"]).alias("keys_total"),
        keys_in(["now"], ["before"]).alias("keys_new"),
        keys_in(["now", "before"]).alias("keys_kept"),
        keys_in(["before"], ["now"]).alias("keys_gone"),
    )
    return calendar.join(flows, "report_month", "left").na.fill(0)


def month_sizes(bitmaps: DataFrame) -> DataFrame:
    """Number of keys per month and set."""
    return bitmaps.groupBy("report_month", "set").agg(F.sum(F.bitmap_count("bits")).alias("keys_cnt"))


def identity_of_months(a: DataFrame, b: DataFrame, c: DataFrame) -> DataFrame:
    """Is A = B \\ C? Sizes of the sets and of both differences, from stored bitmaps of any months."""
    tagged = [df.select(F.lit(name).alias("set"), "block", "bits") for name, df in (("a", a), ("b", b), ("c", c))]
    sizes = union_sizes(tagged[0].unionByName(tagged[1]).unionByName(tagged[2]), ["a", "b", "c"])
    out = sizes.select(
        keys_in("a").alias("size_a"), keys_in("b").alias("size_b"), keys_in("c").alias("size_c"),
        keys_in("b", "c").alias("size_expected"),
        (keys_in("a") - keys_in("ab", "c")).alias("only_in_a"),
        (keys_in("b", "c") - keys_in("ab", "c")).alias("missing_from_a"),
    )
    return out.withColumn("identical", ((F.col("only_in_a") == 0) & (F.col("missing_from_a") == 0)).cast("int"))
