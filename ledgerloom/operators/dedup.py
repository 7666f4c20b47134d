"""One row per key, unique keys and cardinality of mappings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import blank_to_null, clean_text
from ..session import materialize


def top_per_key(df: DataFrame, keys, order, n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of every key.

    The filter on the row number lets Spark cut each task's rows to n per key
    before the shuffle, so a key with very many rows stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def latest_version(df: DataFrame, keys, order) -> DataFrame:
    """The first row of every key in the given order; give a complete order for a stable pick."""
    return top_per_key(df, keys, order, 1, "_rn").drop("_rn")


def most_complete_row(df: DataFrame, keys, cols, tie) -> DataFrame:
    """The row of every key with the attributes filled, earlier ones first, then by the tie order."""
    order = [F.col(c).isNull().cast("int") for c in cols]
    return latest_version(df, keys, [*order, *tie])


def drop_duplicates_by(df: DataFrame, keys) -> DataFrame:
    """One row per key, the same one on every run: the first by all other columns (null last)."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    # A smallest struct is found before the shuffle; no key is sorted.
    first = F.min(F.struct(*[x for c in rest for x in (F.col(c).isNull().alias(f"no {c}"), F.col(c))])).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[F.col(c) if c in keys else F.col(f"_first.`{c}`").alias(c) for c in df.columns])


def _counted(df: DataFrame, keys) -> DataFrame:
    """One row per key with the number of its rows; the count shuffles on the key, so a join on it reuses the shuffle."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others])


def _checked(df: DataFrame, keys) -> DataFrame:
    """The rows without their count; the query fails while it runs when a count is above one."""
    fails = F.assert_true(F.coalesce("_n", F.lit(1)) == 1, F.concat(F.lit("duplicate key: "), F.concat_ws("|", *keys)))
    return df.filter(fails.isNull()).drop("_n")


def assert_unique(df: DataFrame, keys) -> DataFrame:
    """The same rows; the query fails while it runs when a key occurs twice, if anything reads the rows."""
    return _checked(_counted(df, keys), keys).select(*df.columns)


def unique_left_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left join that cannot change the number of rows: fails on a repeated right key.

    The count of a key travels to the joined row and is checked there, so that the check runs for
    every row of the result, also where only the rows are counted. Keys that no left row has are
    not checked.
    """
    on = [on] if isinstance(on, str) else list(on)
    return _checked(left.join(_counted(right, on), on, "left"), on)


def map_cardinality(df: DataFrame, a: str, b: str) -> DataFrame:
    """How many b each a maps to, as one row of counts."""
    per_key = _targets(df, a, b)
    many = F.count_if(F.col("targets") > 1)
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("targets") == 1).alias("keys_with_one"),
        many.alias("keys_with_many"),
        F.round(many * F.lit(100.0) / F.count(F.lit(1)), 2).alias("many_pct"),
        F.max("targets").alias("max_per_key"),
    )


def map_distribution(df: DataFrame, a: str, b: str) -> DataFrame:
    """How many a map to one, two, three ... b."""
    return _targets(df, a, b).groupBy("targets").agg(F.count(F.lit(1)).alias("keys"))


def map_offenders(df: DataFrame, a: str, b: str) -> DataFrame:
    """The a that map to more than one b."""
    return _targets(df, a, b).filter("targets > 1")


def _targets(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.dropna(subset=[a, b]).groupBy(a).agg(F.countDistinct(b).alias("targets"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_cnt")).filter("row_cnt > 1")


def conflicting_keys(df: DataFrame, keys, value: str) -> DataFrame:
    """Keys with more than one distinct value."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_cnt"), F.countDistinct(value).alias("distinct_cnt"))
        .filter("distinct_cnt > 1")
    )


def key_conflict_summary(df: DataFrame, keys, value: str) -> DataFrame:
    """Number and share of duplicate and of conflicting keys."""
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")
    )
    duplicate, conflict = F.col("n") > 1, F.col("lo") != F.col("hi")
    keys_n = F.count(F.lit(1))
    return per_key.agg(
        keys_n.alias("key_cnt"),
        F.count_if(duplicate).alias("duplicate_key_cnt"),
        F.count_if(conflict).alias("conflict_key_cnt"),
        F.coalesce(F.sum(F.when(conflict, F.col("n"))), F.lit(0)).alias("rows_in_conflicts"),
        (F.count_if(duplicate) * F.lit(100.0) / keys_n).alias("duplicate_key_pct"),
        (F.count_if(conflict) * F.lit(100.0) / keys_n).alias("conflict_key_pct"),
    )


def unique_map_only(df: DataFrame, key, target) -> DataFrame:
    """Per key the number of distinct complete targets, and the target where it is the only one.

    ``mapping`` is ``none``, ``unique`` or ``ambiguous``. The distinct step comes
    first, so a key with many rows is collapsed before it is counted.
    """
    key, target = list(key), list(target)
    complete = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in target])
    pairs = df.select(*key, *[F.when(complete, F.col(c)).alias(c) for c in target]).distinct()
    counted = F.count(F.when(complete, 1))
    out = pairs.groupBy(*key).agg(
        counted.alias("target_cnt"), *[F.max(c).alias(c) for c in target]
    )
    unique = F.col("target_cnt") == 1
    return out.withColumns(
        {
            "mapping": F.when(F.col("target_cnt") == 0, "none").when(unique, "unique").otherwise("ambiguous"),
            **{c: F.when(unique, F.col(c)) for c in target},
        }
    )


def mode_per_key(df: DataFrame, keys, value: str, clean=clean_text) -> DataFrame:
    """Most frequent non-blank value of every key, the smallest of equally frequent ones."""
    counts = (
        df.withColumn(value, clean(value))
        .filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return latest_version(counts, keys, [F.col("_n").desc(), F.col(value)]).drop("_n")


def profile_fallback(df: DataFrame, key: str, cols, suffix: str) -> DataFrame:
    """First non-blank value of each attribute per key, smallest first."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.min(clean_text(c)).alias(f"{c}{suffix}") for c in cols])
    )


def list_per_key(df: DataFrame, keys, value: str) -> DataFrame:
    """The distinct values of each key in order: one row per value, with its place from 1 and their number.

    Blank texts, None and nan are no values. The values are dealt by ranges of key and value and
    written, so that a key with very many values lies in many partitions; a place is the number
    within the partition and the counts of the key in the partitions before it. Runs a job.
    """
    keys = list(keys)
    pairs = df.select(*keys, blank_to_null(value).alias(value)).filter(F.col(value).isNotNull()).distinct()
    dealt = materialize(pairs.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()))
    within = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(value))
    counts = dealt.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"))
    # A row per key and partition.
    of_key = Window.partitionBy(*keys)
    before = F.sum("_n").over(of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    counts = counts.select("_part", *keys, before.alias("_before"), F.sum("_n").over(of_key).alias(f"{value}_cnt"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("_part", *keys)]
    rows = dealt.withColumn("_within", within).alias("l").join(counts.alias("r"), reduce(lambda x, y: x & y, same))
    place = (F.col("_within") + F.col("_before")).cast("int")
    return rows.select(*[F.col(f"l.{c}") for c in keys], value, place.alias("position"), f"{value}_cnt")


def joined_lists(listed: DataFrame, keys, value: str, wanted: DataFrame) -> DataFrame:
    """Comma text of the lists of the wanted keys, for a report."""
    rows = listed.join(wanted.select(*keys).distinct(), list(keys), "left_semi")
    text = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("position", value))), lambda x: x[value]))
    return rows.groupBy(*keys, f"{value}_cnt").agg(text.alias(f"{value}_list"))
