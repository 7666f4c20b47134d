"""Stable keys, ratio coefficients and ranked selections over several months."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import ratio
from ..operators.dedup import top_per_key
from ..operators.quantiles import exact_quantiles, one_row
from ..session import materialize


def months_present_all(df: DataFrame, key: str, months, month="report_month") -> DataFrame:
    """Keys with a row in every one of the months."""
    per_key = df.filter(F.col(month).isin(*months)).select(key, month).distinct().groupBy(key).agg(
        F.count(F.lit(1)).alias("months_cnt")
    )
    return per_key.filter(F.col("months_cnt") == len(months)).select(key)


def stable_attribute_keys(df: DataFrame, key: str, attribute: str, months, month="report_month") -> DataFrame:
    """Keys present in every month that keep one value of the attribute, with that value."""
    per_key = df.filter(F.col(month).isin(*months)).groupBy(key, month).agg(
        F.min(attribute).alias("lo"), F.max(attribute).alias("hi")
    ).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    keep = (F.col("n") == len(months)) & (F.col("lo") == F.col("hi"))
    return per_key.filter(keep).select(key, F.col("lo").alias(attribute))


def category_by_month_pattern(df: DataFrame, key: str, lake: str, ref: str, months, tol=0.01, month="report_month") -> DataFrame:
    """Keys whose two values agree, or disagree in one way, in every month."""
    n = len(months)
    a, b = F.coalesce(F.col(lake), F.lit(0)), F.coalesce(F.col(ref), F.lit(0))
    equal = F.abs(a - b) <= F.lit(tol)
    per_key = df.filter(F.col(month).isin(*months)).groupBy(key).agg(
        F.countDistinct(month).alias("months_cnt"),
        F.count_if(equal).alias("match_months"),
        F.count_if(~equal).alias("mismatch_months"),
        F.count_if(a > 0).alias("lake_gt_0_months"),
        F.count_if(b == 0).alias("excel_eq_0_months"),
        F.count_if(b > 0).alias("excel_gt_0_months"),
    ).filter(F.col("months_cnt") == n)
    positive = F.col("lake_gt_0_months") == n
    off = (F.col("mismatch_months") == n) & positive
    category = (
        F.when((F.col("match_months") == n) & positive, "match")
        .when(off & (F.col("excel_eq_0_months") == n), "mismatch_excel_zero")
        .when(off & (F.col("excel_gt_0_months") == n), "mismatch_excel_positive")
    )
    return per_key.withColumn("category", category).filter("category is not null")


def ratio_coefficients(df: DataFrame, key: str, base: str, ref: str) -> DataFrame:
    """Reference over base per key; one where both are zero, the median where the ratio is missing. Runs jobs.

    The sums are read for the median's sketch and counts and for the result, so they are drawn from the rows once.
    """
    sums = df.groupBy(key).agg(F.coalesce(F.sum(base), F.lit(0)).alias("base_sum"), F.coalesce(F.sum(ref), F.lit(0)).alias("ref_sum"))
    sums = materialize(sums.withColumn("_k", ratio("ref_sum", "base_sum")))
    median = exact_quantiles(sums, "_k", [0.5]).agg(F.max("p50")).scalar()
    both_zero = (F.col("base_sum") == 0) & (F.col("ref_sum") == 0)
    value = F.when(both_zero, F.lit(1.0)).otherwise(F.coalesce("_k", median, F.lit(1.0)))
    source = F.when(both_zero, "both_zero_eq_1").when(F.col("_k").isNull(), "fallback_global_median").otherwise("agr_ratio")
    return sums.withColumns({"coefficient": value, "coef_source": source}).drop("_k")


def ratio_profile(df: DataFrame, base: str, ref: str) -> DataFrame:
    """Median, mean, minimum and maximum of reference over base where both are positive. Runs jobs.

    All of them need only the ratios, which are drawn from the rows once.
    """
    both = materialize(df.filter((F.col(base) > 0) & (F.col(ref) > 0)).select(ratio(ref, base).alias("_r")))
    stats = both.agg(
        F.count(F.lit(1)).alias("rows"), F.avg("_r").alias("mean"), F.min("_r").alias("min"), F.max("_r").alias("max")
    )
    return one_row(stats, exact_quantiles(both, "_r", [0.5]).toDF("median"))


def hypothesis_product_check(df: DataFrame, base: str, count: str, ref: str) -> DataFrame:
    """Totals of base × count against the reference, where base and reference are positive."""
    both = df.filter((F.col(base) > 0) & (F.col(ref) > 0))
    out = both.agg(F.sum(ref).alias("ref_sum"), F.sum(F.col(base) * F.col(count)).alias("hypothesis_sum"))
    return out.withColumns(
        {"delta": F.col("hypothesis_sum") - F.col("ref_sum"), "ratio": ratio("hypothesis_sum", "ref_sum")}
    )


def ops_month_long(df: DataFrame, key: str, date: str, values) -> DataFrame:
    """Rows and sums per key and month."""
    return df.groupBy(key, F.date_format(date, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(v).alias(v) for v in values]
    )


def ops_month_pivot(long: DataFrame, key: str, values, months) -> DataFrame:
    """One column per value and month."""
    sums = long.groupBy(key, "month").agg(*[F.sum(v).alias(v) for v in values])
    # A key's months travel as one short list; the wide row is made from it at the end, so none is shuffled or held.
    wanted = F.col("month").isin(*months)
    entry = F.when(wanted, F.struct("month", F.struct(*values).alias("_v")))
    wide = sums.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("_m"))
    return wide.select(key, *[F.col("_m")[m][v].alias(f"{v}_{m.replace('-', '_')}") for m in months for v in values])


def first_attributes(df: DataFrame, key: str, order, cols) -> DataFrame:
    """Attributes of the earliest row per key."""
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in cols])
    first = df.groupBy(key).agg(F.min(packed).alias("_f"))
    return first.select(key, *[F.col(f"_f.{c}").alias(c) for c in cols])


def top_n_by_class(df: DataFrame, cls: str, rules: dict, n: int, key: str) -> DataFrame:
    """The first n rows of every class, each class with its own filter and order.

    ``rules`` maps a class to (condition, list of (column, descending)).
    """
    parts = []
    for name, (condition, order) in rules.items():
        sort = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]
        pool = df.filter(F.col(cls) == name)
        if condition is not None:
            pool = pool.filter(condition)
        parts.append(top_per_key(pool, [cls], [*sort, F.col(key)], n))
    return reduce(DataFrame.unionByName, parts)


def top_n_by_mean(df: DataFrame, value: str, n: int, key: str) -> DataFrame:
    """The n keys with the largest mean."""
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(key)).limit(n)
