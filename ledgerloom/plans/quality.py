"""Data-quality profiles and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null
from ..operators.quantiles import approx_quantiles, exact_quantiles, one_row


def _mean(c: str):
    return F.sum(c).cast("double") / F.count(c)


def numeric_profile(df: DataFrame, value: str, probs=(0.5, 0.9, 0.95, 0.99), exact: bool = True) -> DataFrame:
    """Null, zero and negative counts, range, mean, deviation, quantiles and total of a column."""
    v = F.col(value)
    base = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(v.isNull()).alias("null_cnt"),
        F.count_if(v == 0).alias("zero_cnt"),
        F.count_if(v < 0).alias("negative_cnt"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        _mean(value).alias("avg"),
        F.stddev_samp(v.cast("double")).alias("std"),
        F.sum(v).alias("total"),
    )
    quantiles = (exact_quantiles if exact else approx_quantiles)(df, value, probs)
    return one_row(base, quantiles)


def profile_all_numeric(df: DataFrame, probs=(0.5, 0.95), accuracy: int = 10_000) -> DataFrame:
    """Count, non-zero count, sum, mean, discrete quantiles and maximum of every numeric column.

    The quantiles are exact. A sketch of at most 2,000 only bounds them, since one for a high
    ``accuracy`` holds about as many values of every column in each task.
    """
    columns = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        fields = [
            F.lit(c).alias("column"), F.count(c).alias("non_null_cnt"), F.count_if(F.abs(c) >= 0.01).alias("nonzero_cnt"),
            F.sum(F.col(c)).cast("double").alias("sum"), _mean(c).alias("mean"), F.max(v).alias("max"),
        ]
        aggs.append(F.struct(*fields))
    totals = df.agg(F.array(*aggs).alias("_rows")).select(F.inline("_rows")).filter("non_null_cnt > 0")
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_value")) for c in columns])))
    ranks = exact_quantiles(values, "_value", probs, ["column"], accuracy=min(accuracy, 2_000), discrete=True)
    return totals.join(ranks, "column")


def fill_rates(df: DataFrame, cols, by=()) -> DataFrame:
    """Percent of rows with a value, per column."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.round(F.count(c) * F.lit(100.0) / F.count(F.lit(1)), 2).alias(f"{c}_fill_pct") for c in cols],
    )


def post_load_dq(df: DataFrame, value: str, key="inn", month="yearmm") -> DataFrame:
    """Rows, keys, months, filled rows, sum and repeated keys of a loaded table."""
    per_key = df.groupBy(key, month).agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("f"), F.sum(value).alias("v"))
    return per_key.agg(
        F.sum("n").alias("rows_cnt"),
        F.countDistinct(key).alias("inns"),
        F.countDistinct(month).alias("months_cnt"),
        F.sum("f").alias("filled_rows"),
        F.coalesce(F.sum("v"), F.lit(0)).alias("value_sum"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )


def invariants(df: DataFrame, checks: dict, required=()) -> DataFrame:
    """Violations per named condition; a missing required column is an error at once."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    names = list(checks)
    counts = df.agg(*[F.count_if(~F.coalesce(F.expr(checks[n]), F.lit(False))).alias(f"_{i}") for i, n in enumerate(names)])
    pairs = ", ".join(f"'{n}', `_{i}`" for i, n in enumerate(names))
    return counts.select(F.expr(f"stack({len(names)}, {pairs}) as (check_name, violations)"))


def require_invariants(df: DataFrame, checks: dict, required=()) -> DataFrame:
    """The same rows; the query fails on the first row that breaks a condition."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    for name, condition in checks.items():
        ok = F.assert_true(F.coalesce(F.expr(condition), F.lit(False)), F.lit(f"invariant broken: {name}"))
        df = df.filter(ok.isNull())
    return df


def missing_months(df: DataFrame, expected: DataFrame, month="report_month") -> DataFrame:
    """Expected months without a row."""
    return expected.select(month).join(df.select(month).distinct(), month, "left_anti")


def group_sizes(df: DataFrame, group: str, key: str, empty_label: str = "[ПУСТО]") -> DataFrame:
    """Distinct keys per group, with one bucket for blank groups."""
    label = F.coalesce(blank_to_null(group, ("", "nan", "None", "<NA>")), F.lit(empty_label))
    return df.select(label.alias(group), key).distinct().groupBy(group).agg(F.count(key).alias("keys"))


def attribute_month_summary(df: DataFrame, attribute: str, keyword: str, month="report_month") -> DataFrame:
    """Rows, distinct names, rows with a keyword and empty rows per month."""
    named = df.filter(F.col(month).isNotNull()).withColumn("_a", blank_to_null(attribute))
    per_name = named.groupBy(month, "_a").agg(F.count(F.lit(1)).alias("n"))
    hit = F.lower(F.coalesce("_a", F.lit(""))).contains(keyword)
    out = per_name.groupBy(month).agg(
        F.sum("n").alias("total_rows"),
        F.count("_a").alias("unique_names"),
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("keyword_rows"),
        F.sum(F.when(F.col("_a").isNull(), F.col("n")).otherwise(0)).alias("empty_rows"),
    )
    share = F.round(F.col("keyword_rows") * F.lit(100.0) / F.col("total_rows"), 2)
    return out.withColumn("keyword_share_pct", share)


def attribute_names_by_month(df: DataFrame, attribute: str, month="report_month") -> DataFrame:
    """Distinct names per month."""
    return df.select(month, blank_to_null(attribute).alias(attribute)).dropna().distinct()


def keys_without_attribute(df: DataFrame, key: str, attribute: str, month="report_month") -> DataFrame:
    """Month and key pairs that have a row without the attribute."""
    return df.filter(blank_to_null(attribute).isNull()).select(month, key).dropna().distinct()


def top_by_abs(df: DataFrame, value: str, n: int, tie) -> DataFrame:
    """The n rows with the largest absolute value."""
    return df.filter(F.col(value).isNotNull()).orderBy(F.abs(value).desc(), *tie).limit(n)


def top_by_count(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n most frequent values."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.col("cnt").desc(), F.col(key)).limit(n)


def set_identity(a: DataFrame, b: DataFrame, c: DataFrame, key: str) -> DataFrame:
    """Is A = B \\ C? Sizes of the sets and of both differences, in one pass over tagged keys."""
    tagged = None
    for i, df in enumerate((a, b, c)):
        part = df.select(F.col(key).alias("k"), *[F.lit(int(i == j)).alias(f"s{j}") for j in range(3)])
        tagged = part if tagged is None else tagged.unionByName(part)
    per_key = tagged.filter("k is not null").groupBy("k").agg(*[F.max(f"s{j}").alias(f"s{j}") for j in range(3)])
    expected = (F.col("s1") == 1) & (F.col("s2") == 0)
    in_a = F.col("s0") == 1
    out = per_key.agg(
        F.sum("s0").alias("size_a"), F.sum("s1").alias("size_b"), F.sum("s2").alias("size_c"),
        F.count_if(expected).alias("size_expected"),
        F.count_if(in_a & ~expected).alias("only_in_a"),
        F.count_if(~in_a & expected).alias("missing_from_a"),
    )
    return out.withColumn("identical", ((F.col("only_in_a") == 0) & (F.col("missing_from_a") == 0)).cast("int"))


def set_identity_offenders(a: DataFrame, b: DataFrame, c: DataFrame, key: str) -> DataFrame:
    """Keys that break A = B \\ C, with their side."""
    def keys(df):
        return df.select(key).filter(F.col(key).isNotNull())

    expected = keys(b).subtract(keys(c))
    extra = keys(a).subtract(expected).withColumn("side", F.lit("only_in_a"))
    absent = expected.subtract(keys(a)).withColumn("side", F.lit("missing_from_a"))
    return extra.unionByName(absent)


def key_intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of both tables."""
    return a.select(key).intersect(b.select(key)).filter(F.col(key).isNotNull())


