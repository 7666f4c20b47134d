"""Total income of a company from several sources, and its split over agreements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import month_int
from ..functions.text import norm_inn


def multi_source_max(sources: dict[str, DataFrame], keys: DataFrame, months, value: str = "nbi_ssp") -> DataFrame:
    """Largest source sum per company and month, for every company and every month.

    The sources are tagged and summed together, so all share one shuffle; each
    company meets its months by an array, not by a join.
    """
    names = list(sources)
    tagged = None
    for name in names:
        part = sources[name].select(
            norm_inn("inn").alias("inn"), F.col("yearmm").cast("int").alias("yearmm"),
            F.lit(name).alias("_src"), F.col(value).alias("_v"),
        )
        tagged = part if tagged is None else tagged.unionByName(part)
    skeleton = (
        keys.select(norm_inn("inn").alias("inn"))
        .filter("inn is not null")
        .distinct()
        .withColumn("yearmm", F.explode(F.array(*[F.lit(int(m)) for m in months])))
    )
    scoped = tagged.filter("inn is not null").groupBy("inn", "yearmm").agg(
        *[F.sum(F.when(F.col("_src") == n, F.col("_v"))).alias(f"chod_{n}") for n in names]
    )
    out = skeleton.join(scoped, ["inn", "yearmm"], "left")
    columns = [F.col(f"chod_{n}") for n in names]
    present = [F.when(c.isNotNull(), F.lit(n)) for n, c in zip(names, columns)]
    count = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    return out.withColumns(
        {
            "report_month": F.format_string("%04d-%02d", F.floor(F.col("yearmm") / 100).cast("int"), F.col("yearmm") % 100),
            "total_income": F.greatest(*columns) if len(columns) > 1 else columns[0],
            "src_cnt": count,
            "ok_sources": F.concat_ws(",", *present),
        }
    )


def enrich_total_income(mart: DataFrame, income: DataFrame, order=("agr_id", "n_agr")) -> DataFrame:
    """Company income on every row, and once per company and month as a contribution.

    The contribution sits on the first row of the company's month. That row is
    found by a minimum and joined on its full key, so a company with very many
    rows needs no window over all of them.
    """
    per_key = (
        income.select(norm_inn("inn").alias("_inn"), F.col("yearmm").cast("int").alias("_ym"), "total_income", "src_cnt")
        .dropna(subset=["_inn", "_ym"])
        .groupBy("_inn", "_ym")
        .agg(F.max("total_income").alias("total_income"), F.max("src_cnt").alias("total_income_src_cnt"))
    )
    keyed = mart.withColumns({"_inn": norm_inn("inn"), "_ym": month_int("report_month")})
    ordered = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in order])
    first = keyed.groupBy("_inn", "_ym").agg(F.min(ordered).alias("_first"))
    first = first.join(per_key, ["_inn", "_ym"]).select(
        F.col("_inn").alias("_fi"), F.col("_ym").alias("_fy"),
        *[F.col(f"_first.{c}").alias(f"_f_{c}") for c in order], F.col("total_income").alias("_contrib"),
    )
    on = (F.col("_inn") == F.col("_fi")) & (F.col("_ym") == F.col("_fy"))
    for c in order:
        on = on & (F.coalesce(F.col(c).cast("string"), F.lit("")) == F.col(f"_f_{c}"))
    out = keyed.join(per_key, ["_inn", "_ym"], "left").join(first, on, "left")
    out = out.withColumn("total_income_contrib", F.coalesce("_contrib", F.lit(0)))
    return out.drop("_inn", "_ym", "_fi", "_fy", "_contrib", *[f"_f_{c}" for c in order])


def contribution_drift(enriched: DataFrame) -> DataFrame:
    """Sum over companies and months against the sum of the contributions: zero when additive."""
    per_key = enriched.groupBy("inn", "report_month").agg(
        F.max("total_income").alias("u"), F.sum("total_income_contrib").alias("c"),
        F.count(F.lit(1)).alias("n"), F.count("total_income").alias("filled"),
    )
    zero = F.lit(0)
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.sum("filled").alias("filled_rows"),
        F.coalesce(F.sum("u"), zero).alias("sum_unique"),
        F.coalesce(F.sum("c"), zero).alias("sum_contrib"),
        F.coalesce(F.sum(F.abs(F.coalesce("u", zero) - F.col("c"))), zero).alias("drift"),
    )


def source_month_coverage(df: DataFrame, value: str, sources, month="report_month", key="inn") -> DataFrame:
    """Rows, filled rows, keys and percent filled per month, and filled rows per source."""
    per_key = df.groupBy(month, key).agg(
        F.count(F.lit(1)).alias("_n"), F.count(value).alias("_f"), *[F.count(c).alias(f"_{c}") for c in sources]
    )
    return per_key.groupBy(month).agg(
        F.sum("_n").alias("rows"),
        F.sum("_f").alias("filled"),
        F.count(key).alias("inns"),
        (F.sum("_f").cast("double") / F.sum("_n") * 100).alias("filled_pct"),
        *[F.sum(f"_{c}").alias(f"filled_{c}") for c in sources],
    )
