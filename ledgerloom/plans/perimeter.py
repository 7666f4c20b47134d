"""Which agreements count in a month, and how filters shape that set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import digits_only
from ..operators.spans import FIRST, LAST, merged_spans, month_number, month_spans, monthly_sums, span_months
from ..operators.validity import not_deleted

AGREEMENT_COLUMNS = (
    "n_agr", "agr_id", "n_cmp_client", "contract_number", "d_valid_from", "d_valid_to", "inn", "company_name",
)


def agreements_of_class(agreements: DataFrame, cls: str = "SA", deleted=("1",)) -> DataFrame:
    """Live agreements of one class."""
    wanted = F.upper(F.trim(F.col("acq_class").cast("string"))) == cls
    return not_deleted(agreements, values=deleted).filter(wanted)


def live_companies(companies: DataFrame, deleted=("1",)) -> DataFrame:
    """Companies with a taxpayer id."""
    return (
        not_deleted(companies, values=deleted)
        .filter("c_inn is not null")
        .select(
            F.col("n_cmp").cast("string").alias("n_cmp_client"),
            digits_only("c_inn").alias("inn"),
            F.col("c_cmp_name").alias("company_name"),
        )
        .distinct()
    )


def agreement_heads(agreements: DataFrame, cls: str = "SA") -> DataFrame:
    """Live agreement rows of the class, repeated ones too."""
    return agreements_of_class(agreements, cls).select(
        F.col("n_agr").cast("string").alias("n_agr"),
        F.col("abs_agr_id").cast("string").alias("agr_id"),
        F.col("n_cmp_client").cast("string").alias("n_cmp_client"),
        F.nullif(F.trim("c_agr_number"), F.lit("")).alias("contract_number"),
        "d_valid_from",
        "d_valid_to",
    )


def base_spans(agreements: DataFrame, companies: DataFrame, start, end, cls: str = "SA") -> DataFrame:
    """Agreement rows with their company and the span of months of their validity."""
    heads = agreement_heads(agreements, cls).distinct()
    joined = heads.join(live_companies(companies), "n_cmp_client").select(*AGREEMENT_COLUMNS)
    return month_spans(joined, start, end)


def base_agreements(agreements: DataFrame, companies: DataFrame, start, end, cls: str = "SA") -> DataFrame:
    """Agreement rows with their company, one per month of validity."""
    return span_months(base_spans(agreements, companies, start, end, cls))


def term_rows(terms: DataFrame, start, end) -> DataFrame:
    """Live terms with the span of months that they begin by the end of and end after the first day of."""
    return month_spans(not_deleted(terms).withColumn("_until", F.date_sub("d_valid_to", 1)), start, end, valid_to="_until").drop("_until")


def term_spans(terms: DataFrame, start, end, ter_type: str | None = "P") -> DataFrame:
    """Spans of months, not overlapping, in which an agreement has a live term of the type."""
    live = term_rows(terms, start, end)
    if ter_type is not None:
        live = live.filter(F.upper(F.trim(F.col("cf_ter_type").cast("string"))) == ter_type)
    return merged_spans(live, ["n_agr"])


def term_months(terms: DataFrame, start, end, ter_type: str | None = "P") -> DataFrame:
    """Months in which an agreement has a live term of the type."""
    return span_months(term_spans(terms, start, end, ter_type))


def within(base: DataFrame, spans: DataFrame) -> DataFrame:
    """The parts of an agreement's spans that lie in other spans of it; those must not overlap."""
    others = spans.withColumnsRenamed({FIRST: "_from", LAST: "_to"})
    both = base.join(others, "n_agr").withColumns({FIRST: F.greatest(FIRST, "_from"), LAST: F.least(LAST, "_to")})
    return both.filter(F.col(FIRST) <= F.col(LAST)).drop("_from", "_to")


def perimeter(
    agreements: DataFrame, companies: DataFrame, terms: DataFrame, start, end, cls: str = "SA", ter_type: str = "P", spans: bool = False
) -> DataFrame:
    """Active agreements with an active term of one type, per month of [start, end]; with ``spans`` per span of months."""
    # Agreements lie by their number when they are made distinct and meet their terms; the months expand last, so no month is shuffled.
    heads = agreement_heads(agreements, cls).filter("n_agr is not null").repartition("n_agr").distinct()
    rows = within(month_spans(heads, start, end), term_spans(terms, start, end, ter_type)).join(live_companies(companies), "n_cmp_client")
    if spans:
        return rows.select(*AGREEMENT_COLUMNS, FIRST, LAST)
    return span_months(rows).select("n_agr", "month_start", *AGREEMENT_COLUMNS[1:])


def perimeter_funnel(
    agreements: DataFrame, companies: DataFrame, terms: DataFrame, start, end, ter_type="P", group="HOME"
) -> DataFrame:
    """Distinct taxpayer ids per month after each filter of the perimeter."""
    base = base_spans(agreements, companies, start, end).select("n_agr", "inn", FIRST, LAST)
    typed = F.coalesce(F.upper(F.trim("cf_ter_type")) == ter_type, F.lit(False))
    grouped = typed & F.coalesce(F.upper(F.trim("c_fiid_grp")) == group, F.lit(False))
    # One pass over the terms gives all three filters.
    kinds = F.array_compact(F.array(F.lit(2), F.when(typed, 3), F.when(grouped, 4)))
    terms_of = merged_spans(term_rows(terms, start, end).withColumn("_stage", F.explode(kinds)), ["n_agr", "_stage"])
    passed = base.withColumn("_stage", F.lit(1)).unionByName(within(base, terms_of))
    per_inn = merged_spans(passed, ["_stage", "inn"])
    names = [f"s{i}" for i in range(1, 5)]
    totals = monthly_sums(per_inn.withColumns({f"s{i}": (F.col("_stage") == i).cast("int") for i in range(1, 5)}), [], names)
    stages = ["01_base_agreements", "02_plus_terms_active", "03_plus_ter_type", "04_plus_group"]
    pairs = ", ".join(f"'{name}', s{i}" for i, name in enumerate(stages, 1))
    return totals.select("month_start", F.expr(f"stack({len(stages)}, {pairs}) as (stage, inn_cnt)"))


def expanded_vs_current_perimeter(
    agreements: DataFrame, companies: DataFrame, terms: DataFrame, report_keys: DataFrame, start, end
) -> DataFrame:
    """Coverage of a report's keys by the perimeter with and without the term filter, per month."""
    base = base_spans(agreements, companies, start, end).filter("agr_id is not null").select("n_agr", "agr_id", "inn", FIRST, LAST)
    key = ["inn", "agr_id"]
    held = {"expanded": merged_spans(base, key), "current": merged_spans(within(base, term_spans(terms, start, end)), key)}
    wanted = report_keys.select("month_start", *key).distinct().withColumn("_month", month_number("month_start"))
    spans = [d.select(FIRST, LAST, *[F.lit(int(n == x)).alias(f"{x}_keys") for x in held]) for n, d in held.items()]
    sums = monthly_sums(spans[0].unionByName(spans[1]), [], [f"{n}_keys" for n in held])
    # A report's key meets the spans of its agreement id; at most one holds its month.
    marks = wanted
    for name, d in held.items():
        ends = d.select(*[F.col(c).alias(f"_r_{c}") for c in key], F.col(FIRST).alias("_from"), F.col(LAST).alias("_to"))
        met = F.col("_month").between(F.col("_from"), F.col("_to"))
        for c in key:
            met = met & (F.col(c) == F.col(f"_r_{c}"))
        marks = marks.join(ends, met, "left").withColumn(f"covered_{name}", F.col("_from").isNotNull().cast("int"))
        marks = marks.select("month_start", *key, "_month", *[c for c in marks.columns if c.startswith("covered_")])
    marks = marks.groupBy("month_start").agg(
        F.count(F.lit(1)).alias("report_keys"), *[F.sum(f"covered_{n}").alias(f"covered_{n}") for n in held]
    )
    names = ["report_keys", "current_keys", "expanded_keys", "covered_current", "covered_expanded"]
    both = sums.unionByName(marks, allowMissingColumns=True).groupBy("month_start").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    )
    return both.withColumns({
        "added_keys": F.col("expanded_keys") - F.col("current_keys"),
        "covered_gain": F.col("covered_expanded") - F.col("covered_current"),
    })
