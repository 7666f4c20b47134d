"""The monthly profitability mart: all months of a period in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.classes import missing_label_list, tariff_class
from ..functions.numbers import bounded_count, coalesce_by_source, money2, profit_formulas
from ..functions.text import blank_to_null, norm_agr, norm_branch, norm_inn
from ..operators.dedup import most_complete_row
from ..operators.mapping import enrich_dims, key_fallback, map_ids_chain
from ..operators.spans import FIRST, LAST, chosen_spans, month_number, month_spans, span_months_with
from ..operators.validity import not_deleted
from ..session import materialize
from . import metrics as m
from .perimeter import agreements_of_class, perimeter
from .products import merge_product_flags

MONEY = (
    "trx_sum", "commission_from_ops", "commission_monthly", "int_component", "commission_total",
    "aur", "amortization", "chod", "fin_result",
)
COUNTS = ("retl_cnt", "active_retl_cnt", "term_cnt", "active_terms", "active_term_cnt", "trx_cnt")


@dataclass(frozen=True)
class MartInputs:
    """Input tables of the mart."""

    agreements: DataFrame
    companies: DataFrame
    terms: DataFrame
    outlets: DataFrame
    devices: DataFrame
    model: DataFrame
    trx: DataFrame
    trx_acq: DataFrame
    trx_int: DataFrame
    fiids: DataFrame
    master: DataFrame
    ext_ids: DataFrame
    core_merchants: DataFrame
    corp: DataFrame
    depart: DataFrame
    branch: DataFrame
    tariff_plan: DataFrame
    tariff_tune: DataFrame
    tariff_fix: DataFrame
    rent: DataFrame
    product_flags: DataFrame | None = None


def core_attributes(core: DataFrame, corp: DataFrame, depart: DataFrame, branch: DataFrame, plan: DataFrame) -> DataFrame:
    """Registration id, office, branch and plan of each organisation of the core system."""
    live = not_deleted(core).filter("c_cl_org is not null")
    one = most_complete_row(
        live, ["c_cl_org"], ["c_tariff_plan", "c_depart"],
        [F.col("id").desc_nulls_last(), F.col("c_tariff_plan").desc_nulls_last(), F.col("c_depart").desc_nulls_last()],
    ).select(
        F.col("id").alias("r2_id"), F.col("c_cl_org").alias("core_id"), "c_depart", F.col("c_tariff_plan").alias("plan_legacy")
    )
    out = enrich_dims(
        one,
        [
            (corp, "core_id", "id", {"ogrn": "ogrn"}),
            (depart, "c_depart", "id", {"c_name": "vsp_name", "c_num": "vsp_code", "c_filial": "_filial"}),
            (branch, "_filial", "id", {"c_shortlabel": "filial_raw"}),
            (plan, "plan_legacy", "id", {"c_name": "tariff_name_legacy"}),
        ],
    )
    return out.withColumn("filial_rf", norm_branch("filial_raw")).drop("_filial", "c_depart", "filial_raw")


def actual_tariffs(agreements: DataFrame, core: DataFrame, plan: DataFrame, fees: DataFrame, start, end):
    """The agreement valid at each month's end per agreement id, as spans of months, and the plan, its name and fee."""
    live = agreements_of_class(agreements).withColumn("_until", F.add_months(F.trunc(F.date_add("d_valid_to", 1), "MM"), -1))
    actual = month_spans(live, start, end, valid_to="_until").select(
        norm_agr("abs_agr_id").alias("agr_id_key"), F.col("n_agr").alias("n_agr_actual"),
        F.col("c_agr_number").alias("contract_number_acq"), F.col("d_valid_from").alias("d_valid_from_actual"),
        F.col("d_valid_to").alias("d_valid_to_actual"), FIRST, LAST,
    )
    payload = ["n_agr_actual", "contract_number_acq", "d_valid_from_actual", "d_valid_to_actual"]
    newest = chosen_spans(
        actual.filter("agr_id_key is not null"), ["agr_id_key"],
        [F.col("d_valid_from_actual").alias("_o_from"), F.col("n_agr_actual").alias("_o_agr")], payload,
    )
    one_plan = not_deleted(core).groupBy(norm_agr("id").alias("agr_id_key")).agg(F.max("c_tariff_plan").alias("c_tariff_plan"))
    named = enrich_dims(one_plan, [(plan, "c_tariff_plan", "id", {"c_name": "tariff_name_actual"})])
    return newest, named.join(fees, "c_tariff_plan", "left").withColumnRenamed(
        "commission_monthly_fix", "commission_monthly_actual"
    )


def monthly_mart(i: MartInputs, start, end, group: str, master_prefix: str, core_prefix: str) -> DataFrame:
    """Agreement × month with counts, commissions, cost, income and result.

    The perimeter and the small totals drawn from large inputs are written to the
    shared folder, so that transactions are read once and lost executors cost little.
    """
    scope = materialize(perimeter(i.agreements, i.companies, i.terms, start, end))
    ids = map_ids_chain(i.master, i.ext_ids, master_prefix, core_prefix).select("inn", "party_id", "zone", "core_id")
    core = core_attributes(i.core_merchants, i.corp, i.depart, i.branch, i.tariff_plan)
    operational = m.operational_metrics(scope, i.terms, i.outlets, i.devices, i.model, start, end).drop("n_cmp_client")
    totals = m.scoped_totals(scope, i.trx, i.trx_acq, i.trx_int, i.fiids, start, end, group)
    trx = materialize(m.totals_per_agreement(totals))
    per_company = trx.groupBy("n_cmp_client", "month_start").agg(F.max("active_term_cnt").alias("active_term_cnt"))
    used = m.outlets_in_use(totals, i.devices)
    newest, plans = actual_tariffs(
        i.agreements, i.core_merchants, i.tariff_plan, m.plan_fee_map(i.tariff_tune, i.tariff_fix), start, end
    )
    targets = m.rent_targets(i.rent, i.terms, i.agreements, i.companies, start, end, by_year=True)
    fees = m.rent_fee_by_key(m.rent_mapping(targets)).select(
        norm_inn("inn").alias("inn_key"), norm_agr("agr_id").alias("agr_id_key"), "month_start", "commission_monthly_mpos"
    )

    df = scope.join(ids, "inn", "left").join(core, "core_id", "left")
    df = key_fallback(df, "agr_id", "r2_id").withColumns(
        {"inn_key": norm_inn("inn"), "agr_id_key": norm_agr("agr_id")}
    )
    df = (
        df.join(operational, m.KEY, "left")
        .join(trx.drop("n_cmp_client", "inn", "active_term_cnt").groupBy(*m.KEY).agg(
            *[F.max(c).alias(c) for c in ("trx_cnt", "trx_sum", "commission_from_ops", "int_component", "active_terms")]
        ), m.KEY, "left")
        .join(used, m.KEY, "left")
        .join(per_company, ["n_cmp_client", "month_start"], "left")
        .join(plans, "agr_id_key", "left")
    )
    newest = newest.withColumnRenamed("agr_id_key", "_r_key")
    valid = (F.col("agr_id_key") == F.col("_r_key")) & month_number("month_start").between(F.col(FIRST), F.col(LAST))
    df = df.join(newest, valid, "left").drop("_r_key", FIRST, LAST)
    df = m.merge_rent_fee(df, fees)
    name, source = coalesce_by_source(
        ["tariff_name_actual", "tariff_name_legacy"], ["agr_id_actual", "legacy_cft"], "legacy_cft", blank_to_null
    )
    df = df.withColumns(
        {
            "tariff_name": name,
            "tariff_source": source,
            "active_retl_cnt": bounded_count("active_retl_cnt", "retl_cnt"),
        }
    ).withColumn("tariff_short", tariff_class("tariff_name"))
    df = profit_formulas(df)
    df = df.withColumns({c: money2(c) for c in MONEY} | {c: F.col(c).cast("long") for c in COUNTS})
    df = df.withColumns({"report_month": F.date_format("month_start", "yyyy-MM"), "snapshot_month_start": F.col("month_start")})
    out = df.select(
        "report_month", "snapshot_month_start", "inn", "company_name", "agr_id", "agr_id_source", "n_agr",
        "contract_number", "d_valid_from", "d_valid_to", "n_agr_actual", "contract_number_acq",
        "d_valid_from_actual", "d_valid_to_actual", "party_id", F.col("zone").alias("ssp_ocrm"), "core_id", "ogrn",
        "filial_rf", "vsp_name", "vsp_code", "tariff_name", "tariff_short", "tariff_source", "term_calc_source",
        *COUNTS, "trx_sum", "commission_from_ops", "commission_monthly_actual", "commission_monthly",
        "commission_monthly_source", "int_component", "commission_total", "aur", "amortization", "chod", "fin_result",
    )
    if i.product_flags is not None:
        out = merge_product_flags(out, i.product_flags).withColumn("recommended_products", missing_label_list())
    return out


def slim_mart(i: MartInputs, start, end, group: str) -> DataFrame:
    """The smallest useful mart: perimeter, transactions and formulas without fees."""
    scope = materialize(perimeter(i.agreements, i.companies, i.terms, start, end, spans=True))
    trx = m.transaction_metrics(scope, i.trx, i.trx_acq, i.trx_int, i.fiids, start, end, group)
    empty = {c: F.lit(0) for c in ("retl_cnt", "commission_monthly", "amortization")}
    df = span_months_with(scope, trx.drop("n_cmp_client", "inn"), "n_agr").withColumns(empty)
    df = profit_formulas(df)
    return df.withColumns({c: money2(c) for c in MONEY}).withColumn(
        "report_month", F.date_format("month_start", "yyyy-MM")
    )


def commission_cascade(actual: str = "commission_monthly_actual", plan: str = "commission_monthly_fix",
                       legacy: str = "commission_monthly_legacy"):
    """Monthly fee by the agreement's own plan, else by the plan map, else from the old system."""
    return coalesce_by_source([actual, plan, legacy], ["actual", "plan_fallback", "legacy"], "none")


def company_scope(agreements: DataFrame) -> DataFrame:
    """Companies behind the live agreements of the class."""
    return agreements_of_class(agreements).select(F.col("n_cmp_client").alias("n_cmp")).distinct()


