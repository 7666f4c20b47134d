"""Dashboard datasets and key figures over the published all-text mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as fv
from ..functions.classes import cohort_flags, label_list, sign_bucket
from ..functions.numbers import month_key, passive_terms, text_num
from ..functions.text import blank_label, empty_to_null

CLIENT = ("agr_id", "inn", "company_name", "tariff_short", "filial_filter", "ssp_ocrm_filter")


def typed(published: DataFrame, numbers=(), dates=()) -> DataFrame:
    """Published text columns with their types back."""
    out = published.select(
        month_key("report_month").alias("report_month"),
        *[empty_to_null(c).alias(c) for c in ("agr_id", "inn", "company_name", "tariff_short")],
        blank_label("filial_rf", fv.NO_BRANCH_LABEL).alias("filial_filter"),
        blank_label("ssp_ocrm", fv.NO_ZONE_LABEL).alias("ssp_ocrm_filter"),
        *[text_num(c).alias(c) for c in numbers],
        *[empty_to_null(c).try_cast("date").alias(c) for c in dates],
    )
    return out.filter("report_month is not null")


def client_month(published: DataFrame) -> DataFrame:
    """Client × month with an activity flag and sums."""
    rows = typed(published, ("term_cnt", "active_terms", "chod", "fin_result", "trx_sum", "trx_cnt"))
    return rows.filter("agr_id is not null").groupBy("report_month", *CLIENT).agg(
        F.max((F.col("active_terms") > 0).cast("int")).alias("is_active_client"),
        F.sum("term_cnt").alias("term_cnt"),
        F.sum("active_terms").alias("active_terms"),
        F.sum("trx_sum").alias("trx_sum"),
        F.sum("trx_cnt").alias("trx_cnt"),
        F.sum("chod").alias("chod_sum"),
        F.sum("fin_result").alias("fin_result_sum"),
    )


def ds_client_months_upto(published: DataFrame, selected=None) -> DataFrame:
    """Clients of all months up to each selected month; the latest month when none is selected.

    A row meets its anchor months through an array; later months are dropped
    before the aggregation.
    """
    rows = published
    if selected:
        anchors = F.array(*[F.lit(s) for s in sorted(set(selected))])
        rows = published.filter(month_key("report_month") <= F.lit(max(selected)))
    else:
        anchors = None
    base = client_month(rows)
    base = base.withColumns(
        {
            "is_passive_client": F.lit(1) - F.col("is_active_client"),
            "passive_terms": passive_terms("term_cnt", "active_terms"),
            **cohort_flags("chod_sum"),
        }
    ).withColumnRenamed("report_month", "point_report_month")
    if anchors is None:
        # Every month is up to the latest one.
        latest = published.filter(empty_to_null("agr_id").isNotNull()).agg(F.max(month_key("report_month"))).scalar()
        return base.withColumn("report_month", latest)
    reached = F.filter(anchors, lambda a: a >= F.col("point_report_month"))
    return base.withColumn("report_month", F.explode(reached))


def monthly_activity_cohorts(published: DataFrame) -> DataFrame:
    """Active, passive and cohort counts of clients, and turnover, per month."""
    rows = typed(published, ("active_terms", "chod", "trx_sum")).filter("agr_id is not null")
    per_client = rows.groupBy("report_month", "agr_id").agg(
        F.max((F.col("active_terms") > 0).cast("int")).alias("active"),
        F.sum("chod").alias("chod_sum"),
        F.sum("trx_sum").alias("trx_sum"),
    )
    flags = cohort_flags("chod_sum")
    return per_client.withColumns(flags).groupBy(F.col("report_month").alias("point_report_month")).agg(
        F.sum("active").alias("active_clients_cnt"),
        F.sum(1 - F.col("active")).alias("passive_clients_cnt"),
        *[F.sum(name).alias(f"{name}_cnt") for name in flags],
        F.sum("trx_sum").alias("trx_sum_total"),
    )


def ds_months_upto_all(published: DataFrame) -> DataFrame:
    """Monthly figures for every month as anchor with all months up to it."""
    # A row per month: the table is as short as the calendar, and one group of it is too.
    monthly = monthly_activity_cohorts(published)
    whole = monthly.agg(F.collect_list(F.struct("*")).alias("_rows"))
    anchored = whole.select(F.explode("_rows").alias("_m"), F.expr("_rows.point_report_month").alias("_anchors"))
    rows = anchored.select("_m.*", F.explode("_anchors").alias("report_month"))
    return rows.filter(F.col("report_month") >= F.col("point_report_month"))


def ds_anchor_boundary_check(dataset: DataFrame) -> DataFrame:
    """First, last and number of months behind each anchor."""
    months = dataset.select("report_month", "point_report_month").distinct()
    return months.groupBy("report_month").agg(
        F.min("point_report_month").alias("min_point_report_month"),
        F.max("point_report_month").alias("max_point_report_month"),
        F.count(F.lit(1)).alias("point_months_cnt"),
    )


def ds_client_income_bucket(published: DataFrame) -> DataFrame:
    """Client × month with its bucket by the sign of income, and the company's total income."""
    rows = typed(published, ("chod", "total_income", "total_income_contrib")).filter("agr_id is not null")
    out = rows.groupBy("report_month", *CLIENT).agg(
        F.sum("chod").alias("chod_sum"),
        F.max("total_income").alias("total_income"),
        F.sum("total_income_contrib").alias("total_income_contrib"),
    )
    return out.withColumn("client_bucket", sign_bucket("chod_sum"))


def bucket_by_inn_metrics(bucketed: DataFrame) -> DataFrame:
    """Companies, income and companies with negative total income per month and bucket."""
    per_inn = bucketed.groupBy("report_month", "client_bucket", "inn").agg(
        F.sum("chod_sum").alias("chod_sum"), F.max((F.col("total_income") < 0).cast("int")).alias("negative")
    )
    return per_inn.groupBy("report_month", "client_bucket").agg(
        F.count("inn").alias("inn_cnt"),
        F.sum("chod_sum").alias("chod_sum"),
        F.coalesce(F.sum(F.when(F.col("inn").isNotNull(), F.col("negative"))), F.lit(0)).alias("negative_total_income_cnt"),
    )


def ds_client_products(published: DataFrame, labels=fv.PRODUCT_LABELS) -> DataFrame:
    """Company × month with its products and recommendations as text."""
    rows = published.select(
        month_key("report_month").alias("report_month"),
        *[empty_to_null(c).alias(c) for c in ("inn", "company_name", "recommended_products", "tariff_short")],
        blank_label("filial_rf", fv.NO_BRANCH_LABEL).alias("filial_filter"),
        blank_label("ssp_ocrm", fv.NO_ZONE_LABEL).alias("ssp_ocrm_filter"),
        *[text_num(c).alias(c) for c in labels],
    ).filter("inn is not null and report_month is not null")
    labelled = rows.withColumn("client_products", F.nullif(F.trim(label_list(labels)), F.lit("")))
    columns = ("company_name", "client_products", "recommended_products", "filial_filter", "ssp_ocrm_filter", "tariff_short")
    return labelled.groupBy("report_month", "inn").agg(*[F.max(c).alias(c) for c in columns])


def client_kpis(published: DataFrame) -> DataFrame:
    """Total, active, passive, new and terminated clients per month."""
    rows = typed(published, ("active_terms",), ("d_valid_from", "d_valid_to")).filter("agr_id is not null")
    month = F.concat(F.col("report_month"), F.lit("-01")).try_cast("date")

    def ever(condition):
        return F.max(F.coalesce(condition, F.lit(False)).cast("int"))

    per_client = rows.groupBy("report_month", "agr_id").agg(
        ever(F.col("active_terms") > 0).alias("active"),
        ever(F.trunc("d_valid_from", "MM") == month).alias("new"),
        ever(F.trunc("d_valid_to", "MM") == month).alias("gone"),
    )
    return per_client.groupBy("report_month").agg(
        F.count(F.lit(1)).alias("clients_total"),
        F.sum("active").alias("clients_active"),
        F.sum(1 - F.col("active")).alias("clients_passive"),
        F.sum("new").alias("clients_new_contracts"),
        F.sum("gone").alias("clients_terminated_contracts"),
    )


def client_sets(published: DataFrame) -> DataFrame:
    """Clients per month in the sets that the key figures count, as rows for ``keysets.month_key_sets``."""
    rows = typed(published, ("active_terms",), ("d_valid_from", "d_valid_to")).filter("agr_id is not null")
    month = F.concat(F.col("report_month"), F.lit("-01")).try_cast("date")
    sets = F.array_compact(F.array(
        F.lit("all"),
        F.when(F.col("active_terms") > 0, "active"),
        F.when(F.trunc("d_valid_from", "MM") == month, "new"),
        F.when(F.trunc("d_valid_to", "MM") == month, "gone"),
    ))
    return rows.select("report_month", F.explode(sets).alias("set"), F.col("agr_id").alias("key"))


def client_kpis_of_sets(sets: DataFrame) -> DataFrame:
    """The figures of ``client_kpis`` from stored bitmaps."""
    def size(of):
        return F.coalesce(F.sum(F.when(F.col("set") == of, F.bitmap_count("bits"))), F.lit(0))

    return sets.groupBy("report_month").agg(
        size("all").alias("clients_total"),
        size("active").alias("clients_active"),
        (size("all") - size("active")).alias("clients_passive"),
        size("new").alias("clients_new_contracts"),
        size("gone").alias("clients_terminated_contracts"),
    )


def outlet_terminal_kpis(published: DataFrame) -> DataFrame:
    """Outlets and devices, in use and not, per month; also outlets of clients in use."""
    rows = typed(published, ("retl_cnt", "active_retl_cnt", "term_cnt", "active_terms"))
    in_use = F.col("active_terms") > 0
    return rows.groupBy("report_month").agg(
        F.sum("retl_cnt").alias("merchants_total"),
        F.sum("active_retl_cnt").alias("merchants_active"),
        (F.sum("retl_cnt") - F.sum("active_retl_cnt")).alias("merchants_passive"),
        F.sum(F.when(in_use, F.col("retl_cnt")).otherwise(0)).alias("merchants_active_proxy"),
        F.sum(F.when(~in_use, F.col("retl_cnt")).otherwise(0)).alias("merchants_passive_proxy"),
        F.sum("term_cnt").alias("terminals_total"),
        F.sum("active_terms").alias("terminals_active"),
        (F.sum("term_cnt") - F.sum("active_terms")).alias("terminals_passive"),
    )


def result_kpis(published: DataFrame) -> DataFrame:
    """Clients and sums by sign of the result; both parts add up to the whole."""
    rows = typed(published, ("fin_result",))
    per_client = rows.groupBy("report_month", "agr_id").agg(
        F.max((F.col("fin_result") > 0).cast("int")).alias("positive"),
        F.sum("fin_result").alias("total"),
        F.sum(F.when(F.col("fin_result") > 0, F.col("fin_result")).otherwise(0)).alias("gain"),
    )
    client = F.col("agr_id").isNotNull()
    all_clients, positive = F.count("agr_id"), F.coalesce(F.sum(F.when(client, F.col("positive"))), F.lit(0))
    return per_client.groupBy("report_month").agg(
        all_clients.alias("clients_total"),
        positive.alias("clients_positive"),
        (all_clients - positive).alias("clients_negative_or_zero"),
        F.sum("total").alias("result_total"),
        F.sum("gain").alias("result_positive"),
        (F.sum("total") - F.sum("gain")).alias("result_negative"),
    )


def income_bucket_table(published: DataFrame) -> DataFrame:
    """Clients and income in millions per month and sign of a row's income."""
    rows = typed(published, ("chod",)).filter("agr_id is not null").withColumn("chod_bucket", sign_bucket("chod"))
    per_client = rows.groupBy("report_month", "chod_bucket", "agr_id").agg(
        F.sum("chod").alias("chod"), F.max((F.col("chod") < 0).cast("int")).alias("negative")
    )
    return per_client.groupBy("report_month", "chod_bucket").agg(
        F.count(F.lit(1)).alias("clients_cnt"),
        F.round(F.sum("chod").cast("double") / F.lit(1000000.0), 4).alias("chod_sum_mln"),
        F.sum("negative").alias("neg_chod_clients_cnt"),
    )


def bucket_convergence(published: DataFrame) -> DataFrame:
    """Totals of clients and income, directly and through the sign buckets, per month."""
    per_client = typed(published, ("chod",)).filter("agr_id is not null").groupBy("report_month", "agr_id").agg(
        F.sum("chod").alias("chod_sum")
    )
    per_bucket = per_client.groupBy(
        "report_month", sign_bucket("chod_sum", ("pos", "neg", "zero")).alias("bucket")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("chod_sum").alias("v"))
    from_buckets = per_bucket.groupBy("report_month").agg(
        F.sum("n").alias("actual_clients_total_from_buckets"),
        F.sum("v").alias("actual_chod_total_from_buckets"),
        *[F.coalesce(F.sum(F.when(F.col("bucket") == b, F.col("n"))), F.lit(0)).alias(f"{b}_clients")
          for b in ("pos", "neg", "zero")],
    )
    direct = per_client.groupBy("report_month").agg(
        F.count(F.lit(1)).alias("expected_clients_total"), F.sum("chod_sum").alias("expected_chod_total")
    )
    return direct.join(from_buckets, "report_month")


def month_smoke(published: DataFrame) -> DataFrame:
    """Rows, agreements and money totals per month."""
    money = ("amortization", "chod", "aur", "fin_result", "total_income_contrib")
    per_client = typed(published, money).groupBy("report_month", "agr_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in money]
    )
    return per_client.groupBy("report_month").agg(
        F.sum("n").alias("rows_cnt"), F.count("agr_id").alias("agr_nunique"), *[F.sum(c).alias(f"{c}_sum") for c in money]
    )


def formula_drift(published: DataFrame) -> DataFrame:
    """Sum of row errors of result = income − cost − amortization."""
    rows = published.select(*[text_num(c).alias(c) for c in ("fin_result", "chod", "aur", "amortization")])
    error = F.abs(F.col("fin_result") - (F.col("chod") - F.col("aur") - F.col("amortization")))
    return rows.agg(F.sum(error).alias("abs_fin_result_formula_drift"))
