"""Straight-line write-off of devices by month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as fv
from ..functions.classes import age_bucket
from ..functions.numbers import months_between_cal
from ..functions.text import blank_to_null, clean_text, empty_to_null
from ..operators.mapping import two_key_lookup
from ..operators.quantiles import counted_quantiles, exact_quantiles
from ..operators.spans import (
    FIRST, LAST, chosen_spans, cut_spans, merged_spans, month_number, month_of, month_spans, monthly_sums, span_months, stretched_sums,
)
from ..operators.validity import not_deleted
from ..session import materialize

EPOCH = "1900-01-01"
# Ages in months where a range of ``age_bucket`` begins.
AGE_BOUNDS = (0, 12, 24, 36, 48)


def device_rows(devices: DataFrame, delivery: bool = True) -> DataFrame:
    """Distinct intervals of device codes with a serial, and the serial's first delivery; without it, repeated ones too."""
    live = not_deleted(devices).filter("c_pos_serial is not null")
    if not delivery:
        return live.filter("c_nter is not null").select("c_nter", "c_pos_serial", "d_ter_install", "d_ter_close")
    first = live.filter("d_ter_delivery is not null").groupBy("c_pos_serial").agg(
        F.min("d_ter_delivery").alias("first_d_ter_delivery")
    )
    rows = live.filter("c_nter is not null").select("c_nter", "c_pos_serial", "d_ter_install", "d_ter_close").distinct()
    return rows.join(first, "c_pos_serial", "left")


def pick_spans(rows: DataFrame, start, end) -> DataFrame:
    """Spans of months per device code that don't overlap, each with the latest interval that touches its months."""
    known = rows.withColumn("_from", F.coalesce("d_ter_install", F.lit(EPOCH).cast("date")))
    order = [F.col("_from"), F.coalesce("d_ter_close", F.lit(fv.OPEN_END).cast("date")).alias("_to"), F.col("c_pos_serial").alias("_serial")]
    payload = [c for c in rows.columns if c != "c_nter"]
    return chosen_spans(month_spans(known, start, end, "_from", "d_ter_close"), ["c_nter"], order, payload)


def device_months(devices: DataFrame, start, end, spans: bool = False, delivery: bool = True) -> DataFrame:
    """One row per month and active device code, with the serial's first delivery if wanted; with ``spans`` one per span of months."""
    picked = pick_spans(device_rows(devices, delivery), start, end)
    return picked if spans else span_months(picked)


def price_lookup(devices: DataFrame, catalog: DataFrame, prices: DataFrame) -> DataFrame:
    """Model by device id, else by device code, and the model's price."""
    models = catalog.withColumn("model_device", blank_to_null("model_device"))
    by_id = models.select(F.col("device").alias("c_nter"), "model_device")
    by_code = models.select(F.col("code_device").alias("c_nter"), "model_device")
    out = two_key_lookup(devices, by_id, by_code, "c_nter", "model_device")
    price = (
        prices.select(F.upper(clean_text("model_name")).alias("model_key"), "price")
        .dropna()
        .groupBy("model_key")
        .agg(F.max("price").alias("price"))
    )
    return out.withColumn("model_key", F.upper(clean_text("model_device"))).join(price, "model_key", "left")


def straight_line(df: DataFrame, life: int = fv.DEVICE_LIFE_MONTHS) -> DataFrame:
    """Status, age, window flag and monthly write-off of each device month."""
    status = (
        F.when(empty_to_null("c_pos_serial").isNull(), "missing_serial")
        .when(F.col("first_d_ter_delivery").isNull(), "missing_deliver")
        .when(F.col("model_key").isNull(), "missing_model")
        .when(F.col("price").isNull(), "missing_price")
        .otherwise("complete")
    )
    out = df.withColumn("qc_status", status)
    age = F.when(F.col("qc_status") == "complete", months_between_cal("first_d_ter_delivery", "month_start"))
    inside = F.coalesce((F.col("months_from_start") >= 0) & (F.col("months_from_start") < life), F.lit(False))
    monthly = F.col("price").cast("double") / F.lit(float(life))
    out = out.withColumn("months_from_start", age)
    out = out.withColumns(
        {
            "is_in_window": inside.cast("int"),
            "amortization_monthly": monthly,
            "amortization_for_report_month": F.when(inside, F.coalesce(monthly, F.lit(0.0))).otherwise(0.0),
            "age_bucket": age_bucket("months_from_start"),
        }
    )
    return out.withColumn("is_amortized", (F.col("amortization_for_report_month") > 0).cast("int"))


def age_stretches(spans: DataFrame, life: int = fv.DEVICE_LIFE_MONTHS) -> DataFrame:
    """Spans cut where a device's age passes a bound, with their first month and the number of ``months``.

    All months of a stretch have the same status, age range, window flag and write-off.
    """
    born = month_number("first_d_ter_delivery")
    cut = cut_spans(spans.withColumn("_cuts", F.array(*[born + n for n in sorted({*AGE_BOUNDS, life})])), "_cuts")
    cut = cut.withColumns({"month_start": month_of(FIRST), "months": F.col(LAST) - F.col(FIRST) + 1})
    return cut.drop("_cuts", FIRST, LAST)


def amortization_model(devices: DataFrame, catalog: DataFrame, prices: DataFrame, start, end, stretches: bool = False) -> DataFrame:
    """Device months with price and write-off; with ``stretches`` one row per stretch of like months (``age_stretches``).

    Delivery, model and price belong to the device, so they are looked up before
    its months are expanded.
    """
    spans = pick_spans(price_lookup(device_rows(devices), catalog, prices), start, end)
    rows = age_stretches(spans) if stretches else span_months(spans)
    return straight_line(rows).withColumn("snapshot_month_start", F.col("month_start"))


def month_count(model: DataFrame) -> Column:
    """How many device months a row of the model stands for."""
    return F.col("months") if "months" in model.columns else F.lit(1)


def amort_qc(model: DataFrame, by: str = "qc_status") -> DataFrame:
    """Rows and distinct devices per status or per join key."""
    label = F.coalesce(F.col(by), F.lit("no_match")).alias(by)
    per_device = model.groupBy(label, "c_nter").agg(F.sum(month_count(model)).alias("n"))
    return per_device.groupBy(by).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("terminals_nunique"))


def amort_by_age(model: DataFrame) -> DataFrame:
    """Rows and write-off per age range."""
    n = month_count(model)
    return model.groupBy("age_bucket").agg(
        F.sum(n).alias("rows"), F.sum(F.col("amortization_for_report_month") * n).alias("amortization")
    )


def amort_volume(devices: DataFrame, catalog: DataFrame, prices: DataFrame, start, end, life: int = fv.DEVICE_LIFE_MONTHS) -> DataFrame:
    """Rows, devices, serials, write-off and prices in the window, per month.

    The figures of ``amortization_model`` without its row per device and month: the interval that
    is the latest in a month becomes spans, their ends signed events, and running sums give the
    counts. Spans of a serial are merged first, so that it counts once. Write-off and prices follow
    from counts per price, which are whole numbers, so nothing is lost when they cancel.
    """
    spans = pick_spans(price_lookup(device_rows(devices), catalog, prices), start, end)
    complete = empty_to_null("c_pos_serial").isNotNull() & F.col("model_key").isNotNull() & F.col("price").isNotNull()
    born = F.when(complete, month_number("first_d_ter_delivery"))
    inside = F.struct(
        F.lit("inside").alias("kind"), F.col("price"),
        F.greatest(F.col(FIRST), born).alias(FIRST), F.least(F.col(LAST), born + life - 1).alias(LAST),
    )
    whole = F.struct(F.lit("rows").alias("kind"), F.lit(None).cast(spans.schema["price"].dataType).alias("price"), F.col(FIRST), F.col(LAST))
    rows = spans.select(F.inline(F.array(whole, F.when(born.isNotNull(), inside)))).filter(F.col(FIRST) <= F.col(LAST))
    serials = merged_spans(spans, ["c_pos_serial"]).select(F.lit("serials").alias("kind"), F.lit(None).alias("price"), FIRST, LAST)
    # A row per price and month; totals and median are drawn from it.
    held = materialize(monthly_sums(rows.unionByName(serials).withColumn("n", F.lit(1)), ["kind", "price"], ["n"]))

    def total(condition, amount="n"):
        return F.coalesce(F.sum(F.when(condition, F.col(amount))), F.lit(0))

    kept = F.col("kind") == "inside"
    held = held.withColumn("_value", F.col("price").cast("double") / F.lit(float(life)) * F.col("n"))
    totals = held.groupBy("month_start").agg(
        total(F.col("kind") == "rows").alias("rows_cnt"),
        total(F.col("kind") == "serials").alias("serial_nunique"),
        total(kept).alias("in_window_cnt"),
        total(kept & (F.col("price") > 0)).alias("amort_pos_cnt"),
        total(kept, "_value").cast("double").alias("amortization_total"),
        (F.sum(F.when(kept, F.col("price") * F.col("n"))).cast("double") / F.nullif(total(kept), F.lit(0))).alias("avg_price_in_window"),
    )
    median = counted_quantiles(held.filter(kept), "price", "n", [0.5], ["month_start"]).withColumnRenamed("p50", "med_price_in_window")
    return totals.join(median, "month_start", "left")


def price_quantiles(model: DataFrame, probs=(0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Quantiles of the price of devices with a positive write-off."""
    return exact_quantiles(model.filter("is_amortized = 1"), "price", probs, n="months" if "months" in model.columns else None)


def handover_flags(spans: DataFrame, client: str = "n_cmp", month_col: str = "month_start") -> DataFrame:
    """Serials under several device codes in a month: closed under one and installed under another, or held by several clients.

    Takes spans of device codes (``device_months``), whose ends become signed events, so that no row
    per device and month is shuffled. Like spans of a serial are counted first, so that a serial with
    very many codes has few rows; these lie by serial when they become events.
    """
    closed, opened = month_number("d_ter_close"), month_number("d_ter_install")
    before = Window.partitionBy("c_pos_serial", client).orderBy(FIRST, LAST).rowsBetween(Window.unboundedPreceding, -1)
    # The months in which no earlier span of the serial and client stands.
    own = F.when(F.col(client).isNotNull(), F.greatest(F.col(FIRST), F.max(LAST).over(before) + 1))
    inside = {c: F.when(m.between(F.col(FIRST), F.col(LAST)), m) for c, m in (("_closed", closed), ("_opened", opened))}
    shape = ["c_pos_serial", FIRST, LAST, "_own", "_closed", "_opened"]
    rows = spans.withColumn("_own", own).withColumns(inside).groupBy(*shape).agg(F.count(F.lit(1)).alias("_n")).repartition("c_pos_serial")
    names = ("n_c_nter", "n_client", "n_closed", "n_opened", "n_both")

    def part(name, first, last):
        return F.struct(first.alias(FIRST), last.alias(LAST), *[(F.col("_n") if x == name else F.lit(0).cast("long")).alias(x) for x in names])

    def day(name, month, condition=F.lit(True)):
        return F.when(condition & month.isNotNull(), part(name, month, month))

    closed, opened = F.col("_closed"), F.col("_opened")
    parts = F.array(
        part("n_c_nter", F.col(FIRST), F.col(LAST)),
        F.when(F.col("_own") <= F.col(LAST), part("n_client", F.col("_own"), F.col(LAST))),
        day("n_closed", closed), day("n_opened", opened), day("n_both", closed, closed == opened),
    )
    single = rows.select("c_pos_serial", F.inline(F.filter(parts, lambda p: p.isNotNull())))
    n, many = F.col("n_c_nter"), F.col("n_c_nter") >= 2
    handed = (
        many & (F.col("n_closed") > 0) & (F.col("n_opened") > 0)
        & ((F.col("n_closed") > F.col("n_both")) | (F.col("n_opened") > F.col("n_both")) | (F.col("n_closed") >= 2))
    )
    moved = many & (F.col("n_client") >= 2)
    per_serial = stretched_sums(single, ["c_pos_serial"], names).withColumns({
        "close_then_install": handed.cast("int"),
        "handover_same_month": moved.cast("int"),
        "extra_c_nter_rows": F.when(moved, n - 1).otherwise(0),
    })
    return span_months(per_serial, month_col)
