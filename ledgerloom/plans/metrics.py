"""Outlet, device, transaction and fee metrics per agreement and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv
from ..functions.text import digits_only, empty_to_null
from ..operators.dedup import latest_version, unique_map_only
from ..operators.spans import (
    FIRST, LAST, merged_spans, month_number, month_of, month_spans, monthly_sums, span_months, stretched_sums,
)
from ..operators.validity import not_deleted
from ..session import materialize
from .perimeter import agreements_of_class, live_companies

KEY = ["n_agr", "month_start"]


def serial_key(serial="c_pos_serial", code="c_nter") -> Column:
    """Physical device: its serial number, else a key made of the device code."""
    return F.coalesce(empty_to_null(serial), F.concat(F.lit("code:"), F.col(code)))


def outlet_places(
    scope: DataFrame, terms: DataFrame, outlets: DataFrame, start, end,
    reserved_prefix: str = fv.RESERVED_OUTLET_PREFIX, excluded_class: str = "SV",
) -> DataFrame:
    """Outlets per agreement and month: by the agreement's terms, else by its company (``main`` = 0)."""
    sa = scope.select(*KEY, "n_cmp_client").distinct()
    live = not_deleted(outlets).filter("c_nmrc is not null")
    regular = live.filter(
        ~F.upper(F.coalesce(F.trim("c_mrc_name"), F.lit(""))).startswith(reserved_prefix)
        & (F.coalesce(F.upper(F.trim("acq_class")), F.lit("NA")) != excluded_class)
    ).select("c_nmrc").distinct()
    spans = month_spans(not_deleted(terms).filter("c_nmrc is not null"), start, end).select("n_agr", "c_nmrc", FIRST, LAST).distinct()
    spans = merged_spans(spans.join(regular, "c_nmrc", "left_semi"), ["n_agr", "c_nmrc"])
    # An agreement's months are one value of at most a number for each month of the period.
    held = sa.groupBy("n_agr").agg(F.collect_set(month_number("month_start")).alias("_months"))
    reached = F.filter("_months", lambda x: x.between(F.col(FIRST), F.col(LAST)))
    by_term = spans.join(held, "n_agr").select("n_agr", "c_nmrc", F.explode(reached).alias("_month")).select(
        "n_agr", month_of("_month").alias("month_start"), "c_nmrc"
    )
    missing = sa.join(by_term.select(*KEY).distinct(), KEY, "left_anti")
    owned = live.select(F.col("n_cmp").alias("n_cmp_client"), "c_nmrc").distinct()
    by_company = missing.join(owned, "n_cmp_client").select(*KEY, "c_nmrc").distinct()
    return by_term.withColumn("main", F.lit(1)).unionByName(by_company.withColumn("main", F.lit(0)))


def fitted_devices(devices: DataFrame, start, end) -> DataFrame:
    """Live devices that were installed, with the span of months in which each stands at an outlet."""
    fitted = not_deleted(devices).filter("d_ter_install is not null and c_nmrc is not null")
    return month_spans(fitted, start, end, "d_ter_install", "d_ter_close").select(
        "c_nmrc", "c_pos_serial", "c_nter", FIRST, LAST
    ).distinct()


def stays(fitted: DataFrame) -> DataFrame:
    """Spans in which a counted device stands at an outlet, and whether it also stands elsewhere.

    By the terms (``main`` = 1) a device counts by its serial number, by the company by its code.
    """
    counted = F.array(
        F.struct(F.lit(1).alias("main"), F.col("c_pos_serial").alias("device")),
        F.struct(F.lit(0).alias("main"), F.col("c_nter").alias("device")),
    )
    rows = fitted.select("c_nmrc", FIRST, LAST, F.inline(counted)).filter("device is not null")
    spans = merged_spans(rows, ["main", "device", "c_nmrc"])
    several = rows.groupBy("main", "device").agg(F.min("c_nmrc").alias("_a"), F.max("c_nmrc").alias("_b")).filter("_a <> _b")
    several = several.select("main", "device", F.lit(True).alias("several"))
    return spans.join(several, ["main", "device"], "left").withColumn("several", F.coalesce("several", F.lit(False)))


def device_owners(reached: DataFrame, fitted: DataFrame, value: DataFrame) -> DataFrame:
    """Agreement and device code that carry a physical device's value, per month with a value.

    The owner has the smallest agreement among the outlets' smallest ones, then the smallest code.
    Only months in which some code of the device has a value are looked at.
    """
    placed = fitted.filter("c_nter is not null").withColumn("_device", serial_key())
    wanted = placed.select("_device", "c_nter").distinct().join(value.select("c_nter", "month_start"), "c_nter")
    wanted = wanted.select("_device", "month_start").distinct()
    there = month_number("month_start").between(F.col(FIRST), F.col(LAST))
    present = placed.join(wanted, "_device").filter(there).select(
        "_device", "month_start", "c_nmrc", "c_nter", F.col("c_pos_serial").isNotNull().alias("_serial")
    )
    seen = present.join(reached, ["c_nmrc", "month_start"]).filter((F.col("main") == 0) | F.col("_serial"))
    return (
        seen.groupBy("main", "month_start", "_device")
        .agg(F.min(F.struct("n_agr", "c_nter")).alias("_owner"))
        .select("month_start", F.col("_owner.n_agr").alias("n_agr"), F.col("_owner.c_nter").alias("c_nter"))
    )


def operational_metrics(
    scope: DataFrame, terms: DataFrame, outlets: DataFrame, devices: DataFrame, model: DataFrame, start, end, **rules
) -> DataFrame:
    """Outlets, devices and amortization per agreement and month.

    The main path goes from the agreement's terms to outlets and devices. Only
    agreements without a row there take the fallback, from the company's outlets.
    Devices that stand at one outlet only are counted per outlet from signed events, without a row
    per device and month, and agreements sum those counts; only devices of several outlets are
    counted by agreement and month. The scope, its outlets and the devices are written to the
    shared folder once, since several figures are drawn from each.
    """
    sa = materialize(scope.select(*KEY, "n_cmp_client").distinct())
    places = materialize(outlet_places(sa, terms, outlets, start, end, **rules))
    fitted = materialize(fitted_devices(devices, start, end))
    spot = ["main", "c_nmrc", "month_start"]

    spans = stays(fitted)
    amounts = {"_own": F.when(F.col("several"), 0).otherwise(1), "_any": F.lit(1)}
    per_spot = monthly_sums(spans.withColumns(amounts), ["main", "c_nmrc"], ["_own", "_any"])
    per_agreement = places.join(per_spot, spot, "left").groupBy(*KEY).agg(
        F.sum("main").alias("retl_main"),
        F.count_if((F.col("main") == 0) & F.col("_any").isNotNull()).alias("retl_spare"),
        F.sum("_own").alias("_own"),
    )
    shared = spans.filter("several").select("main", "device", "c_nmrc", F.explode(F.sequence(FIRST, LAST)).alias("_month"))
    shared = shared.select("main", "device", "c_nmrc", month_of("_month").alias("month_start"))
    shared = places.join(shared, spot).select(*KEY, "device").distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("_shared"))
    counts = per_agreement.join(shared, KEY, "left").select(
        *KEY,
        F.when(F.col("retl_main") > 0, F.col("retl_main")).alias("retl_main"),
        F.when(F.col("retl_spare") > 0, F.col("retl_spare")).alias("retl_spare"),
        (F.coalesce("_own", F.lit(0)) + F.coalesce("_shared", F.lit(0))).alias("term_cnt"),
    )
    value = model.select(
        F.col("c_nter").cast("string").alias("c_nter"),
        F.col("snapshot_month_start").alias("month_start"),
        F.col("amortization_for_report_month").alias("_value"),
    )
    reached = places.groupBy(*spot).agg(F.min("n_agr").alias("n_agr"))
    owners = device_owners(reached, fitted, value)
    amort = owners.join(value, ["c_nter", "month_start"]).groupBy(*KEY).agg(F.sum("_value").alias("amortization"))
    out = sa.join(counts, KEY, "left").join(amort, KEY, "left")
    source = (
        F.when(F.col("retl_main").isNotNull(), "547_like")
        .when(F.col("retl_spare").isNotNull(), "fallback_old")
        .otherwise("no_data")
    )
    return out.select(
        *KEY,
        "n_cmp_client",
        F.coalesce("retl_main", "retl_spare").alias("retl_cnt"),
        F.when(F.coalesce("retl_main", "retl_spare").isNotNull(), F.col("term_cnt")).alias("term_cnt"),
        F.coalesce("amortization", F.lit(0)).alias("amortization"),
        source.alias("term_calc_source"),
    )


def outer_metric_merge(outlets: DataFrame, devices: DataFrame, model: DataFrame) -> DataFrame:
    """Outlet, device and amortization totals per company over the union of their keys.

    Three aggregates with one key are one aggregation over tagged rows, so no
    chain of full outer joins is needed.
    """
    owned = outlets.filter("c_nmrc is not null").select(F.col("n_cmp").alias("n_cmp_client"), "c_nmrc").distinct()
    fitted = owned.join(devices.filter("c_nter is not null").select("c_nmrc", "c_nter"), "c_nmrc")
    monthly = model.groupBy("c_nter").agg(F.sum("amortization_monthly").alias("_value"))
    device_rows = fitted.join(monthly, "c_nter", "left").groupBy("n_cmp_client", "c_nter").agg(
        F.sum(F.coalesce("_value", F.lit(0))).alias("_value")
    )
    tagged = owned.groupBy("n_cmp_client").agg(F.count(F.lit(1)).alias("retl_cnt")).unionByName(
        device_rows.groupBy("n_cmp_client").agg(
            F.count(F.lit(1)).alias("term_cnt"), F.sum("_value").alias("amortization")
        ),
        allowMissingColumns=True,
    )
    return tagged.groupBy("n_cmp_client").agg(
        F.max("retl_cnt").alias("retl_cnt"), F.max("term_cnt").alias("term_cnt"),
        F.max("amortization").alias("amortization"),
    )


def card_transactions(trx: DataFrame, fiids: DataFrame, start, end, group: str, cls="SA", kind="S01") -> DataFrame:
    """Live transactions of the home group with their month."""
    home = (
        fiids.filter(F.coalesce(F.col("c_fiid_grp"), F.lit("UNKNOWN")) == group)
        .select(F.col("c_fiid").alias("c_fiid_acq"))
        .distinct()
    )
    first = F.lit(start).cast("date").cast(trx.schema["d_trx_orig"].dataType)
    after = F.date_add(F.lit(end).cast("date"), 1).cast(trx.schema["d_trx_orig"].dataType)
    return (
        not_deleted(trx)
        .filter((F.col("d_trx_orig") >= first) & (F.col("d_trx_orig") < after))
        .filter((F.col("c_trx_class") == cls) & (F.col("c_trx_type") == kind))
        .filter(F.col("c_nter").isNotNull() & (F.coalesce("cf_trx_stat", F.lit("")) != "R"))
        .join(home, "c_fiid_acq", "left_semi")
        .select("n_trx", "c_nter", "n_amt_src", F.trunc(F.col("d_trx_orig").cast("date"), "MM").alias("month_start"))
    )


def agreement_lines(trx: DataFrame, trx_acq: DataFrame) -> DataFrame:
    """One row per transaction, month and agreement.

    ``in_use`` is the device of an amount above one, where the agreement's line is live. Both tables
    are dealt by the transaction number before they are grouped, so that each is shuffled once.
    """
    base = trx.filter("n_trx is not null").repartition("n_trx").groupBy("n_trx", "month_start").agg(
        F.max("c_nter").alias("c_nter"), F.max("n_amt_src").alias("n_amt_src"),
        F.max(F.when(F.coalesce("n_amt_src", F.lit(0)) > 1, F.col("c_nter"))).alias("in_use"),
    )
    flag = F.col("ods_deleted_flg") if "ods_deleted_flg" in trx_acq.columns else F.lit(None)
    known = trx_acq.filter("n_agr is not null and n_trx is not null").select(
        "n_trx", "n_agr", "n_amt_tax", (F.coalesce(flag.cast("string"), F.lit("0")) != "1").alias("_live")
    )
    tax = known.repartition("n_trx").groupBy("n_trx", "n_agr").agg(
        F.max(F.coalesce("n_amt_tax", F.lit(0))).alias("n_amt_tax"), F.max("_live").alias("_live")
    )
    return base.join(tax, "n_trx").withColumn("in_use", F.when(F.col("_live"), F.col("in_use"))).drop("_live")


def transaction_lines(trx: DataFrame, trx_acq: DataFrame, trx_int: DataFrame) -> DataFrame:
    """One row per transaction, month and agreement, repeated fee lines taken once.

    All three inputs meet on the transaction number and are shuffled by it once.
    """
    fee = not_deleted(trx_int).groupBy("n_trx").agg(F.max(F.coalesce("n_amt_fee", F.lit(0))).alias("n_amt_fee"))
    return agreement_lines(trx, trx_acq).join(fee, "n_trx", "left")


def device_totals(lines: DataFrame) -> DataFrame:
    """Totals per agreement, month, device and device in use: small, and even for a very busy agreement."""
    return lines.groupBy(*KEY, "c_nter", "in_use").agg(
        F.count(F.lit(1)).alias("trx_cnt"),
        F.sum("n_amt_src").alias("trx_sum"),
        F.sum("n_amt_tax").alias("commission_from_ops"),
        F.sum(F.coalesce("n_amt_fee", F.lit(0))).alias("int_component"),
        F.max((F.coalesce("n_amt_src", F.lit(0)) > 1).cast("int")).alias("active"),
    )


def transaction_metrics(
    scope: DataFrame, trx: DataFrame, trx_acq: DataFrame, trx_int: DataFrame, fiids: DataFrame, start, end, group
) -> DataFrame:
    """Count, turnover, commission, interchange and active devices per agreement and month.

    The scope may have a row per month or per span of months (``perimeter`` with ``spans``).
    """
    return totals_per_agreement(_scoped(scope, trx, trx_acq, trx_int, fiids, start, end, group))


def scoped_totals(
    scope: DataFrame, trx: DataFrame, trx_acq: DataFrame, trx_int: DataFrame, fiids: DataFrame, start, end, group
) -> DataFrame:
    """Totals per device of the scope's agreements, written to the shared folder.

    Agreements, companies and outlets in use are all counted from them, and the transactions are
    read once.
    """
    return materialize(_scoped(scope, trx, trx_acq, trx_int, fiids, start, end, group))


def _scoped(
    scope: DataFrame, trx: DataFrame, trx_acq: DataFrame, trx_int: DataFrame, fiids: DataFrame, start, end, group
) -> DataFrame:
    """Totals per device meet the scope as spans of months, by the agreement alone."""
    totals = device_totals(transaction_lines(card_transactions(trx, fiids, start, end, group), trx_acq, trx_int))
    if FIRST not in scope.columns:
        scope = scope.withColumns({FIRST: month_number("month_start"), LAST: month_number("month_start")})
    sa = merged_spans(scope, ["n_agr", "n_cmp_client", "inn"]).withColumnRenamed("n_agr", "_agr")
    there = (F.col("n_agr") == F.col("_agr")) & month_number("month_start").between(F.col(FIRST), F.col(LAST))
    return totals.join(sa, there).drop("_agr", FIRST, LAST)


def totals_per_agreement(totals: DataFrame) -> DataFrame:
    """Totals per agreement and month, and the active devices of its company.

    An agreement's devices in use are one value, written with its totals; those of a company are counted from them.
    """
    active = F.collect_set(F.when(F.col("active") == 1, F.col("c_nter"))).alias("_devices")
    held = materialize(totals.groupBy(*KEY, "n_cmp_client", "inn").agg(
        F.sum("trx_cnt").alias("trx_cnt"),
        F.sum("trx_sum").alias("trx_sum"),
        F.sum("commission_from_ops").alias("commission_from_ops"),
        F.sum("int_component").alias("int_component"),
        active,
    ))
    per_agreement = held.withColumn("active_terms", F.size("_devices").cast("long")).drop("_devices")
    per_company = (
        held.select("n_cmp_client", "month_start", F.explode("_devices").alias("c_nter")).distinct()
        .groupBy("n_cmp_client", "month_start").agg(F.count(F.lit(1)).alias("_active"))
    )
    out = per_agreement.join(per_company, ["n_cmp_client", "month_start"], "left")
    count = F.when(F.col("n_cmp_client").isNotNull(), F.coalesce("_active", F.lit(0)))
    return out.withColumn("active_term_cnt", count).drop("_active")


def transaction_metrics_naive(
    scope: DataFrame, trx: DataFrame, trx_acq: DataFrame, trx_int: DataFrame, fiids: DataFrame, start, end, group
) -> DataFrame:
    """The same totals without taking repeated lines once, to show what fan-out does."""
    base = card_transactions(trx, fiids, start, end, group)
    tax = trx_acq.select("n_trx", "n_agr", F.coalesce("n_amt_tax", F.lit(0)).alias("n_amt_tax"))
    fee = trx_int.select("n_trx", "n_amt_fee")
    sa = scope.select(*KEY).distinct()
    # The key-level totals come first, so the perimeter join moves few rows.
    per_trx = base.join(tax, "n_trx").join(fee, "n_trx", "left").groupBy(*KEY, "n_trx").agg(
        F.sum("n_amt_src").alias("trx_sum"),
        F.sum("n_amt_tax").alias("commission_from_ops"),
        F.sum(F.coalesce("n_amt_fee", F.lit(0))).alias("int_component"),
    )
    totals = per_trx.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("trx_cnt"),
        F.sum("trx_sum").alias("trx_sum"),
        F.sum("commission_from_ops").alias("commission_from_ops"),
        F.sum("int_component").alias("int_component"),
    )
    return totals.join(sa, KEY)


def active_outlets(trx: DataFrame, trx_acq: DataFrame, devices: DataFrame, fiids: DataFrame, start, end, group) -> DataFrame:
    """Outlets with at least one device in use, per agreement and month."""
    return outlets_in_use(agreement_lines(card_transactions(trx, fiids, start, end, group), trx_acq), devices)


def outlets_in_use(rows: DataFrame, devices: DataFrame) -> DataFrame:
    """Outlets behind the devices in use of lines or of totals per device, per agreement and month."""
    in_use = rows.filter("in_use is not null").select(*KEY, F.col("in_use").alias("c_nter")).distinct()
    places = not_deleted(devices).filter("c_nmrc is not null").select("c_nter", "c_nmrc").distinct()
    return in_use.join(places, "c_nter").groupBy(*KEY).agg(F.countDistinct("c_nmrc").alias("active_retl_cnt"))


def plan_fee_map(tune: DataFrame, fix: DataFrame) -> DataFrame:
    """Monthly fee per tariff plan: the largest fee of its tariffs."""
    pairs = tune.filter("c_tariff_plan is not null").select("c_tariff_plan", "c_tariff").distinct()
    fees = fix.groupBy(F.col("id").alias("c_tariff")).agg(F.max(F.col("c_summa").cast("decimal(18,2)")).alias("_fee"))
    return pairs.join(fees, "c_tariff", "left").groupBy("c_tariff_plan").agg(
        F.max("_fee").alias("commission_monthly_fix")
    )


RENT_KEY = ["c_nmrc", "d_rent", "n_amt"]
SOFT_DELETED = ("1", "Y", "y")


def latest_rent(rent: DataFrame, start, end) -> DataFrame:
    """Newest live version of each outlet's rent day."""
    day = F.col("d_rent")
    live = not_deleted(rent, values=SOFT_DELETED).filter(
        F.col("c_nmrc").isNotNull() & day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    order = [
        F.coalesce("ods_commit_ts", "ods_insert_ts").desc_nulls_first(),
        F.col("ods_op_csn").desc_nulls_first(),
        F.col("ods_insert_ts").desc_nulls_first(),
        F.col("n_amt").desc_nulls_last(),
    ]
    return latest_version(live, ["c_nmrc", "d_rent"], order).select(*RENT_KEY)


def rent_targets(
    rent: DataFrame, terms: DataFrame, agreements: DataFrame, companies: DataFrame, start, end, by_year: bool = False
) -> DataFrame:
    """Rent days with every company and agreement they may belong to on that day.

    Terms, agreements and companies meet as intervals, once per interval. An interval is repeated
    for each of its years, so that a busy outlet is spread over years and no row per month is made.
    With ``by_year`` the year stays, and grouping by outlet, year and day needs no further shuffle.
    """
    cmp_dim = live_companies(companies, SOFT_DELETED).select("n_cmp_client", "inn").distinct()
    agr_dim = agreements_of_class(agreements, deleted=SOFT_DELETED).select(
        "n_agr", F.col("abs_agr_id").alias("agr_id"), "n_cmp_client", F.col("d_valid_from").alias("_from"), _until().alias("_to")
    ).distinct().join(cmp_dim, "n_cmp_client", "left").select("n_agr", "agr_id", "inn", "_from", "_to")
    term_dim = not_deleted(terms, values=SOFT_DELETED).filter("c_nmrc is not null and n_agr is not null").select(
        "n_agr", "c_nmrc", F.col("d_valid_from").alias("_from"), _until().alias("_to")
    )
    low, high = (F.lit(d).cast("date") for d in (start, end))
    known = term_dim.alias("t").join(agr_dim.alias("a"), "n_agr").filter(
        "t._from is not null and a._from is not null"
    ).select(
        "c_nmrc", "agr_id", "inn", F.greatest("t._from", "a._from").alias("_from"), F.least("t._to", "a._to").alias("_to")
    ).filter((F.col("_from") <= F.col("_to")) & (F.col("_from") <= high) & (F.col("_to") >= low))
    years = F.sequence(F.year(F.greatest("_from", low)), F.year(F.least("_to", high)))
    known = known.withColumn("_year", F.explode(years)).select(
        F.col("c_nmrc").alias("_outlet"), F.col("_year").alias("_in"), "agr_id", "inn", "_from", "_to"
    )
    met = (F.col("c_nmrc") == F.col("_outlet")) & (F.col("_year") == F.col("_in")) & F.col("d_rent").between(F.col("_from"), F.col("_to"))
    days = latest_rent(rent, start, end).withColumn("_year", F.year("d_rent"))
    return days.join(known, met, "left").select(*(["_year"] if by_year else []), *RENT_KEY, "inn", "agr_id")


def _until() -> Column:
    return F.coalesce("d_valid_to", F.lit(fv.OPEN_END).cast("date"))


def rent_mapping(targets: DataFrame) -> DataFrame:
    """Outcome of the mapping per rent day."""
    key = [c for c in ("_year", *RENT_KEY) if c in targets.columns]
    return unique_map_only(targets, key, ["inn", "agr_id"])


def rent_row_classes(
    rent: DataFrame, terms: DataFrame, agreements: DataFrame, companies: DataFrame, wanted: DataFrame, start, end
) -> DataFrame:
    """Rent days at the outlets of wanted agreement ids, and what the mapping makes of each.

    An outlet is an agreement's when both its term and the agreement, of whatever class, live in
    the month of the rent. ``map_class`` tells why a fee is missing: the day has no target, a
    single one (this agreement id or another) or several.
    """
    heads = not_deleted(agreements, values=SOFT_DELETED).join(
        wanted.select(F.col("agr_id").alias("abs_agr_id")).distinct(), "abs_agr_id", "left_semi"
    )
    heads = month_spans(heads, start, end).select(
        F.col("abs_agr_id").alias("agr_id"), F.upper(F.trim("acq_class")).alias("acq_class"), "n_agr", FIRST, LAST
    ).distinct()
    leaves = month_spans(not_deleted(terms, values=SOFT_DELETED).filter("c_nmrc is not null"), start, end).select(
        "n_agr", "c_nmrc", F.col(FIRST).alias("_from"), F.col(LAST).alias("_to")
    ).distinct()
    both = {FIRST: F.greatest(FIRST, "_from"), LAST: F.least(LAST, "_to")}
    hits = heads.join(leaves, "n_agr").withColumns(both).filter(F.col(FIRST) <= F.col(LAST))
    hits = merged_spans(hits, ["agr_id", "acq_class", "n_agr", "c_nmrc"])
    hits = hits.withColumn("_year", F.explode(F.sequence(F.floor(F.col(FIRST) / 12).cast("int"), F.floor(F.col(LAST) / 12).cast("int"))))
    found = rent_mapping(rent_targets(rent, terms, agreements, companies, start, end, by_year=True))
    # A day without an amount has no mapping to be found by.
    count = F.when(F.col("n_amt").isNotNull(), F.col("target_cnt")).otherwise(0)
    known = F.col("n_amt").isNotNull()
    map_class = (
        F.when(count == 0, "no_mapping")
        .when(count > 1, "ambiguous")
        .when(F.col("unique_agr") == F.col("agr_id"), "unique_on_target_agr")
        .otherwise("unique_other_agr")
    )
    found = found.withColumns({"unique_inn": F.when(known, F.col("inn")), "unique_agr": F.when(known, F.col("agr_id"))}).drop("inn", "agr_id")
    rows = found.join(hits, ["c_nmrc", "_year"]).filter(month_number("d_rent").between(F.col(FIRST), F.col(LAST)))
    return rows.select(
        "agr_id", "acq_class", "n_agr", *RENT_KEY, count.alias("valid_key_cnt"), "unique_inn", "unique_agr", map_class.alias("map_class")
    )


def count_variants(
    pairs: DataFrame, outlets: DataFrame, devices: DataFrame, start, end, spans: bool = False, at: DataFrame | None = None
) -> DataFrame:
    """Outlets and devices of each agreement's company per month: all of them, and those with a device in place.

    ``pairs`` holds (n_agr, n_cmp_client). Companies are counted once, not once per agreement. With
    ``spans`` a row is a span of months with the same counts. With ``at``, rows of agreement and month,
    those that have counts get them: they meet the spans of the company, so that no row per
    agreement and span is made.
    """
    pairs = pairs.select("n_agr", "n_cmp_client").distinct()
    owned = not_deleted(outlets).filter("c_nmrc is not null").select(F.col("n_cmp").alias("n_cmp_client"), "c_nmrc").distinct()
    owned = owned.join(pairs.select("n_cmp_client").distinct(), "n_cmp_client", "left_semi")
    # Devices meet their outlets once and are written with their span, which ends before it begins where they stood in no month.
    since = F.coalesce("d_ter_install", F.lit("1900-01-01").cast("date"))
    placed = not_deleted(devices).filter("c_nter is not null").select("c_nmrc", "c_nter", since.alias("_since"), "d_ter_close").join(owned, "c_nmrc")
    low, high = (month_number(F.lit(d).cast("date")) for d in (start, end))
    fitted = materialize(placed.select(
        "n_cmp_client", "c_nmrc", "c_nter", F.greatest(month_number("_since"), low).alias(FIRST),
        F.least(F.coalesce(month_number("d_ter_close"), high), high).alias(LAST),
    ))
    term_all = fitted.select("n_cmp_client", "c_nter").distinct().groupBy("n_cmp_client").agg(F.count(F.lit(1)).alias("term_all_cnt"))
    retl_all = owned.groupBy("n_cmp_client").agg(F.count(F.lit(1)).alias("retl_all_cnt"))
    stood = fitted.filter(F.col(FIRST) <= F.col(LAST))
    key = ["n_cmp_client"]
    merged = [
        merged_spans(stood, [*key, c]).select(*key, FIRST, LAST, *[F.lit(int(c == x)).alias(n) for x, n in (("c_nmrc", "retl_active_cnt"), ("c_nter", "term_active_cnt"))])
        for c in ("c_nmrc", "c_nter")
    ]
    active = stretched_sums(merged[0].unionByName(merged[1]), key, ["retl_active_cnt", "term_active_cnt"])
    per_company = retl_all.join(term_all, "n_cmp_client", "left").join(active, "n_cmp_client")
    if at is not None:
        rows = at.join(pairs, "n_agr").join(per_company, "n_cmp_client")
        return rows.filter(month_number("month_start").between(F.col(FIRST), F.col(LAST))).drop("n_cmp_client", FIRST, LAST)
    # Months are expanded last: a company's counts meet its agreements as spans.
    counts = pairs.join(per_company, "n_cmp_client").select(
        "n_agr", "retl_all_cnt", "retl_active_cnt", "term_all_cnt", "term_active_cnt", FIRST, LAST
    )
    return counts if spans else span_months(counts)


def rent_fee_by_key(mapping: DataFrame) -> DataFrame:
    """Rent per company, agreement and month, over days with a single target."""
    return (
        mapping.filter("mapping = 'unique'")
        .groupBy("inn", "agr_id", F.trunc("d_rent", "MM").alias("month_start"))
        .agg(F.sum("n_amt").alias("commission_monthly_mpos"))
    )


def rent_by_month(rent: DataFrame, start, end) -> DataFrame:
    """Rows, outlets and amount per month after taking the newest version of each day."""
    per_outlet = latest_rent(rent, start, end).groupBy(F.trunc("d_rent", "MM").alias("month_start"), "c_nmrc").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_amt").alias("amount")
    )
    return per_outlet.groupBy("month_start").agg(
        F.sum("n").alias("rows_after_dedup"),
        F.count(F.lit(1)).alias("merchant_cnt"),
        F.sum("amount").alias("commission_monthly_new"),
    )


def merge_rent_fee(df: DataFrame, fees: DataFrame, keys=("inn_key", "agr_id_key", "month_start")) -> DataFrame:
    """Monthly commission from the rent map, zero where the key is not in it."""
    keys = list(keys)
    out = df.join(fees.groupBy(*keys).agg(F.sum("commission_monthly_mpos").alias("commission_monthly_mpos")), keys, "left")
    return out.withColumns(
        {
            "commission_monthly": F.coalesce("commission_monthly_mpos", F.lit(0)),
            "commission_monthly_source": F.when(
                F.col("commission_monthly_mpos").isNotNull(), "mpos_rent_n_amt"
            ).otherwise("mpos_rent_zero_fill"),
        }
    )


def fee_lines(trx_int: DataFrame) -> DataFrame:
    """Fee lines per transaction: how many, how many different ones, sum, largest, smallest."""
    fee = F.coalesce(F.col("n_amt_fee"), F.lit(0))
    # Same fees are counted first: a transaction with many lines then holds few rows.
    per_fee = not_deleted(trx_int).groupBy("n_trx", fee.alias("fee")).agg(F.count(F.lit(1)).alias("n"))
    return per_fee.groupBy("n_trx").agg(
        F.sum("n").alias("int_rows"),
        F.count(F.lit(1)).alias("distinct_fee_values"),
        F.sum(F.col("fee") * F.col("n")).alias("fee_sum"),
        F.max("fee").alias("fee_max"),
        F.min("fee").alias("fee_min"),
    )


def multi_fee_classification(trx_int: DataFrame) -> DataFrame:
    """Transactions with several fee lines: copies of one fee, or different fees."""
    multi = fee_lines(trx_int).filter("int_rows > 1")
    same = F.col("distinct_fee_values") == 1

    def total(condition, value):
        return F.sum(F.when(condition, F.col(value)).otherwise(0))

    return multi.agg(
        F.count(F.lit(1)).alias("multi_trx_cnt"),
        F.sum("int_rows").alias("multi_int_rows"),
        F.count_if(same).alias("multi_same_fee_dup"),
        F.count_if(~same).alias("multi_different_fees"),
        total(same, "fee_sum").alias("fee_sum_on_same_fee_dups"),
        total(same, "fee_max").alias("fee_max_on_same_fee_dups"),
        F.sum(F.when(same, F.col("fee_sum") - F.col("fee_max")).otherwise(0)).alias("extra_fee_from_same_fee_dups"),
        total(~same, "fee_sum").alias("fee_sum_on_different_fees"),
        total(~same, "fee_max").alias("fee_max_on_different_fees"),
        (F.sum("int_rows").cast("double") / F.count(F.lit(1))).alias("avg_rows_on_multi"),
        (F.sum("distinct_fee_values").cast("double") / F.count(F.lit(1))).alias("avg_distinct_fee_on_multi"),
    )


def fee_alternatives(trx_int: DataFrame) -> DataFrame:
    """Total interchange under different treatments of repeated fee lines."""
    multi = F.col("int_rows") > 1
    same = F.col("distinct_fee_values") == 1
    return fee_lines(trx_int).agg(
        F.count(F.lit(1)).alias("trx_with_int"),
        F.sum("fee_sum").alias("int_sum_all_rows"),
        F.sum("fee_max").alias("int_max_per_trx"),
        F.sum("fee_min").alias("int_min_per_trx"),
        F.sum(F.when(same, F.col("fee_max")).otherwise(F.col("fee_sum"))).alias("int_dedupe_same_fee_else_sum"),
        F.count_if(multi).alias("multi_trx"),
        F.sum(F.when(multi, F.col("fee_sum") - F.col("fee_max")).otherwise(0)).alias("extra_vs_max_on_multi"),
    )
