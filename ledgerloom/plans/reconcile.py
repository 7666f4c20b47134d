"""Comparison of a mart with an independent report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv
from ..functions.classes import ratio_bucket
from ..functions.numbers import pct, ratio, safe_pct
from ..functions.text import digits_only, norm_inn
from ..operators.dedup import top_per_key
from ..operators.quantiles import one_row
from ..operators.validity import not_deleted

ROW_KEY = ["report_month", "inn_key", "agr_id_key"]
VALUES = fv.COMPARE_METRICS[1:]


def _stack(entries: list[tuple], names: str) -> Column:
    """Rows of (label, expression, ...) unpivoted; all expressions become doubles."""
    parts = []
    for label, *exprs in entries:
        parts.append(f"'{label}'")
        parts += [f"cast({e} as double)" for e in exprs]
    return F.expr(f"stack({len(entries)}, {', '.join(parts)}) as ({names})")


def key_month_agg(df: DataFrame, rules: dict[str, str], suffix: str, keys=ROW_KEY) -> DataFrame:
    """One row per complete key; each column by its rule, ``max`` or ``sum``."""
    rule = {"max": F.max, "sum": F.sum}
    sums = df.groupBy(*keys).agg(_complete(keys), *[rule[how](c).alias(f"{c}{suffix}") for c, how in rules.items()])
    return sums.filter("_known").drop("_known")


def _complete(keys) -> Column:
    """Whether a group has all its keys but the month.

    Taken with the sums: a filter on the keys would be pushed below them and derive every key once more for itself.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys if k != "report_month"])
    return F.bool_and(known).alias("_known")


def metric_totals(agg: DataFrame, suffix: str, metrics=VALUES, optional=()) -> DataFrame:
    """Companies and column sums per month; an optional column that is empty stays null."""
    per_inn = agg.groupBy("report_month", "inn_key").agg(
        *[F.sum(f"{c}{suffix}").alias(c) for c in metrics], *[F.count(f"{c}{suffix}").alias(f"_n_{c}") for c in metrics]
    )
    totals = []
    for c in metrics:
        total = F.coalesce(F.sum(c), F.lit(0))
        totals.append((F.when(F.sum(f"_n_{c}") > 0, total) if c in optional else total).alias(c))
    return per_inn.groupBy("report_month").agg(F.count(F.lit(1)).alias("unique_inn"), *totals)


def monthly_compare(lake_totals: DataFrame, ref_totals: DataFrame, metrics=fv.COMPARE_METRICS) -> DataFrame:
    """Both values, delta and percent per month and metric; one-sided where no report exists."""
    ref = ref_totals.select("report_month", *[F.col(c).alias(f"{c}_ref") for c in metrics], F.lit(1).alias("_has"))
    return _compared(lake_totals.join(ref, "report_month", "left"), metrics)


def _compared(both: DataFrame, metrics) -> DataFrame:
    entries = [(c, c, f"{c}_ref") for c in metrics]
    rows = both.select("report_month", "_has", _stack(entries, "metric, lake_value, excel_value"))
    delta = F.col("lake_value") - F.col("excel_value")
    return rows.select(
        "report_month", "metric", "lake_value", "excel_value",
        delta.alias("delta_lake_minus_excel"),
        safe_pct(delta, "excel_value").alias("divergence_pct"),
        F.when(F.col("_has") == 1, "has_excel_reference").otherwise("no_excel_reference").alias("reference_status"),
    )


def paired_compare(pairs: DataFrame, metrics=VALUES, optional=()) -> DataFrame:
    """``monthly_compare`` of the ``metric_totals`` of both sides of a paired table, with ``optional`` ones of the report.

    A pair gives its month's sums one row without a company, and the count of companies one without values;
    the former are a row per month in each task before the shuffle, the latter carry no values through it.
    """
    sides = {"lake": F.col("merge_status") != "right_only", "excel": F.col("merge_status") != "left_only"}
    # Without a month no row has a partner on the other side.
    rows = pairs.filter(F.col("report_month").isNotNull() | sides["lake"]).withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1))))
    value = F.col("_kind") == 0
    sums = [f"{c}_{s}" for s in sides for c in metrics]
    filled = [f"{c}_excel" for c in metrics if c in optional]
    per_inn = rows.groupBy("report_month", "_kind", F.when(~value, F.col("inn_key")).alias("_inn")).agg(
        *[F.bool_or(here).alias(f"_in_{s}") for s, here in sides.items()],
        *[F.sum(F.when(value, F.col(c))).alias(c) for c in sums],
        *[F.count(F.when(value, F.col(c))).alias(f"_n_{c}") for c in filled],
    )
    totals = []
    for c in sums:
        total = F.coalesce(F.sum(c), F.lit(0))
        totals.append((F.when(F.sum(f"_n_{c}") > 0, total) if c in filled else total).alias(c))
    by_month = per_inn.groupBy("report_month").agg(
        *[F.count_if((F.col("_kind") == 1) & F.col(f"_in_{s}")).alias(f"unique_inn_{s}") for s in sides], *totals
    )
    # Months of the report alone are left out; the values of months without a report are null.
    has = F.col("unique_inn_excel") > 0
    names = ["unique_inn", *metrics]
    both = by_month.filter("unique_inn_lake > 0").select(
        "report_month", *[F.col(f"{c}_lake").alias(c) for c in names],
        *[F.when(has, F.col(f"{c}_excel")).alias(f"{c}_ref") for c in names], F.when(has, F.lit(1)).alias("_has"),
    )
    return _compared(both, names)


def period_total(compare: DataFrame) -> DataFrame:
    """Sums over the months with a report, and separately over those without."""
    has = F.col("reference_status") == "has_excel_reference"
    sums = compare.groupBy("reference_status", "metric").agg(
        F.sum("lake_value").alias("lake_value"), F.sum("excel_value").alias("excel_value")
    )
    delta = F.when(has, F.col("lake_value") - F.col("excel_value"))
    return sums.select(
        F.when(has, "months_with_excel_reference").otherwise("months_without_excel_reference").alias("scope"),
        "metric", "lake_value",
        F.when(has, F.col("excel_value")).alias("excel_value"),
        delta.alias("delta_lake_minus_excel"),
        safe_pct(delta, "excel_value").alias("divergence_pct"),
        "reference_status",
    )


def paired(lake: DataFrame, ref: DataFrame, keys=ROW_KEY) -> DataFrame:
    """Full outer join of two unique-key tables with the side of each row."""
    left = lake.withColumn("_l", F.lit(1))
    right = ref.withColumn("_r", F.lit(1))
    side = (
        F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), "both")
        .when(F.col("_l").isNotNull(), "left_only")
        .otherwise("right_only")
    )
    return left.join(right, list(keys), "full_outer").withColumn("merge_status", side).drop("_l", "_r")


def paired_rows(rows: DataFrame, side: str, sides: dict, keys=ROW_KEY) -> DataFrame:
    """``paired`` of the ``key_month_agg`` of two tables whose rows come as one, told apart by the column ``side``.

    ``sides`` maps the two values of the column to (suffix, rules), the left table first; the rule ``set`` gives
    the different values of a key's rows. One shuffle of
    sums that tasks have taken before, in place of one for each table and a join.
    """
    (left, _), (right, _) = sides.items()
    rule = {"max": F.max, "sum": F.sum, "set": F.collect_set}
    # As in a join, a row with an empty key meets none of the other side.
    alone = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    sums = rows.groupBy(*keys, F.when(alone, F.col(side)).alias("_alone")).agg(
        _complete(keys),
        F.bool_or(F.col(side) == left).alias("_l"), F.bool_or(F.col(side) == right).alias("_r"),
        *[rule[how](F.when(F.col(side) == value, F.col(c))).alias(f"{c}{suffix}")
          for value, (suffix, rules) in sides.items() for c, how in rules.items()],
    )
    status = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left_only").otherwise("right_only")
    return sums.filter("_known").withColumn("merge_status", status).drop("_alone", "_known", "_l", "_r")


def row_match(lake: DataFrame, ref: DataFrame, metrics: dict[str, float]) -> DataFrame:
    """Share of equal rows per month and metric on the shared keys, missing values as zero."""
    return paired_row_match(paired(lake, ref), metrics)


def paired_row_match(pairs: DataFrame, metrics: dict[str, float]) -> DataFrame:
    """``row_match`` of a paired table."""
    both = F.col("merge_status") == "both"
    aggs = [
        F.count_if(both).alias("keys_both"),
        F.count_if(F.col("merge_status") == "right_only").alias("keys_only_excel"),
        F.count_if(F.col("merge_status") == "left_only").alias("keys_only_lake"),
    ]
    for c, tol in metrics.items():
        a, b = F.coalesce(f"{c}_lake", F.lit(0)), F.coalesce(f"{c}_excel", F.lit(0))
        aggs.append(F.count_if(both & (F.abs(a - b) <= F.lit(tol))).alias(f"_e_{c}"))
        aggs.append(F.count_if(both & F.col(f"{c}_excel").isNotNull()).alias(f"_n_{c}"))
    counts = pairs.groupBy("report_month").agg(*aggs)
    entries = [(c, f"_e_{c}", f"_n_{c}", str(tol)) for c, tol in metrics.items()]
    keys = ["report_month", "keys_both", "keys_only_excel", "keys_only_lake"]
    rows = counts.select(*keys, _stack(entries, "metric, exact_n, filled_n, tol")).filter("filled_n > 0")
    return rows.select(
        *keys, "metric", F.col("exact_n").cast("long").alias("exact_match_n"),
        pct(F.col("exact_n"), F.col("keys_both")).alias("exact_match_pct"),
        (F.col("keys_both") - F.col("exact_n")).cast("long").alias("mismatch_n"), "tol",
    )


def meaningful_row_match(lake: DataFrame, ref: DataFrame, metrics: dict[str, float]) -> DataFrame:
    """Share of equal rows among shared keys where a side, or both sides, hold a non-zero value."""
    return paired_meaningful_match(paired(lake, ref), metrics)


def paired_meaningful_match(pairs: DataFrame, metrics: dict[str, float]) -> DataFrame:
    """``meaningful_row_match`` of a paired table."""
    aggs = [F.count(F.lit(1)).alias("keys_both")]
    for c, tol in metrics.items():
        a, b = F.col(f"{c}_lake"), F.col(f"{c}_excel")
        live_a, live_b = F.coalesce(a != 0, F.lit(False)), F.coalesce(b != 0, F.lit(False))
        equal = F.coalesce(F.abs(a - b) <= F.lit(tol), a.isNull() & b.isNull())
        aggs += [
            F.count_if(live_a | live_b).alias(f"_d_{c}"),
            F.count_if((live_a | live_b) & equal).alias(f"_e_{c}"),
            F.count_if(live_a & live_b).alias(f"_b_{c}"),
            F.count_if(live_a & live_b & equal).alias(f"_be_{c}"),
            F.count(b).alias(f"_n_{c}"),
        ]
    counts = pairs.filter("merge_status = 'both'").groupBy("report_month").agg(*aggs)
    entries = [(c, f"_d_{c}", f"_e_{c}", f"_b_{c}", f"_be_{c}", f"_n_{c}", str(t)) for c, t in metrics.items()]
    names = "metric, denom, exact, both_live, both_exact, filled, tol"
    rows = counts.select("report_month", "keys_both", _stack(entries, names)).filter("filled > 0 and denom > 0")
    return rows.select(
        "report_month", "metric", "keys_both",
        F.col("denom").cast("long").alias("denom_n"),
        F.col("exact").cast("long").alias("exact_n"),
        pct(F.col("exact"), F.col("denom")).alias("exact_pct"),
        (F.col("denom") - F.col("exact")).cast("long").alias("mismatch_n"),
        F.col("both_live").cast("long").alias("both_meaningful_n"),
        F.col("both_exact").cast("long").alias("both_meaningful_exact_n"),
        pct(F.col("both_exact"), F.col("both_live")).alias("both_meaningful_exact_pct"),
        pct(F.col("both_live"), F.col("keys_both")).alias("both_meaningful_share_of_both"),
        "tol",
    )


def with_deltas(pairs: DataFrame, metric: str, exact_tol=0.01, near_abs=1.0, near_pct=1.0) -> DataFrame:
    """Delta, match flags and mismatch reason of one metric; a missing side counts as zero."""
    lake = F.coalesce(f"{metric}_lake", F.lit(0))
    ref = F.coalesce(f"{metric}_excel", F.lit(0))
    out = pairs.withColumns({"lake": lake, "excel": ref}).withColumn("delta", F.col("lake") - F.col("excel"))
    size = F.abs("delta")
    near = (size < near_abs) | F.coalesce(safe_pct("delta", "excel") < near_pct, F.lit(False))
    return out.withColumns(
        {
            "delta_pct": safe_pct("delta", "excel"),
            "is_exact": size < exact_tol,
            "is_near": near,
            "mismatch_reason": mismatch_reason("lake", "excel", "merge_status", exact_tol, near_abs, near_pct),
        }
    )


def mismatch_reason(lake: str, ref: str, status: str, exact_tol=0.01, near_abs=1.0, near_pct=1.0) -> Column:
    """Why two values differ: the first explanation that fits."""
    a, b = F.col(lake), F.col(ref)
    delta = a - b
    size = F.abs(delta)
    scale = F.abs(ratio(a, b))
    scaled = (a != 0) & (b != 0) & (scale.between(90, 110) | scale.between(0.009, 0.011))
    rounded = F.abs(F.bround(a, 0) - F.bround(b, 0)) < exact_tol
    has_a, has_b = F.abs(a) >= exact_tol, F.abs(b) >= exact_tol
    return (
        F.when(size < exact_tol, "exact_match")
        .when(size < near_abs, "near_rounding_abs_lt_1")
        .when(safe_pct(delta, b) < near_pct, "near_rounding_pct_lt_1")
        .when(scaled, "suspect_scale_100x_or_0_01x")
        .when(rounded, "suspect_integer_round")
        .when((F.col(status) == "right_only") & has_b, "excel_nz_missing_in_lake")
        .when((F.col(status) == "left_only") & has_a, "lake_nz_missing_in_excel")
        .when(~has_b & has_a, "lake_nz_excel_zero")
        .when(~has_a & has_b, "excel_nz_lake_zero")
        .when(delta > 0, "lake_gt_excel")
        .otherwise("lake_lt_excel")
    )


def mismatch_reason_stats(deltas: DataFrame) -> DataFrame:
    """Keys, net and gross delta and both totals per month and reason."""
    return deltas.groupBy("report_month", "mismatch_reason").agg(
        F.count(F.lit(1)).alias("key_cnt"),
        F.sum("delta").alias("delta_sum"),
        F.sum(F.abs("delta")).alias("abs_delta_sum"),
        F.sum("excel").alias("excel_sum"),
        F.sum("lake").alias("lake_sum"),
    )


def compare_summary(deltas: DataFrame) -> DataFrame:
    """Match rates on the report's keys, on the shared keys and on all keys, with gross deltas."""
    in_ref = F.col("merge_status") != "left_only"
    both = F.col("merge_status") == "both"
    exact, near, delta = F.col("is_exact"), F.col("is_near"), F.col("delta")

    def total(condition, value=delta):
        return F.sum(F.when(condition, value).otherwise(0))

    out = deltas.groupBy("report_month").agg(
        F.count_if(in_ref).alias("excel_key_cnt"),
        F.count_if(F.col("merge_status") != "right_only").alias("lake_key_cnt"),
        F.count_if(both).alias("intersection_key_cnt"),
        F.count_if(F.col("merge_status") == "right_only").alias("only_excel_key_cnt"),
        F.count_if(F.col("merge_status") == "left_only").alias("only_lake_key_cnt"),
        F.count_if(in_ref & exact).alias("full_exact_match_cnt"),
        F.count_if(in_ref & near).alias("full_near_match_cnt"),
        F.count_if(both & exact).alias("intersection_exact_match_cnt"),
        F.count_if(both & near).alias("_both_near"),
        F.count_if(exact).alias("_all_exact"),
        F.count(F.lit(1)).alias("_all"),
        F.sum("excel").alias("excel_total"),
        F.sum("lake").alias("lake_total"),
        total(~exact & (delta > 0)).alias("mismatch_pos_delta_sum"),
        total(~exact & (delta < 0)).alias("mismatch_neg_delta_sum"),
        F.sum("delta").alias("mismatch_net_delta"),
        total(in_ref & ~exact & (delta > 0)).alias("excel_univ_pos_delta_sum"),
        total(in_ref & ~exact & (delta < 0)).alias("excel_univ_neg_delta_sum"),
        total(both).alias("intersection_delta_abs"),
    )

    def rate(part, whole):
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * 100.0)

    return out.withColumns(
        {
            "full_exact_match_rate_pct": rate("full_exact_match_cnt", "excel_key_cnt"),
            "full_near_match_rate_pct": rate("full_near_match_cnt", "excel_key_cnt"),
            "full_mismatch_cnt": F.col("excel_key_cnt") - F.col("full_exact_match_cnt"),
            "intersection_exact_match_rate_pct": rate("intersection_exact_match_cnt", "intersection_key_cnt"),
            "intersection_near_match_rate_pct": rate("_both_near", "intersection_key_cnt"),
            "total_delta_pct": safe_pct(F.col("lake_total") - F.col("excel_total"), "excel_total"),
            "all_keys_exact_match_rate_pct": rate("_all_exact", "_all"),
        }
    ).drop("_both_near", "_all_exact", "_all")


def top_abs_delta(deltas: DataFrame, n: int, tol: float = 0.01, by=("report_month",)) -> DataFrame:
    """The n largest absolute deltas above the tolerance per month, ranked."""
    big = deltas.withColumn("abs_delta", F.abs("delta")).filter(F.col("abs_delta") > tol)
    return top_per_key(big, by, [F.col("abs_delta").desc(), F.col("inn_key"), F.col("agr_id_key")], n)


def only_left_reason_shares(only_left: DataFrame, terms: DataFrame, inserted: str = "ods_insert_ts") -> DataFrame:
    """Per month, why companies are missing in the report: their latest term had ended before the month.

    ``only_left`` holds (report_month, inn, n_agr). The latest term of an agreement has the last
    beginning, then the newest insert, then the last end.
    """
    live = not_deleted(terms)
    newest = F.col(inserted) if inserted in terms.columns else F.lit(None).cast("timestamp")
    end = F.coalesce(F.col("d_valid_to").cast("date"), F.lit(fv.OPEN_END).cast("date"))
    last = live.groupBy("n_agr").agg(F.max(F.struct("d_valid_from", newest.alias("inserted"), end.alias("to"))).alias("_t"))
    scope = only_left.select("report_month", "inn", "n_agr").distinct()
    start = F.to_date(F.concat("report_month", F.lit("-01")))
    months = scope.select("report_month", "n_agr").distinct()
    valid = (F.col("d_valid_from") <= F.last_day(start)) & (F.col("d_valid_to").isNull() | (F.col("d_valid_to") >= start))
    active = months.join(live.select("n_agr", "d_valid_from", "d_valid_to").distinct(), "n_agr").filter(valid)
    active = active.select("report_month", "n_agr").distinct().withColumn("_active", F.lit(True))
    rows = scope.join(last, "n_agr", "left").join(active, ["report_month", "n_agr"], "left")
    closed = F.col("_active").isNull() & F.coalesce(F.col("_t.to") < start, F.lit(False))
    per_inn = rows.groupBy("report_month", "inn").agg(F.max(closed.cast("int")).alias("closed"))
    counts = per_inn.groupBy("report_month").agg(F.sum("closed").alias("c"), F.sum(1 - F.col("closed")).alias("o"), F.count(F.lit(1)).alias("n"))
    out = counts.select("report_month", "n", _stack(
        [("agr_terms_closed_before_month_start", "c"), ("other_only_lake_reasons", "o")], "reason, cnt"))
    return out.select(
        "report_month", "reason", F.col("cnt").cast("long").alias("inn_cnt"), pct(F.col("cnt"), F.col("n")).alias("share_pct_of_only_lake")
    )


def month_totals(rows: DataFrame, metrics, inn="inn_key") -> DataFrame:
    """Companies, rows and metric sums per month."""
    per_inn = rows.groupBy("report_month", inn).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in metrics])
    return per_inn.groupBy("report_month").agg(
        F.count(inn).alias("unique_inn"), F.sum("_n").alias("agr_rows"), *[F.sum(c).alias(c) for c in metrics]
    )


def peer_month_compare(totals: DataFrame, focus: str, peers, metrics) -> DataFrame:
    """One month against the mean of its peers, per metric."""
    at_focus, at_peer = F.col("report_month") == focus, F.col("report_month").isin(*peers)
    aggs = []
    for c in metrics:
        value = F.col(c).cast("double")
        peer_sum, peer_n = F.sum(F.when(at_peer, F.col(c))).cast("double"), F.count(F.when(at_peer, F.col(c)))
        aggs += [F.max(F.when(at_focus, value)).alias(f"_f_{c}"), (peer_sum / peer_n).alias(f"_p_{c}")]
    rows = totals.filter(at_focus | at_peer).agg(*aggs).select(
        _stack([(c, f"_f_{c}", f"_p_{c}") for c in metrics], "metric, focus, peer_mean")
    )
    return rows.withColumns(
        {
            "delta_vs_peer_mean": F.col("focus") - F.col("peer_mean"),
            "pct_vs_peer_mean": ratio("focus", "peer_mean") - 1.0,
        }
    )


def month_pair_deltas(rows: DataFrame, left: str, right: str, metrics, keys=("inn_key", "agr_id_key")) -> DataFrame:
    """Each key's values in two months and their differences, missing months as zero."""
    def at(month, c):
        return F.coalesce(F.sum(F.when(F.col("report_month") == month, F.col(c))), F.lit(0))

    out = rows.filter(F.col("report_month").isin(left, right)).groupBy(*keys).agg(
        *[at(left, c).alias(f"{c}_left") for c in metrics], *[at(right, c).alias(f"{c}_right") for c in metrics]
    )
    return out.withColumns({f"d_{c}": F.col(f"{c}_right") - F.col(f"{c}_left") for c in metrics})


def delta_decomposition(pair: DataFrame, metrics, lead: str = "chod") -> DataFrame:
    """Among keys whose lead metric fell: how much each component fell, and the identity check."""
    drop = F.col(f"d_{lead}") < 0
    total = pair.filter(drop).agg(
        F.count(F.lit(1)).alias("keys_with_drop"),
        *[F.coalesce(F.sum(f"d_{c}"), F.lit(0)).alias(f"sum_d_{c}") for c in metrics],
    )
    share = {f"share_{c}": ratio(f"sum_d_{c}", f"sum_d_{lead}") for c in metrics if c != lead}
    gap = F.col("sum_d_fin_result") - (F.col("sum_d_chod") - F.col("sum_d_aur") - F.col("sum_d_amortization"))
    return total.withColumns({**share, "identity_gap": gap})


def largest_drops(pair: DataFrame, metric: str, n: int = 20) -> DataFrame:
    """The n largest drops."""
    return pair.filter(F.col(f"d_{metric}") < 0).orderBy(f"d_{metric}", "inn_key", "agr_id_key").limit(n)


def drop_share(pair: DataFrame, metric: str, n: int = 20) -> DataFrame:
    """Sum of all drops and the part that the n largest explain."""
    total = pair.filter(F.col(f"d_{metric}") < 0).agg(F.sum(f"d_{metric}").alias("total_drop"), F.count(F.lit(1)).alias("keys"))
    top = largest_drops(pair, metric, n).agg(F.sum(f"d_{metric}").alias("top_drop")).scalar()
    return total.withColumn("top_drop", top).withColumn("top_share", ratio("top_drop", "total_drop"))


def presence_changes(rows: DataFrame, left: str, right: str, keys=("inn_key", "agr_id_key")) -> DataFrame:
    """Keys that are in one of two months only."""
    in_left, in_right = F.col("report_month") == left, F.col("report_month") == right
    per_key = rows.filter(in_left | in_right).groupBy(*keys).agg(F.max(in_left).alias("l"), F.max(in_right).alias("r"))
    return per_key.filter(F.col("l") != F.col("r")).select(
        *keys, F.when(F.col("l"), "left_only").otherwise("right_only").alias("side")
    )


def coverage_vs_prior(totals: DataFrame, month: str, prior: str, history, metrics) -> DataFrame:
    """An incomplete month as percent of the previous one and of the mean of a history."""
    past = F.col("report_month").isin(*history)
    aggs = []
    for c in metrics:
        value = F.col(c).cast("double")
        mean = F.sum(F.when(past, F.col(c))).cast("double") / F.count(F.when(past, F.col(c)))
        aggs += [
            F.max(F.when(F.col("report_month") == month, value)).alias(f"_m_{c}"),
            F.max(F.when(F.col("report_month") == prior, value)).alias(f"_p_{c}"),
            mean.alias(f"_a_{c}"),
        ]
    rows = totals.agg(*aggs).select(
        _stack([(c, f"_m_{c}", f"_p_{c}", f"_a_{c}") for c in metrics], "metric, value, prior, history_mean")
    )
    return rows.withColumns(
        {
            "pct_of_prior": ratio("value", "prior") * 100.0,
            "pct_of_mean": ratio("value", "history_mean") * 100.0,
            "delta_vs_prior": F.col("value") - F.col("prior"),
        }
    )


def gold_keys(lake: DataFrame, ref: DataFrame, months_n: int, counts, money, tol=0.01, activity=("trx_cnt", "trx_sum")) -> DataFrame:
    """Companies present, exactly equal and active in every month, with their means."""
    both = lake.join(ref, ["report_month", "inn_key"])
    zero = F.lit(0)
    equal = F.lit(True)
    for c in counts:
        equal = equal & (F.coalesce(f"{c}_lake", zero) == F.coalesce(f"{c}_excel", zero))
    for c in money:
        equal = equal & (F.abs(F.coalesce(f"{c}_lake", zero) - F.coalesce(f"{c}_excel", zero)) <= F.lit(tol))
    active = F.lit(True)
    for c in activity:
        active = active & (F.coalesce(f"{c}_lake", zero) > 0)
    per_inn = both.groupBy("inn_key").agg(
        F.count(F.lit(1)).alias("months_n"),
        F.count_if(equal).alias("months_ok"),
        F.count_if(active).alias("months_dyn"),
        F.sum("trx_sum_lake").alias("sum_trx_sum"),
        F.sum("chod_lake").alias("_chod"),
    )
    good = per_inn.filter((F.col("months_n") >= months_n) & (F.col("months_ok") >= months_n) & (F.col("months_dyn") >= months_n))
    return good.withColumns(
        {
            "avg_trx_sum": F.col("sum_trx_sum").cast("double") / F.col("months_n"),
            "avg_chod": F.col("_chod").cast("double") / F.col("months_n"),
        }
    ).drop("_chod")


def ab_variant_compare(rows: DataFrame, metrics) -> DataFrame:
    """Which of two counting variants lies closer to the report, per metric."""
    aggs = []
    for c in metrics:
        a = F.abs(F.col(f"{c}_excel") - F.col(f"{c}_a"))
        b = F.abs(F.col(f"{c}_excel") - F.col(f"{c}_b"))
        aggs += [
            F.count_if(b < a).alias(f"_b_{c}"), F.count_if(a < b).alias(f"_a_{c}"),
            (F.sum(a).cast("double") / F.count(a)).alias(f"_ma_{c}"), (F.sum(b).cast("double") / F.count(b)).alias(f"_mb_{c}"),
        ]
    totals = rows.agg(F.count(F.lit(1)).alias("rows_total"), *aggs)
    entries = [(c, f"_b_{c}", f"_a_{c}", f"_ma_{c}", f"_mb_{c}") for c in metrics]
    out = totals.select("rows_total", _stack(entries, "metric, nb, na, mae_a, mae_b"))
    return out.select(
        "metric", "rows_total", F.col("nb").cast("long").alias("better_b_cnt"), F.col("na").cast("long").alias("better_a_cnt"),
        pct(F.col("nb"), F.col("rows_total")).alias("better_b_pct"), "mae_a", "mae_b",
    )


def multi_parent_check(rows: DataFrame, ref: DataFrame, metrics, parent="n_agr", keys=("inn_key", "agr_id_key")) -> DataFrame:
    """For keys with several parents: is the maximum or the sum of the parents closer to the report?"""
    keys = list(keys)
    both = rows.dropna(subset=keys).groupBy(*keys).agg(
        F.countDistinct(parent).alias("_parents"),
        *[F.max(c).alias(f"{c}_max") for c in metrics], *[F.sum(c).alias(f"{c}_sum") for c in metrics],
    )
    pairs = both.filter("_parents > 1").join(ref, keys)
    aggs = []
    for c in metrics:
        by_max, by_sum = F.abs(F.col(f"{c}_max") - F.col(f"{c}_excel")), F.abs(F.col(f"{c}_sum") - F.col(f"{c}_excel"))
        aggs += [
            (F.sum(by_max).cast("double") / F.count(by_max)).alias(f"_mm_{c}"),
            (F.sum(by_sum).cast("double") / F.count(by_sum)).alias(f"_ms_{c}"),
            F.count_if(by_sum < by_max).alias(f"_s_{c}"), F.count_if(by_max < by_sum).alias(f"_m_{c}"),
            F.count_if(by_max == by_sum).alias(f"_q_{c}"),
        ]
    totals = pairs.agg(F.count(F.lit(1)).alias("rows_compared"), *aggs)
    entries = [(c, f"_mm_{c}", f"_ms_{c}", f"_s_{c}", f"_m_{c}", f"_q_{c}") for c in metrics]
    out = totals.select("rows_compared", _stack(entries, "metric, mae_max, mae_sum, s, m, q"))
    return out.select(
        "metric", "rows_compared", "mae_max", "mae_sum", F.col("s").cast("long").alias("better_sum_cnt"),
        F.col("m").cast("long").alias("better_max_cnt"), F.col("q").cast("long").alias("equal_cnt"),
    )


def ratio_bucket_counts(deltas: DataFrame) -> DataFrame:
    """How often mismatches are a whole multiple of each other."""
    off = deltas.filter("not is_exact")
    return off.groupBy(ratio_bucket(ratio("excel", "lake")).alias("ratio_bucket")).agg(F.count(F.lit(1)).alias("rows"))


def three_way_compare(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Totals per month of several tables side by side; ``sources`` holds (table, value column)."""
    tagged = None
    for name, (df, value) in sources.items():
        part = df.groupBy("report_month").agg(F.sum(value).alias(f"{name}_total"))
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    return tagged.groupBy("report_month").agg(*[F.max(f"{n}_total").alias(f"{n}_total") for n in sources])


def padding_audit(lake: DataFrame, ref: DataFrame, agr="agr_id") -> DataFrame:
    """Rows whose taxpayer id changes by zero padding, and shared keys before and after it."""
    def side(df, name):
        return df.select(
            digits_only("inn").alias("raw"), norm_inn("inn").alias("padded"), F.col(agr).alias("agr"), F.lit(name).alias("side")
        )

    rows = side(lake, "lake").unionByName(side(ref, "excel"))

    def keys(column):
        per_key = rows.filter(F.col(column).isNotNull() & F.col("agr").isNotNull()).groupBy(F.col(column).alias("inn"), "agr").agg(
            F.max((F.col("side") == "lake").cast("int")).alias("l"), F.max((F.col("side") == "excel").cast("int")).alias("e")
        )
        return per_key.agg(
            F.sum(F.col("l") * F.col("e")).alias(f"{column}_both"),
            F.sum(F.col("l") * (1 - F.col("e"))).alias(f"{column}_only_lake"),
            F.sum(F.col("e") * (1 - F.col("l"))).alias(f"{column}_only_excel"),
        )

    changed = F.coalesce(F.col("raw") != F.col("padded"), F.lit(False))
    audit = rows.agg(
        F.count_if(changed & (F.col("side") == "lake")).alias("padded_rows_lake"),
        F.count_if(changed & (F.col("side") == "excel")).alias("padded_rows_excel"),
    )
    return one_row(one_row(audit, keys("raw")), keys("padded"))
