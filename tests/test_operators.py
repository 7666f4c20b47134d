import datetime as dt
import os
import random
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerloom.operators import dedup as dd, fuzzy as fz, mapping as mp, quantiles as qt, spans as sp, validity as va
from ledgerloom.plans import amortization as am, events as ev, income as ic, keysets as ks, metrics as me, perimeter as pe, products as pr, quality as ql
from ledgerloom.sources import readers as rd, writers as wr


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def day(text):
    return dt.date.fromisoformat(text) if text else None


def test_active_months_end_rules(spark):
    df = spark.createDataFrame([(1, day("2026-01-15"), day("2026-03-01")), (2, day("2026-02-10"), None), (3, day("2026-01-01"), day("2026-01-31"))],
                               "id int, d_valid_from date, d_valid_to date")
    def months(rule):
        rows = va.active_months(df, "2026-01-01", "2026-03-31", until=rule).collect()
        return sorted((r.id, r.month_start.month) for r in rows)
    assert months("month_start") == [(1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 1)]
    assert months("after_month_start") == [(1, 1), (1, 2), (2, 2), (2, 3), (3, 1)]
    assert months("month_end") == [(1, 1), (1, 2), (2, 2), (2, 3), (3, 1)]
    assert "Exchange" not in plan(va.active_months(df, "2026-01-01", "2026-03-31"))


def test_interval_join_matches_brute_force(spark):
    rng = random.Random(7)
    base = dt.date(2025, 1, 1)
    facts = [(i, rng.choice("aab"), base + dt.timedelta(rng.randrange(300))) for i in range(200)]
    dims = []
    for j in range(40):
        start = base + dt.timedelta(rng.randrange(300))
        dims.append((rng.choice("abc"), j, start, None if rng.random() < 0.2 else start + dt.timedelta(rng.randrange(90))))
    out = va.interval_join(
        spark.createDataFrame(facts, "id int, k string, d date"),
        spark.createDataFrame(dims, "k string, dim int, d_valid_from date, d_valid_to date"), "k", "d", "2025-01-01", "2025-12-31",
    )
    expected = []
    for i, k, d in facts:
        hits = [j for kk, j, a, b in dims if kk == k and a <= d and (b is None or d <= b)]
        expected += [(i, j) for j in hits] or [(i, None)]
    assert sorted(((r.id, r.dim) for r in out.collect()), key=str) == sorted(expected, key=str)


def test_latest_version_limits_rows_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    out = dd.latest_version(df, ["k"], [F.col("id").desc()])
    assert sorted((r.k, r.id) for r in out.collect()) == [(0, 9998), (1, 9999)]
    text = plan(out)
    assert "Partial" in text and text.index("Exchange") > text.index("WindowGroupLimit")


def test_unique_join_fails_on_repeated_key(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    good = spark.createDataFrame([(1, "a")], "k int, v string")
    assert sorted((r.k, r.v) for r in dd.unique_left_join(left, good, ["k"]).collect()) == [(1, "a"), (2, None)]
    bad = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate key"):
        dd.unique_left_join(left, bad, ["k"]).select("v").collect()
    with pytest.raises(Exception, match="duplicate key"):
        dd.unique_left_join(left, bad, "k").count()


def test_invariants(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (None, 1)], "part int, whole int")
    assert ql.invariants(df, {"part within whole": "part <= whole"}).first().violations == 2
    with pytest.raises(Exception, match="invariant broken"):
        ql.require_invariants(df, {"part within whole": "part <= whole"}).select("whole").collect()
    with pytest.raises(ValueError, match="missing columns"):
        ql.invariants(df, {}, ["other"])


def test_exact_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=3000).round(3), np.full(1500, 0.25)])
    groups = np.where(np.arange(values.size) % 4 == 0, "x", "y")
    df = spark.createDataFrame(pd.DataFrame({"g": groups, "v": values}))
    probs = (0.0, 0.1, 0.5, 0.77, 0.99, 1.0)
    row = qt.exact_quantiles(df, "v", probs, accuracy=200).first()
    assert np.allclose(list(row), np.quantile(values, probs))
    for r in qt.exact_quantiles(df, "v", probs, ["g"], accuracy=100).collect():
        assert np.allclose(list(r)[1:], np.quantile(values[groups == r.g], probs))


def test_quantile_bounds_are_narrowed_until_few_values_are_left(spark, monkeypatch):
    monkeypatch.setattr(qt, "CUTS", 8)
    ranked = []
    kept = qt.narrowed
    monkeypatch.setattr(qt, "narrowed", lambda parts, by, probs, limit: ranked.append(kept(parts, by, probs, limit)) or ranked[-1])
    rng = np.random.default_rng(8)
    values = np.concatenate([np.exp(rng.normal(size=6000) * 4), np.full(900, 1.5), -rng.random(300)])
    groups = np.where(np.arange(values.size) % 5 == 0, "x", "y")
    groups[:60] = ""
    df = spark.createDataFrame(pd.DataFrame({"g": groups, "v": values})).withColumn("g", F.nullif("g", F.lit("")))
    probs = (0.0, 0.05, 0.5, 0.5001, 0.93, 1.0)
    row = qt.exact_quantiles(df, "v", probs, accuracy=20, limit=15).first()
    assert np.allclose(list(row), np.quantile(values, probs))
    for r in qt.exact_quantiles(df, "v", probs, ["g"], accuracy=20, limit=15).filter("g is not null").collect():
        assert np.allclose(list(r)[1:], np.quantile(values[groups == r.g], probs))
    for parts, keys in zip(ranked, (["_i"], ["g", "_i"])):
        assert parts.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 15 + 2


def test_list_per_key_has_one_shape_for_any_size(spark):
    hot = spark.range(20_001).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("v"))
    few = spark.createDataFrame([("cold", "5"), ("cold", "4"), ("cold", "5"), ("cold", "nan"), ("cold", " "), ("gone", "None")], "k string, v string")
    rows = dd.list_per_key(hot.union(few), ["k"], "v")
    assert rows.columns == ["k", "v", "position", "v_cnt"]
    got = rows.filter("k = 'hot'").orderBy("position").collect()
    assert [r.v for r in got] == sorted(str(i) for i in range(20_001)) and [r.position for r in got] == list(range(1, 20_002))
    assert {tuple(r) for r in rows.filter("k <> 'hot'").collect()} == {("cold", "4", 1, 2), ("cold", "5", 2, 2)}
    text = dd.joined_lists(rows, ["k"], "v", few).collect()
    assert [tuple(r) for r in text] == [("cold", 2, "4,5")]


def test_list_per_key_deals_a_hot_key_to_many_tasks(spark):
    """Places are numbered within partitions of the sorted values, none of which holds the whole key."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else 30,000 values are one partition
    try:
        rows = dd.list_per_key(spark.range(30_000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("v")), ["k"], "v")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = next(f for f in rows.inputFiles())
    dealt = spark.read.parquet(os.path.dirname(stored))
    assert dealt.groupBy("_part").count().agg(F.max("count")).first()[0] < 15_000
    assert rows.agg(F.max("position"), F.countDistinct("position")).first()[:] == (30_000, 30_000)


def test_one_row_per_key_takes_the_first_by_all_columns(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 2, 9), ("a", 2, 3), ("b", None, None), (None, 5, 5)], "k string, x int, y int")
    assert {tuple(r) for r in dd.drop_duplicates_by(df, ["k"]).collect()} == {("a", 2, 3), ("b", None, None), (None, 5, 5)}
    assert "Window" not in plan(dd.drop_duplicates_by(df, ["k"]))


def test_quantile_plans_have_no_cross_join(spark):
    df = spark.range(500).select(F.col("id").alias("v"), (F.col("id") % 7).alias("k"), F.lit(2).alias("b"))
    from ledgerloom.plans import selection as se

    for out in (qt.exact_quantiles(df, "v", [0.5, 0.9]), ql.numeric_profile(df, "v"), se.ratio_profile(df, "b", "v"), se.ratio_coefficients(df, "k", "b", "v")):
        text = plan(out)
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_quantiles_of_few_values(spark):
    for values in ([3.0], [1.0, 2.0], [5.0, 5.0, 5.0, 7.0], [float(i) for i in range(10)], [1.0] * 99 + [2.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        probs = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
        assert np.allclose(list(qt.exact_quantiles(df, "v", probs).first()), np.quantile(values, probs)), values
        counted = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        assert np.allclose(list(qt.counted_quantiles(counted, "v", "n", probs).first()), np.quantile(values, probs)), values


def test_any_number_of_products(spark):
    long = spark.range(3000).select(F.lit("1").alias("inn"), F.concat(F.lit("p"), "id").alias("product_name"), F.lit(1).alias("has_product"))
    row = pr.product_flags_wide(long, flags=("p1",), excluded=("p2",), extras=("p3", "zz")).first()
    assert (row.p1, row.p3, row.zz) == (1, 1, 0) and len(row.other_products) == 2997


def test_intermediate_data_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from ledgerloom import session

    monkeypatch.setattr(session, "_chosen", [])
    with pytest.raises(ValueError):
        session.checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default)))


def test_a_new_required_column_is_computed_once(spark, tmp_path):
    calls = []

    def compute(columns):
        def run(months):
            calls.append(months)
            return spark.createDataFrame([(m, 1, 2) for m in months], "report_month string, v int, w int").select("report_month", *columns)

        return run

    path, months = str(tmp_path / "months"), ["2026-01", "2026-02", "2026-03"]
    wr.read_or_compute_month(spark, path, months, compute(["v"]), ["v"])
    for _ in range(3):
        out = wr.read_or_compute_month(spark, path, ["2026-02"], compute(["v", "w"]), ["v", "w"])
        assert [(r.report_month, r.v, r.w) for r in out.collect()] == [("2026-02", 1, 2)]
    assert calls == [months, ["2026-02"]]
    rows = {r.report_month: (r.v, r.w) for r in wr.read_months(spark, path).collect()}
    assert rows == {"2026-01": (1, None), "2026-02": (1, 2), "2026-03": (1, None)}
    with pytest.raises(ValueError):
        wr.read_or_compute_month(spark, path, ["2026-04"], compute(["v"]), ["w"])


def test_predecessors_match_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    base = dt.date(2026, 1, 1)
    rows = [("hot" if rng.random() < 0.4 else f"i{rng.randrange(12)}", rng.choice("AB"), base + dt.timedelta(rng.randrange(80)),
             rng.choice("XY"), rng.choice(["t1", "p1", "p2", "p3"])) for _ in range(400)]
    events = spark.createDataFrame(rows, "inn string, segment string, dt date, type string, code string")
    targets = spark.createDataFrame([("A", "X", "t1"), ("B", "Y", "t1"), ("A", "X", "zz")], "segment string, type string, code string")
    keys = {("A", "X", "t1"), ("B", "Y", "t1")}
    lo, hi, days = dt.date(2026, 1, 20), dt.date(2026, 3, 10), 10
    stats = {}
    totals = {}
    for i, (inn, seg, d, ty, code) in enumerate(rows):
        if not lo <= d <= hi:
            continue
        hit = (seg, ty, code) in keys
        n, t = totals.get(seg, (0, 0))
        totals[seg] = (n + 1, t + hit)
        before = {(p[3], p[4]) for p in rows if p[0] == inn and p[1] == seg and (seg, p[3], p[4]) not in keys and 0 < (d - p[2]).days <= days}
        for pair in before:
            s = stats.setdefault((seg, *pair), [0, set(), 0])
            s[2] += 1
            if hit:
                s[0] += 1
                s[1].add(inn)
    out = ev.predecessor_stats(events, targets, str(lo), str(hi), days).filter("anchors_with_pred > 0").collect()
    got = {(r.segment, r.pred_type, r.pred_code): (r.target_cases, r.unique_inn, r.anchors_with_pred) for r in out}
    assert got == {k: (v[0], len(v[1]), v[2]) for k, v in stats.items()}
    for r in out:
        n, t = totals[r.segment]
        assert r.base_target_rate == pytest.approx(t / n)
    top = ev.predecessor_top_n(ev.predecessor_stats(events, targets, str(lo), str(hi), days), 2).collect()
    assert {r.rank_in_segment for r in top} == {1, 2}
    with_prior = sum(1 for inn, seg, d, ty, code in rows if lo <= d <= hi and (seg, ty, code) in keys and any(
        p[0] == inn and p[1] == seg and (seg, p[3], p[4]) not in keys and 0 < (d - p[2]).days <= days for p in rows))
    summary = ev.predecessor_summary(events, targets, str(lo), str(hi), days).collect()
    assert sum(r.target_events_with_predecessor for r in summary) == with_prior


def test_running_counts_of_a_hot_key_are_taken_in_blocks(spark):
    base = dt.date(2026, 1, 1)
    rng = random.Random(11)
    anchors = [("hot", base + dt.timedelta(d), 1 + d % 3, d % 2) for d in range(64)] + [("few", base + dt.timedelta(5), 2, 1)]
    marks = [(k, None, None, d, 1, n, t) for k, d, n, t in anchors]
    marks += [("hot", f"c{i}", 1, base + dt.timedelta(rng.randrange(-20, 90)), rng.choice([0, 2]), None, None) for i in range(4000)]
    marks += [("few", "c", 1, base + dt.timedelta(d), s, None, None) for d in (-1, 4, 5, 6, 30, 70) for s in (0, 2)] + [("few", "c", 1, None, 0, None, None)]
    df = spark.createDataFrame(marks, "inn string, code string, sign int, day date, step int, n int, t int")
    days = spark.createDataFrame(anchors, "inn string, dt date, n int, t int")
    start, end = F.lit(base), F.lit(base + dt.timedelta(63))
    out = ev.counted_to(df, days, ["inn"], ["n", "t"], start, end, 16)
    for r in out.filter("sign is not null").collect():
        upto = [a for a in anchors if a[0] == r.inn and r.day and (a[1] < r.day or a[1] == r.day and r.step > 1)]
        assert (r.cn, r.ct) == (sum(a[2] for a in upto), sum(a[3] for a in upto))
    sizes = [r["count"] for r in out.filter("inn = 'hot'").groupBy("_block").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 4100 / 3
    assert "_block" in plan(out).split("Window [")[1].split("\n")[0]


def test_similar_names_find_every_pair(spark):
    rng = random.Random(11)
    def name():
        return " ".join("".join(rng.choice("ABCDE") for _ in range(rng.randrange(2, 6))) for _ in range(rng.randrange(1, 3)))
    left, right = sorted({name() for _ in range(60)}), sorted({name() for _ in range(60)})
    def grams(s):
        s = f"  {s}  "
        return {s[i:i + 3] for i in range(len(s) - 2)}
    expected = {}
    for a in left:
        for b in right:
            x, y = grams(a), grams(b)
            sim = 2 * len(x & y) / (len(x) + len(y))
            if sim >= 0.55:
                expected[a, b] = sim
    frames = [spark.createDataFrame([(n,) for n in names], "name string") for names in (left, right)]
    got = {(r.name_l, r.name_r): r.name_sim for r in fz.similar_names(*frames).collect()}
    assert got == pytest.approx(expected) and expected


def test_fuzzy_statuses(spark):
    left = spark.createDataFrame([(1, "ООО Ромашка"), (2, "Ромашкин Двор"), (3, "Zzz"), (4, "Лютик")], "row_id int, name string")
    right = spark.createDataFrame([("ООО «Ромашка»", "a1", "i1"), ("Лютик", "a2", "i2"), ("лютик", "a3", "i3"), ("Ромашкин  дворик", "a4", "i4")], "name string, agr_id string, inn string")
    got = {r.row_id: (r.match_status, r.matched_agr_id) for r in fz.fuzzy_entity_match(left, right).collect()}
    assert got[1] == ("matched_by_name_high", "a1")
    assert got[2] == ("ambiguous_low_confidence", "a4")
    assert got[3] == ("not_found", None)
    assert got[4][0] == "ambiguous_multi_candidates"


def looked_up(left, right, threshold=0.55, near=5.0, high=0.95):
    """The rule in plain Python: every pair of names is compared."""
    out, disputed = {}, {}
    for row, name in left:
        pool = []
        for other, *ids in sorted({(n, *i) for n, *i in right}):
            sim = SequenceMatcher(None, name, other).ratio()
            if sim >= threshold:
                pool.append((-(sim * 100 + (30 if name == other else 0)), other, tuple(ids), sim))
        pool.sort()
        if not pool:
            out[row] = ("not_found", None, None)
            continue
        close = {p[2] for p in pool if -p[0] >= -pool[0][0] - near}
        status = "ambiguous_multi_candidates" if len(close) > 1 else "matched_by_name_high" if pool[0][3] >= high else "ambiguous_low_confidence"
        out[row] = (status, pool[0][1], pool[0][2])
        if status != "matched_by_name_high":
            disputed[row] = [(p[1], p[2]) for p in pool[:5]]
    return out, disputed


@pytest.mark.parametrize("few_ids", [True, False])
def test_names_are_matched_as_by_comparing_all_pairs(spark, few_ids):
    rng = random.Random(5)
    def name():
        return " ".join("".join(rng.choice("ABCDEF") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(1, 4)))
    names = [name() for _ in range(80)]
    left = [(i, n) for i, n in enumerate([*names, "A" * 19 + "B", "A" * 40, "QQQQ", "AAAAAAAAAABBBBBBBBB"])]
    right = [(n[:k] + rng.choice("ABX") + n[k:], f"a{i % 3 if few_ids else i}", "i") for i, n in enumerate(names) for k in (0, len(n) // 2)]
    right += [(n, "a0", "i") for n in names[:30]] + [("A" * 19 + "C", "a9", "i9"), ("A" * 39 + "B", "a8", "i8"), ("AAAAAAAAAA", "a7", "i7")]
    expected, disputed = looked_up(left, right)
    assert {s for s, _, _ in expected.values()} == {"not_found", "ambiguous_multi_candidates", "matched_by_name_high", "ambiguous_low_confidence"}
    frames = spark.createDataFrame(left, "row_id int, name string"), spark.createDataFrame(right, "name string, agr_id string, inn string")
    status, candidates = fz.name_matches(*frames)
    got = {r.row_id: (r.match_status, r.matched_name, r.matched_agr_id and (r.matched_agr_id, r.matched_inn)) for r in status.collect()}
    assert got == expected
    listed = {}
    for r in candidates.orderBy("row_id", "candidate").collect():
        listed.setdefault(r.row_id, []).append((r.candidate_name, (r.agr_id, r.inn)))
    assert listed == disputed


def test_names_meet_in_blocks(spark):
    rng = random.Random(6)
    names = sorted({"".join(rng.choice("ABCD") for _ in range(8)) for _ in range(90)})
    left = spark.createDataFrame([(n,) for n in names[::2]], "name string")
    right = spark.createDataFrame([(n, f"a{i}", "i") for i, n in enumerate(names)], "name string, agr_id string, inn string")
    whole, small = ({tuple(r) for r in fz.name_candidates(left, right, block=b).collect()} for b in (1000, 7))
    best = {n: max(r[4] for r in whole if r[0] == n) for n in names[::2]}
    assert {n: max(r[4] for r in small if r[0] == n) for n in names[::2]} == best == {n: 130.0 for n in names[::2]}


def trx_inputs(spark, fee_copies):
    scope = spark.createDataFrame([("A1", day("2026-01-01"), "C1", "I1")], "n_agr string, month_start date, n_cmp_client string, inn string")
    trx = spark.createDataFrame([(f"T{i}", f"D{i % 2}", "F", 10.0 if i else 0.5, dt.datetime(2026, 1, 5), "SA", "S01", None, None) for i in range(4)],
                                "n_trx string, c_nter string, c_fiid_acq string, n_amt_src double, d_trx_orig timestamp, c_trx_class string, c_trx_type string, cf_trx_stat string, ods_deleted_flg string")
    acq = spark.createDataFrame([(f"T{i}", "A1", 1.0) for i in range(4)], "n_trx string, n_agr string, n_amt_tax double")
    fees = spark.createDataFrame([(f"T{i}", -0.25, None) for i in range(4) for _ in range(fee_copies)], "n_trx string, n_amt_fee double, ods_deleted_flg string")
    fiids = spark.createDataFrame([("F", "HOME")], "c_fiid string, c_fiid_grp string")
    return scope, trx, acq, fees, fiids, "2026-01-01", "2026-01-31", "HOME"


@pytest.mark.parametrize("copies", [1, 2])
def test_repeated_fee_lines_change_only_the_naive_totals(spark, copies):
    args = trx_inputs(spark, copies)
    good = me.transaction_metrics(*args).first()
    naive = me.transaction_metrics_naive(*args).first()
    assert (good.trx_cnt, good.trx_sum, good.commission_from_ops, good.int_component, good.active_terms, good.active_term_cnt) == (4, 30.5, 4.0, -1.0, 2, 2)
    assert (naive.trx_sum == good.trx_sum) == (copies == 1)


def test_contribution_sums_to_the_company_value(spark):
    mart = spark.createDataFrame([("1234567890", "2026-01", f"a{i % 50}", f"n{i}") for i in range(200)] + [("0987654321", "2026-01", "a", "n")],
                                 "inn string, report_month string, agr_id string, n_agr string")
    income = spark.createDataFrame([("1234567890", 202601, 70.0, 2), ("987654321", 202601, -5.0, 1)], "inn string, yearmm int, total_income double, src_cnt int")
    out = ic.enrich_total_income(mart, income)
    sums = {r.inn: r.s for r in out.groupBy("inn").agg(F.sum("total_income_contrib").alias("s")).collect()}
    assert sums == {"1234567890": 70.0, "0987654321": -5.0} and out.count() == 201
    assert ic.contribution_drift(out).first().drift == 0.0


def test_perimeter_ignores_input_order(spark):
    agreements = spark.createDataFrame([(str(i), f"a{i}", "c1", f"n{i}", " sa", day("2026-01-01"), None, None) for i in range(20)],
                                       "n_agr string, abs_agr_id string, n_cmp_client string, c_agr_number string, acq_class string, d_valid_from date, d_valid_to date, ods_deleted_flg string")
    companies = spark.createDataFrame([("c1", "12-34", "N", None), ("c2", None, "M", None)], "n_cmp string, c_inn string, c_cmp_name string, ods_deleted_flg string")
    terms = spark.createDataFrame([(str(i), "p", day("2026-01-10"), day("2026-02-01") if i % 2 else None, None) for i in range(10)],
                                  "n_agr string, cf_ter_type string, d_valid_from date, d_valid_to date, ods_deleted_flg string")
    def result(a, t):
        return sorted((r.n_agr, str(r.month_start)) for r in pe.perimeter(a, companies, t, "2026-01-01", "2026-02-28").collect())
    first = result(agreements, terms)
    assert first == result(agreements.orderBy(F.rand(1)).union(agreements), terms.orderBy(F.rand(2)))
    assert len(first) == 15


def test_skewed_join_is_split_by_adaptive_execution(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    for k, v in zip(keep, ("-1", "20KB", "10KB", "2")):
        spark.conf.set(k, v)
    try:
        facts = spark.range(60_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        dims = spark.range(60_000, numPartitions=8).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("w"))
        out = facts.join(dims, "k", "left")
        assert len(out.collect()) == 60_000
        assert "skew=true" in plan(out)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_scan_csv_keeps_every_row(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    lines = ["note;1", "note 2", "id;comment;dt"] + [f"{i};c{i};2026" for i in range(5000)] + ["7;a;b;c;2025", "8", "id;comment;dt"]
    (tmp_path / "x.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10KB")
    try:
        rows = [tuple(r) for r in rd.scan_csv(spark, path, skip_rows=2).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert len(rows) == 5003 and ("0", "c0", "2026") in rows
    assert ("7", "a;b;c", "2025") in rows and ("8", "", "") in rows and ("id", "comment", "dt") in rows
    with pytest.raises(ValueError):
        rd.scan_csv(spark, path, skip_rows=9000)


def test_text_files_of_a_folder(spark, tmp_path):
    """Each file has its own preamble and order of columns, and more than one split."""
    folder = tmp_path / "in put"
    folder.mkdir()
    expected = set()
    for k, names in enumerate((["id", "comment", "n"], ["n", "id", "comment"], ["id", "comment", "n"])):
        lines = [f"preamble {k}", "id;comment;n", ";".join(names)]
        for i in range(400):
            row = {"id": f"{k}-{i}", "comment": "x;y" if i % 3 else "id;comment;n"[: i % 13], "n": str(i)}
            lines.append(";".join(row[c] for c in names))
            expected.add((row["id"], row["comment"], row["n"]))
        (folder / f"part {k}.txt").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2000", "1m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = rd.scan_csv(spark, str(folder), skip_rows=2)
            assert {tuple(r) for r in rows.select("id", "comment", "n").collect()} == expected and rows.count() == len(expected)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20")
        with pytest.raises(Exception, match="does not end in its file's first split"):
            rd.scan_csv(spark, str(folder), skip_rows=2).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_transactions_are_read_once(spark):
    """Agreements, companies and outlets in use come from one table of totals per device."""
    scope, trx, acq, fees, fiids, *period = trx_inputs(spark, 2)
    acq = acq.withColumn("ods_deleted_flg", F.when(F.col("n_trx") == "T1", "1"))
    places = spark.createDataFrame([("D0", "M1", None), ("D1", "M2", None)], "c_nter string, c_nmrc string, ods_deleted_flg string")
    totals = me.scoped_totals(scope, trx, acq, fees, fiids, *period)
    alone = me.active_outlets(trx, acq, places, fiids, *period).collect()
    assert me.outlets_in_use(totals, places).collect() == alone and [r.active_retl_cnt for r in alone] == [2]
    assert me.totals_per_agreement(totals).collect() == me.transaction_metrics(scope, trx, acq, fees, fiids, *period).collect()


def test_transactions_meet_spans_of_months(spark):
    """Each table is shuffled by the transaction number once; a scope of spans gives what its months give."""
    scope, trx, acq, fees, fiids, *period = trx_inputs(spark, 2)
    period = ["2025-11-01", "2026-02-28", "HOME"]
    spans = spark.createDataFrame([("A1", "C1", "I1", 2025 * 12 + 10, 2026 * 12 + 1), ("A1", "C1", "I1", 2026 * 12, 2026 * 12),
                                   ("A1", "C2", None, 2026 * 12, 2026 * 12), ("A2", "C1", "I1", 2026 * 12, 2026 * 12)],
                                  "n_agr string, n_cmp_client string, inn string, _first int, _last int")
    months = sp.span_months(spans)
    both = [{tuple(r) for r in me.transaction_metrics(s, trx, acq, fees, fiids, *period).select(
        "n_agr", "month_start", "n_cmp_client", "inn", "trx_cnt", "trx_sum", "active_terms", "active_term_cnt").collect()} for s in (spans, months)]
    assert both[0] == both[1] == {("A1", day("2026-01-01"), c, i, 4, 30.5, 2, 2) for c, i in (("C1", "I1"), ("C2", None))}
    assert plan(me._scoped(spans, trx, acq, fees, fiids, *period)).count("Exchange hashpartitioning(n_trx") == 3


def test_months_expand_after_a_join_by_key(spark):
    """``span_months_with`` is a left join on key and month, and shuffles no month."""
    spans = spark.createDataFrame([("a", 1, 24300, 24302), ("a", 2, 24301, 24301), ("b", 3, 24300, 24300), (None, 4, 24300, 24300)], "k string, v int, _first int, _last int")
    rows = spark.createDataFrame([("a", day("2025-02-01"), 5), ("a", day("2025-02-01"), 6), ("a", day("2026-01-01"), 7), ("b", day("2025-02-01"), None), (None, day("2025-01-01"), 9)],
                                 "k string, month_start date, x int")
    out = sp.span_months_with(spans, rows, "k")
    expected = sp.span_months(spans).join(rows, ["k", "month_start"], "left").select(*out.columns)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert "month_start" not in "".join(x for x in plan(out).split("\n") if "Exchange" in x)


def test_handover_events_are_not_shuffled(spark):
    """Like spans of a serial are counted before they become events, and only those counts are dealt by serial."""
    rows = [(" ", f"T{i}", i % 7, 24300 + i % 3, 24303, day("2025-02-01"), day("2025-04-01") if i % 2 else None) for i in range(400)]
    spans = spark.createDataFrame(rows, "c_pos_serial string, c_nter string, n_cmp int, _first int, _last int, d_ter_install date, d_ter_close date")
    flags = am.handover_flags(spans)
    found = {r.month_start: (r.n_c_nter, r.n_client, r.n_closed, r.n_opened, r.n_both) for r in flags.collect()}
    assert found == {day("2025-01-01"): (134, 7, 0, 0, 0), day("2025-02-01"): (267, 7, 0, 267, 0), day("2025-03-01"): (400, 7, 0, 0, 0),
                     day("2025-04-01"): (400, 7, 200, 0, 0)}
    assert not [x for x in plan(flags).split("\n") if "Exchange" in x and "_month" in x]


def test_count_variants_at_rows(spark):
    """Rows of agreement and month get the counts of their company's span."""
    pairs = spark.createDataFrame([("A1", "C1"), ("A2", "C1"), ("A2", "C2"), ("A3", None)], "n_agr string, n_cmp_client string")
    outlets = spark.createDataFrame([("M1", "C1", None), ("M2", "C1", None), ("M2", "C2", None), ("M3", "C3", None)], "c_nmrc string, n_cmp string, ods_deleted_flg string")
    devices = spark.createDataFrame([("D1", "M1", "2025-02-03", "2025-03-01", None), ("D1", "M2", None, "2025-02-01", None), ("D2", "M2", "2026-02-01", None, None)],
                                    "c_nter string, c_nmrc string, d_ter_install string, d_ter_close string, ods_deleted_flg string")
    devices = devices.withColumns({c: F.col(c).cast("date") for c in ("d_ter_install", "d_ter_close")})
    at = spark.createDataFrame([(i, a, day(f"2025-0{m}-01")) for i, (a, m) in enumerate((a, m) for a in ("A1", "A2", "A3", "A9") for m in (1, 2, 2, 3, 4))],
                               "id int, n_agr string, month_start date")
    args = pairs, outlets, devices, "2025-01-01", "2025-06-30"
    out = me.count_variants(*args, at=at)
    wanted = at.join(me.count_variants(*args), ["n_agr", "month_start"]).select(*out.columns)
    rows = sorted(map(tuple, out.collect()), key=repr)
    assert len(rows) == 11 and rows == sorted(map(tuple, wanted.collect()), key=repr)


def test_columns_and_schema(spark):
    df = spark.createDataFrame([("1", 2.0)], ["  ИНН  клиента", "x"])
    assert rd.resolve_columns(df, {"inn": ["инн клиента"], "aur": ["АУР"]}, ["inn"]).first().asDict() == {"inn": "1", "aur": None}
    with pytest.raises(ValueError, match="agr"):
        rd.resolve_columns(df, {"agr": ["нет"]})
    schema = StructType([StructField("x", StringType()), StructField("y", DoubleType())])
    assert rd.ensure_columns(df, schema).first().asDict() == {"x": "2.0", "y": None}
    issues = {tuple(r) for r in wr.schema_compat(df.select("x"), ["x", "z"], ["x", "w"]).collect()}
    assert issues == {("missing_required", "z"), ("missing_from_new", "w")}


def test_months_are_stored_once_and_recomputed_when_missing(spark, tmp_path):
    path, calls = str(tmp_path / "mart"), []
    def compute(months):
        calls.append(list(months))
        return spark.createDataFrame([(m, i) for m in months for i in range(3)], "report_month string, v int")
    for months in (["2026-01", "2026-02"], ["2026-01", "2026-02", "2026-03"]):
        assert wr.read_or_compute_month(spark, path, months, compute, ["v"]).count() == 3 * len(months)
    assert calls == [["2026-01", "2026-02"], ["2026-03"]]
    with pytest.raises(ValueError):
        wr.read_or_compute_month(spark, path, ["2026-01"], compute, ["v", "new"])
    wr.read_or_compute_month(spark, path, ["2026-02"], compute, force=True)
    assert calls[2:] == [["2026-01"], ["2026-02"]] and wr.read_months(spark, path).count() == 9


def test_changed_inputs_recompute_their_months(spark, tmp_path):
    path, source, calls = str(tmp_path / "mart"), str(tmp_path / "source"), []

    def compute(months):
        calls.append(list(months))
        return spark.read.parquet(source).filter(F.col("report_month").isin(*months))

    def stored():
        table = spark.read.parquet(source)
        return wr.read_or_compute_month(spark, path, months, compute, ["v"], fingerprint=wr.inputs_fingerprint(table))

    months = ["2026-01", "2026-02", "2026-03"]
    spark.createDataFrame([("2026-01", 1), ("2026-02", 2)], "report_month string, v int").write.parquet(source)
    for _ in range(2):
        assert {tuple(r) for r in stored().select("report_month", "v").collect()} == {("2026-01", 1), ("2026-02", 2)}
    before = wr.read_months(spark, path)
    assert calls == [months]  # the month without rows is known to be empty
    spark.createDataFrame([("2026-03", 3)], "report_month string, v int").write.mode("append").parquet(source)
    assert {tuple(r) for r in stored().select("report_month", "v").collect()} == {("2026-01", 1), ("2026-02", 2), ("2026-03", 3)}
    assert calls == [months, months] and before.count() == 2
    assert {m: e["rows"] for m, e in wr.month_entries(spark, path).items()} == {"2026-01": 1, "2026-02": 1, "2026-03": 1}


def test_two_writers_of_a_month_do_not_mix(spark, tmp_path):
    path = str(tmp_path / "mart")

    def rows(v):
        return lambda months: spark.createDataFrame([(m, v) for m in months for _ in range(2)], "report_month string, v int")

    def slower(fingerprint):
        def run(months):
            wr.read_or_compute_month(spark, path, months, rows(7), ["v"], fingerprint="a", force=True)
            return rows(8)(months)

        return wr.read_or_compute_month(spark, path, ["2026-01"], run, ["v"], fingerprint=fingerprint, force=True)

    assert [r.v for r in slower("a").collect()] == [7, 7]  # the same inputs: the first writer's rows stay
    with pytest.raises(RuntimeError, match="another writer"):
        slower("b")
    assert [r.v for r in wr.read_months(spark, path).collect()] == [7, 7]
    assert not wr._commit(spark, path, 1, {})  # a version is made once
    (tmp_path / "mart" / "manifest" / "draft-lost").touch()  # a writer that was lost before its version was in place
    out = wr.read_or_compute_month(spark, path, ["2026-01"], rows(9), ["v"], fingerprint="c")
    assert [r.v for r in out.collect()] == [9, 9]
    def others_month(months):
        wr.read_or_compute_month(spark, path, ["2026-02"], rows(1), fingerprint="d")
        return rows(2)(months)

    wr.read_or_compute_month(spark, path, ["2026-03"], others_month, fingerprint="e")  # writers of other months both enter theirs
    assert {r.report_month: r.v for r in wr.read_months(spark, path).collect()} == {"2026-01": 9, "2026-02": 1, "2026-03": 2}
    with pytest.raises(ValueError, match="in stored months"):
        wr.write_month(spark.createDataFrame([("2026-05", "x")], "report_month string, v string"), path)
        wr.read_months(spark, path)
    with pytest.raises(ValueError, match="without a month"):
        wr.write_month(spark.createDataFrame([(None, 1)], "report_month string, v int"), str(tmp_path / "other"))


def test_publish_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "Id int, v string")
    spark.sql(f"create database if not exists loom location '{tmp_path}/loom'")
    wr.publish_table(df, "loom.published")
    assert dict(spark.table("loom.published").dtypes) == {"id": "string", "v": "string"}
    with pytest.raises(RuntimeError, match="too few"):
        wr.publish_table(df.limit(1), "loom.published", checks=[lambda rows: "too few" if rows.count() < 2 else None])
    assert spark.table("loom.published").count() == 2
    before = wr.publish_table(df.union(df), "loom.published", checks=[lambda rows: None])
    assert spark.table("loom.published").count() == 4 and spark.read.parquet(before).count() == 2
    wr.publish_table(df.select("v"), "loom.published", text=False)
    assert spark.table("loom.published").columns == ["v"]
    wr.publish_view(df, "seen")
    assert spark.table("seen").count() == 2
    with pytest.raises(ValueError):
        wr.publish_view(df, "seen", "other")
    wr.report_export(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2
    wr.report_export(spark.range(500).repartition(6), str(tmp_path / "top"), top=3, order=[F.col("id").desc()])
    files = [f for f in os.listdir(tmp_path / "top") if f.endswith(".csv")]
    assert len(files) == 1 and (tmp_path / "top" / files[0]).read_text().split() == ["id", "499", "498", "497"]
    spark.sql("drop database loom cascade")


def _intervals(seed, n):
    rng = random.Random(seed)
    base = dt.date(2024, 1, 1)
    out = []
    for i in range(n):
        start = None if rng.random() < 0.1 else base + dt.timedelta(rng.randrange(-60, 700))
        end = None if rng.random() < 0.2 else (start or base) + dt.timedelta(rng.randrange(-20, 300))
        out.append((rng.choice("aaab"), i, start, end))
    return out


def test_spans_match_expanded_months(spark):
    df = spark.createDataFrame(_intervals(5, 120), "k string, id int, d_valid_from date, d_valid_to date")
    rows = df.withColumn("id", F.col("id") % 40).unionByName(df)
    spans = sp.month_spans(rows, "2024-03-01", "2025-10-31")
    months = va.active_months(rows, "2024-03-01", "2025-10-31")

    def expanded(spans, *columns):
        each = spans.withColumn("_m", F.explode(F.sequence(sp.FIRST, sp.LAST)))
        return sorted(tuple(r) for r in each.select(*columns, sp.month_of("_m").alias("m")).collect())

    assert expanded(spans, "k", "id") == sorted((r.k, r.id, r.month_start) for r in months.collect())
    latest = {}
    for r in months.collect():
        key, rank = (r.k, r.month_start), (r.d_valid_from, r.id)
        latest[key] = max(latest.get(key, rank), rank)
    chosen = sp.chosen_spans(spans, ["k"], ["d_valid_from", "id"], ["id"])
    assert expanded(chosen, "k", "id") == sorted((k, i, m) for (k, m), (_, i) in latest.items())
    assert expanded(sp.merged_spans(spans, ["k"]), "k") == sorted({(r.k, r.month_start) for r in months.collect()})
    sums = sp.monthly_sums(spans.withColumns({"n": F.lit(1), "w": F.col("id")}), ["k"], ["n", "w"])
    wanted = {}
    for r in months.collect():
        n, w = wanted.get((r.k, r.month_start), (0, 0))
        wanted[(r.k, r.month_start)] = (n + 1, w + r.id)
    assert {(r.k, r.month_start): (r.n, r.w) for r in sums.collect()} == wanted
    whole = sp.monthly_sums(spans.withColumn("n", F.lit(1)), [], ["n"])
    assert sum(r.n for r in whole.collect()) == months.count()
    assert sp.monthly_sums(spans.limit(0).withColumn("n", F.lit(1)), ["k"], ["n"]).count() == 0


def test_a_busy_key_shrinks_before_its_spans_are_chosen(spark):
    df = spark.range(20_000).select(
        F.lit("k").alias("k"), "id", F.expr("date_add(date '2024-01-01', cast(id % 300 as int))").alias("d_valid_from"), F.lit(None).cast("date").alias("d_valid_to")
    )
    spans = sp.month_spans(df, "2024-01-01", "2024-12-31")
    chosen = sp.chosen_spans(spans, ["k"], ["d_valid_from", "id"], ["id"])
    text = plan(chosen)
    assert text.rindex("partial_max") > text.rindex("Window")
    # One interval per first month is left for the window: ten here, of 20,000.
    assert spans.groupBy("k", sp.FIRST, sp.LAST).count().count() == 10
    assert chosen.count() == 10


def test_amort_volume_matches_the_model_by_month(spark):
    rng = random.Random(11)
    rows = []
    for code, i, start, end in _intervals(9, 200):
        serial = rng.choice([None, " ", "s1", "s2", "s3", f"x{i % 30}"])
        born = None if rng.random() < 0.2 else dt.date(2021, 1, 1) + dt.timedelta(rng.randrange(1600))
        rows.append((rng.choice([None, f"{code}{i % 12}", f"{code}{i % 12}"]), serial, start, end, born, rng.choice([None, "1"]) if i % 9 == 0 else None))
    devices = spark.createDataFrame(rows, "c_nter string, c_pos_serial string, d_ter_install date, d_ter_close date, d_ter_delivery date, ods_deleted_flg string")
    catalog = spark.createDataFrame([(f"{c}{j}", None, rng.choice(["m1", "m2", "m3", "m4"])) for c in "ab" for j in range(10)], "device string, code_device string, model_device string")
    prices = spark.createDataFrame([("M1", 100), ("m2", 250), ("M3", 0)], "model_name string, price int").withColumn("price", F.col("price").cast("decimal(12,2)"))
    model = am.amortization_model(devices, catalog, prices, "2024-03-01", "2025-10-31").toPandas()
    got = am.amort_volume(devices, catalog, prices, "2024-03-01", "2025-10-31").toPandas().set_index("month_start")
    assert len(got) == model["month_start"].nunique()
    for month, part in model.groupby("month_start"):
        row, inside = got.loc[month], part[part["is_in_window"] == 1]
        counts = (len(part), part["c_pos_serial"].nunique(), len(inside), int(part["is_amortized"].sum()))
        assert (row.rows_cnt, row.serial_nunique, row.in_window_cnt, row.amort_pos_cnt) == counts
        assert row.amortization_total == pytest.approx(part["amortization_for_report_month"].sum())
        if len(inside):
            assert row.avg_price_in_window == pytest.approx(inside["price"].astype(float).mean())
            assert row.med_price_in_window == pytest.approx(inside["price"].astype(float).median())
        else:
            assert pd.isna(row.avg_price_in_window)


def test_operational_metrics_count_moved_and_shared_devices(spark):
    """Terms and devices drawn at random against loops over agreements, outlets, devices and months."""
    rng = random.Random(3)
    months = [dt.date(2025, m, 1) for m in range(1, 7)]
    ends = [(dt.date(2025, m + 1, 1) - dt.timedelta(1)) for m in range(1, 7)]
    scope = [(f"a{i}", m, f"c{i % 4}") for i in range(12) for m in months if rng.random() < 0.8]
    def term():
        start = dt.date(2025, 1, 1) + dt.timedelta(rng.randrange(150))
        return start, None if rng.random() < 0.4 else start + dt.timedelta(rng.randrange(90))
    terms = [(f"a{rng.randrange(8)}", f"m{rng.randrange(6)}", *term(), None) for _ in range(25)]
    outlets = [(f"m{j}", f"c{j % 4}", "shop", "SA", None) for j in range(6)]
    devices = [(rng.choice([None, f"t{i % 15}"]), f"m{rng.randrange(6)}", rng.choice([None, " ", f"s{i % 9}"]), *term(), None) for i in range(60)]
    model = [(f"t{i}", m, rng.randrange(1, 50)) for i in range(15) for m in months if rng.random() < 0.6]
    args = [
        spark.createDataFrame(scope, "n_agr string, month_start date, n_cmp_client string"),
        spark.createDataFrame(terms, "n_agr string, c_nmrc string, d_valid_from date, d_valid_to date, ods_deleted_flg string"),
        spark.createDataFrame(outlets, "c_nmrc string, n_cmp string, c_mrc_name string, acq_class string, ods_deleted_flg string"),
        spark.createDataFrame(devices, "c_nter string, c_nmrc string, c_pos_serial string, d_ter_install date, d_ter_close date, ods_deleted_flg string"),
        spark.createDataFrame(model, "c_nter string, snapshot_month_start date, amortization_for_report_month int"),
    ]
    got = {(r.n_agr, r.month_start): (r.retl_cnt, r.term_cnt, int(r.amortization), r.term_calc_source)
           for r in me.operational_metrics(*args, "2025-01-01", "2025-06-30").collect()}
    value = {(code, m): v for code, m, v in model}
    wanted, owned = {}, {}
    reach = {}
    for agr, m, company in scope:
        last = ends[m.month - 1]
        own = {o for a, o, s, e, _ in terms if a == agr and s <= last and (e is None or e >= m)}
        reach[agr, m] = (1, own) if own else (0, {o for o, c, *_ in outlets if c == company})
    for (agr, m), (main, places) in reach.items():
        here = [d for d in devices if d[1] in places and d[3] <= ends[m.month - 1] and (d[4] is None or d[4] >= m) and (d[2] if main else d[0]) is not None]
        # By the company, only outlets with a device count.
        count = len(places) if main else len({d[1] for d in here})
        wanted[agr, m] = (count or None, len({d[2] if main else d[0] for d in here}) if count else None, "547_like" if main else "fallback_old" if count else "no_data")
        for d in here:
            if d[0] is not None:
                device = (main, m, "s" + d[2] if (d[2] or "").strip() else "c" + d[0])
                owned[device] = min(owned.get(device, (agr, d[0])), (agr, d[0]))
    money = {}
    for (_, m, _), (agr, code) in owned.items():
        money[agr, m] = money.get((agr, m), 0) + value.get((code, m), 0)
    assert got == {k: (n, t, money.get(k, 0), source) for k, (n, t, source) in wanted.items()}


def test_key_sets_are_read_once_and_compared_as_sets(spark, tmp_path):
    rng = random.Random(21)
    months = ["2025-01", "2025-02", "2025-04"]
    rows = [(m, rng.choice(["all", "vip"]), rng.choice([None, f"k{rng.randrange(60)}"])) for m in months for _ in range(90)]
    # One key fills a third of the rows.
    rows += [("2025-02", "all", "k1")] * 120
    df = spark.createDataFrame(rows, "report_month string, set string, key string")
    path, asked = str(tmp_path / "sets"), []

    def give(wanted):
        asked.append(list(wanted))
        return df.filter(F.col("report_month").isin(wanted))

    ks.month_key_sets(spark, path, months[:2], give, "f1")
    before = {r.key: r.number for r in wr.read_months(spark, f"{path}/keys", "batch").collect()}
    sets = ks.month_key_sets(spark, path, months, give, "f1")
    ks.month_key_sets(spark, path, months, give, "f1")
    assert asked == [months[:2], months[2:]]
    numbers = wr.read_months(spark, f"{path}/keys", "batch").collect()
    after = {r.key: r.number for r in numbers}
    assert len(numbers) == len(after) == len(set(after.values())) == len({k for _, _, k in rows if k})
    assert before.items() <= after.items()

    def keys(month, of):
        return {k for m, s, k in rows if (m, s) == (month, of) and k}

    assert {(r.report_month, r.set): r.keys_cnt for r in ks.month_sizes(sets).collect()} == {
        (m, s): len(keys(m, s)) for m in months for s in ("all", "vip")
    }
    empty = set()
    flows = {r.report_month: (r.keys_total, r.keys_new, r.keys_kept, r.keys_gone) for r in ks.month_flows(sets, "all").collect()}
    for prev, month in ((None, "2025-01"), ("2025-01", "2025-02"), ("2025-02", "2025-03"), ("2025-03", "2025-04")):
        now, old = keys(month, "all"), keys(prev, "all") if prev else empty
        assert flows.pop(month) == (len(now), len(now - old), len(now & old), len(old - now))
    assert not flows
    a, b, c = keys("2025-04", "all"), {k for m in months for k in keys(m, "all")}, keys("2025-01", "vip")
    whole = sets.filter("set = 'all'")
    got = ks.identity_of_months(whole.filter("report_month = '2025-04'"), whole, sets.filter("set = 'vip' and report_month = '2025-01'")).first()
    assert tuple(got) == (len(a), len(b), len(c), len(b - c), len(a - (b - c)), len((b - c) - a), int(a == b - c))
    none = sets.limit(0)
    assert tuple(ks.identity_of_months(none, none, none).first()) == (0, 0, 0, 0, 0, 0, 1)
    assert ks.month_flows(none, "all").count() == 0


def test_changed_inputs_draw_key_sets_anew_with_the_same_numbers(spark, tmp_path):
    path, months = str(tmp_path / "sets"), ["2025-01"]

    def rows(keys):
        return lambda wanted: spark.createDataFrame([("2025-01", "all", k) for k in keys], "report_month string, set string, key string")

    ks.month_key_sets(spark, path, months, rows("abc"), "f1")
    first = {r.key: r.number for r in wr.read_months(spark, f"{path}/keys", "batch").collect()}
    sets = ks.month_key_sets(spark, path, months, rows("cd"), "f2")
    second = {r.key: r.number for r in wr.read_months(spark, f"{path}/keys", "batch").collect()}
    assert [r.keys_cnt for r in ks.month_sizes(sets).collect()] == [2]
    assert first == {k: n for k, n in second.items() if k in first} and set(second) == set("abcd")
    # Keys of a later batch lie in blocks of their own.
    assert (second["d"] - 1) // ks.BLOCK > max((n - 1) // ks.BLOCK for n in first.values())


def test_key_sets_rows_of_unions_are_merged_by_bits(spark):
    sets = spark.createDataFrame([(s, k) for s, part in (("a", "pqr"), ("b", "qrs"), ("c", "rst"), ("d", "")) for k in part], "set string, key string")
    numbers = spark.createDataFrame([(k, 32_767 + i) for i, k in enumerate("pqrst")], "key string, number long")
    bitmaps = ks.key_bitmaps(sets, numbers, ["set"])
    # Numbers on both sides of a block's end lie in two bitmaps.
    assert bitmaps.filter("set = 'a'").count() == 2
    sizes = ks.union_sizes(bitmaps, ["a", "b", "c", "d"])
    got = sizes.select(
        ks.keys_in("a", "bc").alias("x"), ks.keys_in("bc", "a").alias("y"), ks.keys_in("abc").alias("z"), ks.keys_in("d").alias("w"), ks.keys_in("ad").alias("v")
    ).first()
    assert tuple(got) == (1, 1, 1, 0, 0)
    with pytest.raises(ValueError):
        ks.union_sizes(bitmaps, "abcde")


def before_shuffles(df, text):
    """Whether a step stands above every exchange of the plan, so that its rows are not shuffled."""
    steps = plan(df)
    return text in steps and steps.rindex(text) < steps.index("Exchange")


def test_device_months_expand_after_the_last_shuffle(spark):
    rng = random.Random(21)
    rows = []
    for code, i, start, end in _intervals(17, 160):
        born = None if rng.random() < 0.2 else dt.date(2021, 1, 1) + dt.timedelta(rng.randrange(1600))
        rows.append((f"{rng.choice('TU')}{i % 3}-{code}{i % 7}", rng.choice([None, " ", "s1", "s2", f"x{i % 9}"]), start, end, born, None))
    devices = spark.createDataFrame(rows, "c_nter string, c_pos_serial string, d_ter_install date, d_ter_close date, d_ter_delivery date, ods_deleted_flg string")
    low, high = "2024-03-01", "2025-10-31"
    months = am.device_months(devices, low, high)
    assert before_shuffles(months, "sequence(_first")
    best = {}
    for month in pd.date_range(low, high, freq="MS"):
        for code, serial, start, end, _, _ in rows:
            since, until = start or dt.date(1900, 1, 1), end or dt.date(2999, 12, 31)
            if serial is not None and since <= (month + pd.offsets.MonthEnd(0)).date() and until >= month.date():
                key = (month.date(), code)
                best[key] = max(best.get(key, (since, until, serial)), (since, until, serial))
    got = {(r.month_start, r.c_nter): (r.d_ter_install or dt.date(1900, 1, 1), r.d_ter_close or dt.date(2999, 12, 31), r.c_pos_serial) for r in months.collect()}
    assert got == best

    flags = am.handover_flags(am.device_months(devices, low, high, spans=True).withColumn("n_cmp", F.split_part("c_nter", F.lit("-"), F.lit(1))))
    assert before_shuffles(flags, "sequence(_first")
    wanted = {}
    for (month, code), (since, until, serial) in best.items():
        within = [(d.year, d.month) == (month.year, month.month) for d in (until, since)]
        wanted.setdefault((month, serial), []).append((code.split("-")[0], *within))
    for r in flags.collect():
        held = wanted.pop((r.month_start, r.c_pos_serial))
        n, clients = len(held), len({x[0] for x in held})
        closed, opened, both = sum(x[1] for x in held), sum(x[2] for x in held), sum(x[1] and x[2] for x in held)
        assert (r.n_c_nter, r.n_client, r.n_closed, r.n_opened, r.n_both) == (n, clients, closed, opened, both)
        pairs = any(a[1] and b[2] for i, a in enumerate(held) for j, b in enumerate(held) if i != j)
        assert (r.close_then_install, r.handover_same_month) == (int(pairs), int(n >= 2 and clients >= 2))
    assert not wanted


def test_stretches_stand_for_the_device_months(spark):
    rng = random.Random(23)
    rows = [(f"{c}{i % 9}", rng.choice([" ", "s1", f"x{i}"]), start, end, None if i % 5 == 0 else dt.date(2021, 1, 1) + dt.timedelta(rng.randrange(1900)), None)
            for c, i, start, end in _intervals(29, 150)]
    devices = spark.createDataFrame(rows, "c_nter string, c_pos_serial string, d_ter_install date, d_ter_close date, d_ter_delivery date, ods_deleted_flg string")
    catalog = spark.createDataFrame([(f"{c}{j}", None, rng.choice(["m1", "m2", "m3"])) for c in "ab" for j in range(7)], "device string, code_device string, model_device string")
    prices = spark.createDataFrame([("M1", 100.0), ("m2", 250.0)], "model_name string, price double")
    args = (devices, catalog, prices, "2024-03-01", "2025-10-31")
    months, stretches = am.amortization_model(*args), am.amortization_model(*args, stretches=True)
    assert stretches.count() < months.count()
    for f in (am.amort_qc, lambda m: am.amort_qc(m, "join_key_used"), am.amort_by_age, am.price_quantiles):
        a, b = (sorted(tuple(r) for r in f(m).collect()) for m in (months, stretches))
        assert [x[:1] for x in a] == [x[:1] for x in b] and all(x[1:] == pytest.approx(y[1:]) for x, y in zip(a, b))
    assert "months" in plan(am.amort_by_age(stretches)) and "sequence(_first" not in plan(am.amort_by_age(stretches))


def test_counted_values_have_the_quantiles_of_their_copies(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), float(rng.randrange(60)), rng.randrange(0, 9)) for _ in range(300)]
    df, probs = spark.createDataFrame(rows, "g string, v double, n int"), [0.1, 0.5, 0.95]
    copies = {g: [v for k, v, n in rows if g in ("", k) for _ in range(n)] for g in ("", "a", "b")}
    for limit in (1_000_000, 15):
        assert np.allclose(list(qt.exact_quantiles(df, "v", probs, n="n", limit=limit).first()), np.quantile(copies[""], probs))
        for r in qt.exact_quantiles(df, "v", probs, ["g"], n="n", limit=limit).collect():
            assert np.allclose(list(r)[1:], np.quantile(copies[r.g], probs))


def _random_terms(spark, seed, n=140):
    rng = random.Random(seed)
    low = dt.date(2024, 1, 1)

    def interval():
        start = low + dt.timedelta(rng.randrange(0, 500))
        return start, None if rng.random() < 0.2 else start + dt.timedelta(rng.randrange(0, 250))

    terms = [(f"g{rng.randrange(12)}", f"o{rng.randrange(8)}", rng.choice(["P", " p", "E"]), rng.choice(["HOME", "X"]), *interval(), rng.choice([None, None, "1"])) for _ in range(n)]
    heads = [(f"g{i % 12}", rng.choice([None, f"i{i % 5}", f"i{i % 5}"]), f"c{i % 6}", "no", rng.choice(["SA", "SA", "SV"]), *interval(), rng.choice([None, None, None, "1"])) for i in range(40)]
    firms = [(f"c{i}", None if i == 5 else f"77{i % 4}", f"firm {i}", None) for i in range(6)]
    return (
        spark.createDataFrame(heads, "n_agr string, abs_agr_id string, n_cmp_client string, c_agr_number string, acq_class string, d_valid_from date, d_valid_to date, ods_deleted_flg string"),
        spark.createDataFrame(firms, "n_cmp string, c_inn string, c_cmp_name string, ods_deleted_flg string"),
        spark.createDataFrame(terms, "n_agr string, c_nmrc string, cf_ter_type string, c_fiid_grp string, d_valid_from date, d_valid_to date, ods_deleted_flg string"),
        heads, firms, terms,
    )


def _lives(since, until, month, after=False):
    last = (month + pd.offsets.MonthEnd(0)).date()
    return since <= last and (until is None or (until > month.date() if after else until >= month.date()))


def test_parents_and_perimeter_meet_as_spans(spark):
    agreements, companies, terms, heads, firms, leaves = _random_terms(spark, 31)
    low, high = "2024-02-01", "2025-06-30"
    probe = mp.parent_path_probe(agreements, terms, low, high)
    peri = pe.perimeter(agreements, companies, terms, low, high)
    assert before_shuffles(probe, "sequence(_first") and before_shuffles(peri, "sequence(_first")
    wanted, scope = {}, set()
    inn = {n: i for n, i, _, _ in firms if i}
    for month in pd.date_range(low, high, freq="MS"):
        for g, a, c, _, cls, since, until, gone in heads:
            if gone or not _lives(since, until, month):
                continue
            if a:
                row = wanted.setdefault((a, month.date()), (set(), set(), set(), set()))
                row[0].add(cls), row[1].add(g), row[3].update(x[1] for x in leaves if x[0] == g and not x[6] and _lives(x[4], x[5], month))
                row[2].update([g] if cls == "SA" else [])
            if cls == "SA" and c in inn and any(x[0] == g and x[2].strip().upper() == "P" and not x[6] and _lives(x[4], x[5], month, True) for x in leaves):
                scope.add((g, month.date(), a, since, until, inn[c]))
    assert {(r.agr_id, r.month_start): (r.acq_class_sample, r.n_agr_cnt, r.n_agr_sa_cnt, r.c_nmrc_cnt) for r in probe.collect()} == {
        k: (max(c), len(g), len(s), len(o)) for k, (c, g, s, o) in wanted.items()
    }
    assert {(r.n_agr, r.month_start, r.agr_id, r.d_valid_from, r.d_valid_to, r.inn) for r in peri.collect()} == scope


def test_rent_days_meet_intervals_by_year(spark):
    agreements, companies, terms, heads, firms, leaves = _random_terms(spark, 37)
    rng = random.Random(41)
    rows = [(f"o{rng.randrange(9)}", dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(600)), rng.choice([None, 5.0, 7.0]), None, None, i, None) for i in range(120)]
    rent = spark.createDataFrame(rows, "c_nmrc string, d_rent date, n_amt double, ods_commit_ts timestamp, ods_insert_ts timestamp, ods_op_csn int, ods_deleted_flg string")
    low, high = "2024-02-01", "2025-06-30"
    mapped = me.rent_mapping(me.rent_targets(rent, terms, agreements, companies, low, high, by_year=True))
    assert "INTERVAL '1' MONTH" not in plan(mapped)
    newest = {}
    for o, d, amount, _, _, csn, _ in rows:
        if dt.date(2024, 2, 1) <= d <= dt.date(2025, 6, 30):
            newest[o, d] = max(newest.get((o, d), (-1, None)), (csn, amount), key=lambda x: x[0])
    inn, end = {n: i for n, i, _, _ in firms if i}, dt.date(2999, 12, 31)
    wanted = {}
    for (o, d), (_, amount) in newest.items():
        via = {x[0] for x in leaves if x[1] == o and not x[6] and x[4] <= d <= (x[5] or end)}
        wanted[o, d, amount] = len({(inn[h[2]], h[1]) for h in heads if h[0] in via and h[4] == "SA" and not h[7] and h[5] <= d <= (h[6] or end) and h[1] and h[2] in inn})
    assert {(r.c_nmrc, r.d_rent, r.n_amt): r.target_cnt for r in mapped.collect()} == wanted and max(wanted.values()) > 1


def test_profile_quantiles_are_exact_with_a_small_sketch(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("a"), F.when(F.col("id") % 3 == 0, F.col("id") / 10).alias("b"))
    out = ql.profile_all_numeric(df, accuracy=1_000_000)
    assert "1000000" not in plan(out)
    got = {r["column"]: (r.non_null_cnt, r.p50, r.p95) for r in out.collect()}
    assert got == {"a": (5_000, 2499.0, 4749.0), "b": (1667, 249.9, 474.9)}
