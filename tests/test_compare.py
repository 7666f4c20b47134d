"""Mart against report in one pass, ratios, month pivots and key sets that read their rows once."""

import datetime as dt
import random
from types import SimpleNamespace

from pyspark.sql import functions as F

from ledgerloom.checks import QUERIES, report_checks as rch, standins as st
from ledgerloom.plans import keysets as ks, reconcile as rc, selection as se


def counted(df, seen):
    """The rows, counted in an accumulator whenever they are read."""
    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema)


def two_sides(spark):
    rng = random.Random(5)
    months, ids = ["2025-01", "2025-02", "2025-03", None], ["a", "b", None]
    rows = [
        (rng.choice((0, 1)), rng.choice(months), rng.choice(ids), rng.choice(ids), rng.choice((None, 0, rng.randrange(9))), rng.choice((None, rng.randrange(99))))
        for _ in range(160)
    ]
    # A month for each side alone; y is empty on the second side in one month.
    rows += [(0, "2025-04", "a", "a", 1, 1), (1, "2025-05", "a", "a", 1, 1), (0, "2025-06", "a", "a", 2, 3), (1, "2025-06", "a", "a", 2, None)]
    return spark.createDataFrame(rows, "side int, report_month string, inn_key string, agr_id_key string, x long, y long")


def test_paired_rows_are_the_join_of_both_sides_sums(spark):
    df = two_sides(spark)
    lake, ref = {"x": "max", "y": "sum"}, {"x": "sum", "y": "max"}
    a, b = rc.key_month_agg(df.filter("side = 0"), lake, "_lake"), rc.key_month_agg(df.filter("side = 1"), ref, "_excel")
    joined, pairs = rc.paired(a, b), rc.paired_rows(df, "side", {0: ("_lake", lake), 1: ("_excel", ref)})
    cols = [*rc.ROW_KEY, "merge_status", "x_lake", "y_lake", "x_excel", "y_excel"]

    def rows(d, names):
        return sorted(map(repr, d.select(*names).collect()))

    assert rows(pairs, cols) == rows(joined, cols)
    assert {r.merge_status for r in pairs.filter("report_month is null").collect()} == {"left_only", "right_only"}
    assert joined.count() > 20 and pairs.filter("inn_key is null or agr_id_key is null").count() == 0
    old = rc.monthly_compare(
        rc.metric_totals(a, "_lake", ["x", "y"]), rc.metric_totals(b, "_excel", ["x", "y"], optional=("y",)), ["unique_inn", "x", "y"])
    new = rc.paired_compare(pairs, ["x", "y"], optional=("y",))
    assert new.columns == old.columns and rows(new, old.columns) == rows(old, old.columns)
    got = {(r.report_month, r.metric): (r.lake_value, r.excel_value, r.reference_status) for r in new.collect()}
    assert got["2025-04", "x"] == (1.0, None, "no_excel_reference") and got["2025-06", "y"] == (3.0, None, "has_excel_reference")
    assert ("2025-05", "x") not in got and got[None, "unique_inn"][1] is None
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_keys_are_derived_once_for_the_sums(spark):
    df = two_sides(spark).withColumn("agr_id_key", F.regexp_replace("agr_id_key", "a+", "z"))
    for out in (rc.key_month_agg(df, {"x": "max"}, ""), rc.paired_rows(df, "side", {0: ("_l", {"x": "max"}), 1: ("_r", {"x": "max"})})):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1


def test_mart_and_report_read_their_tables_once(spark, tmp_path):
    rng = random.Random(11)
    day = dt.datetime(2001, 5, 1)
    segments, priorities = ["BUILDING", "HOUSEHOLD", "MACHINERY", None], ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None]
    customers = [(k, f"C{k}", rng.choice([1, 4, 7, 10, None]), rng.choice([-1.0, 5.0]), rng.choice(segments)) for k in (1, 1, 2, 3, 4, 5, 6, 7)]
    orders = [(k % 90, rng.choice([1, 2, 3, 4, 5, 6, 7, None]), "F", 4000.0, day, rng.choice(priorities)) for k in range(100)]
    orders += orders[:5]
    lines = [
        (rng.randrange(95), 1, 1, 1, float(rng.randrange(1, 50)), float(rng.randrange(100, 999)), 0.05, 0.02, "N", "F",
         rng.choice([None, day + dt.timedelta(days=rng.randrange(120))])) for _ in range(600)
    ]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")

    def plain(name):
        if name in st.TABLES:
            return spark.read.parquet(f"{tmp_path}/{name}.parquet")
        return spark.sql(st.STANDINS[name], **{r: plain(r) for r in set(st._REF.findall(st.STANDINS[name]))})

    for name in ("facts", "mart", "report"):
        a, b = plain(name), st.table(spark, str(tmp_path), name)
        assert a.dtypes == b.dtypes and a.count() > 50
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), name
    for name in ("monthly_compare", "period_total", "top_abs_delta", "meaningful_row_match", "full_outer_pairs", "row_match", "compare_summary"):
        plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet [l_orderkey") == 1, name


def test_ratios_draw_their_rows_once(spark):
    rows = [("a", 1, 2), ("a", 1, 4), ("b", 2, 3), ("c", 0, 5), ("d", 0, 0), ("e", 4, None), (None, 1, 7)]
    df = spark.createDataFrame(rows, "k string, base long, ref long")
    seen = spark.sparkContext.accumulator(0)
    profile = se.ratio_profile(counted(df, seen), "base", "ref").first()
    assert tuple(profile) == (4, (2 + 4 + 1.5 + 7) / 4, 1.5, 7.0, 3.0) and seen.value == len(rows)
    seen = spark.sparkContext.accumulator(0)
    out = se.ratio_coefficients(counted(df, seen), "k", "base", "ref").collect()
    assert seen.value == len(rows)
    assert {(r.k, r.base_sum, r.ref_sum, r.coefficient, r.coef_source) for r in out} == {
        ("a", 2, 6, 3.0, "agr_ratio"), ("b", 2, 3, 1.5, "agr_ratio"), ("c", 0, 5, 2.25, "fallback_global_median"),
        ("d", 0, 0, 1.0, "both_zero_eq_1"), ("e", 4, 0, 0.0, "agr_ratio"), (None, 1, 7, 7.0, "agr_ratio"),
    }


def test_month_pivot_shuffles_no_wide_rows(spark):
    months = ["2025-01", "2025-02", "2025-03"]
    rows = [("a", "2025-01", 1, 5), ("a", "2025-01", 2, None), ("a", "2024-12", 9, 9), ("a", None, 8, 8), ("b", "2025-03", None, 1), ("c", "2024-12", 1, 1), (None, "2025-02", 3, 4)]
    df = spark.createDataFrame(rows, "k string, month string, v long, w long")
    out = se.ops_month_pivot(df, "k", ["v", "w"], months)
    assert out.columns == ["k", "v_2025_01", "w_2025_01", "v_2025_02", "w_2025_02", "v_2025_03", "w_2025_03"]
    assert {tuple(r) for r in out.collect()} == {
        ("a", 3, 5, None, None, None, None), ("b", None, None, None, None, None, 1),
        ("c", None, None, None, None, None, None), (None, None, None, 3, 4, None, None),
    }
    assert se.ops_month_pivot(df, "k", ["v"], months).columns == ["k", "v_2025_01", "v_2025_02", "v_2025_03"]
    assert "pivotfirst" not in out._jdf.queryExecution().toString().lower()


def test_key_sets_of_a_query_read_their_rows_once(spark, tmp_path):
    rows = [("2025-01", "all", "a"), ("2025-01", "all", "a"), ("2025-02", "all", "b"), ("2025-02", "new", None)]
    df = spark.createDataFrame(rows, "report_month string, set string, key string")
    seen = spark.sparkContext.accumulator(0)
    sets = rch._stored_sets(SimpleNamespace(spark=spark), counted(df, seen), df)
    assert {(r.report_month, r.set): r.keys_cnt for r in ks.month_sizes(sets).collect()} == {("2025-01", "all"): 1, ("2025-02", "all"): 1}
    assert seen.value == len(rows)
