"""Queries over text files, stored months, published tables and exports, all made from the given tables."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import checkpoint_dir
from ..sources import readers as rd, writers as wr
from .registry import query
from .standins import Inputs


def _place(t: Inputs, name: str) -> str:
    return f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def _report_files(t: Inputs, suffix: str = "") -> str:
    """Suppliers as text files, one per task: each with a line of preamble and a header, short rows and rows with separators in the comment."""
    rows = t.supplier.select(
        F.when(F.col("s_suppkey") % 3 == 0, F.concat_ws(";", F.col("s_suppkey"), F.col("s_name")))
        .when(F.col("s_suppkey") % 3 == 1, F.concat_ws(";", F.col("s_suppkey"), F.col("s_name"), F.lit("a;b;c"), F.col("s_nationkey")))
        .otherwise(F.concat_ws(";", F.col("s_suppkey"), F.col("s_name"), F.lit("plain"), F.col("s_nationkey")))
        .alias("value"),
    )

    def headed(batches):
        written = False
        for batch in batches:
            if not written and batch.num_rows:
                written = True
                head = ["made from supplier", "Supplier ID;Name;COMMENT;nation"]
                yield pa.RecordBatch.from_arrays([pa.array(head, batch.schema.field(0).type)], schema=batch.schema)
            yield batch

    path = _place(t, "report") + suffix
    rows.repartition("value").mapInArrow(headed, "value string").write.text(path)
    return path


_REPORT = """
select cast(s_suppkey as varchar) as {0}, s_name as {1},
  case s_suppkey % 3 when 0 then '' when 1 then 'a;b;c' else 'plain' end as {2},
  case when s_suppkey % 3 = 0 then '' else cast(s_nationkey as varchar) end as {3} from supplier"""


@query("scan_csv", _REPORT.format("supplier", "name", "comment", "nation"))
def _(t):
    return rd.scan_csv(t.spark, _report_files(t), skip_rows=1).toDF("supplier", "name", "comment", "nation")


@query("scan_reference", f"select supplier, name, country, cast(null as varchar) as branch from ({_REPORT.format('supplier', 'name', 'c', 'country')}) x")
def _(t):
    aliases = {"supplier": ["supplier_id", "supplier id"], "name": ["Name"], "country": ["land", "NATION"], "branch": ["filial"]}
    return rd.scan_reference(t.spark, _report_files(t, ".csv"), aliases, required=["supplier", "name", "country"], header_row=1)


def _by_month(t: Inputs, months: list[str], *columns: str) -> DataFrame:
    rows = t.orders.withColumn("report_month", F.date_format("o_orderdate", "yyyy-MM")).filter(F.col("report_month").isin(*months))
    sums = rows.groupBy("report_month", F.col("o_custkey").alias("customer")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("newest")
    )
    return sums.select("report_month", "customer", *columns)


_ALL = [f"{y}-{m:02d}" for y in range(1992, 2002) for m in range(1, 13)]


@query("stored_months", """
select strftime(o_orderdate, '%Y-%m') as report_month, o_custkey as customer, count(*) as n,
  case when year(o_orderdate) >= 1995 then max(o_orderkey) end as newest
from orders where strftime(o_orderdate, '%Y-%m') between '1992-01' and '2001-12' group by 1, 2, year(o_orderdate)""")
def _(t):
    """Months are stored with one column, then those from 1995 with a further one; all are read back."""
    path, made_from = _place(t, "months"), wr.inputs_fingerprint(t.orders)
    wr.read_or_compute_month(t.spark, path, _ALL, lambda m: _by_month(t, m, "n"), ["n"], fingerprint=made_from)
    wr.read_or_compute_month(t.spark, path, [m for m in _ALL if m >= "1995"], lambda m: _by_month(t, m, "n", "newest"), ["n", "newest"], fingerprint=made_from)
    return wr.read_months(t.spark, path).select("report_month", "customer", "n", "newest")


@query("publish_table", """
select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment from customer""")
def _(t):
    """A table is published and then replaced by one with the same columns."""
    name, path = f"published_{uuid.uuid4().hex}", _place(t, "table")
    rows = t.customer.select("c_custkey", F.col("c_name").alias(" C_NAME "), "c_nationkey", "c_mktsegment")
    wr.publish_table(rows.filter("c_nationkey < 5"), name, path=path)
    wr.publish_table(rows, name, path=path)
    return t.spark.table(name)


@query("publish_view", "select c_nationkey, count(*) as n from customer group by 1")
def _(t):
    name = f"shown_{uuid.uuid4().hex}"
    wr.publish_view(t.customer, name)
    return t.spark.sql(f"select c_nationkey, count(*) as n from {name} group by c_nationkey")


@query("schema_compat", """
select v.issue, v.column_name, x.n as new_rows from (values ('missing_required', 'c_inn'), ('missing_from_new', 'c_phone'),
  ('missing_from_new', 'c_inn'), ('added_in_new', 'c_acctbal'), ('added_in_new', 'c_mktsegment')) v(issue, column_name),
  (select count(*) as n from customer) x""")
def _(t):
    new = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    issues = wr.schema_compat(new, ["c_custkey", "c_inn"], ["c_custkey", "c_name", "c_nationkey", "c_phone", "c_inn"])
    return issues.withColumn("new_rows", new.agg(F.count(F.lit(1))).scalar())


@query("report_export", """
select cast(l_suppkey as varchar) as l_suppkey, cast(count(*) as varchar) as n, cast(cast(sum(l_quantity) as bigint) as varchar) as quantity from lineitem group by 1""")
def _(t):
    path = _place(t, "export")
    rows = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    wr.report_export(rows, path)
    return t.spark.read.option("header", True).csv(path)


@query("report_export_top", """
select cast(l_suppkey as varchar) as l_suppkey, cast(n as varchar) as n from (select l_suppkey, count(*) as n from lineitem group by 1 order by 2 desc, 1 limit 20) x""")
def _(t):
    path = _place(t, "export")
    rows = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    wr.report_export(rows, path, top=20, order=[F.col("n").desc(), "l_suppkey"])
    return t.spark.read.option("header", True).csv(path)
