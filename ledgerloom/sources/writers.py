"""Monthly tables, published tables and small exports."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T


def _manifest(spark: SparkSession, path: str):
    """The manifest's folder, its file system and the class of its paths."""
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = of(f"{path.rstrip('/')}/manifest")
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def _state(spark: SparkSession, path: str) -> tuple[int, dict[str, dict]]:
    """The manifest's newest version and what it says about each month."""
    folder, files, of = _manifest(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    newest = max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)
    if not newest:
        return 0, {}
    stream = files.open(of(folder, f"{newest}.json"))
    try:
        return newest, json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, version: int, state: dict[str, dict]) -> bool:
    """Put a version of the manifest in place by a rename that never replaces a file; whether it was the first to do so.

    The file system must make such a rename in one step, as HDFS does.
    """
    jvm = spark.sparkContext._jvm
    folder, files, of = _manifest(spark, path)
    draft, place = of(folder, f"draft-{uuid.uuid4().hex}"), of(folder, f"{version}.json")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(place), keep)
    except Py4JJavaError as error:
        if not error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
            raise
        files.delete(draft, False)
        return False
    return True


def month_entries(spark: SparkSession, path: str) -> dict[str, dict]:
    """The manifest: per stored month its place, rows, fingerprint of the inputs and schema."""
    return _state(spark, path)[1]


def inputs_fingerprint(*tables: DataFrame) -> str:
    """A fingerprint of the files that tables are read from: places, sizes and times of change, and the columns' types.

    The files' states are read and summed by tasks; the driver gets one row.
    """
    spark = tables[0].sparkSession
    names = sorted({f for t in tables for f in t.inputFiles()})
    columns = hashlib.sha256(json.dumps([t.dtypes for t in tables]).encode()).hexdigest()
    if not names:
        return f"0:0:{columns}"
    states = spark.read.format("binaryFile").load(names).select(F.xxhash64("path", "modificationTime", "length").alias("h"))
    n, total = states.agg(F.count("h"), F.sum(F.col("h").cast("decimal(20,0)"))).first()
    return f"{n}:{total}:{columns}"


def write_month(
    df: DataFrame, path: str, month: str = "report_month", rows_per_file: int = 20_000_000,
    months: Iterable[str] = (), fingerprint: str | None = None, seen: dict[str, dict] | None = None,
) -> None:
    """Write months to places of their own, then enter them all into the manifest at once; the other months stay. Runs jobs.

    A version of the manifest is a new file that only one writer can make; a writer that comes second
    builds on the first one's. ``seen`` holds the entries that the writer started from (by default those
    found now): if another writer has entered one of its months meanwhile, those rows stay and this is an
    error that enters nothing, unless fingerprint and columns are the same. A month of ``months`` without rows is
    entered as empty. Rows without a month are an error. Earlier rows stay for their readers. Adaptive
    execution deals each month to as many tasks as its size asks for.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    seen = month_entries(spark, path) if seen is None else seen
    # A folder of its own also keeps the drafts of writers at the same time apart.
    place = f"{path}/rows/_rows={uuid.uuid4().hex}"
    named = df.withColumn(month, F.col(month).cast("string"))
    named.hint("rebalance", month).write.option("maxRecordsPerFile", rows_per_file).partitionBy(month).parquet(place)
    counts = {r[0]: r[1] for r in spark.read.schema(named.schema).parquet(place).groupBy(month).count().collect()}
    if None in counts:
        raise ValueError(f"{counts[None]} rows without a month")
    fresh = {
        m: {
            "place": f"{place}/{month}={m}", "rows": counts.get(m, 0),
            "fingerprint": fingerprint, "schema": named.schema.json(),
        }
        for m in {*months, *counts}
    }
    while True:
        version, state = _state(spark, path)
        others = {m for m in fresh if state.get(m) != seen.get(m)}
        same = ("fingerprint", "schema")
        if taken := sorted(m for m in others if fingerprint is None or any(state[m][c] != fresh[m][c] for c in same)):
            raise RuntimeError(f"written by another writer meanwhile: {', '.join(taken)}")
        if _commit(spark, path, version + 1, {**state, **{m: e for m, e in fresh.items() if m not in others}}):
            return


def _merged(entries: Iterable[dict], month: str) -> T.StructType:
    """The columns of all entries; one column with two types is an error."""
    fields: dict[str, T.StructField] = {}
    for entry in entries:
        for field in T.StructType.fromJson(json.loads(entry["schema"])):
            known = fields.setdefault(field.name, T.StructField(field.name, field.dataType))
            if known.dataType != field.dataType:
                raise ValueError(f"{field.name} is {known.dataType.simpleString()} and {field.dataType.simpleString()} in stored months")
    return T.StructType([f for f in fields.values() if f.name != month] + [T.StructField(month, T.StringType())])


def read_months(spark: SparkSession, path: str, month: str = "report_month", months: Iterable[str] | None = None) -> DataFrame | None:
    """The stored months with the columns of all of them, null where a month lacks one; nothing when none was written yet."""
    entries = dict(sorted(month_entries(spark, path).items()))
    if not entries:
        return None
    schema = _merged(entries.values(), month)
    wanted = entries if months is None else set(months)
    places = [e["place"] for m, e in entries.items() if e["rows"] and m in wanted]
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", f"{path.rstrip('/')}/rows").schema(schema).parquet(*places).select(*schema.names)


def stored_months(
    spark: SparkSession, path: str, months: list[str], required=(), month: str = "report_month", fingerprint: str | None = None
) -> set[str]:
    """Those of the months whose entries hold all required columns and, where one is given, the fingerprint."""
    entries = month_entries(spark, path)
    return {
        m for m in months
        if m in entries and set(required) <= {month, *(f["name"] for f in json.loads(entries[m]["schema"])["fields"])}
        and (fingerprint is None or entries[m]["fingerprint"] == fingerprint)
    }


def read_or_compute_month(
    spark: SparkSession,
    path: str,
    months: list[str],
    compute: Callable[[list[str]], DataFrame],
    required=(),
    force: bool = False,
    month: str = "report_month",
    fingerprint: str | None = None,
) -> DataFrame:
    """Stored months where complete; the others are computed together, stored and read back.

    A month that lacks a required column, or was computed from inputs of another fingerprint
    (``inputs_fingerprint``), is computed anew; a result that lacks one is an error and is not
    written. If another writer enters one of the months meanwhile, see ``write_month``. Runs a job
    where a month is missing.
    """
    seen = month_entries(spark, path)
    present = set() if force else stored_months(spark, path, months, required, month, fingerprint)
    missing = [m for m in months if m not in present]
    if missing:
        fresh = compute(missing)
        if absent := sorted(set(required) - set(fresh.columns)):
            raise ValueError(f"computed months lack required columns: {absent}")
        write_month(fresh.filter(F.col(month).isin(*missing)), path, month, months=missing, fingerprint=fingerprint, seen=seen)
    return read_months(spark, path, month, months)


def concat_months(parts: list[DataFrame]) -> DataFrame:
    """Months one below the other; columns absent in one are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c.strip().lower()) for c in df.columns])


def publish_table(
    df: DataFrame, name: str, text: bool = True, check: bool = True, path: str | None = None,
    checks: Iterable[Callable[[DataFrame], str | None]] = (),
) -> str | None:
    """Replace a table with the rows, as text by default; gives the place of the rows it had before. Runs jobs.

    The rows are written to a new folder under ``path`` (or in the database's) and checked there:
    their number, counted while they are written, and what ``checks`` say about them. Only then
    the table is pointed to the new folder, in one step if its columns stay the same; else it is
    dropped and made anew. A failed check leaves the table and its rows as they were. Folders of
    earlier rows stay for their readers; the caller may remove them.
    """
    spark = df.sparkSession
    out = as_text(df) if text else df
    rows = Observation()
    database, _, table = name.rpartition(".")
    base = path or f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri}/{table}"
    place = f"{base.rstrip('/')}/rows-{uuid.uuid4().hex}"
    out.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(place)
    staged = spark.read.schema(out.schema).parquet(place)
    problems = [p for p in (c(staged) for c in checks) if p]
    if check and (written := staged.count()) != rows.get["n"]:
        problems.append(f"{written} rows written, {rows.get['n']} expected")
    if problems:
        raise RuntimeError(f"{name}: {'; '.join(problems)}")
    known = spark.catalog.tableExists(name)
    before = spark.sql(f"describe formatted {name}").filter("col_name = 'Location'").first() if known else None
    if known and before and spark.table(name).dtypes == staged.dtypes:
        spark.sql(f"alter table {name} set location '{place}'")
        spark.catalog.refreshTable(name)
    else:
        if known:
            spark.sql(f"drop table {name}")
        spark.catalog.createTable(name, place, "parquet", staged.schema)
    return before["data_type"] if before else None


def publish_view(df: DataFrame, name: str, mode: str = "view") -> None:
    """Publish as a view of the session or as a table."""
    if mode == "view":
        df.createOrReplaceTempView(name)
    elif mode == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"unknown mode: {mode}")


def schema_compat(df: DataFrame, required, old) -> DataFrame:
    """Columns that are missing or new against a previous table and a required list."""
    new, old, required = set(df.columns), set(old), set(required)
    rows = [("missing_required", c) for c in sorted(required - new)]
    rows += [("missing_from_new", c) for c in sorted(old - new)]
    rows += [("added_in_new", c) for c in sorted(new - old)]
    return df.sparkSession.createDataFrame(rows, "issue string, column_name string")


def report_export(df: DataFrame, path: str, top: int | None = None, order=()) -> None:
    """A report as CSV files with headers in a folder; the first ``top`` rows in order as one file. Runs a job."""
    rows = df if top is None else df.orderBy(*order).limit(top).coalesce(1)
    rows.write.mode("overwrite").option("header", True).csv(path)
