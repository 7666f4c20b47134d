"""Scans and month skeletons."""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def scan_table(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """A parquet table, optionally only some columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_csv(
    spark: SparkSession, path: str, skip_rows: int = 0, sep: str = ";", comment=("comment", "COMMENT", "COMMENT_TEXT")
) -> DataFrame:
    """Separated text files, each with a preamble and a header; every field stays text and every row is kept.

    Only the first lines of each file are read on the driver. Files may name their columns in
    different orders, and a column that a file lacks is empty there. Short rows get empty fields
    at their end. Separators too many belong to the comment column, or to the last one.
    """
    files = sorted(spark.read.text(path).inputFiles())
    headers: dict[tuple[str, ...], list[str]] = {}
    for file, lines in zip(files, _first_lines(spark, files, skip_rows + 1), strict=True):
        if len(lines) <= skip_rows:
            raise ValueError(f"fewer than {skip_rows + 1} lines in {file}")
        headers.setdefault(tuple(lines[skip_rows].split(sep)), []).append(file)
    if not headers:
        raise ValueError(f"no file in {path}")
    parts = []
    for names, some in headers.items():
        place = path if len(headers) == 1 else [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)).toString() for f in some]
        lines = _after_preamble(spark.read.text(place), skip_rows + 1)
        parts.append(_fields(lines, list(names), sep, comment))
    together = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return together.na.fill("") if len(parts) > 1 else together


def _fields(lines: DataFrame, names: list[str], sep: str, comment) -> DataFrame:
    n = len(names)
    at = next((names.index(c) for c in comment if c in names), n - 1)
    parts = F.split(lines["value"], re.escape(sep), -1)
    extra = F.greatest(F.size("_p") - F.lit(n), F.lit(0))
    rows = lines.select(parts.alias("_p")).withColumn("_x", extra)

    def field(i: int) -> Column:
        if i < at:
            value = F.try_element_at("_p", F.lit(i + 1))
        elif i == at:
            value = F.concat_ws(sep, F.slice("_p", F.lit(i + 1), F.col("_x") + 1))
        else:
            value = F.try_element_at("_p", F.col("_x") + F.lit(i + 1))
        return F.coalesce(value, F.lit(""))

    return rows.select(*[field(i).alias(c) for i, c in enumerate(names)])


def _first_lines(spark: SparkSession, files: list[str], n: int) -> list[list[str]]:
    """The first n lines, or all of fewer, of each file, through the file system that Spark itself would use."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def head(file: str) -> list[str]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = path.getFileSystem(conf).open(path)
        codec = codecs.getCodec(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            lines = [reader.readLine() for _ in range(n)]
        finally:
            reader.close()
        return [x for x in lines if x is not None]

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(head, files))


def _after_preamble(text: DataFrame, skipped: int) -> DataFrame:
    """Lines after each file's header: told apart by their place in the file, not by their text.

    A task reads the splits of files one after another and each in order, so that a running
    number since the beginning of a file marks its preamble. A preamble that goes beyond a
    file's first split is an error.
    """
    first = F.when(F.col("_metadata.file_block_start") == 0, F.xxhash64("_metadata.file_path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, skipped
        for batch in batches:
            files = batch.column(1).to_pylist() if batch.column(1).null_count < batch.num_rows else None
            if files is None and seen >= skipped:
                current = None
                yield batch.select(["value"])
                continue
            keep = []
            for file in files or [None] * batch.num_rows:
                if file != current:
                    if seen < skipped:
                        raise ValueError(f"a preamble of {skipped} lines does not end in its file's first split")
                    current, seen = file, 0 if file is not None else skipped
                keep.append(seen >= skipped)
                seen = min(seen + 1, skipped)
            yield batch.select(["value"]).filter(pa.array(keep))
        if seen < skipped:
            raise ValueError(f"a preamble of {skipped} lines does not end in its file's first split")

    return text.select("value", first.alias("file")).mapInArrow(run, "value string")


def fold(name: str) -> str:
    """Column name with one kind of space and in lower case."""
    return re.sub(r"\s+", " ", name.replace("\u00a0", " ")).strip().lower()


def resolve_columns(df: DataFrame, aliases: dict[str, list[str]], required=None) -> DataFrame:
    """Columns under their common names, found by the first alias that occurs.

    A missing required column is an error, a missing optional one becomes null.
    """
    required = set(aliases if required is None else required)
    folded = {fold(c): c for c in reversed(df.columns)}
    found = {}
    for name, options in aliases.items():
        hits = [o if o in df.columns else folded.get(fold(o)) for o in options]
        found[name] = next((h for h in hits if h), None)
    missing = sorted(n for n in required if found[n] is None)
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")
    return df.select(
        *[(F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(n) for n, c in found.items()]
    )


def scan_reference(spark: SparkSession, path: str, aliases, required=None, header_row: int = 0, sep: str = ";") -> DataFrame:
    """An independent report (parquet, or text with its header in a given row) under common column names."""
    raw = scan_csv(spark, path, header_row, sep) if path.endswith((".csv", ".txt")) else spark.read.parquet(path)
    return resolve_columns(raw, aliases, required)


def ensure_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of the schema, cast to its types, null where absent."""
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def month_skeleton(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every month of a period with its first and last day."""
    months = F.sequence(
        F.trunc(F.lit(start).cast("date"), "MM"), F.trunc(F.lit(end).cast("date"), "MM"), F.expr("interval 1 month")
    )
    return spark.range(1).select(F.explode(months).alias("month_start")).withColumn("month_end", F.last_day("month_start"))
