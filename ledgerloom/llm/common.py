"""Shared helpers: durable intermediate tables and batched Arrow stages."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import checkpoint_dir

#: Code points (or bytes) of text that a Python stage works on at once.
BLOCK_CHARS = 1_000_000


def new_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write a result that several jobs read to the shared folder and read it back.

    The written table survives lost executors and cuts the lineage.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def place(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path, which executors can open by themselves, and the name in it."""
    return pa.fs.FileSystem.from_uri(path if ":/" in path else "file://" + os.path.abspath(path))


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete written tables that no later step reads."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def bounded_sample(df: DataFrame, n: int, key: list[str]) -> DataFrame:
    """The n rows, or all of fewer, that come first by a hash of the key columns.

    Hashes above a limit that leaves about twice n rows are dropped first, so that a task sends
    the driver its share of those and not n rows of its own.
    """
    total = df.count()
    order = F.xxhash64(*key)
    if total > 4 * n:
        least, span = -(1 << 63), 1 << 64
        df = df.where(order < F.lit(least + span * 2 * n // total).cast("long"))
    return df.orderBy(order, *key).limit(n)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it, that no column of the table has in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between stages and share an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library; nothing depends on it


def text_blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches, with their texts, of about `limit` characters; a longer text is a slice of its own.

    The text is the last column; null is empty.
    """
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
        start = size = 0
        for i, text in enumerate(texts):
            if i > start and size + len(text) > limit:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(text)
        if start < len(texts):
            yield batch.slice(start), texts[start:]
        batch = texts = None
    give_back()
