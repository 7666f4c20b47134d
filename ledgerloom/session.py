"""Session settings and durable intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerloom", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings the jobs rely on; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Month expansion and interval joins multiply rows after a shuffle, so small
        # shuffles must not be merged into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_chosen: list[str] = []


def use_folder(path: str) -> None:
    """The folder for intermediate data of sessions that name none; the caller answers for its being shared."""
    _chosen[:] = [path]


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir, else the one of use_folder()."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or next(iter(_chosen), None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write a result that several jobs read to the shared folder and read it back.

    The written table survives the loss of executors and cuts the lineage.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/ledgerloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
