"""Variants of free payment texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as fv
from ..functions.text import semantic_text, semantic_text_key


def raw_variants(df: DataFrame, text: str) -> DataFrame:
    """Rows per raw text."""
    return df.groupBy(F.coalesce(F.col(text), F.lit("")).alias("raw")).agg(F.count(F.lit(1)).alias("raw_cnt"))


def keyed_variants(df: DataFrame, text: str, phrase: str = fv.TAIL_PHRASE) -> DataFrame:
    """Raw texts with their counts, semantic text and semantic key."""
    return raw_variants(df, text).withColumns(
        {"semantic": semantic_text("raw", phrase), "key": semantic_text_key("raw", phrase)}
    )


def text_variants(df: DataFrame, text: str, phrase: str = fv.TAIL_PHRASE) -> DataFrame:
    """Per semantic key: a representative, rows, and raw texts that fall together."""
    return keyed_variants(df, text, phrase).groupBy("key").agg(
        F.min("semantic").alias("representative"),
        F.sum("raw_cnt").alias("cnt"),
        F.count(F.lit(1)).alias("raw_variants_collapsed"),
    )


def text_variant_stats(df: DataFrame, text: str, keyword: str, phrase: str = fv.TAIL_PHRASE) -> DataFrame:
    """Rows and distinct raw, semantic and key texts; the same for texts with the keyword."""
    rows = keyed_variants(df, text, phrase).withColumn("hit", F.lower("raw").rlike(keyword).cast("int"))
    per_semantic = rows.groupBy("key", "semantic").agg(
        F.sum("raw_cnt").alias("rows"), F.count(F.lit(1)).alias("raws"),
        F.sum(F.col("raw_cnt") * F.col("hit")).alias("hit_rows"), F.max("hit").alias("hit"),
    )
    per_key = per_semantic.groupBy("key").agg(
        F.sum("rows").alias("rows"), F.sum("raws").alias("raws"), F.count(F.lit(1)).alias("semantics"),
        F.sum("hit_rows").alias("hit_rows"), F.sum("hit").alias("hit_semantics"), F.max("hit").alias("hit"),
    )
    return per_key.agg(
        F.sum("rows").alias("total_rows"),
        F.sum("raws").alias("unique_raw"),
        F.sum("semantics").alias("unique_semantic"),
        F.count(F.lit(1)).alias("unique_key"),
        F.sum("hit_rows").alias("matched_rows"),
        F.sum("hit_semantics").alias("matched_unique_semantic"),
        F.sum("hit").alias("matched_unique_key"),
    )
