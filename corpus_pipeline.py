"""A corpus pipeline: quality rules, near-duplicates, benchmark passages, personal data, tokens."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, common, pii, quality, queries, simhash, winnow


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return quality.kept(docs, "v4")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no considerable part of a benchmark item."""
    return winnow.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data in their text replaced, and their length set anew."""
    cleaned = pii.redact(docs, pii.fit(docs))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document with checksums."""
    return bpe.digests(docs, public_tokenizers.path(queries.RANKS))


STAGES = [
    ("quality rules", by_quality),
    ("near-duplicates", one_of_near_duplicates),
    ("benchmark", without_benchmark),
    ("personal data", without_personal_data),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each stage's result is written before the next reads it."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fingerprints, trained models and tokens are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None
