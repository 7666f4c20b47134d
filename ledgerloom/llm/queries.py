"""The registered queries of the operators in this subpackage."""

import os
from functools import reduce

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.oracles import ORACLES  # noqa: F401
from ledgerloom.llm import alignment, bpe, common, licenses, packing, pii, prefixtrie, quality, reputation, simhash, tokenfile, toxicity, warc, winnow

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(table(spark, sf_dir, "documents"))
    base = quality.fails("base")
    return book.select(
        "doc_id",
        *quality.MEASURES[:5],
        base.alias("base_failed"),
        (~base & ~quality.fails("v3")).alias("kept"),
        F.col("failed").alias("failed_mask"),
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy costs, from one ledger."""
    book = common.materialize(quality.ledger(table(spark, sf_dir, "documents")).select("failed"), "ledger")
    parts = [quality.ablations(book, policy).withColumn("policy", F.lit(policy)) for policy in quality.POLICIES]
    return reduce(DataFrame.unionByName, parts)


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived records of every page, as read from the files that they were written to."""
    made = warc.derive_pages(table(spark, sf_dir, "pages"))
    rows = warc.read(warc.write(made))
    return rows.select(*warc.FIELDS, F.length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("content_sha256"))


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are labelled by the row of `labels` with their number: bad if toxic or of low quality."""
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", bad.alias("bad"))
    rows = reputation.filter_urls(table(spark, sf_dir, "pages"), labels)
    return rows.withColumn("mean", F.round("mean", 6)).withColumn("bound", F.round("bound", 6))


def _joined(spans: str) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))
    return F.array_join(parts, ",")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = pii.find(docs, pii.fit(docs))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in pii.KINDS]
    return rows.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.per_document(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return rows.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"),
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = tokenfile.write(docs, public_tokenizers.path(TOKENIZER))
    return tokenfile.summary(tokenfile.read(manifest, docs.schema["doc_id"].dataType.simpleString()))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


def op12_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation begins with the first turns of the one whose number is the next multiple of five below."""
    conv = F.col("conv_id")
    donor = conv - F.pmod(conv, F.lit(5))
    seqs = prefixtrie.sequences(table(spark, sf_dir, "conversations"))
    return prefixtrie.trie(prefixtrie.start_replaced(seqs, donor, F.crc32(conv.cast("string")) % 9, most=8))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality_rules": op3_quality_rules,
    "quality_ablations": quality_ablations,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_url_reputation": op5_url_reputation,
    "op6_personal_data": op6_personal_data,
    "op7_decontamination": op7_decontamination,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_token_files": op10_token_files,
    "op11_token_alignment": op11_token_alignment,
    "op12_sequence_packing": op12_sequence_packing,
    "op13_prefix_trie": op13_prefix_trie,
}
