"""SimHash near-duplicates by covering anchors.

A fingerprint of 64 bits is cut into two halves. Fingerprints that differ in at most THRESHOLD
= 2 bits differ in at most one bit in one of the halves. The anchors of a half are the words of
a covering code: the perfect Hamming code of 31 bits beside a free bit, so that every half is
within RADIUS = 1 bit of an anchor. A fingerprint is home at the anchor nearest to it and is
replicated to all anchors within RADIUS + 1 bits, 17 in each half: one near, 15 at two bits, one
across the free bit (if the half is an anchor itself: itself and its free-bit neighbour). If two
halves differ in at most one bit, the home of the one is among the replicas of the other.
Fingerprints are compared per anchor, homes with replicas, by the number of differing bits.

Equal fingerprints are one row before anything is compared, so that a group of copies of any
size is one node; documents get their component by a join at the end. Components are found by
alternating large-star and small-star steps on the links, with a written table a round.

Both sides of these joins grow with the corpus, and Spark sizes them too low: replicas by the rows
before they are exploded, links by files that pack them well. So the joins ask to be merged.

Documents: null and empty texts, like all texts without a word, have fingerprint zero and link
like any other. Rows that repeat an identifier are separate members. Null identifiers are kept;
they are never the smallest identifier of a component, which is null only if all its members'
are. An empty table gives an empty result. Columns beside identifier and text are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_name, materialize, new_path, remove, text_blocks

THRESHOLD = 2
SHINGLE = 3
SEED = 42
#: Shingle hashes whose bits are counted at once.
COUNTED = 100_000

#: Lower case for A-Z alone.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str) -> int:
    """SimHash of a text's word shingles; bit i is set if it is set in over half of their hashes."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends[:-1]).tolist()
    ends = (ends - 1).tolist()
    last = min(SHINGLE, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[last:])]
    n = len(hashes)
    values = np.array(hashes, "<u8")
    total = np.zeros(64, np.int64)
    for i in range(0, n, COUNTED):
        raw = values[i : i + COUNTED].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            fp = np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], names=["doc_id", "text_hash", "fp"])

    body = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


#: Parity checks of the Hamming code: bit i of a 31-bit word takes part in those that i + 1 has.
_PARITY = tuple(sum(1 << i for i in range(31) if (i + 1) >> j & 1) for j in range(5))
_FREE = 1 << 31


def _anchored(distinct: DataFrame) -> DataFrame:
    """(fp, half, home, replicas): the anchors of both halves of a fingerprint.

    The syndrome s names the bit to flip to come to the nearest anchor (0: none). Flipping bit j
    first changes it to s xor j, which gives the anchors at two bits without a search.
    """
    halves = F.array(F.expr("fp & 4294967295"), F.expr("shiftrightunsigned(fp, 32)"))
    rows = distinct.select("fp", F.posexplode(halves).alias("half", "value"))
    syndrome = " + ".join(f"(bit_count(value & {parity}L) & 1) * {1 << j}" for j, parity in enumerate(_PARITY))
    rows = rows.withColumn("s", F.expr(syndrome)).withColumn("home", F.expr("value ^ if(s = 0, 0L, shiftleft(1L, s - 1))"))
    two = "transform(sequence(1, 31), j -> value ^ shiftleft(1L, j - 1) ^ if((s ^ j) = 0, 0L, shiftleft(1L, (s ^ j) - 1)))"
    return rows.select("fp", "half", "home", F.expr(f"array_distinct(concat(array(home, home ^ {_FREE}L), {two}))").alias("replicas"))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) with a < b: fingerprints of column fp that differ in at most THRESHOLD bits.

    Fingerprints are few bytes and become 34 rows each, so they are dealt to all tasks first; by a
    hash of their own, since Spark leaves out a second exchange by the same column.
    """
    distinct = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    homes = _anchored(distinct).select("fp", "half", F.col("home").alias("anchor"))
    probes = _anchored(distinct).select(F.col("fp").alias("other"), F.col("half").alias("part"), F.explode("replicas").alias("place"))
    near = F.expr(f"bit_count(fp ^ other) <= {THRESHOLD}")
    # Sized by its fingerprints alone, a side of replicas would be broadcast although it is 34 times as large.
    pairs = homes.hint("merge").join(probes.hint("merge"), (F.col("half") == F.col("part")) & (F.col("anchor") == F.col("place")) & near & (F.col("fp") != F.col("other")))
    return pairs.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the component's smallest node.

    A round links every node's larger neighbours to its smallest one (large star), then its
    smaller neighbours (small star); the links then form stars after few rounds. Each round is
    written, so that a lost executor repeats that round only.
    """
    spark = edges.sparkSession
    path = new_path(spark, "links")
    edges.where("a <> b").select("a", "b").write.parquet(path)
    while True:
        now = spark.read.schema("a bigint, b bigint").parquet(path)
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Now a > b in every row.
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest.hint("merge"), "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l"))
        small = small.select("l.a", "l.b").where("a <> b").distinct()
        following = new_path(spark, "links")
        small.write.parquet(following)
        remove(spark, [path])
        path = following
        now = spark.read.schema("a bigint, b bigint").parquet(path)
        # Stars: no node has two links up, and none that is linked up is linked to.
        many = now.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        inner = now.join(now.select(F.col("b").alias("a")).distinct().hint("merge"), "a", "leftsemi").select("a")
        if not many.union(inner).take(1):
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id, is_first) of every row.

    root is the component's smallest fingerprint, component_id its smallest doc_id. is_first
    marks the rows with the component's smallest (doc_id, text_hash).
    """
    rows = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    # Nulls last, so that a row with an identifier goes first.
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")
    nodes = rows.groupBy("fp").agg(F.min(order).alias("first"))
    root = components(links(rows.select("fp").distinct()))
    nodes = nodes.join(root.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = nodes.groupBy("root").agg(F.min("first").alias("least"))
    nodes = nodes.join(firsts.hint("merge"), "root").select("fp", "root", "least")
    return rows.join(nodes.hint("merge"), "fp").select(
        "doc_id",
        "text_hash",
        "fp",
        "root",
        F.col("least.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))).alias("is_first"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the smallest identifier, then text hash.

    Of rows that repeat both, the one that sorts first by its other columns stays.
    """
    key, other, digest = (free_name(docs, n) for n in ("body_hash", "first_id", "first_hash"))
    chosen = near_duplicates(docs, id_col, text_col).where("is_first").select(F.col("doc_id").alias(other), F.col("text_hash").alias(digest)).distinct()
    body = F.xxhash64(F.col(text_col).cast("string"))
    kept = docs.withColumn(key, body).join(chosen, F.col(id_col).eqNullSafe(F.col(other)) & (F.col(key) == F.col(digest)), "leftsemi")
    return one_each(kept, [id_col, key]).drop(key)


def one_each(docs: DataFrame, key: list[str]) -> DataFrame:
    """The first row of each key, by a hash of all columns."""
    place = free_name(docs, "place")
    order = [F.xxhash64(*(c for c in docs.columns))]
    return docs.withColumn(place, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(place) == 1).drop(place)
