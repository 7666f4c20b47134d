"""Benchmark decontamination by winnowing.

Words are hashed; of every GUARANTEE - K + 1 successive k-grams the ones with the least hash are
kept as fingerprints, ties included. Two texts that share GUARANTEE consecutive words share a
kept k-gram, since both keep the same ones inside the shared span. Fingerprints carry the words
around them, as hashes; after the join of training and test fingerprints each hit is extended to
both sides, and spans of at least GUARANTEE words count. An item of fewer words is one window
of its own length, found by the hash of all windows of that length.

A fingerprint of a document goes to the join only if its slot in a bit table of all test
fingerprints is taken. The table has a fixed size, so it is small for any number of items; it
leaves out only fingerprints that no item has. The test fingerprints are broadcast while they
are fewer than BROADCAST_ROWS; more of them are joined by a shuffle.

Null texts have no words. Rows are told apart by identifier and text; rows that repeat both get
one result each. Null identifiers are kept. Passages of items with null identifier are hits, but
no item is counted for them; items without words match nothing; an item that repeats counts
once. Empty tables on either side are allowed.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_name, text_blocks

GUARANTEE = 13
K = 4
#: k-grams of which the least is kept: K + WINDOW - 1 = GUARANTEE.
WINDOW = GUARANTEE - K + 1
#: Words that a fingerprint carries: as many to each side as a span of GUARANTEE words can have.
REACH = GUARANTEE - K
SPAN = REACH + K + REACH
#: Slots of the bit table (a table of 512 KB).
SLOTS = 1 << 22
BROADCAST_ROWS = 200_000
#: Distinct words whose hashes a task remembers at a time.
REMEMBERED = 400_000

#: Lower case for A-Z, blanks for what is no word character; bytes above 0x7F belong to words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256)
)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k successive words from each place."""
    n = len(words) - k + 1
    out = words[:n] * MIX[2]
    for i in range(1, k):
        out = (_mixed(out) + words[i : n + i]) * MIX[2]
    return _mixed(out)


def _least(values: np.ndarray, width: int, of=np.minimum) -> np.ndarray:
    """The least (or by another function the most) of `width` successive values from each place."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = of(values[:-step], values[step:])
        done += step
    return values


def kept_places(values: np.ndarray) -> np.ndarray:
    """Places of the k-grams that are least in some window of WINDOW successive ones."""
    least = _least(values, WINDOW)
    edge = np.zeros(WINDOW - 1, np.uint64)
    reached = _least(np.concatenate((edge, least, edge)), WINDOW, np.maximum)
    return np.flatnonzero(reached == values)


def fingerprints(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kept k-gram hashes, their places); none for fewer than GUARANTEE words."""
    if len(words) < GUARANTEE:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    values = grams(words, K)
    places = kept_places(values)
    return values[places], places


def _around(words: np.ndarray, places: np.ndarray, edge: int) -> np.ndarray:
    """The SPAN words around each place as 32-bit hashes; `edge` stands beyond the text's ends."""
    short = np.maximum((words >> np.uint64(32)).astype(np.uint32), 2)
    side = np.full(REACH, edge, np.uint32)
    padded = np.concatenate((side, short, side))
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, SPAN)[places])


def _rows_of(words: np.ndarray, shorts: tuple[int, ...], edge: int, taken: np.ndarray | None):
    """(hash, window length, place, surrounding words) of one text, those whose slot is taken."""
    out = []
    values, places = fingerprints(words)
    if taken is not None:
        here = taken[(values & np.uint64(SLOTS - 1)).astype(np.int64)]
        values, places = values[here], places[here]
    if len(values):
        out.append((values, GUARANTEE, places, _around(words, places, edge)))
    for n in shorts:
        if len(words) < n:
            continue
        values = grams(words, n)
        places = np.arange(len(values))
        if taken is not None:
            here = taken[(values & np.uint64(SLOTS - 1)).astype(np.int64)]
            values, places = values[here], places[here]
        if len(values):
            out.append((values, n, places, None))
    return out


def _lists(parts: list[tuple[int, np.ndarray | None]]) -> pa.Array:
    """Rows of SPAN words as lists; the rows of a part without words are null."""
    words = [near.ravel().view(np.int32) for _, near in parts if near is not None]
    known = np.concatenate([np.full(n, near is not None) for n, near in parts])
    ends = np.append(0, np.cumsum(known * SPAN)).astype(np.int32)
    offsets = pa.array(ends, mask=np.append(~known, False))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(words) if words else np.empty(0, np.int32)))


FINGERPRINT = "fp bigint, width int, place int, around array<int>"


def _fingerprint_stage(rows: DataFrame, lead: str, shorts: tuple[int, ...] | None, edge: int, slots=None, summary: bool = False) -> DataFrame:
    """Fingerprint rows of the texts in the last column.

    shorts: lengths of short windows; None: of an item, whose own length counts.
    summary: a first row per text has width 0, and its number of words as place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Hashes()
        taken = None
        if slots is not None:
            taken = np.unpackbits(np.frombuffer(slots.value, np.uint8)).astype(bool)
        for batch, texts in text_blocks(batches):
            fp, width, place, around, at = [], [], [], [], []
            for i, text in enumerate(texts):
                names = words_of(text)
                words = np.fromiter(map(memory.__getitem__, names), np.uint64, len(names))
                if summary:
                    fp.append(np.zeros(1, np.uint64))
                    width.append(0)
                    place.append(np.array([len(words)]))
                    around.append((1, None))
                    at.append((i, 1))
                own = shorts if shorts is not None else (len(words),) if 0 < len(words) < GUARANTEE else ()
                for values, n, places, near in _rows_of(words, own, edge, taken):
                    fp.append(values)
                    width.append(n)
                    place.append(places)
                    around.append((len(values), near))
                    at.append((i, len(values)))
            if not at:
                continue
            source = np.repeat([i for i, _ in at], [n for _, n in at])
            columns = [batch.column(j).take(pa.array(source)) for j in range(batch.num_columns - 1)]
            columns += [
                pa.array(np.concatenate(fp).view(np.int64)),
                pa.array(np.repeat(width, [n for _, n in at]).astype(np.int32)),
                pa.array(np.concatenate(place).astype(np.int32)),
                _lists(around),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "fp", "width", "place", "around"])

    return rows.mapInArrow(run, f"{lead}, {FINGERPRINT}")


def _extended(tests_around: str) -> Column:
    """struct(lo, hi): the words of the text that a hit covers; lo = hi if the shared span is too short.

    Words beside the k-gram belong to the span as far as both texts have the same ones.
    """
    same = f"zip_with(around, {tests_around}, (a, b) -> a = b)"
    left = f"array_position(reverse(slice({same}, 1, {REACH})), false)"
    right = f"array_position(slice({same}, {REACH + K + 1}, {REACH}), false)"
    middle = f"forall(slice({same}, {REACH + 1}, {K}), x -> x)"
    return F.expr(f"""
        case when around is null then struct(place as lo, place + width as hi)
        else transform(array(struct(
            cast(if({left} = 0, {REACH}, {left} - 1) as int) as l, cast(if({right} = 0, {REACH}, {right} - 1) as int) as r, {middle} as m)),
          x -> if(x.m and x.l + {K} + x.r >= {GUARANTEE}, struct(place - x.l as lo, place + {K} + x.r as hi), struct(place as lo, place as hi)))[0]
        end""")


def spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Contaminated word spans: (doc_id, text_hash, n_words, item_id, lo, hi).

    Every text has one row with null item and its number of words; further rows say that words
    lo to hi (end exclusive) stand in windows that the item has.
    """
    spark = docs.sparkSession
    text = F.col(item_text_col).cast("string")
    tests = items.select(F.col(item_col).alias("item_id"), text.alias("__text"))
    kind = tests.schema["item_id"].dataType.simpleString()
    tests = _fingerprint_stage(tests, f"item_id {kind}", None, 1).select("fp", "width", "around", "item_id").distinct().persist()
    try:
        shape = tests.groupBy("width").count().collect()
        shorts = tuple(sorted(r["width"] for r in shape if r["width"] < GUARANTEE))
        n_tests = sum(r["count"] for r in shape)
        taken = tests.select(F.col("fp").bitwiseAND(F.lit(SLOTS - 1).cast("long")).cast("int").alias("slot")).distinct()
        table = np.zeros(SLOTS, bool)
        for batch in taken.toArrow().to_batches():
            table[batch.column(0).to_numpy()] = True
    finally:
        tests.unpersist()
    slots = spark.sparkContext.broadcast(np.packbits(table).tobytes())
    body = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("__text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = _fingerprint_stage(rows, f"doc_id {kind}, text_hash bigint", shorts, 0, slots, summary=True)
    right = tests.withColumnRenamed("around", "there").withColumn("found", F.lit(True))
    if n_tests <= BROADCAST_ROWS:
        right = F.broadcast(right)
    # The summary rows have width 0, which no item has; they pass the outer join.
    joined = found.join(right, ["fp", "width"], "left").where((F.col("width") == 0) | F.col("found"))
    hit = _extended("there")
    out = joined.select(
        "doc_id",
        "text_hash",
        F.when(F.col("width") == 0, F.col("place")).cast("long").alias("n_words"),
        "item_id",
        hit.alias("hit"),
    )
    return out.select("doc_id", "text_hash", "n_words", "item_id", F.col("hit.lo").alias("lo"), F.col("hit.hi").alias("hi")).where(
        F.col("n_words").isNotNull() | (F.col("lo") < F.col("hi"))
    )


def _is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, its text_hash and its copies.

    Overlapping spans are merged in order, so that a word counts once. A group holds the hits of
    one document, which its own length bounds.
    """
    is_hit = F.col("n_words").isNull()
    result = spans(docs, items, **names).groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("copies"),
        F.array_sort(F.collect_set(F.when(is_hit, F.struct("lo", "hi")))).alias("spans"),
        F.array_sort(F.collect_set(F.when(is_hit, F.col("item_id").cast("string")))).alias("items"),
    )
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    n_hit = F.aggregate(
        "spans",
        start,
        lambda done, x: F.struct(
            (done.total + F.greatest(F.lit(0), x.hi - F.greatest(x.lo, done.end))).alias("total"), F.greatest(done.end, x.hi).alias("end")
        ),
        lambda done: done.total.cast("long"),
    )
    result = result.withColumn("n_hit", n_hit)
    return result.select(
        "doc_id",
        "text_hash",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        _is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        "copies",
    )


def per_document(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """contamination() with one row per input row."""
    rows = contamination(docs, items, **names)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", again.alias("copy")).drop("copy")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is not contaminated."""
    found = contamination(docs, items, id_col=id_col, text_col=text_col).where("contaminated")
    key, digest = free_name(docs, "id"), free_name(docs, "hash")
    found = found.select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest))
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(digest))
    return docs.join(found, same, "leftanti")
