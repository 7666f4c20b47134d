"""Toxicity by compression distance.

Two zstandard dictionaries are made, one from toxic and one from ordinary text. A document is cut
into windows of WINDOW words; each window is compressed with either dictionary, and the bytes
that the toxic one saves are its distance. Scores combine a document's largest and mean
distances by weights fitted on labelled documents, and are shifted so that CUT is the threshold
with the best F1 among them.

What a class adds to its dictionary are the parts of words that it uses in far more different
contexts than the other class (a context is the word before, so that copies of a text count
once); both dictionaries end in the same common words. Otherwise the two would mostly tell
apart which rare words their samples happen to hold.

The model is fitted on a bounded sample: TOXIC_ROWS and ORDINARY_ROWS labelled documents, those
that come first by a hash of their identifier. Distances for the weights come from dictionaries
made of the other half of the sample. Every document is scored on its whole text.

Null texts are empty and get the score of an empty text. Each input row gives one row. Of
labels that repeat an identifier the largest counts; labels that are null are not used. If a
class has no labelled document, every score is 0. Empty tables are allowed.
"""

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_blocks

TOXIC_ROWS, ORDINARY_ROWS = 1_500, 2_500
CUT = 0.7
WINDOW = 12
#: Lengths of word parts, the contexts that one needs (some, and more in proportion to a class's
#: texts), and times that its share must exceed the other class's.
PARTS = (4, 5, 6)
CONTEXTS, TEXTS_A_CONTEXT = 4, 200
TIMES = 15
SNIPPETS, COMMON = 400, 4_000
EDGES = ".,;:!?\"'()|*#$%&"
SPLIT = zstandard.ZstdCompressionParameters.from_level(
    3,
    format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    write_content_size=0,
    write_dict_id=0,
    write_checksum=0,
    strategy=zstandard.STRATEGY_LAZY2,
    min_match=5,
    window_log=18,
    search_log=6,
)


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray
    shift: float

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        out = []
        for content in (self.toxic, self.ordinary):
            table = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            out.append(zstandard.ZstdCompressor(dict_data=table, compression_params=SPLIT))
        return out[0], out[1]


def _contexts(texts: list[str]) -> tuple[dict[str, int], Counter]:
    """(word -> number of different words before it, word -> number of texts)."""
    before = defaultdict(set)
    texts_with: Counter = Counter()
    for text in texts:
        words = [w.strip(EDGES) for w in text.lower().split()]
        texts_with.update(set(words))
        for a, b in zip(["", *words], words):
            before[b].add(a)
    return {w: len(s) for w, s in before.items() if w}, texts_with


def _parts(word: str) -> Iterator[tuple[int, int]]:
    for n in PARTS:
        for i in range(len(word) - n + 1):
            yield i, i + n


def _part_counts(contexts: dict[str, int]) -> Counter:
    out: Counter = Counter()
    for word, n in contexts.items():
        word = f" {word}"
        for part in {word[i:j] for i, j in _parts(word)}:
            out[part] += n
    return out


def _distinctive(own: Counter, size: int, other: Counter, other_size: int, least: int) -> set[str]:
    return {p for p, n in own.items() if n >= least and (n + 0.5) / size > TIMES * (other[p] + 0.5) / other_size}


def _snippets(contexts: dict[str, int], parts: set[str]) -> list[str]:
    """Stretches of words that distinctive parts cover, the most common first."""
    out: Counter = Counter()
    for word, n in contexts.items():
        word = f" {word}"
        covered = [False] * len(word)
        for i, j in _parts(word):
            if word[i:j] in parts:
                covered[i:j] = [True] * (j - i)
        i = 0
        while i < len(word):
            j = i
            while j < len(word) and covered[j]:
                j += 1
            if j > i:
                out[word[i:j]] += n
            i = j + 1
    return [s for s, _ in sorted(out.items(), key=lambda x: (-x[1], x[0]))[:SNIPPETS]]


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary; what is likelier to match stands last."""
    (one, one_texts), (two, two_texts) = _contexts(toxic), _contexts(ordinary)
    parts_one, parts_two = _part_counts(one), _part_counts(two)
    sizes = sum(one.values()) or 1, sum(two.values()) or 1
    least = [CONTEXTS + len(texts) // TEXTS_A_CONTEXT for texts in (toxic, ordinary)]
    own = _distinctive(parts_one, sizes[0], parts_two, sizes[1], least[0])
    others = _distinctive(parts_two, sizes[1], parts_one, sizes[0], least[1])
    either = own | others
    shared = []
    for word, _ in sorted((one_texts + two_texts).items(), key=lambda x: (-x[1], x[0])):
        padded = f" {word}"
        if word and not any(padded[i:j] in either for i, j in _parts(padded)):
            shared.append(word)
            if len(shared) == COMMON:
                break
    common = " " + " ".join(reversed(shared))
    return tuple(("".join(reversed(_snippets(c, p))) + common).encode("utf-8", "replace") for c, p in ((one, own), (two, others)))


def features(text: str, toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> list[float]:
    """A constant and the distances of a text's windows: largest, mean of three, mean, shares of clear ones."""
    words = text.lower().split()
    saved = []
    for i in range(0, max(1, len(words)), WINDOW):
        window = (" " + " ".join(words[i : i + WINDOW])).encode("utf-8", "replace")
        saved.append(len(ordinary.compress(window)) - len(toxic.compress(window)))
    saved.sort(reverse=True)
    n = len(saved)
    top = saved[:3]
    return [
        1.0,
        saved[0] / 4,
        sum(top) / len(top) / 4,
        max(-4.0, min(4.0, 4 * sum(saved) / n)),
        4 * sum(s >= 2 for s in saved) / n,
        4 * sum(s >= 3 for s in saved) / n,
        math.log1p(sum(s >= 3 for s in saved)),
        math.log1p(n) / 4,
    ]


def _fit(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a small penalty."""
    weights = np.zeros(rows.shape[1])
    penalty = np.eye(len(weights))
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (labels - chance) - penalty @ weights
        weights += np.linalg.solve((rows * (chance * (1 - chance))[:, None]).T @ rows + penalty, slope)
    return weights


def train(toxic: list[str], ordinary: list[str]) -> Model | None:
    """A model from the texts of both classes; None if a class has fewer than two."""
    if len(toxic) < 2 or len(ordinary) < 2:
        return None
    rows, labels = [], []
    for half in (0, 1):
        held = toxic[half::2], ordinary[half::2]
        pair = Model(*dictionaries(toxic[1 - half :: 2], ordinary[1 - half :: 2]), np.zeros(0), 0.0).compressors()
        for label, texts in ((1, held[0]), (0, held[1])):
            rows += [features(t, *pair) for t in texts]
            labels += [label] * len(texts)
    x, y = np.array(rows), np.array(labels, float)
    weights = _fit(x, y)
    value = x @ weights
    order = np.argsort(-value, kind="stable")
    found = np.cumsum(y[order])
    f1 = 2 * found / (np.arange(1, len(y) + 1) + y.sum())
    best = int(f1.argmax())
    following = value[order[min(best + 1, len(y) - 1)]]
    cut = (value[order[best]] + following) / 2
    return Model(*dictionaries(toxic, ordinary), weights, math.log(CUT / (1 - CUT)) - float(cut))


def held_out(doc_id: Column) -> Column:
    """Rows kept out of fitting, by a checksum of the identifier; rows without one are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """A model fitted on labelled documents that are not held out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).alias("label"))
    chosen = None
    for label, limit in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS)):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(limit)
        chosen = part if chosen is None else chosen.union(part)
    body = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The chosen ids are TOXIC_ROWS + ORDINARY_ROWS at most.
    rows = body.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = rows.orderBy(F.xxhash64("id"), "id").collect()
    texts = {label: list(dict.fromkeys(r["text"] for r in rows if r["label"] == label)) for label in (0, 1)}
    return train(texts[1], texts[0])


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.compressors() if model else None
        for batch, texts in text_blocks(batches):
            if model:
                value = np.array([features(t, *pair) for t in texts]) @ model.weights + model.shift
                chance = 1 / (1 + np.exp(-np.clip(value, -30, 30)))
            else:
                chance = np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chance)], names=[id_col, "score"])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, score double")
