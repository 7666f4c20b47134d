"""Personal data: exact patterns, and a semi-Markov conditional random field for what they miss.

The field works on islands, the stretches around digits and @ that personal data can stand in.
An island is cut into runs of letters, runs of digits and single signs. Every run of up to
MAX_TOKENS tokens is a candidate segment; features of the whole segment (its checksum, its
shape, what stands beside it) score it as each kind, and dynamic programming over segment ends
chooses boundaries and kinds together. Weights maximize the likelihood of the segmentations that
the patterns give on a bounded sample: the islands of SAMPLE_DOCS documents at most, of which
SAMPLE_ISLANDS are used. Segments that overlap a pattern's span are left out of the result, so
that pattern spans always stay.

Texts may be null or empty (no spans). Each input row gives one row; repeated rows and null
identifiers are kept. Without any island in the sample the weights are zero and only pattern
spans are found. An empty table gives an empty result. Spans count code points, end exclusive.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.llm.common import bounded_sample, text_blocks

# The kinds in order, and their patterns. The possessive and lookbehind forms match
# what the plain ones do and read a long run once.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE_DOCS = 400
SAMPLE_ISLANDS = 300
EPOCHS = 6
MAX_TOKENS = 16
#: Tokens of an island whose segments are held at once.
BLOCK_TOKENS = 2_000
#: Characters beyond an island's first and last mark that may belong to an entity.
MARGIN = 48
#: Marks no further apart than this are one island.
GAP = 8
OUTSIDE = len(KINDS)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) by the patterns, sorted by start, then kind."""
    out = [(a, b, 0) for a, b in _emails(text)]
    out += [(*m.span(), 1) for m in IP.finditer(text) if _is_ip(m[0])]
    for m in CARD.finditer(text):
        if len(m[0]) < 40 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((*m.span(), 2))
    out += [(*m.span(), 3) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


MARKS = re.compile(r"[0-9@]+")
TOKENS = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
EMAIL_SHAPE = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")
DOTTED = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
NUMBERS = re.compile(r"[0-9][0-9 .-]*[0-9]")
CALL = re.compile(r"\+?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3}[ .-]?[0-9]{4}")
FEATURES = 18


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches (start, end) around the marks, cut at white space beyond them."""
    out: list[list[int]] = []
    for m in MARKS.finditer(text):
        if out and m.start() - out[-1][1] <= GAP:
            out[-1][1] = m.end()
        else:
            out.append([*m.span()])
    spread = []
    for a, b in out:
        low = spread[-1][1] if spread else 0
        i, j = a, b
        while i > low and a - i < MARGIN and not text[i - 1].isspace():
            i -= 1
        while j < len(text) and j - b < MARGIN and not text[j].isspace():
            j += 1
        if i < j:
            spread.append((i, j))
    return spread


def segment_features(segment: str, left: str, right: str, size: int) -> list[float]:
    """Features of a whole candidate segment, with the characters beside it."""
    digits = _digits(segment)
    n = len(digits)
    numeric = NUMBERS.fullmatch(segment) is not None
    edges = (segment[0].isalnum() or segment[0] in "+(") and segment[-1].isalnum()
    return [
        1.0,
        float(EMAIL_SHAPE.fullmatch(segment) is not None),
        float("@" in segment),
        float(DOTTED.fullmatch(segment) is not None and _is_ip(segment)),
        float(segment.count(".") >= 1 and n > 0 and numeric),
        float(numeric and 12 <= n <= 19),
        float(numeric and 12 <= n <= 19 and "." not in segment and luhn(digits)),
        float(segment[0] == "+" and 9 <= n <= 15),
        float(segment[0] == "+"),
        float(segment.count("(") == segment.count(")")),
        float(edges),
        float(left.isalnum() or left in ".@_-" and left != ""),
        float(right.isalnum() or right in "@_-" and right != ""),
        float("@" not in segment and any(c.isalpha() for c in segment)),
        float(any(c.isspace() for c in segment)),
        float(CALL.fullmatch(segment) is not None),
        float(size == 1),
        float(n < 9),
    ]


@dataclass
class Lattice:
    """The candidate segments of an island, or of those that begin in a block of its tokens.

    Token i of the island ends at ends[i] and begins where the one before ends.
    """

    start: int
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray
    features: np.ndarray

    def span(self, i: int, j: int) -> tuple[int, int]:
        """Where tokens i to j stand in the text."""
        return int(self.ends[i - 1]) if i else self.start, int(self.ends[j])


def _token_ends(text: str, start: int, end: int) -> np.ndarray:
    return np.fromiter((m.end() for m in TOKENS.finditer(text, start, end)), np.int64)


def _candidates(text: str, start: int, ends: np.ndarray, low: int, high: int) -> Lattice:
    """The candidate segments whose first token is one of low to high (exclusive)."""
    first, last, rows = [], [], []
    base = max(0, low - 1)
    near = ends[base : high + MAX_TOKENS].tolist()
    for i in range(low, high):
        a = near[i - 1 - base] if i else start
        for j in range(i, min(len(ends), i + MAX_TOKENS)):
            b = near[j - base]
            segment = text[a:b]
            # Longer segments start and end beside no white space, and hold a mark.
            if j > i and (segment[0].isspace() or segment[-1].isspace() or not MARKS.search(segment)):
                continue
            first.append(i)
            last.append(j)
            rows.append(segment_features(segment, text[a - 1 : a] if a else "", text[b : b + 1], j - i + 1))
    return Lattice(start, ends, np.array(first), np.array(last), np.array(rows).reshape(-1, FEATURES))


def lattice(text: str, start: int, end: int) -> Lattice:
    """All candidate segments of an island."""
    ends = _token_ends(text, start, end)
    return _candidates(text, start, ends, 0, len(ends))


def _scores(grid: Lattice, weights: np.ndarray) -> np.ndarray:
    """Scores of every segment by kind and outside; outside is for single tokens only."""
    scores = grid.features @ weights.T
    scores[grid.first != grid.last, OUTSIDE] = -np.inf
    return scores


def viterbi(text: str, start: int, end: int, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the entities in the best segmentation of an island.

    Segments are made and scored for BLOCK_TOKENS tokens at a time; what is held for the whole
    island is some bytes a token.
    """
    ends = _token_ends(text, start, end)
    n = len(ends)
    best = np.full(n + 1, -np.inf)
    best[0] = 0
    # The best segment up to each token: its number of tokens and its kind.
    back = np.zeros(n + 1, np.int8)
    kinds = np.zeros(n + 1, np.int8)
    for low in range(0, n, BLOCK_TOKENS):
        grid = _candidates(text, start, ends, low, min(n, low + BLOCK_TOKENS))
        scores = _scores(grid, weights)
        kind, score = scores.argmax(axis=1), scores.max(axis=1)
        # Segments are in order of their first token, so best[i] is final when it is read.
        for s, (i, j) in enumerate(zip(grid.first.tolist(), grid.last.tolist(), strict=True)):
            if best[i] + score[s] > best[j + 1]:
                best[j + 1] = best[i] + score[s]
                back[j + 1] = j + 1 - i
                kinds[j + 1] = kind[s]
    out = []
    at = n
    while at:
        i = at - int(back[at])
        if kinds[at] != OUTSIDE:
            out.append((int(ends[i - 1]) if i else start, int(ends[at - 1]), int(kinds[at])))
        at = i
    return out[::-1]


def _expected(grid: Lattice, weights: np.ndarray) -> np.ndarray:
    """Expected features by kind under the model."""
    scores = _scores(grid, weights)
    total = np.logaddexp.reduce(scores, axis=1)
    n = len(grid.ends)
    ahead = np.full(n + 1, -np.inf)
    ahead[0] = 0
    behind = np.full(n + 1, -np.inf)
    behind[n] = 0
    first, last = grid.first.tolist(), grid.last.tolist()
    for i, j, s in zip(first, last, total.tolist(), strict=True):
        ahead[j + 1] = np.logaddexp(ahead[j + 1], ahead[i] + s)
    for i, j, s in zip(first[::-1], last[::-1], total[::-1].tolist(), strict=True):
        behind[i] = np.logaddexp(behind[i], behind[j + 1] + s)
    chance = np.exp(scores + (ahead[grid.first] + behind[grid.last + 1] - ahead[n])[:, None])
    return chance.T @ grid.features


def _gold(grid: Lattice, spans: list[tuple[int, int, int]]) -> np.ndarray | None:
    """Features by kind of the segmentation that the patterns give; None if tokens can't express it."""
    kinds = np.zeros((len(KINDS) + 1, FEATURES))
    place = {(int(i), int(j)): s for s, (i, j) in enumerate(zip(grid.first, grid.last, strict=True))}
    bounds = [grid.span(i, i) for i in range(len(grid.ends))]
    starts = {a: i for i, (a, _) in enumerate(bounds)}
    ends = {b: i for i, (_, b) in enumerate(bounds)}
    at = 0
    for a, b, kind in spans:
        if a not in starts or b not in ends or starts[a] < at or (starts[a], ends[b]) not in place:
            return None
        for i in range(at, starts[a]):
            kinds[OUTSIDE] += grid.features[place[i, i]]
        kinds[kind] += grid.features[place[starts[a], ends[b]]]
        at = ends[b] + 1
    for i in range(at, len(bounds)):
        kinds[OUTSIDE] += grid.features[place[i, i]]
    return kinds


def train(texts: list[str]) -> np.ndarray:
    """Weights (kind, feature) that maximize the likelihood of the patterns' segmentations."""
    rows = []
    for text in texts:
        spans = pattern_spans(text)
        for a, b in islands(text):
            if b - a > 200 or len(rows) >= SAMPLE_ISLANDS:
                continue
            grid = lattice(text, a, b)
            gold = _gold(grid, [s for s in spans if s[0] >= a and s[1] <= b])
            if gold is not None:
                rows.append((grid, gold))
    weights = np.zeros((len(KINDS) + 1, FEATURES))
    squares = np.full_like(weights, 1e-8)
    for _ in range(EPOCHS):
        for grid, gold in rows:
            slope = gold - _expected(grid, weights) - 0.001 * weights
            squares += slope**2
            weights += 0.5 * slope / np.sqrt(squares)
    return weights


def all_spans(text: str, weights: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(pattern spans, pattern and model spans together), sorted by start, then kind."""
    base = pattern_spans(text)
    if not weights.any():
        return base, base
    # The patterns' spans as stretches apart from each other, in order.
    taken: list[list[int]] = []
    for a, b, _ in base:
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    stops = [b for _, b in taken]
    added = []
    for a, b in islands(text):
        at = bisect_right(stops, a)
        # What the patterns explain in full needs no search.
        if b - a < 400 and at < len(taken) and taken[at][0] < b:
            left, done = [], a
            for x, y in taken[at : bisect_left(taken, [b, 0])]:
                left.append(text[done:x])
                done = max(done, y)
            if not MARKS.search("".join(left) + text[done:b]):
                continue
        for span in viterbi(text, a, b, weights):
            over = bisect_right(stops, span[0])
            if over == len(taken) or taken[over][0] >= span[1]:
                added.append(span)
    return base, sorted(base + added, key=lambda s: (s[0], s[2]))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Train on the documents with marks that come first by a hash of identifier and text, SAMPLE_DOCS at most."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(F.col("text").rlike("[0-9@]"))
    sample = bounded_sample(rows, SAMPLE_DOCS, ["id", "text"]).collect()
    return train(list(dict.fromkeys(r["text"] for r in sample)))


SPAN = "array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): the patterns' spans and all spans, as lists of (kind, start, end)."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def named(spans):
        return [{"kind": KINDS[k], "start": a, "end": b} for a, b, k in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            found = [all_spans(t, weights) for t in texts]
            columns = [pa.array([named(f[i]) for f in found], span) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "base", "spans"])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, base {SPAN}, spans {SPAN}")


def redact_text(text: str, weights: np.ndarray) -> str:
    """The text with [KIND] for each span; spans that overlap become one, named by the first."""
    out, done = [], 0
    merged: list[list[int]] = []
    for a, b, kind in all_spans(text, weights)[1]:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = b
    return "".join(out) + text[done:] if merged else text


def redact(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows with personal data in the text replaced; null texts stay null, other columns as they are."""

    @F.pandas_udf(StringType())
    def cleaned(text: pd.Series) -> pd.Series:
        return text.map(lambda t: redact_text(t, weights), na_action="ignore")

    return docs.withColumn(text_col, cleaned(F.col(text_col).cast("string")))
