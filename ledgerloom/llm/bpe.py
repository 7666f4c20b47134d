"""Byte-level BPE by replaying the merges over a corpus of distinct pieces.

Each task gathers the distinct pieces of its documents, some hundred thousand at a time, and
keeps an inverted index from mergeable pair to the positions where the pair stands. Merges are
applied in rank order, each to all its positions at once; only the pairs beside a merged
position change. Pieces are merged independently of each other, so that any division of the
corpus into tasks gives the same ids; nothing is shuffled. The documents' ids are then read off
by piece number.

Documents: null texts are empty and have no ids; each input row gives one output row, repeated
rows and null identifiers included; an empty table gives an empty result. Columns other than
the identifier and the text are not read. Text that the vocabulary lacks cannot occur: every
byte must be a token of its own, or ValueError is raised.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import pretokens
from ledgerloom.llm.common import give_back, text_blocks

#: Pieces held before the merges are replayed, and distinct ones; both bound a task's memory.
PIECES = 2_000_000
DISTINCT = 150_000
NONE = np.iinfo(np.int32).max
OUT_IDS = 500_000


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes by rank from a file with lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


class Merges:
    """The merge table of a rank file in arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        if missing := [i for i in range(256) if bytes([i]) not in ranks]:
            raise ValueError(f"bytes without a token: {missing}")
        self.ranks = ranks
        self.width = max(ranks.values()) + 1
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs: dict[int, int] = {}
        lowers = np.zeros(self.width, bool)
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is None or b is None:
                    continue
                pairs[a * self.width + b] = rank
                # Merging into such a token may bring forth a pair of lower rank.
                lowers[a] |= rank < a
                lowers[b] |= rank < b
        self.lowers = lowers
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens; NONE if they do not merge."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)


@functools.cache
def load_merges(path: str) -> Merges:
    return Merges(load_ranks(path))


def replay(pieces: list[str], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, start of each piece's ids and the end): every merge in rank order, leftmost first."""
    raw = [p.encode("utf-8", "replace") for p in pieces]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    whole = np.fromiter((merges.ranks.get(r, -1) for r in raw), np.int32, len(raw))
    symbol = merges.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
    n = len(symbol)
    first = np.cumsum(size) - size
    piece = np.repeat(np.arange(len(raw), dtype=np.int32), size)
    after = np.arange(1, n + 1, dtype=np.int32)
    after[first + size - 1] = -1
    before = np.arange(-1, n - 1, dtype=np.int32)
    before[first] = -1
    alive = np.ones(n, bool)
    # A piece that is a token keeps its first position only.
    known = whole[piece] >= 0
    alive[known] = False
    alive[first[whole >= 0]] = True
    symbol[first[whole >= 0]] = whole[whole >= 0]
    now = np.full(n, NONE, np.int32)
    left = np.flatnonzero((after >= 0) & ~known).astype(np.int32)
    now[left] = merges.rank(symbol[left], symbol[after[left]])

    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def enter(places: np.ndarray) -> None:
        """Put places into the index under the rank of the pair that begins there."""
        rank = now[places]
        places, rank = places[rank != NONE], rank[rank != NONE]
        if not len(places):
            return
        order = np.argsort(rank, kind="stable")
        places, rank = places[order], rank[order]
        cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        edges = [0, *cut.tolist(), len(rank)]
        for a, b, r in zip(edges, edges[1:], rank[np.append(0, cut)].tolist(), strict=False):
            if r in index:
                index[r].append(places[a:b])
            else:
                index[r] = [places[a:b]]
                heapq.heappush(waiting, r)

    enter(left)
    while waiting:
        r = heapq.heappop(waiting)
        held = index.pop(r)
        at = held[0] if len(held) == 1 else np.concatenate(held)
        at = at[now[at] == r]
        if len(held) > 1:
            at = np.unique(at)
        if not len(at):
            continue
        if merges.lowers[r]:
            # One merge a piece; the rest waits until lower pairs have had their turn.
            _, one = np.unique(piece[at], return_index=True)
            rest = np.delete(at, one)
            at = at[one]
            if len(rest):
                index[r] = [rest]
                heapq.heappush(waiting, r)
        elif len(at) > 1:
            # Of pairs that overlap, the leftmost of each two.
            joined = np.append(False, after[at[:-1]] == at[1:])
            if joined.any():
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(joined, 0, place))) % 2 == 0]
        gone = after[at]
        alive[gone] = False
        now[gone] = NONE
        symbol[at] = r
        beyond = after[gone]
        after[at] = beyond
        has = beyond >= 0
        before[beyond[has]] = at[has]
        ahead = before[at]
        ahead = ahead[ahead >= 0]
        now[at] = NONE
        right = at[has]
        now[right] = merges.rank(symbol[right], symbol[after[right]])
        now[ahead] = merges.rank(symbol[ahead], symbol[after[ahead]])
        touched = np.concatenate((ahead, right))
        enter(np.unique(touched) if len(touched) > 1 else touched)
    return symbol[alive], np.append(0, np.cumsum(np.bincount(piece[alive], minlength=len(raw))))


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[s : s + n] of each start and size, one after another."""
    ends = np.cumsum(sizes)
    where = np.arange(ends[-1] if len(ends) else 0)
    return values[where + np.repeat(starts - (ends - sizes), sizes)]


def encoded_batches(batches: Iterator[pa.RecordBatch], encode) -> Iterator[pa.RecordBatch]:
    """The leading columns with a list of ids instead of the text.

    encode(distinct pieces) gives their ids and bounds, as replay() does.
    """
    numbers: dict[str, int] = {}
    held: list[tuple[list[pa.Array], np.ndarray, np.ndarray]] = []
    names: list[str] = []
    pieces = 0

    def flush(names: list[str]) -> Iterator[pa.RecordBatch]:
        ids, bounds = encode(list(numbers))
        sizes = np.diff(bounds)
        for lead, number, per_text in held:
            out = gather(ids, bounds[number], sizes[number])
            upto = np.append(0, np.cumsum(sizes[number]))
            offsets = upto[np.append(0, np.cumsum(per_text))]
            start, n = 0, len(per_text)
            while start < n:
                stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + OUT_IDS)))
                stop = min(stop, n)
                part = offsets[start : stop + 1]
                lists = pa.ListArray.from_arrays(pa.array((part - part[0]).astype(np.int32)), pa.array(out[part[0] : part[-1]], pa.int32()))
                yield pa.RecordBatch.from_arrays([*(c.slice(start, stop - start) for c in lead), lists], names=names)
                start = stop
        held.clear()
        numbers.clear()

    for batch, texts in text_blocks(batches):
        number, distinct, per_text = pretokens.split(texts)
        known = np.fromiter((numbers.setdefault(p, len(numbers)) for p in distinct), np.int64, len(distinct))
        # The texts are not held.
        names = [*batch.schema.names[:-1], "ids"]
        held.append((batch.columns[:-1], known[number].astype(np.int32), per_text))
        pieces += len(number)
        if pieces >= PIECES or len(numbers) >= DISTINCT:
            yield from flush(names)
            pieces = 0
    if held:
        yield from flush(names)
        give_back()


def _schema(df: DataFrame, names: list[str], last: str) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join([*(f"`{n}` {types[n]}" for n in names), last])


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every document; vocabulary: path of a rank file on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load_merges(vocabulary)
        return encoded_batches(batches, lambda pieces: replay(pieces, merges))

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, _schema(rows, [id_col], "ids array<int>"))


@functools.cache
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def decoded_batches(batches: Iterator[pa.RecordBatch], vocabulary: str, decoded_col: str = "decoded") -> Iterator[pa.RecordBatch]:
    """The batches, whose last column is a list of ids, with the bytes that the ids stand for."""
    flat, starts, sizes = _token_bytes(vocabulary)
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
        upto = np.append(0, np.cumsum(sizes[ids]))[bounds - bounds[0]]
        raw = gather(flat, starts[ids], sizes[ids])
        buffers = [pa.py_buffer(upto.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())]
        out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, *buffers]).cast(pa.binary())
        if lists.null_count:
            out = pc.if_else(lists.is_valid(), out, None)
        yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, decoded_col])


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """The rows with the bytes their ids stand for; null ids give null."""
    names = [c for c in encoded.columns if c != ids_col]
    rows = encoded.select(*names, ids_col)
    return rows.mapInArrow(lambda batches: decoded_batches(batches, vocabulary, decoded_col), _schema(rows, rows.columns, f"`{decoded_col}` binary"))


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every document: encode() and decode() in one stage, so that one worker a task holds the tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load_merges(vocabulary)
        return decoded_batches(encoded_batches(batches, lambda pieces: replay(pieces, merges)), vocabulary)

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, _schema(rows, [id_col], "ids array<int>, decoded binary"))


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number of tokens and checksums of the ids and of the decoded bytes, per document."""
    rows = round_trip(docs, vocabulary, id_col, text_col)
    return rows.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
