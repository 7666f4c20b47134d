"""Prefix trie of conversations from sorted common prefixes, without a stack.

Each conversation becomes a sequence of turn keys (the first 16 bytes of a SHA-256 over role and
text). All sequences are sorted by key sequence and identifier over all tasks and cut into
blocks. Between neighbours stands the length of their common prefix. A prefix of depth d that
place p holds belongs to the places around p that can be reached over common prefixes of at
least d: two binary searches, one to the left and one to the right, over a sparse table of
range minima give the interval of its members. Within a block the table is that of the block;
a search that comes to a block's edge goes on over a table of the blocks' minima, and ends in
another block's answer for that edge and depth, which is joined. All sums over members and
subtrees are differences of running sums over the sorted places.

What the driver holds is a few numbers per block, and blocks are as large as it takes to have
BLOCKS of them at most besides one per partition. Sequences are dealt by range over key
sequence and identifier, so that equal conversations are spread over tasks. The digest over the
identifiers of equal conversations is one sequential sum by its nature; it is fed with one
text per block.

Conversations: turns are ordered by turn (null first), then role, then text; null roles and
texts are empty; turns of a null conversation belong to none and are left out; repeated rows are
turns of their own; an empty table has no node, not even a root. A conversation's keys must fit
into one value (16 bytes a turn). Columns other than the four named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize

KEY = 16
#: Blocks besides one per partition: what the driver and every task hold grows with this number.
BLOCKS = 200_000
#: Sequences and bytes of keys of a block, unless more are needed to stay within BLOCKS.
ROWS, BYTES = 4096, 4 << 20


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, keys, sizes): a conversation's turn keys one after another, and its texts' UTF-8 bytes."""
    text_of, role_of = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    rows = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), role_of.alias("role"), text_of.alias("text"))
    key = F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 2 * KEY)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    placed = rows.select("conv_id", place.alias("place"), key.alias("key"), F.octet_length("text").cast("long").alias("size"))
    listed = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "key", "size"))).alias("turns"))
    return listed.select("conv_id", F.unhex(F.array_join("turns.key", "")).alias("keys"), F.col("turns.size").alias("sizes"))


def start_replaced(seqs: DataFrame, donor: Column, n: Column, most: int) -> DataFrame:
    """Sequences whose first n turns (at most `most`) are replaced by the first n of the donor, or by all it has."""
    seqs = materialize(seqs, "own-sequences")
    own = seqs.select("*", donor.alias("donor"), n.alias("n"))
    heads = seqs.select(
        F.col("conv_id").alias("donor"), F.expr(f"substring(keys, 1, {KEY * most})").alias("head"), F.slice("sizes", 1, most).alias("head_sizes")
    )
    rows = own.join(heads, "donor", "left")
    return rows.select(
        "conv_id",
        F.expr(f"concat(coalesce(substring(head, 1, cast({KEY} * n as int)), x''), substring(keys, cast({KEY} * n + 1 as int)))").alias("keys"),
        F.expr("concat(coalesce(slice(head_sizes, 1, cast(n as int)), cast(array() as array<bigint>)), slice(sizes, cast(n + 1 as int), size(sizes)))").alias("sizes"),
    )


class Ranges:
    """Sparse tables over values: range minima, how many marks stand at the minimum, and minima of a second row of numbers."""

    def __init__(self, values: np.ndarray, marks: np.ndarray, ids: np.ndarray):
        self.n = len(values)
        self.least, self.marks, self.ids = [values], [marks], [ids]
        width = 1
        while 2 * width <= self.n:
            a, b = (self.least[-1][:-width], self.least[-1][width:])
            low = np.minimum(a, b)
            self.marks.append(np.where(a == low, self.marks[-1][:-width], 0) + np.where(b == low, self.marks[-1][width:], 0))
            self.ids.append(np.minimum(self.ids[-1][:-width], self.ids[-1][width:]))
            self.least.append(low)
            width *= 2

    def right(self, i: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first place at or after i whose value is below d (or n); marks at values equal to d and the least id on the way."""
        i = i.copy()
        count, least_id = np.zeros(len(i), np.int64), np.full(len(i), np.iinfo(np.int64).max)
        for k in reversed(range(len(self.least))):
            fits = np.flatnonzero(i + (1 << k) <= self.n)
            fits = fits[self.least[k][i[fits]] >= d[fits]]
            at = i[fits]
            count[fits] += np.where(self.least[k][at] == d[fits], self.marks[k][at], 0)
            least_id[fits] = np.minimum(least_id[fits], self.ids[k][at])
            i[fits] += 1 << k
        return i, count, least_id

    def left(self, i: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least j such that all values from j to before i are d or more, and the least id there."""
        i = i.copy()
        least_id = np.full(len(i), np.iinfo(np.int64).max)
        for k in reversed(range(len(self.least))):
            at = i - (1 << k)
            fits = np.flatnonzero(at >= 0)
            fits = fits[self.least[k][at[fits]] >= d[fits]]
            least_id[fits] = np.minimum(least_id[fits], self.ids[k][at[fits]])
            i[fits] = at[fits]
        return i, least_id


def common_prefixes(keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each sequence with the one before it; 0 for the first."""
    out = np.zeros(len(sizes), np.int64)
    at, k = np.arange(1, len(sizes)), 0
    while len(at):
        at = at[(sizes[at] > k) & (sizes[at - 1] > k)]
        at = at[(keys[starts[at] + k] == keys[starts[at - 1] + k]).all(axis=1)]
        k += 1
        out[at] = k
    return out


class Block:
    """The sequences of a block and their tables. before, after: common prefix with the blocks on both sides, -1 for none."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, keys: bytes, texts: np.ndarray, before: int, after: int):
        self.ids, self.sizes, self.before, self.after = ids, sizes, before, after
        self.n = n = len(ids)
        starts = np.cumsum(sizes) - sizes
        self.shared = common_prefixes(np.frombuffer(keys, np.uint64).reshape(-1, KEY // 8), starts, sizes)
        self.shared[0] = before
        follow = np.append(self.shared[1:], after)
        self.bytes = np.append(0, np.cumsum(texts))
        self.starts = starts
        self.marks = (sizes > self.shared).astype(np.int64)
        self.ranges = Ranges(self.shared, self.marks, ids)
        #: Bytes that a sequence shares with the one before it, and leaves that end at it: running sums.
        self.saved = np.append(0, np.cumsum(self.upto(np.arange(n), np.maximum(self.shared, 0))))
        self.leaves = np.append(0, np.cumsum(follow < sizes))

    def upto(self, p: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Bytes of the first d texts of sequence p."""
        return self.bytes[self.starts[p] + d] - self.bytes[self.starts[p]]

    def from_left_edge(self, d: np.ndarray) -> tuple[np.ndarray, ...]:
        """What belongs to the prefix of depth d that comes in from the left: places, marks, saved bytes, leaves, least id."""
        stop, count, least = self.ranges.right(np.ones(len(d), np.int64), d)
        count = count + np.where(d == self.before, self.marks[0], 0)
        return stop, count, self.saved[stop], self.leaves[stop], np.minimum(least, self.ids[0])

    def from_right_edge(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place of the prefix of depth d that comes in from the right, and the least id."""
        j, least = self.ranges.left(np.full(len(d), self.n), d)
        first = np.maximum(j - 1, 0)
        return first, np.minimum(least, self.ids[first])


def _packed(seqs: DataFrame, rows: int, size: int) -> DataFrame:
    """Blocks of the sorted sequences, a row each: (part, seq, ahead, ids, sizes, keys, texts, first, last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, ahead = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        taken = 0

        def flush() -> pa.RecordBatch:
            ids = [r[0] for r in held]
            keys = [r[1] for r in held]
            texts = [x for r in held for x in r[2]]
            values = [part, seq, ahead, ids, [len(k) // KEY for k in keys], b"".join(keys), texts, keys[0], keys[-1]]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) >= rows or taken + len(row[1]) > size):
                    yield flush()
                    seq, ahead, taken = seq + 1, ahead + len(held), 0
                    held.clear()
                held.append(row)
                taken += len(row[1])
        if held:
            yield flush()

    names = ["part", "seq", "ahead", "ids", "sizes", "keys", "texts", "first", "last"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    schema = "part int, seq int, ahead bigint, ids array<bigint>, sizes array<bigint>, keys binary, texts array<bigint>, first binary, last binary"
    ordered = seqs.select("conv_id", "keys", "sizes").repartitionByRange("keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    return ordered.mapInArrow(run, schema)


def _edges(blocks: DataFrame) -> np.ndarray:
    """(common prefix, whether the same sequence goes on) at the left edge of every block but the first, by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, same = [], []
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n = min(len(a), len(b)) // KEY
                x, y = (np.frombuffer(s, np.uint64, n * KEY // 8).reshape(-1, KEY // 8) for s in (a, b))
                differ = np.flatnonzero((x != y).any(axis=1))
                shared.append(int(differ[0]) if len(differ) else n)
                same.append(a == b)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared, pa.int64()), pa.array(same, pa.bool_())], names=["block", "shared", "same"])

    right = blocks.select("block", "first")
    left = blocks.select((F.col("block") + 1).alias("block"), "last")
    rows = right.join(left, "block").select("block", "last", "first").mapInArrow(run, "block bigint, shared bigint, same boolean")
    return np.array([tuple(r) for r in rows.collect()], np.int64).reshape(-1, 3)


def _block_of(row: dict, edge: np.ndarray) -> Block:
    b = row["block"]
    return Block(np.array(row["ids"], np.int64), np.array(row["sizes"], np.int64), row["keys"], np.array(row["texts"], np.int64), int(edge[b]), int(edge[b + 1]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: a block's numbers as plain lists are larger than the block."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


PROFILE = ["kind", "block", "d", "place", "least", "count", "saved", "leaves"]
SUMMARY, FROM_LEFT, FROM_RIGHT = 0, 1, 2


def _profiles(blocks: DataFrame, edge) -> DataFrame:
    """A summary row per block, and per edge and depth what a search that comes in over that edge finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b, block = row["block"], _block_of(row, edge.value)
            low = block.shared.min()
            marks = block.marks[block.shared == low].sum()
            parts = [np.array([[SUMMARY, b, low, block.n, block.ids.min(), marks, block.saved[-1], block.leaves[-1]]])]
            if len(d := np.arange(block.before + 1)):
                stop, count, saved, leaves, least = block.from_left_edge(d)
                parts.append(np.stack([np.full(len(d), FROM_LEFT), np.full(len(d), b), d, stop, least, count, saved, leaves], axis=1))
            if len(d := np.arange(block.after + 1)):
                first, least = block.from_right_edge(d)
                none = np.zeros(len(d), np.int64)
                parts.append(np.stack([np.full(len(d), FROM_RIGHT), np.full(len(d), b), d, first, least, none, none, none], axis=1))
            out = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, i], pa.int64()) for i in range(len(PROFILE))], names=PROFILE)

    return blocks.select("block", "ids", "sizes", "keys", "texts").mapInArrow(run, ", ".join(f"{c} bigint" for c in PROFILE))


CONT = ["block", "kind", "d", "target", "place", "least", "count", "saved", "leaves"]


def _searches(profiles: DataFrame, edge, table) -> DataFrame:
    """Per block, side and depth: how far a search that leaves the block there goes over whole blocks, and the block where it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, n, least, marks, saved, leaves = table.value.T
        ranges = Ranges(low, marks, least)
        rows, sums, ends = (np.append(0, np.cumsum(x)) for x in (n, saved, leaves))
        top = np.iinfo(np.int64).max
        for batch in batches:
            for b in batch.column(0).to_pylist():
                parts = []
                if len(d := np.arange(edge.value[b + 1] + 1)):
                    q, count, low_id = ranges.right(np.full(len(d), b + 1), d)
                    # -1: the search ends at the edge before block q.
                    target = np.where(edge.value[q] >= d, q, -1)
                    parts.append(np.stack([np.full(len(d), b), np.full(len(d), FROM_LEFT), d, target, rows[q], low_id, count, sums[q] - sums[b + 1], ends[q] - ends[b + 1]], axis=1))
                if len(d := np.arange(edge.value[b] + 1)):
                    q, low_id = ranges.left(np.full(len(d), b), d)
                    none = np.zeros(len(d), np.int64)
                    parts.append(np.stack([np.full(len(d), b), np.full(len(d), FROM_RIGHT), d, q - 1, rows[q - 1], np.minimum(low_id, top), none, none, none], axis=1))
                if parts:
                    out = np.concatenate(parts)
                    yield pa.RecordBatch.from_arrays([pa.array(out[:, i], pa.int64()) for i in range(len(CONT))], names=CONT)

    asked = profiles.where(F.col("kind") == SUMMARY).select("block").mapInArrow(run, ", ".join(f"{c} bigint" for c in CONT))
    found = profiles.where(F.col("kind") != SUMMARY).select("kind", F.col("block").alias("target"), "d", *(F.col(c).alias(f"f_{c}") for c in PROFILE[3:]))
    rows = asked.join(found, ["kind", "target", "d"], "left")
    zero = F.lit(0).cast("long")
    both = [(F.col(c) + F.coalesce(f"f_{c}", zero)).alias(c) for c in ("place", "count", "saved", "leaves")]
    rows = rows.select("block", "kind", "d", F.least("least", "f_least").alias("least"), *both)
    return rows.groupBy("block").agg(F.collect_list(F.struct("kind", "d", "place", "least", "count", "saved", "leaves")).alias("beyond"))


def _beyond(rows: list[dict] | None, kind: int, n: int) -> dict[str, np.ndarray]:
    """By depth 0 to n: what lies beyond one edge."""
    names = ("place", "least", "count", "saved", "leaves")
    out = {c: np.zeros(n + 1, np.int64) for c in names}
    for r in rows or ():
        if r["kind"] == kind:
            for c in names:
                out[c][r["d"]] = r[c]
    return out


def _nodes(blocks: DataFrame, edge, same, starts) -> DataFrame:
    """Nodes of every block (kind 0), without a digest where equal conversations go on beyond the block, and the texts for those digests (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b, block = row["block"], _block_of(row, edge.value)
            base, n = int(starts.value[b]), block.n
            right = _beyond(row["beyond"], FROM_LEFT, max(block.after, 0))
            left = _beyond(row["beyond"], FROM_RIGHT, max(block.before, 0))

            def extent(p: np.ndarray, d: np.ndarray):
                """Members' interval as places in all sequences, their least id, and what lies to the right of p."""
                j, low = block.ranges.left(p + 1, d)
                stop, count, low_right = block.ranges.right(p + 1, d)
                first = np.maximum(j - 1, 0)
                low = np.minimum(np.minimum(low, low_right), np.minimum(block.ids[p], block.ids[first]))
                begin, end = base + first, base + stop
                saved, leaves = block.saved[stop] - block.saved[p + 1], block.leaves[stop] - block.leaves[p]
                open_left, open_right = (j == 0) & (d <= block.before), (stop == n) & (d <= block.after)
                x = d[open_left]
                begin[open_left] = left["place"][x]
                low[open_left] = np.minimum(low[open_left], left["least"][x])
                x = d[open_right]
                end[open_right] = right["place"][x]
                low[open_right] = np.minimum(low[open_right], right["least"][x])
                count[open_right] += right["count"][x]
                saved[open_right] += right["saved"][x]
                leaves[open_right] += right["leaves"][x]
                return begin, end, low, count, saved, leaves

            # A node is told by its first member: prefixes longer than what that shares with the sequence before it.
            new = block.sizes - block.shared
            p = np.repeat(np.arange(n), new)
            d = np.arange(len(p)) - np.repeat(np.cumsum(new) - new, new) + np.repeat(block.shared + 1, new)
            begin, end, low, count, saved, leaves = extent(p, d)
            members = end - begin
            saved = saved - (members - 1) * block.upto(p, np.maximum(d - 1, 0))
            children = count + (block.sizes[p] > d)
            # The parent: the same place's prefix before, or the one shared with the sequence before it.
            first = np.flatnonzero((d == block.shared[p] + 1) & (d > 0))
            parent = np.append(0, low[:-1]) if len(low) else low
            parent[first] = extent(p[first], d[first] - 1)[2]

            # Equal sequences stand together; a run that goes on beyond the block leaves its text.
            fresh = np.flatnonzero((block.shared < block.sizes) | (np.append(0, block.sizes[:-1]) != block.sizes) | (np.arange(n) == 0))
            bounds = np.append(fresh, n)
            digest, blobs = {}, []
            for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                text = ",".join(map(str, block.ids[a:z].tolist()))
                from_before, goes_on = a == 0 and bool(same.value[b]), z == n and bool(same.value[b + 1])
                if from_before or goes_on:
                    start = int(left["place"][block.sizes[a]]) if from_before else base + a
                    blobs.append((start, b, text))
                    digest[a] = None
                else:
                    digest[a] = hashlib.sha256(text.encode()).hexdigest()
            empty = hashlib.sha256(b"").hexdigest()
            ends = [digest[a] if is_end else empty for a, is_end in zip(p.tolist(), (block.sizes[p] == d).tolist(), strict=True)]
            for a in range(0, len(p), 100_000):
                z = min(len(p), a + 100_000)
                numbers = [begin, d, low, parent, members, children, leaves, saved]
                columns = [pa.array(x[a:z], pa.int64()) for x in numbers]
                columns[3] = pa.array(parent[a:z], pa.int64(), mask=d[a:z] == 0)
                void = pa.nulls(z - a, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(z - a, np.int64)), void, *columns, pa.array(ends[a:z], pa.string())], names=names)
            for start, b, text in blobs:
                columns = [pa.nulls(1, pa.int64()) for _ in names[3:-1]]
                yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([b], pa.int64()), pa.array([start], pa.int64()), *columns, pa.array([text], pa.string())], names=names)

    names = ["kind", "block", "start", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    schema = ", ".join(f"{c} bigint" for c in names[:-1]) + ", ends_sha256 string"
    return blocks.select("block", "ids", "sizes", "keys", "texts", "beyond").mapInArrow(run, schema)


def _streamed(texts: DataFrame) -> DataFrame:
    """(start, digest) over the comma-joined texts of each start, in the order of their blocks, one text at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(start, state):
            return pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([state.hexdigest()])], names=["start", "digest"])

        current = state = None
        for batch in batches:
            for start, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or start != current:
                    if state is not None:
                        yield out(current, state)
                    current, state = start, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if state is not None:
            yield out(current, state)

    ordered = texts.repartition("start").sortWithinPartitions("start", "block")
    return ordered.select("start", F.col("ends_sha256").alias("text")).mapInArrow(run, "start bigint, digest string")


def trie(seqs: DataFrame, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """A row per node of the trie of (conv_id, keys, sizes) sequences; see the module's text.

    rows, size: sequences and bytes of keys a block holds at least before it is closed.
    """
    spark = seqs.sparkSession
    seqs = materialize(seqs, "sequences")
    n, total = seqs.agg(F.count("*"), F.coalesce(F.sum(F.length("keys")), F.lit(0))).first()
    packed = materialize(_packed(seqs, max(rows, n // BLOCKS), max(size, total // BLOCKS)), "trie-blocks")
    # One row per partition.
    parts = sorted(tuple(r) for r in packed.groupBy("part").agg(F.count("*"), F.sum(F.size("ids"))).collect())
    first_block = np.append(0, np.cumsum([p[1] for p in parts]))
    first_row = np.append(0, np.cumsum([p[2] for p in parts]))
    offsets = spark.createDataFrame(pd.DataFrame({"part": [p[0] for p in parts], "b": first_block[:-1], "r": first_row[:-1]}), "part int, b bigint, r bigint")
    numbered = packed.join(F.broadcast(offsets), "part").withColumns({"block": F.col("b") + F.col("seq"), "start": F.col("r") + F.col("ahead")})
    n_blocks = int(first_block[-1])
    edge, same = np.full(n_blocks + 1, -1, np.int64), np.zeros(n_blocks + 1, bool)
    found = _edges(numbered)
    edge[found[:, 0]], same[found[:, 0]] = found[:, 1], found[:, 2] > 0
    edges = spark.sparkContext.broadcast(edge)
    profiles = materialize(_profiles(numbered, edges), "trie-profiles")
    # Some numbers per block.
    summary = profiles.where(F.col("kind") == SUMMARY).select("block", "d", "place", "least", "count", "saved", "leaves")
    table = np.array(sorted(tuple(r) for r in summary.collect()), np.int64).reshape(-1, 7)[:, 1:]
    starts = np.append(0, np.cumsum(table[:, 1]))
    beyond = _searches(profiles, edges, spark.sparkContext.broadcast(table))
    joined = numbered.join(beyond, "block", "left")
    found = materialize(_nodes(joined, edges, spark.sparkContext.broadcast(same), spark.sparkContext.broadcast(starts)), "trie-nodes")
    nodes = found.where(F.col("kind") == 0)
    digests = _streamed(found.where(F.col("kind") == 1).select("start", "block", "ends_sha256"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    whole = nodes.where(F.col("ends_sha256").isNotNull()).select(*columns, "ends_sha256")
    rest = nodes.where(F.col("ends_sha256").isNull()).join(digests, "start", "left").select(*columns, F.col("digest").alias("ends_sha256"))
    return whole.unionByName(rest)
