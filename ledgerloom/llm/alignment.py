"""Alignment of two tokenizers' tokens by the bytes that they end at.

A text is encoded by a byte-level tokenizer (A, after a space) and by a piece tokenizer (B, which
puts the space itself). Both give an ascending list of byte offsets where tokens end. The lists
are intersected by galloping: each end of the shorter list is looked for in the longer one by
steps of doubling width from where its unit of text begins, then by halving the last step, for
all ends of a block at once. The common ends cut both sequences into groups; the ranks of two
neighbouring common ends in either list bound the tokens of a group, and the pair of tokens
that ends at a common end is a link.

Both tokenizers end a token wherever a blank follows a character that is no white space: the
first one's pattern does so, and of the second's pieces none holds the blank sign after another
sign (this is looked up in its vocabulary; a vocabulary that has such a piece is refused). So
texts are cut there into units, each distinct unit of a stretch of text is encoded and
intersected once, and a text's groups are those of its units one after another.

The corpus-wide count of a pair of tokens is a sum over all stretches. A stretch holds its
distinct pairs, and the counts come back to it by a join on the pair, so that nothing of the
corpus goes through one task, and no table is broadcast that grows with it. A stretch is written
as many small rows and put together again one at a time, so that a task's memory does not grow
with the number of stretches that it reads or writes.

Documents: null and empty texts, and those whose tokens' bytes differ from the text (a blank
sign in the text itself), have no tokens and zeros. Each input row gives one row, repeated rows
and null identifiers included; an empty table gives an empty result. Columns besides identifier
and text are not read. A text's tokens must fit into one value.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import gather
from ledgerloom.llm.common import give_back, materialize, text_blocks
from ledgerloom.llm.pretokens import SPACE, class_table, split
from ledgerloom.llm.tokenfile import tokenizer_of
from ledgerloom.llm.windows import windows

#: Characters of text of a stretch, whose units and pairs are kept together.
STRETCH = 4_000_000
#: Characters of units that are encoded as one text.
JOINED = 100_000
#: Units, links or pairs in a row of a written stretch: Parquet's writer holds at least 100 rows.
ROW = 25_000
ROW_GROUP = 16 << 20
BLANK = "▁"


@functools.cache
def _token_sizes(path: str) -> np.ndarray:
    """Bytes of each token: a byte-level vocabulary writes a byte as one sign."""
    tokenizer = tokenizer_of(path)
    return np.array([len(tokenizer.id_to_token(i) or "") for i in range(tokenizer.get_vocab_size())], np.int64)


def encode_joined(pieces: list[str], vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, bounds of each piece's ids) by the tokenizers library.

    A piece that begins with a space and ends with another character may follow any such piece:
    these are encoded as long texts, and the tokens' bytes tell where each piece's tokens end.
    """
    joinable = [i for i, p in enumerate(pieces) if p[0] == " " and not p[-1].isspace()]
    others = [i for i, p in enumerate(pieces) if p[0] != " " or p[-1].isspace()]
    texts, sizes, start = [], [], 0
    taken = 0
    for k, i in enumerate(joinable):
        taken += len(pieces[i])
        if taken >= JOINED or k == len(joinable) - 1:
            texts.append("".join([pieces[j] for j in joinable[start : k + 1]]))
            start, taken = k + 1, 0
    n_joined = len(texts)
    encoded = tokenizer_of(vocabulary).encode_batch_fast(texts + [pieces[i] for i in others], add_special_tokens=False)
    listed = [np.array(e.ids, np.int32) for e in encoded[:n_joined]]
    joined = np.concatenate([np.empty(0, np.int32), *listed])
    raw = np.cumsum(np.fromiter((len(pieces[i].encode()) for i in joinable), np.int64, len(joinable)))
    ends = np.cumsum(_token_sizes(vocabulary)[joined])
    last = np.searchsorted(ends, raw)
    if len(raw) and not (ends[last] == raw).all():
        raise ValueError("a token of the vocabulary goes beyond a piece")
    first = np.append(0, last[:-1] + 1)[: len(last)]
    rest = [e.ids for e in encoded[n_joined:]]
    ids = np.concatenate([joined, np.fromiter(itertools.chain.from_iterable(rest), np.int32)])
    starts, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    starts[joinable], sizes[joinable] = first, last + 1 - first
    lengths = np.fromiter(map(len, rest), np.int64, len(rest))
    starts[others], sizes[others] = len(joined) + np.cumsum(lengths) - lengths, lengths
    return gather(ids, starts, sizes), np.append(0, np.cumsum(sizes))


def gallop(values: np.ndarray, long: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Per value the first rank at or after `low` where the ascending list is not below it: steps of doubling width, then halving."""
    low, step = low.copy(), np.ones(len(low), np.int64)
    top = len(long) - 1
    going = np.flatnonzero(long[low] < values)
    low_open = np.zeros(len(low), bool)
    low_open[going] = True
    high = low.copy()
    while len(going):
        high[going] = np.minimum(low[going] + step[going], top + 1)
        below = (high[going] <= top) & (long[np.minimum(high[going], top)] < values[going])
        going = going[below]
        low[going] = high[going]
        step[going] *= 2
    # long[low] is below the value, long[high] is not.
    while len(wide := np.flatnonzero(low_open & (high - low > 1))):
        middle = (low[wide] + high[wide]) // 2
        below = long[middle] < values[wide]
        low[wide[below]] = middle[below]
        high[wide[~below]] = middle[~below]
    return high


def common_ends(a: np.ndarray, b: np.ndarray, bounds_a: np.ndarray, bounds_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in a and in b of the values that both ascending lists hold.

    The lists consist of units' lists, between the bounds; in each unit the shorter list is looked up in the longer one.
    """
    n_a, n_b = np.diff(bounds_a), np.diff(bounds_b)
    found = []
    for short, long, n, from_short, from_long, drives in ((a, b, n_a, bounds_a, bounds_b, n_a <= n_b), (b, a, n_b, bounds_b, bounds_a, n_a > n_b)):
        units = np.flatnonzero(drives)
        ranks = gather(np.arange(len(short)), from_short[units], n[units])
        at = gallop(short[ranks], long, np.repeat(from_long[units], n[units]))
        hit = (at < len(long)) & (long[np.minimum(at, len(long) - 1)] == short[ranks])
        found.append((ranks[hit], at[hit]))
    (x, y), (v, u) = found
    at_a, at_b = np.concatenate([x, u]), np.concatenate([y, v])
    order = np.argsort(at_a, kind="stable")
    return at_a[order], at_b[order]


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones for themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Strings:
    """Byte strings in one array."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.starts[numbers], self.sizes[numbers])


class Units:
    """What is known of units, by number: whether both tokenizers give its bytes, its tokens, links and groups as text."""

    def __init__(self, ok: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, n_links: np.ndarray, pairs: np.ndarray, groups: list[bytes]):
        self.ok, self.n_a, self.n_b, self.n_links, self.pairs, self.groups = ok, n_a, n_b, n_links, pairs, groups


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece

        self.path = byte_level
        a = tokenizer_of(byte_level)
        byte_of = byte_of_sign()
        n = a.get_vocab_size()
        entries = [a.id_to_token(i) or "" for i in range(n)]
        self.a = Strings([bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in entries])
        self.b_model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.width = self.b_model.get_piece_size()
        names = [self.b_model.id_to_piece(i) for i in range(self.width)]
        if wrong := [p for p in names if BLANK in p.lstrip(BLANK)]:
            raise ValueError(f"pieces with a blank after other signs: {wrong[:3]}")
        self.b = Strings([bytes([int(p[3:5], 16)]) if self.b_model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)])
        self.blank = self.b_model.piece_to_id(BLANK)
        # Each id with what stands behind it: 2 i and 2 i + 1, then the same for B.
        self.texts = Strings([b"%d%c" % (i, c) for ends, n in ((b",|", n), (b",;", self.width)) for i in range(n) for c in ends])
        self.b_texts = 2 * n

    def units(self, units: list[str]) -> Units:
        """units: texts with a leading space."""
        n = len(units)
        a, bounds_a = encode_joined(units, self.path)
        # The tokenizer puts the first space itself, but not before nothing.
        lists = [x or [self.blank] for x in self.b_model.encode([u[1:] for u in units], num_threads=1)]
        b = np.fromiter(itertools.chain.from_iterable(lists), np.int32)
        bounds_b = np.append(0, np.cumsum(np.fromiter(map(len, lists), np.int64, n)))
        raw = [u.encode("utf-8", "surrogatepass") for u in units]
        whole = np.frombuffer(b"".join(raw), np.uint8)
        ok = np.ones(n, bool)
        if not (np.array_equal(self.a.joined(a), whole) and np.array_equal(self.b.joined(b), whole)):
            for i, wanted in enumerate(raw):
                of_a, of_b = a[bounds_a[i] : bounds_a[i + 1]], b[bounds_b[i] : bounds_b[i + 1]]
                ok[i] = self.a.joined(of_a).tobytes() == wanted == self.b.joined(of_b).tobytes()
            good = np.flatnonzero(ok)
            sizes_a, sizes_b = np.diff(bounds_a)[good], np.diff(bounds_b)[good]
            a, b = gather(a, bounds_a[good], sizes_a), gather(b, bounds_b[good], sizes_b)
            bounds_a, bounds_b = np.append(0, np.cumsum(sizes_a)), np.append(0, np.cumsum(sizes_b))
        n_a, n_b, n_links = (np.zeros(n, np.int64) for _ in range(3))
        n_a[ok], n_b[ok] = np.diff(bounds_a), np.diff(bounds_b)
        groups = [b""] * n
        if not len(a):
            return Units(ok, n_a, n_b, n_links, np.empty(0, np.int64), groups)
        at_a, at_b = common_ends(np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b]), bounds_a, bounds_b)
        upto = np.searchsorted(at_a, bounds_a[1:] - 1) + 1
        n_links[ok] = np.diff(np.append(0, upto))
        pairs = a[at_a].astype(np.int64) * self.width + b[at_b]
        # Tokens in the order of the text: each group's of A, then those of B.
        group_a, group_b = np.searchsorted(at_a, np.arange(len(a))), np.searchsorted(at_b, np.arange(len(b)))
        before_b = np.append(0, at_b[:-1] + 1)
        text = np.empty(len(a) + len(b), np.int64)
        text[np.arange(len(a)) + before_b[group_a]] = 2 * a.astype(np.int64) + (at_a[group_a] == np.arange(len(a)))
        text[np.arange(len(b)) + at_a[group_b] + 1] = self.b_texts + 2 * b.astype(np.int64) + (at_b[group_b] == np.arange(len(b)))
        joined = self.texts.joined(text).tobytes()
        ends = np.cumsum(self.texts.sizes[text])[bounds_a[1:] + bounds_b[1:] - 1].tolist()
        start = 0
        for i, end in zip(np.flatnonzero(ok).tolist(), ends, strict=True):
            groups[i] = joined[start:end]
            start = end
        return Units(ok, n_a, n_b, n_links, pairs, groups)


@functools.cache
def load(byte_level: str, pieces: str) -> Tokenizers:
    return Tokenizers(byte_level, pieces)


def unit_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where units begin: texts' starts, and spaces after a character that is no white space."""
    start = first.copy()
    start[1:] |= (codes[1:] == 32) & (class_table()[codes[:-1]] != SPACE)
    return start


class Stretch:
    """Units of some texts, in the order they stand there, and what is known of the distinct ones."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.numbers: dict[str, int] = {}
        self.known: list[Units] = []
        self.groups: list[bytes] = []
        self.sizes = np.empty((4, 0), np.int64)
        self.rows: list[tuple] = []
        self.used: list[np.ndarray] = []
        self.chars = 0

    def place(self, units: list[str]) -> np.ndarray:
        """Numbers of the units, new ones among them."""
        numbers = self.numbers
        new = [u for u in units if u not in numbers]
        if new:
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new)), strict=True))
            found = self.tokenizers.units(new)
            self.known.append(found)
            self.groups += found.groups
            self.sizes = np.concatenate([self.sizes, [found.n_a, found.n_b, found.n_links, ~found.ok]], axis=1)
        return np.fromiter((numbers[u] for u in units), np.int32, len(units))

    def add_long(self, lead, text: str) -> None:
        """A long text is taken in windows that end where units do."""
        parts = [np.empty(0, np.int32)]
        for window in windows(" " + text) if text else ():
            number, distinct, _ = split([window], unit_starts)
            parts.append(self.place(distinct)[number])
        units = np.concatenate(parts)
        self.add_rows([lead], units, np.array([0, len(units)]), len(text))

    def add(self, leads: list, texts: list[str]) -> None:
        number, distinct, per_text = split([" " + t if t else "" for t in texts], unit_starts)
        units = self.place(distinct)[number] if len(distinct) else np.empty(0, np.int32)
        self.add_rows(leads, units, np.append(0, np.cumsum(per_text)), sum(map(len, texts)))

    def add_rows(self, leads: list, units: np.ndarray, bounds: np.ndarray, chars: int) -> None:
        self.chars += chars + len(leads)
        sums = np.stack([np.append(0, np.cumsum(row[units]))[bounds] for row in self.sizes]) if len(units) else np.zeros((4, len(bounds)), np.int64)
        n_a, n_b, n_links, wrong = np.diff(sums, axis=1).tolist()
        for i, lead in enumerate(leads):
            own = units[bounds[i] : bounds[i + 1]]
            if len(own) and not wrong[i]:
                self.rows.append((lead, n_a[i], n_b[i], n_links[i], self.digest(own)))
                self.used.append(own)
            else:
                self.rows.append((lead, 0, 0, 0, b""))
                self.used.append(own[:0])

    def digest(self, units: np.ndarray) -> bytes:
        """Over the groups of units, one after another; each unit's text ends with a separator, the last of which is left out."""
        digest = hashlib.sha256()
        groups = self.groups
        for i in range(0, len(units), 100_000):
            text = b"".join([groups[u] for u in units[i : i + 100_000].tolist()])
            digest.update(text if i + 100_000 < len(units) else text[:-1])
        return digest.digest()

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct linked pairs, their counts over the stretch, number of pair of each unit's links)."""
        which, pairs = pd.factorize(np.concatenate([np.empty(0, np.int64), *(k.pairs for k in self.known)]))
        times = np.bincount(np.concatenate([np.empty(0, np.int32), *self.used]), minlength=len(self.groups))
        counts = np.bincount(which, np.repeat(times, self.sizes[2]), minlength=len(pairs)).astype(np.int64)
        return pairs, counts, which.astype(np.int32)


def _rows_of(stretch: Stretch) -> Iterator[dict]:
    """A stretch as rows of some hundred KB: its documents (a long one is a row of its own), its dictionary, its pairs."""
    ends = np.cumsum([len(u) for u in stretch.used])
    start = 0
    for i in range(len(ends)):
        if i + 1 == len(ends) or ends[i + 1] - (ends[start - 1] if start else 0) > ROW:
            leads, n_a, n_b, n_links, digests = zip(*stretch.rows[start : i + 1], strict=True)
            used = stretch.used[start : i + 1]
            yield {
                "ids": leads, "n_a": n_a, "n_b": n_b, "n_links": n_links, "groups": digests,
                "ends": np.cumsum([len(u) for u in used]), "units": np.concatenate(used).tobytes(),
            }
            start = i + 1
    pairs, counts, which = stretch.pairs()
    for i in range(0, len(stretch.groups), ROW):
        yield {"links": stretch.sizes[2, i : i + ROW].astype(np.int32).tobytes()}
    for i in range(0, len(which), ROW):
        yield {"which": which[i : i + ROW].tobytes()}
    kept = np.flatnonzero(counts)
    for i in range(0, len(kept), ROW):
        numbers = kept[i : i + ROW]
        yield {"numbers": numbers, "pairs": pairs[numbers], "counts": counts[numbers]}


def _stretches(docs: DataFrame, byte_level: str, pieces: str, id_col: str, text_col: str, chars: int) -> DataFrame:
    """Each stretch as numbered rows: its documents with their units, what its units link, its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = load(byte_level, pieces)
        stretch = Stretch(tokenizers)
        numbers = itertools.count(TaskContext.get().partitionId() << 32)

        def out(stretch: Stretch) -> Iterator[pa.RecordBatch]:
            number = next(numbers)
            for part, row in enumerate(_rows_of(stretch)):
                values = {"stretch": number, "part": part} | row
                yield pa.RecordBatch.from_arrays([pa.array([values.get(n)], t) for n, t in types.items()], names=list(types))

        for batch, texts in text_blocks(batches):
            leads = batch.column(0).to_pylist()
            if len(texts) == 1:
                stretch.add_long(leads[0], texts[0])
            else:
                stretch.add(leads, texts)
            if stretch.chars >= chars:
                yield from out(stretch)
                stretch = Stretch(tokenizers)
        if stretch.rows:
            yield from out(stretch)
        stretch = None
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    long, longs, binary = pa.int64(), pa.list_(pa.int64()), pa.binary()
    types = {
        "stretch": long, "part": long, "ids": pa.list_({"bigint": long, "int": pa.int32(), "string": pa.string()}[id_type]),
        "n_a": longs, "n_b": longs, "n_links": longs, "groups": pa.list_(binary), "ends": longs, "units": binary,
        "links": binary, "which": binary, "numbers": longs, "pairs": longs, "counts": longs,
    }
    many = "array<bigint>"
    schema = (
        f"stretch bigint, part bigint, ids array<{id_type}>, n_a {many}, n_b {many}, n_links {many}, groups array<binary>, ends {many}, "
        f"units binary, links binary, which binary, numbers {many}, pairs {many}, counts {many}"
    )
    return rows.mapInArrow(run, schema)


def pair_counts(stretches: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): corpus-wide links of each pair, and whether no pair with the same second token has more."""
    each = stretches.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("x.*")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count"))
    # A token of B has at most as many pairs as A has tokens.
    most = F.max("count").over(Window.partitionBy(F.col("pair") % width))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def align(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", chars: int = STRETCH) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    byte_level, pieces: paths of the two vocabularies on every executor.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    # Small row groups, since a task reads one at once.
    stretches = materialize(_stretches(docs, byte_level, pieces, id_col, text_col, chars), "alignment", {"parquet.block.size": ROW_GROUP})
    counts = materialize(pair_counts(stretches, load(byte_level, pieces).width), "pair-counts")
    wanted = stretches.select(F.col("stretch").alias("owner"), F.explode(F.arrays_zip("numbers", "pairs")).alias("x")).select("owner", "x.numbers", F.col("x.pairs").alias("pair"))
    # Counts in files are far smaller than as a table to look up.
    known = wanted.join(counts.hint("merge"), "pair").select("owner", "numbers", "count", "best")
    names = ["ids", "n_a", "n_b", "n_links", "groups", "ends", "units", "links", "which"]
    rows = stretches.where("numbers is null").select("stretch", "part", *names)

    def run(own: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(own.column("part").to_numpy()).tolist()
        column = {n: own.column(n).combine_chunks() for n in names}

        def whole(name: str) -> np.ndarray:
            values = [column[name][i] for i in order]
            return np.concatenate([np.empty(0, np.int32), *(np.frombuffer(v.as_buffer(), np.int32) for v in values if v.is_valid)])

        which, bounds = whole("which"), np.append(0, np.cumsum(whole("links"), dtype=np.int64))
        at = known.column("numbers").to_numpy()
        per_unit = []
        for name in ("best", "count"):
            per_pair = np.zeros(which.max(initial=-1) + 1, np.int64)
            per_pair[at] = known.column(name).to_numpy()
            upto = np.append(0, np.cumsum(per_pair[which]))
            per_unit.append(upto[bounds[1:]] - upto[bounds[:-1]])
        parts = []
        for i in order:
            value = {n: column[n][i] for n in names[:7]}
            if not value["ids"].is_valid:
                continue
            units = np.frombuffer(value["units"].as_buffer(), np.int32)
            ends = np.append(0, value["ends"].values.to_numpy())
            sums = [pa.array(np.diff(np.append(0, np.cumsum(x[units]))[ends])) for x in per_unit]
            lists = [value[n].values for n in ("ids", "n_a", "n_b", "n_links", "n_links")]
            parts.append(pa.RecordBatch.from_arrays([*lists, *sums, pa.array([d.hex() for d in value["groups"].as_py()], pa.string())], names=out))
        return pa.Table.from_batches(parts)

    out = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = f"id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    # One stretch at a time: its rows and the counts of its pairs.
    return rows.groupBy("stretch").cogroup(known.groupBy("owner")).applyInArrow(run, schema).withColumnRenamed("id", id_col)
