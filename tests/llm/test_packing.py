"""Packing: the exact cut of documents, valid sequences, and the number of sequences against exhaustive search."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import packing, queries

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "no number"), (None, None), (4, "<|endoftext|> é"), (5, "word " * 5000), (6, "x " * 1023), (7, "x " * 1022)]
TEXTS += [(100 + i, "the cat sat, " * (i * 7 % 90)) for i in range(60)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "n") for r in rows], "doc_id bigint, text string, piece int, number int, part string")


def counted(sizes, capacity):
    return np.bincount(sizes, minlength=capacity + 1).astype(np.int64)


def optimum(sizes, capacity):
    """Fewest sequences, by trying all."""
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                go(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1 :])
        go(i + 1, rooms + [capacity - sizes[i]])

    go(0, [])
    return best


def used(steps, counts, capacity):
    total = np.zeros_like(counts)
    for times, filling in steps:
        assert times > 0 and sum(filling) <= capacity
        for s in filling:
            total[s] += times
    assert (total == counts).all()
    return sum(n for n, _ in steps)


def test_against_exhaustive_search():
    """Among the cases are some where best-fit decreasing needs more sequences."""
    rng = random.Random(1)
    better = 0
    for _ in range(150):
        capacity = rng.choice([10, 40, 100])
        least, most = rng.choice([(1, capacity + 1), (capacity // 5, capacity // 2)])
        sizes = sorted((rng.randrange(least, most) for _ in range(rng.randrange(4, 12))), reverse=True)
        counts = counted(sizes, capacity)
        fewest = optimum(sizes, capacity)
        assert packing.lower_bound(counts, capacity) <= fewest
        better += used(packing.best_fit(counts, capacity), counts, capacity) > fewest
        assert used(packing.solve(counts, capacity), counts, capacity) == fewest
    assert better


@pytest.mark.parametrize("kind", ["uniform", "large", "few", "small"])
def test_many_pieces(kind):
    rng = np.random.default_rng(2)
    sizes = {
        "uniform": rng.integers(1, 1025, 20_000), "large": rng.integers(200, 700, 20_000),
        "few": rng.choice([300, 341, 500, 513, 700, 1024], 1_000_000), "small": rng.integers(1, 60, 50_000),
    }[kind]
    counts = counted(sizes, 1024)
    n = used(packing.solve(counts, 1024, nodes=2000), counts, 1024)
    best_fit = used(packing.best_fit(counts, 1024), counts, 1024)
    assert packing.lower_bound(counts, 1024) <= n <= best_fit


def test_undominated():
    assert packing.fits_into((3, 2), [5]) and not packing.fits_into((3, 3), [5, 2])
    assert packing.undominated([(4, 3), (7,), (5, 1)], 9) == [(7,)]
    counts = counted([5, 4, 3, 3, 2], 10)
    everything = set()
    for n in range(1, 6):
        for some in itertools.combinations([5, 4, 3, 3, 2], n):
            rest = [5, 4, 3, 3, 2]
            for s in some:
                rest.remove(s)
            if sum(some) <= 9 and all(sum(some) + r > 9 for r in rest):
                everything.add(some)
    assert set(packing.enumerate_fillings([5, 4, 3, 2], counts, 9, 99)) == everything


def expected_pieces(rows):
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    out = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        start, stop, piece = 0, (len(ids) - 1) % 1024 + 1, 0
        while start < len(ids):
            out.append((doc, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())))
            start, stop, piece = stop, stop + 1024, piece + 1
    return sorted(out, key=repr)


def check(rows, result):
    found = [tuple(r) for r in result.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    assert sorted((r[:5] for r in found), key=repr) == expected_pieces(rows)
    sequences = {}
    for r in found:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    counts = counted([r[3] for r in found], 1024)
    full, counts[1024] = counts[1024], 0
    assert len(sequences) <= full + packing.lower_bound(counts, 1024) + 1


def test_packed_documents(spark, tmp_path):
    check(TEXTS, packing.pack(frame(spark, TEXTS).repartition(4), VOCABULARY))
    frame(spark, TEXTS).write.parquet(f"{tmp_path}/documents.parquet")
    check(TEXTS, queries.op12_sequence_packing(spark, str(tmp_path)))
    assert packing.pack(frame(spark, TEXTS).where("false"), VOCABULARY).collect() == []


def test_plan():
    plan = packing.Plan([(2, (5, 3)), (3, (3, 3, 2)), (1, (5,))])
    sequence, offset = plan.place(3, np.arange(8))
    assert sequence.tolist() == [0, 1, 2, 2, 3, 3, 4, 4] and offset.tolist() == [5, 5, 0, 3, 0, 3, 0, 3]
    assert plan.place(5, np.arange(3))[0].tolist() == [0, 1, 5] and plan.n_sequences == 6
