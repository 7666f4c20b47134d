"""The prefix trie against plain Python, with blocks so small that most searches leave their block."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import prefixtrie, queries
from tests.llm import brute

NAMES = "conv_id bigint, turn bigint, role string, text string, keys string, block int, start int, part int"


def rows_of(seed, n, most):
    """Conversations over few texts, so that many share beginnings and many are equal."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for k in range(rng.choice([1, 2, 3, most])):
            rows.append((c, k, rng.choice(["user", "bot"]) if k > 1 else "user", "é" * rng.choice([0, 0, 1, 2])))
    rows += [(10_000 + i, k, "user", "copy") for i in range(40) for k in range(5)]
    return rows


ODD = [
    (7, None, None, None), (7, None, "a", None), (7, 0, "b", "x"), (None, 0, "a", "y"), (8, 3, "a", ""), (8, 3, "a", ""), (8, 3, None, "long " * 5000),
    *((20_000 + i, 0, "a", "no donor") for i in range(1, 5)),
    (12, 0, "1:a", "b"), (13, 0, "1", ":ab"), (19, 0, "only", "turn"), (29, 0, "only", "turn"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], NAMES)


def collected(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


@pytest.mark.parametrize("rows_in_block, size, parts", [(1, 1 << 20, 3), (3, 1 << 20, 2), (4096, 64, 5), (4096, 1 << 20, 1)])
def test_trie(spark, rows_in_block, size, parts):
    rows = rows_of(parts, 60, 6) + ODD
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    seqs = prefixtrie.sequences(frame(spark, rows).repartition(parts))
    assert collected(prefixtrie.trie(seqs, rows_in_block, size)) == brute.trie(convs)


def test_query(spark, tmp_path):
    rows = rows_of(9, 80, 12) + ODD
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    convs = brute.rebuilt(rows)
    assert any(not turns for turns in convs.values())
    assert collected(queries.op13_prefix_trie(spark, str(tmp_path))) == brute.trie(convs)


def test_empty_and_turnless(spark):
    none = frame(spark, ODD).where("false")
    assert prefixtrie.trie(prefixtrie.sequences(none)).collect() == []
    bare = spark.createDataFrame([(3, b"", []), (1, b"", [])], "conv_id bigint, keys binary, sizes array<bigint>")
    assert collected(prefixtrie.trie(bare, rows=1)) == [(1, 0, None, 2, 0, 1, 0, brute.sha("1,3"))]


def test_ranges():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values, marks, ids = rng.integers(0, 4, n), rng.integers(0, 2, n), rng.integers(0, 99, n)
        ranges = prefixtrie.Ranges(values, marks, ids)
        for i in range(n + 1):
            for d in range(5):
                stop, count, least = (int(x[0]) for x in ranges.right(np.array([i]), np.array([d])))
                j = next((j for j in range(i, n) if values[j] < d), n)
                assert stop == j and count == sum(m for v, m in zip(values[i:j], marks[i:j], strict=True) if v == d)
                assert least == min(ids[i:j], default=np.iinfo(np.int64).max)
                begin, least = (int(x[0]) for x in ranges.left(np.array([i]), np.array([d])))
                j = next((j + 1 for j in reversed(range(i)) if values[j] < d), 0)
                assert begin == j and least == min(ids[j:i], default=np.iinfo(np.int64).max)
