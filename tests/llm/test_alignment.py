"""Token alignment against both libraries on whole texts."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import alignment, queries, windows
from tests.llm import brute

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SIGNS = ["a", "the", "Étion", " ", "  ", "\n", "\n ", "\t", "　", "中文", "x1", "'s", "''ll", ",", "...", "🙂", " ", "é", "\x00", "<|endoftext|>", "</s>", "<0x41>", "   b", "-", "12345"]
TEXTS = [
    (1, "The cat sat on the mat."), (1, "The cat sat on the mat."), (2, None), (3, ""), (None, "no number here"), (None, None), (4, " "), (5, "\n \n"),
    (6, "a blank sign ▁ in the text"), (7, " leading and trailing "), (8, "x" * 5000), (9, "word filler, " * 20_000), (10, "<|endoftext|> <s> ﬁ"),
]


def mixed(seed, n):
    rng = random.Random(seed)
    return [(100 + i, "".join(rng.choice(SIGNS) for _ in range(rng.randrange(40)))) for i in range(n)]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def ends(tokens):
    out, at = [], 0
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def expected(rows, tokenizers):
    """Per row: the contract's columns, from the libraries' tokens of the whole text."""
    a_lib, b_lib = tokenizers
    byte_of = {v: k for k, v in alignment.byte_of_sign().items()}
    sign = {v: k for k, v in byte_of.items()}
    per_row, links = [], Counter()
    for doc, text in rows:
        raw = (" " + (text or "")).encode()
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        bytes_a = [bytes(sign[c] for c in a_lib.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            per_row.append((doc, None, None, [], []))
            continue
        at_a = {e: i for i, e in enumerate(ends(bytes_a))}
        at_b = {e: i for i, e in enumerate(ends(bytes_b))}
        groups, pairs, i, j = [], [], 0, 0
        for end in sorted(set(at_a) & set(at_b)):
            x, y = at_a[end], at_b[end]
            groups.append((list(map(str, a[i : x + 1])), list(map(str, b[j : y + 1]))))
            pairs.append((a[x], b[y]))
            i, j = x + 1, y + 1
        links.update(pairs)
        per_row.append((doc, len(a), len(b), groups, pairs))
    best = {}
    for (_, y), n in links.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for doc, n_a, n_b, groups, pairs in per_row:
        text = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)
        out.append((
            doc, n_a or 0, n_b or 0, len(groups), len(pairs), sum(links[p] == best[p[1]] for p in pairs), sum(links[p] for p in pairs),
            brute.sha(text) if n_a else "",
        ))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def collected(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id bigint, text string, stretch int, pairs string, count int")


@pytest.mark.parametrize("chars", [50, 2000, 10_000_000])
def test_alignment(spark, tokenizers, chars):
    rows = TEXTS + mixed(chars, 150)
    assert collected(alignment.align(frame(spark, rows).repartition(3), A, B, chars=chars)) == expected(rows, tokenizers)


def test_query_and_empty(spark, tokenizers, tmp_path):
    rows = TEXTS + mixed(1, 30)
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert collected(queries.op11_token_alignment(spark, str(tmp_path))) == expected(rows, tokenizers)
    assert collected(alignment.align(frame(spark, rows).where("false"), A, B)) == []
    texts = alignment.align(frame(spark, rows).withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), A, B)
    assert texts.schema["doc_id"].dataType.simpleString() == "string" and texts.count() == len(rows)


def test_small_rows(spark, tokenizers):
    """A stretch is written as small rows, whatever it holds; a long document and a large dictionary too."""
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{rng.randrange(40_000)}" for _ in range(100))) for i in range(600)]
    rows.append((600, " ".join(f"w{i}" for i in range(30_000))))
    docs = frame(spark, rows).coalesce(1)
    sizes = [F.max(F.length(c)).alias(c) for c in ("units", "which")] + [F.max(F.size("pairs")).alias("pairs"), F.countDistinct("stretch").alias("n")]
    most = alignment._stretches(docs, A, B, "doc_id", "text", 10_000_000).agg(*sizes).first()
    assert most["n"] == 1 and most["units"] == 4 * 30_000 and most["which"] <= 100_000 and most["pairs"] <= 25_000
    assert collected(alignment.align(docs, A, B)) == expected(rows, tokenizers)


def test_windows(tokenizers):
    """Units of windows are units of the whole text, and long texts are encoded as the libraries do."""
    a_lib, b_lib = tokenizers
    for _, text in mixed(5, 300):
        text = " " + text
        parts = list(windows.windows(text, 7))
        assert "".join(parts) == text
        if "▁" not in text:
            assert [i for p in parts for i in a_lib.encode(p, add_special_tokens=False).ids] == a_lib.encode(text, add_special_tokens=False).ids
            assert [i for p in parts for i in b_lib.encode(p[1:]) or [b_lib.piece_to_id("▁")]] == (b_lib.encode(text[1:]) or [b_lib.piece_to_id("▁")])


def test_common_ends():
    rng = random.Random(4)
    for _ in range(300):
        lists, bounds, base = ([], []), ([0], [0]), 0
        for _ in range(rng.randrange(1, 5)):
            for side, most in ((0, 12), (1, 50)):
                lists[side].extend(base + x for x in sorted(rng.sample(range(60), rng.randrange(1, rng.choice([4, most])))))
                bounds[side].append(len(lists[side]))
            base += 60
        a, b = (np.array(x) for x in lists)
        x, y = alignment.common_ends(a, b, *(np.array(x) for x in bounds))
        assert a[x].tolist() == b[y].tolist() == sorted(set(lists[0]) & set(lists[1]))
