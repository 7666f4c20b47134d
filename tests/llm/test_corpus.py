"""Operators on small tables with nulls, empty, odd and long texts, repeated rows and clashing columns."""

import gzip
import io
import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, licenses, pii, pretokens, quality, queries, reputation, simhash, tokenfile, toxicity, warc, winnow
from tests.llm import brute

PASSAGE = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
LONG = " ".join(f"word{i % 977} filler{i % 31}" for i in range(12_000))
ITEMS = [(1, PASSAGE), (2, "short item here"), (3, None), (None, "one two three"), (4, ""), (1, PASSAGE), (5, "!!! ..."), (6, "Q " * 20)]
TEXTS = [
    (1, "Licensed under the GNU General Public License, version 3. " + PASSAGE),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "the cat sat on the mat\nthe cat sat on the mat\n\nÉtude ÉTUDE K İ cc-by CC BY-NC 4.0 MIT License"),
    (5, "the cat sat on the mat\nthe cat sat on the mat\n\nÉtude ÉTUDE K İ cc-by CC BY-NC 4.0 MIT License"),
    (6, "a b"),
    (None, "a short item here, and " + PASSAGE.upper()),
    (None, None),
    (7, LONG + " " + PASSAGE + " 4111 1111 1111 1111 x@y.zz"),
    (8, "mail a.b@c.de, c@d@e.fr or jürgen@exämple.de; 1.2.3.4.5.6.7.8 999.1.1.1 +1 (555) 123-4567 4111-1111-1111-1111"),
    (9, "x" * 30_000),
    (10, "q " * 300 + "# $ | < >"),
    (11, "don't we'll 've 're''s  \n\n  tabs\t\tand   blanks 　 中文字 12345 <|endoftext|> 🙂🙂"),
    (12, PASSAGE + " " + PASSAGE),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns whose names the operators use as well."""
    rows = [(i, t, "en", None, len(t or ""), 1, 2, "w", 3) for i, t in TEXTS]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, place int, fp bigint, gram string, item_id int"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id int, text string")


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_licenses(docs, none):
    rows = licenses.scan(docs).drop("labels", "score", "n_spans").collect()
    assert ordered(rows) == ordered((i, *brute.licenses(t)) for i, t in TEXTS)
    assert licenses.scan(none).count() == 0
    spans = licenses.scan(docs).where("doc_id = 1").first()
    assert spans["labels"] == "gpl,gpl-3.0" and spans["score"] == 1.0


def test_license_span_survives_changes(spark):
    words = licenses.NOTICES[13][0].split()
    changed = " ".join(["intro"] * 9 + words[:8] + ["added"] + words[8:])
    rows = licenses.scan(spark.createDataFrame([(1, changed), (2, " ".join(words[:6]))], "doc_id int, text string"))
    assert {r["doc_id"]: r["labels"] for r in rows.collect()} == {1: "bsd", 2: ""}


def test_license_spans_stand_by_themselves(spark):
    """Repeated word pairs before a notice, one changed word in a short notice, and notices that are other ones."""
    texts = [
        (1, "the mit the mit the mit the mit released under the mit license", "mit,mit-notice"),
        (2, "licensed under the new apache license version 2 0", "apache,apache-2.0"),
        (3, "licensed under the gnu general public license version 3", "gpl,gpl-3.0"),
        (4, "licensed under the gnu general common public license version 2", "gpl-2.0"),
        (5, "licensed under cc by nc 4 0", "cc-by,cc-by-nc-4.0"),
        (6, "released under the mit license released under the mit license", "mit,mit-notice"),
        (7, "the mit " * 3000 + "under the license", ""),
        (8, "licensed under the general license version 2", ""),
    ]
    rows = licenses.scan(spark.createDataFrame([t[:2] for t in texts], "doc_id int, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in rows} == {i: labels for i, _, labels in texts}
    assert {r["doc_id"]: r["n_spans"] for r in rows}[6] == 4


def test_license_join_by_shuffle(docs, monkeypatch):
    expected = ordered(licenses.scan(docs).collect())
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", -1)
    assert ordered(licenses.scan(docs).collect()) == expected


def test_license_plan_has_no_python(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def _tokens(text):
    import tiktoken

    ranks = bpe.load_ranks(public_tokenizers.path(queries.RANKS))
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return coder.encode_ordinary(text or "")


def test_bpe(docs, none):
    path = public_tokenizers.path(queries.RANKS)
    rows = bpe.digests(docs, path).collect()
    expected = [(i, len(x := _tokens(t)), brute.sha(" ".join(map(str, x))), brute.sha(t or "")) for i, t in TEXTS]
    assert ordered(rows) == ordered(expected)
    assert bpe.digests(none, path).count() == 0
    again = bpe.decode(bpe.encode(docs, path), path).select("doc_id", F.col("decoded").cast("string"))
    assert ordered(again.collect()) == ordered((i, t or "") for i, t in TEXTS)


def test_replay_on_odd_pieces():
    rng = np.random.default_rng(7)
    letters = list("  \n\t'''srtvemld!aab12é中　")
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3_000)]
    texts += ["a" * 3_000, " " * 1_000, "\n" * 300 + "x", "ab" * 2_000, "!?" * 900, "aaab" * 500, "''''s"]
    number, pieces, per_text = pretokens.split(texts)
    ids, bounds = bpe.replay(pieces, bpe.load_merges(public_tokenizers.path(queries.RANKS)))
    upto = np.append(0, np.cumsum(per_text))
    for i, text in enumerate(texts):
        got = [x for j in number[upto[i] : upto[i + 1]] for x in ids[bounds[j] : bounds[j + 1]].tolist()]
        assert got == _tokens(text), text[:60]


def test_quality(docs, none):
    book = quality.ledger(docs)
    assert ordered(book.select("doc_id", *quality.MEASURES[:5]).collect()) == ordered((i, *brute.quality(t)) for i, t in TEXTS)
    assert quality.ledger(none).count() == 0
    base = {r["doc_id"] for r in book.where(quality.fails("base")).collect()}
    assert base == {i for i, t in TEXTS if (m := brute.quality(t))[0] < 50 or 100 * m[4] > 50 * m[0]}
    kept = quality.kept(docs, "base")
    assert kept.columns == docs.columns
    assert ordered((r["doc_id"],) for r in kept.collect()) == ordered((r["doc_id"],) for r in book.where(~quality.fails("base")).collect())


def test_quality_ablations(docs):
    book = [r["failed"] for r in quality.ledger(docs).collect()]
    bit = {n: 1 << i for i, n in enumerate(quality.RULES)}
    for policy, names in quality.POLICIES.items():
        whole = sum(bit[n] for n in names)
        expected = [
            (n, sum(m & bit[n] > 0 for m in book), sum(m & whole == bit[n] for m in book), sum(m & whole & ~bit[n] == 0 for m in book)) for n in names
        ]
        assert ordered(quality.ablations(quality.ledger(docs), policy).collect()) == ordered(expected)


def test_quality_keeps_long_and_unspaced_texts(spark):
    import corpus_pipeline

    long = " ".join(f"word{i} stands here" for i in range(400_000))
    chinese = " ".join("".join(chr(0x4E00 + (31 * i + 7 * k) % 5_000) for k in range(30)) + "，见 www.a.cn 。" for i in range(40))
    thai = " ".join("".join(chr(0x0E01 + (11 * i + 5 * k) % 46) for k in range(40)) for i in range(60))
    junk = " ".join(f"{i:x}" + "Qx" * 30 for i in range(60))
    mixed = junk + " 中文"
    texts = {1: long, 2: chinese, 3: thai, 4: junk, 5: mixed, 6: None}
    rows = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    kept = corpus_pipeline.by_quality(spark, rows, "")
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3}


def test_clashing_names(spark, items):
    """Columns with the names that the operators give their own."""
    names = ["__ledger", "ledger", "failed", "LEDGER_", "id", "hash", "body_hash", "first_id", "first_hash", "place", "__key", "__row", "__id"]
    schema = "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names)
    long = " ".join(f"word{i} stands here" for i in range(60))
    rows = [(1, long, *names), (2, long, *names), (3, PASSAGE, *names), (3, PASSAGE, *names), (None, None, *names)]
    docs = spark.createDataFrame(rows, schema)
    for out, ids in ((quality.kept(docs, "v4"), [1, 2, 3, 3]), (simhash.keep_first(docs), [1, 3, None]), (winnow.clean(docs, items), [1, 2, None])):
        assert out.columns == docs.columns
        found = out.collect()
        assert ordered((r["doc_id"],) for r in found) == ordered((i,) for i in ids) and all(tuple(r)[2:] == tuple(names) for r in found)


def test_items_without_identifier_count(spark):
    docs = spark.createDataFrame([(1, PASSAGE), (2, "nothing of it")], "doc_id int, text string")
    rows = winnow.per_document(docs, spark.createDataFrame([(None, PASSAGE)], "item_id int, text string")).orderBy("doc_id").collect()
    assert [(r["n_hit"] > 0, r["n_items"], r["contaminated"]) for r in rows] == [(True, 0, True), (False, 0, False)]


def test_winnowing(docs, none, items):
    expected = brute.contamination([t for _, t in TEXTS], ITEMS)
    rows = winnow.per_document(docs, items).collect()
    assert ordered(rows) == ordered((i, *x) for (i, _), x in zip(TEXTS, expected))
    assert winnow.per_document(none, items).count() == 0
    rows = winnow.per_document(docs, items.where("false")).collect()
    assert len(rows) == len(TEXTS) and not any(r["n_hit"] or r["contaminated"] for r in rows)
    clean = winnow.clean(docs, items)
    assert clean.columns == docs.columns
    assert ordered((r["doc_id"],) for r in clean.collect()) == ordered((i,) for (i, _), x in zip(TEXTS, expected) if not x[4])


def test_winnowing_finds_every_long_span(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(40)]
    benchmark = [(i, " ".join(rng.choice(vocabulary, 60))) for i in range(20)]
    texts = []
    for i in range(150):
        body = list(rng.choice(vocabulary, rng.integers(5, 200)))
        source = benchmark[rng.integers(20)][1].split()
        n, at = rng.integers(8, 25), rng.integers(0, 35)
        cut = rng.integers(0, len(body))
        texts.append((i, " ".join(body[:cut] + source[at : at + n] + body[cut:])))
    rows = winnow.per_document(spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame(benchmark, "item_id int, text string"))
    expected = brute.contamination([t for _, t in texts], benchmark)
    assert ordered(rows.collect()) == ordered((i, *x) for (i, _), x in zip(texts, expected))


def test_winnowing_by_shuffle(docs, items, monkeypatch):
    monkeypatch.setattr(winnow, "BROADCAST_ROWS", -1)
    expected = brute.contamination([t for _, t in TEXTS], ITEMS)
    assert ordered(winnow.per_document(docs, items).collect()) == ordered((i, *x) for (i, _), x in zip(TEXTS, expected))


def test_simhash_joins_broadcast_nothing(spark, docs):
    """Replicas and links are sized too low by Spark: no join of fingerprints may build a side on the driver."""
    few = spark.createDataFrame([(v,) for v in range(0, 4000, 7)], "fp bigint").repartition(2)
    for rows in (simhash.links(few), simhash.near_duplicates(docs)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_simhash(docs, none):
    rows = simhash.near_duplicates(docs)
    got = rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    expected = [(i, *x) for (i, _), x in zip(TEXTS, brute.near_duplicates(TEXTS))]
    assert ordered(got) == ordered(expected)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    groups = {x for x in brute.near_duplicates(TEXTS)}
    assert kept.count() == rows.select("root").distinct().count() <= len(groups)


def test_links_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    values = set(rng.integers(0, 1 << 63, 60, np.uint64).tolist()) | {0, (1 << 64) - 1}
    for x in list(values)[:40]:
        for _ in range(12):
            y = x
            for bit in rng.choice(64, rng.integers(1, 4), replace=False):
                y ^= 1 << int(bit)
            values.add(y)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()
    mask = (1 << 64) - 1
    expected = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & mask).bit_count() <= 2}
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (300, 100), (500, 400)]
    rows = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert rows == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100, 400: 400, 500: 400}


PERSONAL = [
    f"call +1 (555) 12{i}-4567 or {i}.2.3.{i} by a{i}@b.example.com, card 4111111111111111, order 12345{i} of 20{i:02d}, build {i}.4.1"
    for i in range(60)
]


def test_pii(docs, none):
    weights = pii.train(PERSONAL)
    rows = pii.find(docs, weights).collect()
    assert len(rows) == len(TEXTS)
    got = [(r["doc_id"], ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r["base"])) for r in rows]
    assert ordered(got) == ordered((i, brute.pii(t)[1]) for i, t in TEXTS)
    for r in rows:
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))
    assert pii.find(none, pii.fit(none)).count() == 0
    assert pii.find(docs, pii.fit(docs)).count() == len(TEXTS)
    cleaned = pii.redact(docs, weights)
    assert cleaned.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert text[2] is None and text[3] == "" and "4111" not in text[7] and "@c.de" not in text[8]


def test_pii_patterns_on_odd_texts():
    rng = np.random.default_rng(11)
    signs = list("0123456789.@+-() ab%é\n")
    for _ in range(3_000):
        text = "".join(rng.choice(signs, rng.integers(0, 60)))
        got = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in pii.pattern_spans(text))
        assert got == brute.pii(text)[1], text


def test_pii_field_finds_what_patterns_drop():
    weights = pii.train(PERSONAL)
    base, spans = pii.all_spans("paid 4111111111111111 5500005555555559 now", weights)
    assert not base and {(a, b) for a, b, k in spans if k == 2} == {(5, 21), (22, 38)}


def test_pii_field_holds_little_of_a_numeric_text(monkeypatch):
    import tracemalloc

    weights = pii.train(PERSONAL)
    few = " ".join(f"{i % 100:02d}" for i in range(900)) + " paid 5500005555555559 to a@b or 1.2.3.4"
    whole = pii.all_spans(few, weights)
    assert len(whole[1]) > len(whole[0])
    numbers = " ".join(f"{i % 100:02d}" for i in range(8_000))
    assert pii.islands(numbers) == [(0, len(numbers))]
    tracemalloc.start()
    pii.all_spans(numbers, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25e6
    monkeypatch.setattr(pii, "BLOCK_TOKENS", 5)
    assert pii.all_spans(few, weights) == whole


def test_toxicity(spark):
    rng = np.random.default_rng(2)
    common = [f"word{i}" for i in range(300)]
    bad = ["gruntle", "frobnish", "skwark"]
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice(common, 80))
        toxic = i % 5 == 0
        if toxic:
            for at in rng.choice(80, 5):
                words[at] = str(rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(600, None), (601, ""), (None, "gruntle " * 50), (601, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id int, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, marks)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 100
    assert sum((r["score"] >= toxicity.CUT) == (r["doc_id"] % 5 == 0) for r in held) / len(held) > 0.95
    assert toxicity.fit(docs.where("false"), marks) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}


def test_token_files(docs, none, spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    manifest = tokenfile.write(docs, path)
    got = tokenfile.read(manifest).orderBy("start").collect()
    coder = Tokenizer.from_file(path)
    coder.encode_special_tokens = True
    expected = [(i, [*coder.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in TEXTS]
    assert ordered((r["doc_id"], np.frombuffer(r["tokens"], "<u4").tolist()) for r in got) == ordered(expected)
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    start = 0
    for r in got:
        assert r["start"] == start
        start += len(r["tokens"]) // 4
    assert [r["doc_id"] for r in tokenfile.read(manifest, wanted=[7]).collect()] == [7]
    empty = tokenfile.write(none, path)
    assert empty.count() == 0 and tokenfile.read(empty).count() == 0


def test_token_file_reader():
    class Counted(io.BytesIO):
        got = 0

        def read(self, *n):
            out = super().read(*n)
            self.got += len(out)
            return out

    stream = io.BytesIO()
    stream.close = lambda: None
    writer = tokenfile.Writer(stream)
    parts = [np.random.default_rng(i).integers(0, 50_000, 4_000) for i in range(50)]
    for i, part in enumerate(parts):
        writer.add(i, part)
    writer.close()
    raw = stream.getvalue()
    reader = tokenfile.Reader(counted := Counted(raw), len(raw))
    assert reader.tokens(17).tolist() == parts[17].tolist() and counted.got < len(raw) / 10
    damaged = bytearray(raw)
    damaged[int(reader.starts[17]) + 40] ^= 255
    reader = tokenfile.Reader(io.BytesIO(bytes(damaged)), len(raw))
    with pytest.raises(Exception):
        reader.tokens(17)
    assert reader.tokens(18).tolist() == parts[18].tolist()
    import zstandard

    out = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read(-1) for _ in range(1))
    assert out == b"".join(p.astype("<u4").tobytes() for p in parts)


PAGES = [
    (1, "http://A.example.com/en/x?q=1", "<html><title>T &amp; U</title><p>One<b> two</b></p><script>if (a<b) '</p>'</script><!-- no --><a href='/l'>go</a> on</html>", 0),
    (2, None, None, 0),
    (3, "https://h.co.uk#top", "", 0),
    (1, "http://A.example.com/en/x?q=1", "<p>unclosed <a title=\"x>y\" href=z>z", 0),
    (None, "no host", "<!-- open", 0),
    (5, "ftp://www.example.com/en/", "é" * 9_000, 0),
    (6, "http://b.net/es/", "x < y & z", 0),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id int, url string, html string, host int")


def test_warc(pages):
    sources = {}
    for r in warc.responses(pages).collect():
        headers, block = warc.parse(r["record"])
        sources.setdefault(headers["warc-record-id"], []).append((headers, block))
    rows = warc.read(warc.write(warc.derive(warc.responses(pages)))).collect()
    assert len(rows) == 2 * len(PAGES)
    assert ordered(warc.derive_pages(pages).collect()) == ordered(warc.derive(warc.responses(pages)).collect())
    for r in rows:
        headers, block = sources[r["refers_to"]][0]
        assert r["target_uri"] == headers["warc-target-uri"] and r["source_digest"] == headers["warc-payload-digest"]
        assert r["block_digest"] == warc.digest(r["content"])
        if r["kind"] == "metadata":
            about = json.loads(r["content"])
            assert about["source_headers"]["warc-block-digest"] == warc.digest(block) and about["status"] == "HTTP/1.1 200 OK"
    texts = {r["content"].decode() for r in rows if r["kind"] == "conversion"}
    assert {"One two\ngo on", "unclosed z", "", "é" * 9_000, "x < y & z"} == texts
    assert {json.loads(r["content"])["title"] for r in rows if r["kind"] == "metadata"} == {"T & U", ""}
    assert warc.derive(warc.responses(pages.where("false"))).count() == 0


def test_warc_damaged_records(spark):
    good = warc.response("1", "http://x", "<p>a", "2024-01-01T00:00:00Z")
    rows = [(1, good), (2, good[:-8]), (3, good.replace(b"<p>a", b"<p>b")), (4, b""), (5, None), (6, good.replace(b"response\r", b"resource\r", 1))]
    out = warc.derive(spark.createDataFrame(rows, "page_id int, record binary")).collect()
    assert sorted((r["page_id"], r["error"] is None) for r in out) == [(1, True), (1, True), (2, False), (3, False), (4, False), (5, False), (6, False)]


def test_warc_repeated_headers_and_codings(spark):
    page = "<p>one<p>two é".encode()
    raw_deflate = zlib.compressobj(wbits=-15)
    bodies = {
        1: ("Transfer-Encoding: chunked", b"5;x=1\r\n" + page[:5] + b"\r\nA\r\n" + page[5:] + b"\r\n0\r\nTrailer: x\r\n\r\n"),
        2: ("Content-Encoding: gzip", gzip.compress(page[:6]) + gzip.compress(page[6:])),
        3: ("Content-Encoding: deflate", zlib.compress(page)),
        4: ("Content-Encoding: deflate", raw_deflate.compress(page) + raw_deflate.flush()),
        5: ("Transfer-Encoding: gzip, chunked", b"%x\r\n" % len(gzip.compress(page, mtime=0)) + gzip.compress(page, mtime=0) + b"\r\n0\r\n\r\n"),
        6: ("Content-Encoding: identity", page),
        7: ("Content-Encoding: br", page),
        8: ("Transfer-Encoding: chunked", b"ff\r\n" + page),
        9: ("Content-Encoding: gzip", gzip.compress(page)[:-9]),
        10: ("Content-Encoding: gzip", page),
    }
    rows = []
    for i, (coding, body) in bodies.items():
        block = f"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2,\r\n c\r\n{coding}\r\n\r\n".encode() + body
        fields = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:{i}>"), ("WARC-Concurrent-To", "<urn:x>"), ("WARC-Concurrent-To", "<urn:y>")]
        rows.append((i, warc.record(fields, block)))
    out = warc.derive(spark.createDataFrame(rows, "page_id int, record binary")).collect()
    assert {r["page_id"] for r in out if r["error"]} == {7, 8, 9, 10} and len(out) == 6 * 2 + 4
    for r in out:
        if r["kind"] == "conversion":
            assert warc.parse(bytes(r["record"]))[1].decode() == "one\ntwo é"
        elif r["kind"] == "metadata":
            about = json.loads(warc.parse(bytes(r["record"]))[1])
            assert about["http_headers"]["set-cookie"] == ["a=1", "b=2, c"] and isinstance(about["source_headers"]["warc-type"], str)
            assert about["source_headers"]["warc-concurrent-to"] == ["<urn:x>", "<urn:y>"]


def test_urls(pages, spark):
    labels = spark.createDataFrame([(1, True), (1, False), (5, True), (None, True), (6, None)], "doc_id int, bad boolean")
    rows = reputation.filter_urls(pages, labels).collect()
    got = ordered((r["page_id"], r["host"], r["path"], r["rule"]) for r in rows)
    assert got == ordered([
        (1, "a.example.com", "/en/x", "example.com/en/"), (1, "a.example.com", "/en/x", "example.com/en/"), (2, "", "", None),
        (3, "h.co.uk", "", None), (None, "", "", None), (5, "www.example.com", "/en/", "www.example.com/en/"), (6, "b.net", "/es/", "net/es/"),
    ])
    assert reputation.filter_urls(pages.where("false"), labels).count() == 0
    assert reputation.filter_urls(pages, labels.where("false")).count() == len(PAGES)
    plan = reputation.filter_urls(pages, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_reputation_shrinks(spark):
    rows = [(f"h{i}.good.com", 0) for i in range(50) for _ in range(20)]
    rows += [(f"h{i}.evil.com", 1) for i in range(50) for _ in range(20)] + [("new.evil.com", None), ("new.good.com", None), ("one.org", 1)]
    out = {r["host"]: r for r in reputation.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert out["new.evil.com"]["mean"] > 0.9 > 0.1 > out["new.good.com"]["mean"]
    assert out["h1.evil.com"]["bound"] > max(0.5, out["one.org"]["bound"])


def test_domains(spark):
    hosts = ["a.b.example.com", "example.com", "com", "", "x.y.co.uk", "co.uk", "y.de", "a..b"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = [tuple(r) for r in df.select(reputation.domain_of(F.col("h")), reputation.suffix_of(F.col("h"))).collect()]
    assert got[:7] == [("example.com", "com"), ("example.com", "com"), ("com", "com"), ("", ""), ("y.co.uk", "co.uk"), ("co.uk", "uk"), ("y.de", "de")]
