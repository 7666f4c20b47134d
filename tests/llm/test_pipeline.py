"""The pipeline against plain Python versions of its stages, each on what the stage before kept."""

import public_tokenizers

import corpus_pipeline
from ledgerloom.llm import pii, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import tiktoken

    from ledgerloom.llm import bpe, common

    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    items = [tuple(r) for r in queries.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    def stage(name, frame):
        out = common.materialize(stages[name](spark, frame, SF), "test")
        return out, {r["doc_id"]: r for r in out.collect()}

    docs, got = stage("quality rules", docs)
    assert docs.columns == columns

    def keeps(text):
        n, chars, symbols, dup, repeat = brute.quality(text)
        lines = sum(bool(brute.CHUNK.search(x)) for x in text.split("\n"))
        letters = sum(c.isalpha() if c < "\x80" else True for c in text)
        capitals = sum("A" <= c <= "Z" for c in text)
        # No row of these tables has a script without blanks.
        failed = n == 0 or 2 * repeat > n or chars < 2 * n or chars > 20 * n
        return not (failed or 4 * symbols > n or 5 * dup > 2 * lines or 5 * letters < 2 * chars or 5 * capitals > 3 * letters)

    rows = {i: t for i, t in rows.items() if keeps(t)}
    assert set(got) == set(rows)

    docs, got = stage("near-duplicates", docs)
    pairs = sorted(rows.items())
    rows = {i: t for (i, t), (_, least) in zip(pairs, brute.near_duplicates(pairs)) if i == least}
    assert set(got) == set(rows) and docs.columns == columns

    docs, got = stage("benchmark", docs)
    found = brute.contamination(list(rows.values()), items)
    rows = {i: t for (i, t), x in zip(rows.items(), found) if not x[4]}
    assert set(got) == set(rows) and docs.columns == columns

    weights = pii.fit(docs)
    docs, got = stage("personal data", docs)
    assert docs.columns == columns
    rows = {i: pii.redact_text(t, weights) for i, t in rows.items()}
    assert {i: r["text"] for i, r in got.items()} == rows
    assert all(r["n_chars"] == len(r["text"]) and not brute.pii(r["text"])[1] for r in got.values())

    ranks = bpe.load_ranks(public_tokenizers.path(queries.RANKS))
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {i: coder.encode_ordinary(t) for i, t in rows.items()}
    expected = {i: (len(x), brute.sha(" ".join(map(str, x))), brute.sha(rows[i])) for i, x in ids.items()}
    out = corpus_pipeline.run(spark, SF).collect()
    assert len(out) == len(expected)
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out} == expected
