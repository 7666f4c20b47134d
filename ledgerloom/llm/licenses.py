"""License scans by diagonal voting, in DataFrame operations only.

Every place of a document gives the hash of its K words; the places are joined with the places
of the same words in license templates. A match of place p with template place q votes for the
diagonal p - q. Votes are counted per document, template and diagonal. A diagonal that covers
enough of the template's distinct places is a span by itself, as where the template stands word by
word. Where none near it does, as words added to or missing from a license leave it, the heaviest
diagonal is merged with those near it and verified: together they must cover enough and be no
longer than the template allows. Of a short template up to K places may be lost, as one changed
word loses them, if its first and last ones are there; of a very short one none.

The join compares the words themselves beside their hash, so that no vote comes from a collision.
The templates are a parameter; they are broadcast while their places are fewer than
BROADCAST_ROWS, and joined by a shuffle beyond. A summary row of each document passes the same
join, so that documents without a license are kept without a second reading.

Null texts are empty: no words, no spans, score 0. Rows are told apart by identifier and text;
rows that repeat both get one result each; null identifiers are kept. Empty tables of documents
give empty results; other columns are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 2
#: Diagonals of one template no further apart than this belong to one span.
NEAR = 4
#: Share of a template's places that a span must cover; of one with more than 3 K places up to K may be lost between its ends.
COVER = 0.9
BROADCAST_ROWS = 100_000

# Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Opening or characteristic sentences of public licenses, and labels for them.
NOTICES = (
    ("licensed under the gnu general public license version 2", "gpl-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-notice"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-notice"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: Column) -> Column:
    """A-Z in lower case. lower() also changes other letters, of which only two have ASCII small forms."""
    odd = text.contains("K") | text.contains("İ")
    return F.when(odd, F.translate(text, CAPITALS, SMALL)).otherwise(F.lower(text))


def _places(words: str, first: int, last: str) -> Column:
    """Structs (place, gram) of the K words from each place of an array of words."""
    grams = ", ' ', ".join(f"{words}[i + {k}]" for k in range(K))
    return F.expr(
        f"if(size({words}) < {K}, array(), transform(sequence({first}, {last}), i -> struct(i as place, concat({grams}) as gram)))"
    )


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """(template, label, base, n_grams, q, gram): the places of all templates. A template has K words at least."""
    rows = [(t, label, True) for t, label in phrases] + [(t, label, False) for t, label in notices]
    if short := [t for t, _, _ in rows if len(t.split()) < K]:
        raise ValueError(f"templates of fewer than {K} words: {short}")
    rows = [(i, label, base, t.split()) for i, (t, label, base) in enumerate(rows)]
    df = spark.createDataFrame(rows, "template int, label string, base boolean, w array<string>")
    df = df.withColumn("n_grams", F.size("w") - (K - 1))
    return df.select("template", "label", "base", "n_grams", F.explode(_places("w", 0, f"size(w) - {K}")).alias("p")).select(
        "template", "label", "base", "n_grams", F.col("p.place").alias("q"), F.col("p.gram").alias("gram")
    )


def votes(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_words, template, ..., place, q): a row per match, and one per document with n_words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.regexp_extract_all(_lower(text), F.lit(WORD), F.lit(0))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words.alias("w"))
    summary = F.expr("array(struct(size(w) as place, cast(null as string) as gram))")
    rows = rows.select("doc_id", "text_hash", F.explode(F.concat(summary, _places("w", 0, f"size(w) - {K}"))).alias("p"))
    rows = rows.select("doc_id", "text_hash", F.col("p.place").alias("place"), F.col("p.gram").alias("gram"))
    rows = rows.withColumn("h", F.xxhash64("gram"))
    right = known.withColumn("h", F.xxhash64("gram")).withColumnRenamed("gram", "words")
    if known.count() <= BROADCAST_ROWS:
        right = F.broadcast(right)
    found = rows.join(right, (rows.h == right.h) & (rows.gram == right.words), "left")
    found = found.where(F.col("gram").isNull() | F.col("template").isNotNull())
    return found.select(
        "doc_id",
        "text_hash",
        F.when(F.col("gram").isNull(), F.col("place")).alias("n_words"),
        "template",
        "label",
        "base",
        "n_grams",
        "place",
        "q",
    )


KEY = ("doc_id", "text_hash")


def spans(docs: DataFrame, known: DataFrame | None = None, **names: str) -> DataFrame:
    """(doc_id, text_hash, n_words, copies, template, label, base, lo, hi, cover).

    Verified spans of words lo to hi (end exclusive), cover being the share of the template they
    have; every document also has one row with n_words, copies and no template.
    """
    known = templates(docs.sparkSession) if known is None else known
    # One row per document, template and diagonal; the places of a diagonal are a set of q.
    lines = votes(docs, known, **names).groupBy(*KEY, "template", "label", "base", "n_grams", (F.col("place") - F.col("q")).alias("diagonal"))
    lines = lines.agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("copies"),
        F.min("place").alias("lo"),
        (F.max("place") + K).alias("hi"),
        F.collect_set("q").alias("qs"),
    )
    n, own = F.col("n_grams"), F.size("qs")

    def fits(covered: Column, places: str) -> Column:
        ends = F.array_contains(places, F.lit(0)) & F.array_contains(F.col(places), (n - 1).cast("int"))
        return (covered / n >= COVER) | ((n > 3 * K) & (n - covered <= K) & ends)

    # A template that one diagonal covers is a span by itself, and phrases are nothing else.
    lines = lines.withColumn("alone", F.when(F.col("base"), own == n).otherwise(fits(own, "qs")))
    # Else the heaviest diagonal among its neighbours stands for them. They are few, however many
    # diagonals a text has, and so near that the span is short.
    near = Window.partitionBy(*KEY, "template").orderBy("diagonal").rangeBetween(-NEAR, NEAR)
    weight = F.struct(own.alias("own"), (-F.col("diagonal")).alias("first"))
    lines = lines.withColumns(
        {
            "around": F.array_distinct(F.flatten(F.collect_list("qs").over(near))),
            "lo_around": F.min("lo").over(near),
            "hi_around": F.max("hi").over(near),
            "some": F.max("alone").over(near),
            "heaviest": F.max(weight).over(near) == weight,
        }
    )
    together = ~F.col("base") & F.col("heaviest") & ~F.col("some") & fits(F.size("around"), "around")
    together &= F.col("hi_around") - F.col("lo_around") <= 2 * (n + K - 1)
    covered = F.when(F.col("alone"), own).otherwise(F.size("around"))
    return lines.where(F.col("template").isNull() | F.col("alone") | together).select(
        *KEY, "template", "label", "base", "n_words", "copies",
        F.when(F.col("alone"), F.col("lo")).otherwise(F.col("lo_around")).alias("lo"),
        F.when(F.col("alone"), F.col("hi")).otherwise(F.col("hi_around")).alias("hi"),
        F.least(covered / n, F.lit(1.0)).alias("cover"),
    )


def scan(docs: DataFrame, known: DataFrame | None = None, **names: str) -> DataFrame:
    """One row per input row: n_words, base places and labels, all labels, score and number of spans.

    score is the largest cover of a verified span.
    """
    base = F.col("base") & F.col("template").isNotNull()
    rows = spans(docs, known, **names).groupBy(*KEY).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.max("copies").alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("lo"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("lo"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.coalesce(F.max(F.when(F.col("template").isNotNull(), F.col("cover"))), F.lit(0.0)).alias("score"),
        F.count("template").alias("n_spans"),
    )
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_spans", again).drop("copy")
