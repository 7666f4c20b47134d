"""Approximate matching of entity names.

``similar_names`` finds all pairs by the Dice similarity of their letter-triple sets. Two sets
as similar as the threshold must share a triple among the rarer part of each, so joining on
those triples finds every such pair and forms few others.

``name_matches`` looks up each name of a list by the share of characters in matching blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as fv
from ..functions.text import clean_text
from ..session import materialize

#: Candidates of a disputed row, and names that are compared with as many others in one step.
KEEP = 5
BLOCK = 1000


def name_key(c: Column | str) -> Column:
    """Upper-cased name of letters, digits and single spaces."""
    text = F.translate(F.upper(clean_text(c)), "Ё", "Е")
    return F.nullif(F.trim(F.regexp_replace(text, "[^A-ZА-Я0-9]+", " ")), F.lit(""))


def triples(name: Column) -> Column:
    """Distinct letter triples of the name between two spaces on each side."""
    padded = F.concat(F.lit("  "), name, F.lit("  "))
    spots = F.sequence(F.lit(1), F.length(padded) - 2)
    return F.array_distinct(F.transform(spots, lambda i: F.substr(padded, i, F.lit(3))))


def similar_names(left: DataFrame, right: DataFrame, threshold: float = 0.55) -> DataFrame:
    """All pairs (left name, right name) whose similarity reaches the threshold.

    Both inputs hold distinct names in a column ``name``.
    """
    sides = [
        df.select("name", F.lit(side).alias("side"), triples(F.col("name")).alias("grams"))
        for df, side in ((left, "l"), (right, "r"))
    ]
    names = sides[0].unionByName(sides[1]).withColumn("size", F.size("grams"))
    grams = names.select("name", "side", "size", "grams", F.explode("grams").alias("gram"))
    frequency = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    # |A ∩ B| >= t/2 (|A| + |B|) and |B| >= t/(2-t) |A| give the least overlap of A.
    least = F.ceil(F.col("size") * F.lit(threshold / (2 - threshold)) - F.lit(1e-9))
    rare = Window.partitionBy("side", "name").orderBy("df", "gram")
    prefix = (
        grams.join(frequency, "gram")
        .withColumn("pos", F.row_number().over(rare))
        .filter(F.col("pos") <= F.col("size") - least + 1)
    )
    a = prefix.filter("side = 'l'").select("gram", F.col("name").alias("name_l"), F.col("grams").alias("grams_l"), F.col("size").alias("size_l"))
    b = prefix.filter("side = 'r'").select("gram", F.col("name").alias("name_r"), F.col("grams").alias("grams_r"), F.col("size").alias("size_r"))
    ratio = F.lit(threshold / (2 - threshold) - 1e-9)
    close = (F.col("size_r") >= F.col("size_l") * ratio) & (F.col("size_l") >= F.col("size_r") * ratio)
    shared = F.size(F.array_intersect("grams_l", "grams_r"))
    return (
        a.join(b, "gram")
        .filter(close)
        .withColumn("name_sim", shared * 2.0 / (F.col("size_l") + F.col("size_r")))
        .filter(F.col("name_sim") >= threshold)
        .select("name_l", "name_r", "name_sim")
        .distinct()
    )


def best_pairs(
    left: list[str], right: list[tuple[str, list[tuple]]], threshold: float = 0.55, near: float = 5.0, bonus: float = 30.0, keep: int = KEEP
) -> list[tuple]:
    """(left name, right name, ids, score, similarity) of the best right rows of each left name.

    Similarity is the share of characters in matching blocks: the longest common block, then the
    longest ones on both sides of it, and so on. What two names have in common as bags of
    characters bounds it, so names are compared in the order of that bound, and only while one
    can still come among the first ``keep`` rows or be a second pair of ids near the best score.
    Of each name the ``keep`` best rows are given, and the best row of the two best pairs of ids.
    """
    column = {c: i for i, c in enumerate(sorted(set("".join(left))))}

    def bags(names: list[str]) -> np.ndarray:
        out = np.zeros((len(names), len(column)), np.int16)
        for i, name in enumerate(names):
            for c in name:
                if c in column:
                    out[i, column[c]] += 1
        return out

    right = sorted(right)
    of_right = bags([name for name, _ in right])
    sizes = np.array([len(name) for name, _ in right], np.int64)
    out: list[tuple] = []
    for name, own in zip(left, bags(left), strict=True):
        bound = 2.0 * np.minimum(of_right, own).sum(axis=1) / (sizes + len(name))
        found: list[tuple] = []
        scores: list[float] = []
        first, second = (None, float("-inf")), (None, float("-inf"))
        for j in np.argsort(-bound, kind="stable"):
            most = bound[j] * 100.0
            last = scores[0] if len(scores) == keep else float("-inf")
            if bound[j] < threshold or (most < last and most < max(second[1], first[1] - near)):
                break
            other, rows = right[j]
            similarity = SequenceMatcher(None, name, other).ratio()
            if similarity < threshold:
                continue
            score = similarity * 100 + (bonus if name == other else 0)
            for ids in rows:
                found.append((-score, other, ids, similarity))
                heapq.heappush(scores, score) if len(scores) < keep else heapq.heappushpop(scores, score)
                if ids == first[0]:
                    first = (ids, max(first[1], score))
                elif score > first[1]:
                    first, second = (ids, score), first
                elif ids == second[0] or score > second[1]:
                    second = (ids, max(score, second[1]))
        found.sort()
        chosen = found[:keep]
        for ids in (first[0], second[0]):
            chosen += [f for f in found[keep:] if f[2] == ids][:1] if ids is not None and all(f[2] != ids for f in chosen) else []
        out += [(name, other, ids, -negative, similarity) for negative, other, ids, similarity in chosen]
    return out


def name_candidates(
    names: DataFrame, entities: DataFrame, ids=("agr_id", "inn"), threshold: float = 0.55, near: float = 5.0, bonus: float = 30.0,
    keep: int = KEEP, block: int = BLOCK,
) -> DataFrame:
    """The best entities of each name: (name_l, name_r, ids, score, name_sim, near_text, sim_text), a few rows per name and block.

    The names are a stated set of queries: they are gathered in blocks, and each block meets each
    block of entity names in one row. Only the best of a pair of blocks leave it. Runs jobs.
    """
    ids = list(ids)
    names = materialize(names.select("name").distinct())
    pairs = entities.select("name", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ids]).distinct()
    place = F.row_number().over(Window.partitionBy("name").orderBy(*ids))
    # The rows of one name score the same: the first of them do.
    rows = pairs.withColumn("_place", place).filter(F.col("_place") <= keep).groupBy("name").agg(F.collect_list(F.struct(*ids)).alias("rows"))
    rows = materialize(rows)
    n_left, n_right = names.count(), rows.count()
    tasks = names.sparkSession.sparkContext.defaultParallelism
    left_blocks = max(1, -(-n_left // block))
    right_blocks = max(1, -(-n_right // block), min(n_right, tasks))
    number = F.pmod(F.xxhash64("name"), F.lit(left_blocks))
    left = names.groupBy(number.alias("_l")).agg(F.collect_list("name").alias("left"))
    left = left.select("left", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(right_blocks - 1).cast("long"))).alias("_r"))
    right = rows.groupBy(F.pmod(F.xxhash64("name"), F.lit(right_blocks)).alias("_r")).agg(F.collect_list(F.struct("name", "rows")).alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, others in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = [(o["name"], [tuple(r[c] for c in ids) for r in o["rows"]]) for o in others]
                found = best_pairs(some, held, threshold, near, bonus, keep)
                columns = [
                    [f[0] for f in found], [f[1] for f in found], *([f[2][k] for f in found] for k in range(len(ids))), [f[3] for f in found],
                    [f[4] for f in found], [f"{f[3] - near:.1f}" for f in found], [f"{f[4]:.3f}" for f in found],
                ]
                types = [pa.string()] * (2 + len(ids)) + [pa.float64()] * 2 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=out)

    out = ["name_l", "name_r", *ids, "score", "name_sim", "near_text", "sim_text"]
    schema = f"name_l string, name_r string, {', '.join(f'{c} string' for c in ids)}, score double, name_sim double, near_text string, sim_text string"
    return left.join(right, "_r").select("left", "right").mapInArrow(run, schema)


def name_matches(
    left: DataFrame, right: DataFrame, row="row_id", name="name", ids=("agr_id", "inn"),
    threshold: float = 0.55, near: float = 5.0, bonus: float = 30.0, high: float = 0.95, keep: int = KEEP,
) -> tuple[DataFrame, DataFrame]:
    """(status and best right entity of each left row, the best candidates of the disputed rows in order).

    Names are compared after ``name_key``; repeated rows of one name and ids are one candidate.
    Equal scores are ordered by name and ids. Several pairs of ids within ``near`` points of the
    best score make a match ambiguous.
    """
    ids = list(ids)
    rows = left.withColumn("_name", name_key(name))
    entities = right.withColumn("name", name_key(name)).filter("name is not null")
    names = rows.filter("_name is not null").select(F.col("_name").alias("name"))
    found = materialize(name_candidates(names, entities, ids, threshold, near, bonus, keep))
    best = found.groupBy("name_l").agg(
        F.min(F.struct((-F.col("score")).alias("neg"), "name_r", *ids, "name_sim", "near_text", "sim_text")).alias("b")
    )
    other = reduce(lambda x, y: x | y, [F.col(c) != F.col(f"b.{c}") for c in ids])
    close = F.col("score") >= -F.col("b.neg") - near
    held = found.join(best, "name_l").groupBy("name_l").agg(F.min("b").alias("b"), F.max(close & other).alias("_many"))
    score, similarity = -F.col("b.neg"), F.col("b.name_sim")
    status = (
        F.when(F.col("b").isNull(), "not_found")
        .when(F.col("_many"), "ambiguous_multi_candidates")
        .when(similarity >= high, "matched_by_name_high")
        .otherwise("ambiguous_low_confidence")
    )
    reason = (
        F.when(F.col("b").isNull(), fv.MATCH_REASONS["not_found"].format(threshold))
        .when(F.col("_many"), F.concat(*_around(fv.MATCH_REASONS["ambiguous_multi_candidates"], F.col("b.near_text"))))
        .when(similarity >= high, fv.MATCH_REASONS["matched_by_name_high"].format(high))
        .otherwise(F.concat(*_around(fv.MATCH_REASONS["ambiguous_low_confidence"], F.col("b.sim_text"))))
    )
    matched = rows.join(held, F.col("_name") == F.col("name_l"), "left").select(
        row, name, "_name",
        status.alias("match_status"),
        reason.alias("match_reason"),
        (status != "matched_by_name_high").cast("int").alias("is_disputed"),
        F.col("b.name_r").alias("matched_name"),
        *[F.col(f"b.{c}").alias(f"matched_{c}") for c in ids],
        F.round(score, 2).alias("match_score"),
        F.round(similarity, 4).alias("name_similarity"),
    )
    order = Window.partitionBy("name_l").orderBy(F.col("score").desc(), "name_r", *ids)
    ranked = found.withColumn("candidate", F.row_number().over(order)).filter(F.col("candidate") <= keep)
    disputed = matched.filter("is_disputed = 1").select(row, name, "_name").join(ranked, F.col("_name") == F.col("name_l"))
    candidates = disputed.select(
        row, name, "candidate", F.col("name_r").alias("candidate_name"), *ids, F.round("score", 2).alias("score"), F.round("name_sim", 4).alias("name_sim")
    )
    return matched.drop("_name"), candidates


def _around(text: str, value: Column) -> list[Column]:
    before, after = text.split("{}")
    return [F.lit(before), value, F.lit(after)]


def fuzzy_entity_match(left: DataFrame, right: DataFrame, row="row_id", name="name", ids=("agr_id", "inn"), **rules) -> DataFrame:
    """Status, reason and best right entity of each left row by name; see ``name_matches``."""
    return name_matches(left, right, row, name, ids, **rules)[0]


def disputed_candidates(left: DataFrame, right: DataFrame, row="row_id", name="name", ids=("agr_id", "inn"), **rules) -> DataFrame:
    """The best candidates of each disputed row, for a decision by hand; see ``name_matches``."""
    return name_matches(left, right, row, name, ids, **rules)[1]
