"""Identifier chains, lookups and their coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import coalesce_by_source
from ..functions.text import blank_to_null, contract_key, contract_key_no_prefix, clean_text, digits_only
from ..functions.classes import zone_class

from .dedup import drop_duplicates_by, latest_version, unique_left_join
from .spans import FIRST, LAST, chosen_spans, merged_spans, month_spans, monthly_sums
from .validity import not_deleted


def current_master(master: DataFrame) -> DataFrame:
    """Newest live customer record per taxpayer id, with its responsibility zone."""
    live = master.filter(
        (F.coalesce("x_removed_flg", F.lit("N")) == "N") & (F.coalesce("x_duplicate_flg", F.lit("N")) == "N")
    ).select(
        digits_only("x_inn").alias("inn"),
        F.col("row_id").cast("string").alias("row_id"),
        clean_text("x_area_resp").alias("zone_raw"),
        F.col("created").cast("timestamp").alias("created"),
    )
    newest = latest_version(
        live.filter("inn is not null"), ["inn"], [F.col("created").desc_nulls_last(), F.col("row_id").desc()]
    )
    return newest.select("inn", "row_id", "zone_raw", zone_class("zone_raw").alias("zone"))


def external_ids(ext: DataFrame, prefix: str) -> DataFrame:
    """Distinct party and source ids of the systems whose name starts with the prefix."""
    system = F.upper(F.col("cmo_ext_source_system").cast("string"))
    return (
        ext.filter(system.startswith(prefix))
        .select(
            F.col("party_id").cast("string").alias("party_id"),
            F.col("cmo_ext_party_source_id").cast("string").alias("source_id"),
        )
        .distinct()
    )


def map_ids_chain(
    master: DataFrame, ext: DataFrame, master_prefix: str, core_prefix: str, scope: DataFrame | None = None
) -> DataFrame:
    """Taxpayer id → party id → core-system id, one row per taxpayer id."""
    current = current_master(master)
    if scope is not None:
        current = current.join(scope.select("inn").distinct(), "inn", "left_semi")
    parties = external_ids(ext, master_prefix).withColumnRenamed("source_id", "row_id")
    party = latest_version(parties, ["row_id"], [F.col("party_id")])
    cores = external_ids(ext, core_prefix).withColumnRenamed("source_id", "core_id")
    core = latest_version(cores, ["party_id"], [F.col("core_id")])
    return (
        current.join(party, "row_id", "left")
        .join(core, "party_id", "left")
        .select("inn", "zone_raw", "zone", "party_id", "core_id")
    )


def enrich_dims(df: DataFrame, dims, unique: bool = False) -> DataFrame:
    """Left lookups one after another.

    ``dims`` holds (dimension, key column of df, key column of the dimension,
    {column of the dimension: new name}). Each dimension is cut to one row per key, the first by
    its columns (null last); with ``unique`` a repeated key is an error instead.
    """
    for dim, left_key, right_key, columns in dims:
        lookup = dim.select(
            F.col(right_key).alias(left_key), *[F.col(c).alias(name) for c, name in columns.items()]
        )
        lookup = lookup.filter(F.col(left_key).isNotNull())
        if unique:
            df = unique_left_join(df, lookup, left_key)
            continue
        df = df.join(drop_duplicates_by(lookup, [left_key]), left_key, "left")
    return df


def key_fallback(df: DataFrame, main: str, spare: str, names=("sa", "r2_fallback"), source="agr_id_source") -> DataFrame:
    """Second id where the first is blank, and which of both was used (the first by default)."""
    value, tag = coalesce_by_source([main, spare], names, names[0], blank_to_null)
    return df.withColumns({main: value, source: tag})


def two_key_lookup(
    df: DataFrame, by_first: DataFrame, by_second: DataFrame, key: str, value: str, names=("id_device", "code_device")
) -> DataFrame:
    """Value by a key in a first map, else in a second one; ``join_key_used`` tells which."""

    def one(m, name):
        pairs = m.select(F.col(m.columns[0]).alias(key), blank_to_null(value).alias(name))
        return pairs.filter(F.col(name).isNotNull()).groupBy(key).agg(F.min(name).alias(name))

    out = df.join(one(by_first, "_v1"), key, "left").join(one(by_second, "_v2"), key, "left")
    found, used = coalesce_by_source(["_v1", "_v2"], names)
    return out.withColumns({value: found, "join_key_used": used}).drop("_v1", "_v2")


def map_coverage(mapped: DataFrame, amount: str, by=()) -> DataFrame:
    """Rows and amount by outcome of a mapping (none, unique, ambiguous), with percents."""
    kinds = {"no": "none", "unique": "unique", "ambiguous": "ambiguous"}
    aggs = [F.count(F.lit(1)).alias("rows_total"), F.coalesce(F.sum(amount), F.lit(0)).alias("amount_total")]
    for name, kind in kinds.items():
        hit = F.col("mapping") == kind
        aggs.append(F.count_if(hit).alias(f"{name}_rows"))
        aggs.append(F.sum(F.when(hit, F.coalesce(F.col(amount), F.lit(0))).otherwise(0)).alias(f"{name}_amount"))
    out = mapped.groupBy(*by).agg(*aggs)
    for name in kinds:
        out = out.withColumn(f"{name}_rows_pct", _share(f"{name}_rows", "rows_total"))
        out = out.withColumn(f"{name}_amount_pct", _share(f"{name}_amount", "amount_total"))
    return out


def _share(part: str, whole: str):
    part, whole = F.col(part).cast("double"), F.col(whole).cast("double")
    return F.when(whole != 0, part / whole * 100.0)


def map_ambiguous_top(mapped: DataFrame, amount: str, n: int, tie) -> DataFrame:
    """Keys with several targets, largest amounts first."""
    return (
        mapped.filter("mapping = 'ambiguous'")
        .orderBy(F.col(amount).desc_nulls_last(), F.col("target_cnt").desc(), *tie)
        .limit(n)
    )


def map_ambiguous_detail(pairs: DataFrame, mapped: DataFrame, keys, target) -> DataFrame:
    """The targets of the ambiguous keys."""
    ambiguous = mapped.filter("mapping = 'ambiguous'").select(*keys, "target_cnt")
    complete = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in target])
    return pairs.filter(complete).select(*keys, *target).distinct().join(ambiguous, list(keys))


def ordered_lookup(
    inputs: DataFrame, agreements: DataFrame, tariffs: DataFrame, row="row_num", inn="inn", contract="contract"
) -> DataFrame:
    """Agreement and tariff of each input row by taxpayer id and contract number.

    The full contract key counts first, the key without prefix second; of several
    agreements the newest wins. Each row keeps its number, candidate count and status.
    """
    base = inputs.select(row, F.col(inn).alias("_inn"), contract_key(contract).alias("_key"),
                         contract_key_no_prefix(contract).alias("_key_np"))
    targets = agreements.select(
        F.col("inn").alias("_inn"), contract_key("contract_number").alias("_key"),
        contract_key_no_prefix("contract_number").alias("_key_np"),
        "agr_id", "n_agr", "contract_number", "d_valid_from",
    ).filter(blank_to_null("agr_id").isNotNull())
    full = base.join(targets.drop("_key_np"), ["_inn", "_key"]).withColumn("match_rule", F.lit("full_key"))
    bare = base.join(targets.drop("_key"), ["_inn", "_key_np"]).withColumn("match_rule", F.lit("no_prefix_key"))
    cols = [row, "agr_id", "n_agr", "contract_number", "d_valid_from", "match_rule"]
    candidates = full.select(*cols).unionByName(bare.select(*cols))
    best = latest_version(
        candidates, [row],
        [F.col("d_valid_from").desc_nulls_last(), F.col("n_agr").desc(), F.col("match_rule"), F.col("agr_id")],
    )
    counts = candidates.groupBy(row).agg(F.countDistinct("agr_id").alias("candidate_cnt"))
    tariff = tariffs.groupBy("agr_id").agg(
        F.min(F.struct("tariff_plan", "tariff_name")).alias("_t"),
        F.countDistinct("tariff_plan").alias("tariff_candidate_cnt"),
    )
    out = (
        inputs.join(best, row, "left")
        .join(counts, row, "left")
        .join(tariff, "agr_id", "left")
        .withColumns(
            {
                "candidate_cnt": F.coalesce("candidate_cnt", F.lit(0)),
                "tariff_candidate_cnt": F.coalesce("tariff_candidate_cnt", F.lit(0)),
                "tariff_plan": F.col("_t.tariff_plan"),
                "tariff_name": F.col("_t.tariff_name"),
            }
        )
        .drop("_t")
    )
    status = (
        F.when(F.col("agr_id").isNull(), "no_agr_match")
        .when(blank_to_null("tariff_name").isNull(), "no_tariff")
        .otherwise("ok")
    )
    return out.withColumn("final_status", status).orderBy(row)


def mcc_by_company(outlets: DataFrame, scope: DataFrame) -> DataFrame:
    """Largest merchant category per company of the scope."""
    return (
        outlets.join(scope.select("n_cmp").distinct(), "n_cmp", "left_semi")
        .groupBy("n_cmp")
        .agg(F.max("n_mcc").cast("string").alias("mcc"))
    )


def enrich_reference(
    report: DataFrame, ids: DataFrame, registration: DataFrame, mcc: DataFrame, tariffs: DataFrame
) -> DataFrame:
    """Report rows with zone and party by taxpayer id, registration id, category and tariff."""
    return enrich_dims(
        report,
        [
            (ids, "inn", "inn", {"zone": "zone", "core_id": "core_id"}),
            (registration, "core_id", "id", {"ogrn": "ogrn"}),
            (mcc, "n_cmp", "n_cmp", {"mcc": "mcc"}),
            (tariffs.groupBy("agr_id").agg(F.max("tariff_name").alias("tariff_name")),
             "agr_id", "agr_id", {"tariff_name": "tariff_name"}),
        ],
    )


def parent_path_probe(agreements: DataFrame, terms: DataFrame, start, end, cls: str = "SA", deleted=("1", "Y", "y")) -> DataFrame:
    """Per agreement id and month: its live parents, those of the wanted class, and the live outlets behind them."""
    live = not_deleted(agreements, values=deleted).filter("abs_agr_id is not null")
    heads = month_spans(live, start, end).select(
        F.col("abs_agr_id").alias("agr_id"), "n_agr", F.upper(F.trim("acq_class")).alias("acq_class"), FIRST, LAST
    )
    leaves = not_deleted(terms, values=deleted).filter("c_nmrc is not null")
    leaves = month_spans(leaves, start, end).select("n_agr", "c_nmrc", F.col(FIRST).alias("_from"), F.col(LAST).alias("_to")).distinct()
    both = {FIRST: F.greatest(FIRST, "_from"), LAST: F.least(LAST, "_to")}
    outlets = heads.drop("acq_class").distinct().join(leaves, "n_agr").withColumns(both).filter(F.col(FIRST) <= F.col(LAST))
    key = ["agr_id"]
    names = ("_heads", "n_agr_cnt", "n_agr_sa_cnt", "c_nmrc_cnt")
    none = F.lit(None).cast("struct<acq_class: string>")

    def part(spans, name, label=none):
        return spans.select(*key, FIRST, LAST, *[F.lit(int(n == name)).alias(n) for n in names], label.alias("_class"))

    classed = chosen_spans(heads, key, ["acq_class"], ["acq_class"])
    parents = heads.filter("n_agr is not null")
    parts = (
        part(classed, "_heads", F.struct("acq_class")),
        part(merged_spans(parents, [*key, "n_agr"]), "n_agr_cnt"),
        part(merged_spans(parents.filter(F.col("acq_class") == cls), [*key, "n_agr"]), "n_agr_sa_cnt"),
        part(merged_spans(outlets, [*key, "c_nmrc"]), "c_nmrc_cnt"),
    )
    # Nothing is expanded to months before the last shuffle; an expansion would also pass for a small table and be broadcast.
    counts = monthly_sums(reduce(DataFrame.unionByName, parts), key, names, label="_class")
    return counts.select(*key, "month_start", F.col("_class.acq_class").alias("acq_class_sample"), *names[1:])


def text_search(df: DataFrame, text: str, needle: str, dates=(), months=()) -> DataFrame:
    """Rows whose text contains the needle and one of whose dates falls into one of the months."""
    out = df.filter(F.col(text).contains(needle))
    if dates and months:
        hits = [F.date_format(d, "yyyy-MM").isin(*months) for d in dates]
        out = out.filter(reduce(lambda x, y: x | y, hits))
    return out


