"""URL filters by host reputation, in DataFrame operations only.

Labelled pages have outcome 0 or 1 (bad). Each host's share of bad pages is shrunk towards that
of its registered domain, the domain's towards that of its suffix and the suffix's towards all
pages': a level's prior is a beta distribution around the mean of the level above, whose
strength is found from the spread between the level's groups (method of moments for the
beta-binomial). A host is blocked if the lower bound of its posterior is above a limit.
Rules for hosts and paths go first.

Counts are summed per host before anything else, so that a host with very many pages is one row;
each level above sums those rows. Per level one row of sums comes to the driver.

A url that is null or has no :// has empty host and path and is judged like any other host.
Rows that repeat are judged each; null page ids have no label; of labels that repeat an id the
worst counts. Empty tables of pages or labels are allowed; without labels the reputation is
the prior's. Extra columns are not read.
"""


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize

# Second-level labels under which domains are registered.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

# Rules as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Standard deviations between posterior mean and lower bound, and the share above which it blocks.
Z = 1.645
LIMIT = 0.5
#: Bounds of the correlation within a group, and so of the prior's strength (1 - r) / r.
LEAST_R, MOST_R = 0.001, 0.5

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), CAPITALS, SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two if the one before is a usual second level of a country (co.uk)."""
    last = F.substring_index(host, ".", -1)
    two = F.substring_index(host, ".", -2)
    second = F.substring_index(two, ".", 1)
    return F.when((F.length(last) == 2) & second.isin(*SECOND_LEVEL) & (host != two), two).otherwise(last)


def domain_of(host: Column) -> Column:
    """The suffix and the label before it."""
    suffix = suffix_of(host)
    rest = host.substr(F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(host == suffix, host).otherwise(F.concat(F.substring_index(rest, ".", -1), F.lit("."), suffix))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, the first of equally long ones; else null."""
    out = []
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out.append(F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*out) if out else F.lit(None).cast("struct<rule:string,verdict:string>")


def _strength(groups: DataFrame) -> float:
    """Strength of the prior from (n, bad) of a level's groups."""
    sums = groups.where("n > 0").agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("bb"),
    ).first()
    if not sums["n"] or sums["k"] < 2:
        return (1 - LEAST_R) / LEAST_R
    n, k, p = sums["n"], sums["k"], sums["bad"] / sums["n"]
    spread = p * (1 - p)
    rest = spread * (n - sums["nn"] / n - (k - 1))
    r = (sums["bb"] - n * p * p - spread * (k - 1)) / rest if rest > 0 else 0.0
    r = min(max(r, LEAST_R), MOST_R)
    return (1 - r) / r


def _posterior(groups: DataFrame, prior: Column, strength: float, name: str) -> DataFrame:
    return groups.withColumn(name, (F.lit(strength) * prior + F.col("bad")) / (F.lit(strength) + F.col("n")))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, n, bad, mean, bound) of every host from rows (host, bad); bad is null where there is no label."""
    hosts = materialize(
        outcomes.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "bad"),
        "hosts",
    )
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    suffixes = hosts.groupBy("suffix").agg(*counts)
    whole = hosts.agg(*counts).first()
    mean = F.lit(((whole["bad"] or 0) + 0.5) / ((whole["n"] or 0) + 1))
    suffixes = _posterior(suffixes, mean, _strength(suffixes), "s_mean").select("suffix", "s_mean")
    domains = _posterior(domains.join(suffixes, "suffix"), F.col("s_mean"), _strength(domains), "d_mean").select("domain", "suffix", "d_mean")
    strength = _strength(hosts)
    out = _posterior(hosts.join(domains, ["domain", "suffix"]), F.col("d_mean"), strength, "mean")
    error = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.lit(strength) + F.col("n") + 1))
    return out.select("host", "n", "bad", "mean", (F.col("mean") - Z * error).alias("bound"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES, limit: float = LIMIT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, n_labelled, mean, bound) of every page; labels: (id, bad)."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    known = labels.toDF("id", "bad").groupBy("id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    outcomes = rows.join(known, rows["page_id"] == known["id"], "left").select("host", "bad")
    judged = rows.join(host_reputation(outcomes).withColumnRenamed("n", "n_labelled"), "host", "left")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return judged.withColumn("fit", rule).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), "n_labelled", "mean", "bound"
    )
