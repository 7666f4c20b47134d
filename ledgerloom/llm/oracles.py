"""DuckDB SQL for the queries whose rows SQL can give, written from their definitions."""

from ledgerloom.llm import licenses, quality, reputation

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def license_scan() -> str:
    known = [(t, label, "true") for t, label in licenses.PHRASES] + [(t, label, "false") for t, label in licenses.NOTICES]
    rows = ", ".join(f"({i}, '{t}', '{label}', {base})" for i, (t, label, base) in enumerate(known))
    k = licenses.K
    fits = f"(len(qs) / n >= {licenses.COVER} OR n > {3 * k} AND n - len(qs) <= {k} AND list_contains(qs, 0) AND list_contains(qs, n - 1))"
    return f"""
WITH known AS (SELECT t, string_split(phrase, ' ') AS w, label, base FROM (VALUES {rows}) AS v(t, phrase, label, base)),
grams AS (
  SELECT t, label, base, len(w) - {k - 1} AS n, i - 1 AS q, array_to_string(w[i:i + {k - 1}], ' ') AS gram
  FROM known, unnest(range(1, len(w) - {k - 2})) AS r(i)),
docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
places AS (SELECT doc_id, i - 1 AS p, array_to_string(w[i:i + {k - 1}], ' ') AS gram FROM docs, unnest(range(1, len(w) - {k - 2})) AS r(i)),
hits AS (SELECT doc_id, t, label, base, n, p, q, p - q AS d FROM places JOIN grams USING (gram)),
lines AS (
  SELECT doc_id, t, label, base, n, d, min(p) AS lo, max(p) + {k} AS hi, list(DISTINCT q) AS qs FROM hits GROUP BY doc_id, t, label, base, n, d),
alone AS (SELECT *, CASE WHEN base THEN len(qs) = n ELSE {fits} END AS fit FROM lines),
around AS (
  SELECT a.doc_id, a.t, a.label, a.base, a.n, a.d, min(b.lo) AS lo, max(b.hi) AS hi, list_distinct(flatten(list(b.qs))) AS qs,
    bool_or(b.fit) AS any_fit, bool_or(len(b.qs) > len(a.qs) OR len(b.qs) = len(a.qs) AND b.d < a.d) AS beaten
  FROM alone a JOIN alone b ON b.doc_id = a.doc_id AND b.t = a.t AND abs(b.d - a.d) <= {licenses.NEAR} WHERE NOT a.base
  GROUP BY a.doc_id, a.t, a.label, a.base, a.n, a.d, a.qs),
spans AS (
  SELECT doc_id, t, label, base, lo, least(1.0, len(qs) / n) AS cover FROM alone WHERE fit
  UNION ALL SELECT doc_id, t, label, base, lo, least(1.0, len(qs) / n) FROM around
  WHERE NOT any_fit AND NOT beaten AND hi - lo <= 2 * (n + {k - 1}) AND ({fits})),
found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(lo) FILTER (base) AS first_word, max(lo) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score, count(*) AS n_spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score, coalesce(n_spans, 0) AS n_spans
FROM docs LEFT JOIN found USING (doc_id)"""


def measures() -> str:
    """Common table expressions up to m, the measurements of each document."""
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_replace(text, '{quality.UNSPACED.pattern}', ' ', 'g') AS spaced, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM words, unnest(range(1, len(w) - 1)) AS r(i)),
twice AS (SELECT doc_id, unnest(list(i)) AS i FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest(range(3)) AS r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
line_counts AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
    len(regexp_extract_all(spaced, '[^\x20\x09-\x0D]+')) AS n_spaced_words,
    length(regexp_replace(spaced, '[\x20\x09-\x0D]', '', 'g')) AS spaced_chars
  FROM words LEFT JOIN repeated USING (doc_id) LEFT JOIN line_counts USING (doc_id))"""


def _any_of(rules) -> str:
    return " OR ".join(f"({quality.RULES[r]})" for r in rules) or "false"


def quality_rules() -> str:
    bit = " + ".join(f"CASE WHEN {condition} THEN {1 << i} ELSE 0 END" for i, condition in enumerate(quality.RULES.values()))
    base, v3 = (_any_of(quality.POLICIES[p]) for p in ("base", "v3"))
    return f"""{measures()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {base} AS base_failed, NOT ({base} OR {v3}) AS kept, CAST({bit} AS BIGINT) AS failed_mask
FROM m"""


def quality_ablations() -> str:
    parts = []
    for policy, rules in quality.POLICIES.items():
        for rule in rules:
            others = _any_of(r for r in rules if r != rule)
            parts.append(
                f"SELECT '{policy}' AS policy, '{rule}' AS rule, count(*) FILTER ({quality.RULES[rule]}) AS n_failed, "
                f"count(*) FILTER (({quality.RULES[rule]}) AND NOT ({others})) AS n_failed_alone, count(*) FILTER (NOT ({others})) AS n_kept_without FROM m"
            )
    return measures().replace("m AS (", "m AS MATERIALIZED (") + " UNION ALL ".join(parts)


def url_reputation() -> str:
    r = reputation
    host = LOWER.format(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '')")
    path = r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"
    rules = sorted(r.RULES, key=lambda x: -len(x[1] + x[2]))
    fit = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules]
    rule = " ".join(f"{c} THEN '{h + p}'" for c, (_, h, p) in zip(fit, rules, strict=True))
    verdict = " ".join(f"{c} THEN '{v}'" for c, (v, _, _) in zip(fit, rules, strict=True))
    second = ", ".join(f"'{s}'" for s in r.SECOND_LEVEL)

    def strength(table: str) -> str:
        return f"""
SELECT CASE WHEN n = 0 OR k < 2 OR n IS NULL THEN {(1 - r.LEAST_R) / r.LEAST_R}
  ELSE (1 - least(greatest(coalesce((bb - n * p * p - p * (1 - p) * (k - 1)) / nullif(p * (1 - p) * (n - nn / n - (k - 1)), 0), 0), {r.LEAST_R}), {r.MOST_R}))
    / least(greatest(coalesce((bb - n * p * p - p * (1 - p) * (k - 1)) / nullif(p * (1 - p) * (n - nn / n - (k - 1)), 0), 0), {r.LEAST_R}), {r.MOST_R}) END
FROM (SELECT count(*) AS k, sum(n) AS n, sum(bad) / sum(n) AS p, sum(CAST(n AS DOUBLE) * n) AS nn, sum(CAST(bad AS DOUBLE) * bad / n) AS bb
  FROM {table} WHERE n > 0)"""

    return rf"""
WITH p AS (SELECT page_id, {host} AS host, {path} AS path FROM pages),
outcome AS (
  SELECT doc_id, max(CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, string_split(host, '.') AS parts FROM p LEFT JOIN outcome ON page_id = doc_id GROUP BY host),
h1 AS (SELECT *, CASE WHEN length(parts[-1]) = 2 AND len(parts) > 2 AND parts[-2] IN ({second}) THEN 2 ELSE 1 END AS s FROM h0),
h AS (SELECT host, n, bad, array_to_string(parts[-s:], '.') AS suffix, array_to_string(parts[-(s + 1):], '.') AS domain FROM h1),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY suffix),
a AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS m FROM h),
sp AS (SELECT suffix, (ms * (SELECT m FROM a) + bad) / (ms + n) AS sm FROM s, ({strength("s")}) AS x(ms)),
dp AS (SELECT domain, suffix, (md * sm + bad) / (md + n) AS dm FROM d JOIN sp USING (suffix), ({strength("d")}) AS x(md)),
hp AS (SELECT host, n, mh, (mh * dm + bad) / (mh + n) AS mean FROM h JOIN dp USING (domain, suffix), ({strength("h")}) AS x(mh)),
b AS (SELECT host, n, mean, mean - {r.Z} * sqrt(mean * (1 - mean) / (mh + n + 1)) AS bound FROM hp)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN bound > {r.LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
  n AS n_labelled, round(mean, 6) AS mean, round(bound, 6) AS bound
FROM p JOIN b USING (host)"""


def decontamination() -> str:
    return f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
items AS (SELECT item_id, {WORDS} AS w, least(13, len({WORDS})) AS n FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM items, unnest(range(1, len(w) - n + 2)) AS r(i) WHERE n > 0),
widths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM docs, widths, unnest(range(1, len(w) - n + 2)) AS r(i)),
hits AS (SELECT doc_id, item_id, n, i FROM doc_windows JOIN item_windows USING (n, g)),
word_hits AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(n)) AS r(k) GROUP BY doc_id),
item_hits AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN word_hits USING (doc_id) LEFT JOIN item_hits USING (doc_id)"""


#: Unsigned CRC-32 of a text without characters beyond ASCII, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda ch: CAST(ord(ch) AS BIGINT))),
  lambda c, x: list_reduce(CAST([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[]), lambda a, b: xor(a >> 1, (a & 1) * 3988292384))), CAST(4294967295 AS BIGINT))"""


def prefix_trie() -> str:
    """Nodes by the digest of their whole path; a subtree by joining each node with the paths it begins with."""
    return f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
    sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS turn_key, strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, conv_id - (conv_id % 5 + 5) % 5 AS donor, {CRC32.format("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own),
turns AS (
  SELECT c.conv_id, k, turn_key, size FROM convs c JOIN own o ON o.conv_id = c.donor WHERE k <= h
  UNION ALL SELECT c.conv_id, k, turn_key, size FROM convs c JOIN own o ON o.conv_id = c.conv_id WHERE k > h),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS depth FROM turns),
paths AS (
  SELECT conv_id, depth, size, sha256(string_agg(turn_key, ',') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS path FROM numbered
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs),
last AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(CASE WHEN l.conv_id IS NOT NULL THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
  FROM paths LEFT JOIN last l USING (conv_id, depth) GROUP BY path, depth),
parents AS (SELECT n.path, p.path AS parent FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent AS path, count(*) AS n_children FROM parents GROUP BY parent),
sums AS (
  SELECT p.path, sum((d.n_convs - 1) * d.size) AS saved, count(*) FILTER (WHERE c.path IS NULL) AS n_leaves
  FROM nodes d JOIN paths p ON p.conv_id = d.conv_id AND p.depth <= d.depth LEFT JOIN children c ON c.path = d.path GROUP BY p.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (path) LEFT JOIN children USING (path) LEFT JOIN parents p ON p.path = n.path LEFT JOIN nodes q ON q.path = p.parent"""


ORACLES = {
    "op1_license_scan": license_scan(),
    "op3_quality_rules": quality_rules(),
    "quality_ablations": quality_ablations(),
    "op5_url_reputation": url_reputation(),
    "op7_decontamination": decontamination(),
    "op13_prefix_trie": prefix_trie(),
}
