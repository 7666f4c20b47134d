"""Ordered business classes: zones, tariffs, code groups, buckets and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as fv
from .text import _col, clean_text


def _first_match(cases, default=None) -> Column:
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out if default is None else out.otherwise(default)


def zone_class(c: Column | str, rules=fv.ZONE_RULES) -> Column:
    """Responsibility zone by the first matching prefix, else null."""
    text = F.regexp_replace(F.lower(clean_text(c)), " ", "")
    return _first_match([(text.startswith(p), F.lit(label)) for p, label in rules])


def tariff_class(c: Column | str, source: str = "lake", rules=fv.TARIFF_RULES) -> Column:
    """Tariff class by keyword; a bare zero counts as individual in a spreadsheet source."""
    text = F.coalesce(F.lower(clean_text(c)), F.lit(""))
    cases = []
    for words, label in rules:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        if source == "excel" and label == fv.TARIFF_ZERO_LABEL:
            bare = F.translate(text, ",\u00a0 ", ".")
            hit = hit | bare.isin("0", "0.0", "0.00")
        cases.append((hit, F.lit(label)))
    return _first_match(cases, F.lit(fv.TARIFF_OTHER_LABEL))


def tariff_group(c: Column | str) -> Column:
    """Four tariff groups with a literal zero group, null for anything else."""
    raw = F.trim(_col(c).cast("string"))
    text = F.translate(F.lower(clean_text(c)), "ё", "е")
    by_act = text.contains("акт") & (
        text.contains("индивид") | text.contains("по акту") | text.startswith("по акт")
    )
    return _first_match(
        [
            (raw.rlike(r"^0(\.0+)?$"), F.lit(fv.GROUP_ZERO)),
            (by_act, F.lit(fv.GROUP_ACT)),
            (text.contains("меню") | text.contains("возможност"), F.lit(fv.GROUP_MENU)),
            (text.contains("стандарт"), F.lit(fv.GROUP_STANDARD)),
        ]
    )


def clean_code(c: Column | str, look_alikes=("YU", "УУ")) -> Column:
    """Upper-cased code without spaces, look-alike letters folded."""
    text = F.upper(F.regexp_replace(F.trim(_col(c).cast("string")), " ", ""))
    return F.coalesce(F.translate(text, *look_alikes), F.lit(""))


def prefix_group(c: Column | str, prefixes, exact=None) -> Column:
    """First prefix the cleaned code starts with.

    ``exact`` maps a group to the only codes it accepts, in place of its prefix.
    """
    code = clean_code(c)
    exact = exact or {}
    cases = []
    for prefix in prefixes:
        hit = code.isin(*exact[prefix]) if prefix in exact else code.startswith(prefix)
        cases.append((hit, F.lit(prefix)))
    return _first_match(cases)


def age_bucket(months: Column | str) -> Column:
    """Age ranges of a year each up to 48 months."""
    n = _col(months)
    return (
        F.when(n.isNull(), "null")
        .when(n < 0, "lt_0")
        .when(n < 12, "0_11")
        .when(n < 24, "12_23")
        .when(n < 36, "24_35")
        .when(n < 48, "36_47")
        .otherwise("ge_48")
    )


def sign_bucket(x: Column | str, labels=fv.SIGN_LABELS) -> Column:
    """Label by sign: positive, negative, and zero or missing."""
    x = _col(x)
    return F.when(x > 0, labels[0]).when(x < 0, labels[1]).otherwise(labels[2])


def cohort_flags(x: Column | str, limit: int = fv.COHORT_LIMIT) -> dict[str, Column]:
    """0/1 cohort columns of a client's income."""
    x = _col(x)

    def flag(condition):
        return F.when(condition, 1).otherwise(0)

    return {
        f"cohort_0_{limit}": flag((x > 0) & (x <= limit)),
        f"cohort_gt_{limit}": flag(x > limit),
        "cohort_eq_0": flag(x == 0),
        "cohort_lt_0": flag(x < 0),
    }


def label_list(labels: dict[str, str] = fv.PRODUCT_LABELS) -> Column:
    """Comma list of the labels whose flag column is 1."""
    return F.concat_ws(", ", *[F.when(F.col(flag) == 1, F.lit(label)) for flag, label in labels.items()])


def missing_label_list(flags=fv.RECOMMENDABLE, labels: dict[str, str] = fv.PRODUCT_LABELS) -> Column:
    """Comma list of the labels whose flag column is not 1."""
    return F.concat_ws(
        ", ", *[F.when(F.coalesce(F.col(f), F.lit(0)) != 1, F.lit(labels.get(f, f))) for f in flags]
    )


def ratio_bucket(ratio: Column | str, multiples=(2, 3, 4, 5, 6, 8, 10), tol: float = 0.05) -> Column:
    """Whole multiple a ratio is close to, or ``<1x``, ``other``, ``na``."""
    r = _col(ratio)
    out = F.when(r.isNull(), "na")
    for k in multiples:
        out = out.when(F.abs(r - k) < tol, f"{k}x")
    return out.when(r < 1, "<1x").otherwise("other")
