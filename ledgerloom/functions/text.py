"""Normalisation of identifiers, names and payment texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as fv

_NBSP = "\u00a0"
_WORD = r"[\p{L}\p{N}_]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c: Column | str) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def blank_to_null(c: Column | str, blanks=fv.BLANKS) -> Column:
    """Trimmed text, null for any spelling of "no value"."""
    text = F.trim(_col(c).cast("string"))
    return F.when(~text.isin(*blanks), text)


def digits_only(c: Column | str) -> Column:
    """The digits of a text, null when there are none."""
    return F.nullif(F.regexp_replace(_col(c).cast("string"), "[^0-9]", ""), F.lit(""))


def norm_inn(c: Column | str) -> Column:
    """Taxpayer id: 10 or 12 digits after restoring one lost leading zero, else null."""
    text = F.regexp_replace(F.trim(_col(c).cast("string")), r"\.0$", "")
    digits = F.regexp_replace(text, "[^0-9]", "")
    # One chain of patterns names the input once; a chain of length tests would repeat it in the plan.
    padded = F.regexp_replace(digits, "^([0-9]{9}|[0-9]{11})$", "0$1")
    return F.nullif(F.regexp_extract(padded, "^([0-9]{10}|[0-9]{12})$", 0), F.lit(""))


def norm_agr(c: Column | str) -> Column:
    """Agreement id: whole numbers in any spelling become plain digits."""
    text = F.translate(F.trim(_col(c).cast("string")), f",{_NBSP} ", ".")
    number = text.try_cast("decimal(38,18)")
    whole = number.cast("decimal(38,0)")
    plain = F.regexp_replace(text, r"\.0$", "")
    return F.when(number % 1 == 0, whole.cast("string")).when(
        ~plain.isin("", "nan", "None"), plain
    )


def norm_contract(c: Column | str) -> Column:
    """Trimmed contract number, null when empty."""
    return empty_to_null(c)


def contract_key(c: Column | str, prefixes=fv.CONTRACT_PREFIXES, prefix=fv.CONTRACT_PREFIX) -> Column:
    """Contract number without separators, with its prefix in one spelling."""
    text = F.translate(F.upper(_col(c).cast("string")), "Ё", "Е")
    text = F.regexp_replace(text, "[^A-ZА-Я0-9]+", "")
    return F.nullif(F.regexp_replace(text, f"^(?:{'|'.join(prefixes)})", prefix), F.lit(""))


def contract_key_no_prefix(c: Column | str, prefix=fv.CONTRACT_PREFIX) -> Column:
    """Contract key with the prefix dropped."""
    return F.nullif(F.regexp_replace(contract_key(c, prefix=prefix), f"^{prefix}", ""), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """One space for any run of white space, null when empty."""
    text = F.regexp_replace(_col(c).cast("string"), r"[\s\u00a0]+", " ")
    return F.nullif(F.trim(text), F.lit(""))


def blank_label(c: Column | str, label: str) -> Column:
    """A label in place of empty text and of the literal null spelling."""
    return F.coalesce(F.nullif(empty_to_null(c), F.lit("<NULL>")), F.lit(label))


def norm_branch(c: Column | str, marker=fv.BRANCH_MARKER, legal_forms=fv.LEGAL_FORMS) -> Column:
    """Branch name up to its marker, without the legal form's tail, in sentence case."""
    text = F.lower(clean_text(c))
    head = F.regexp_extract(text, f"^(.*?{marker})", 1)
    text = F.when(head != "", head).otherwise(text)
    text = F.regexp_replace(text, f"(?<!{_WORD})(?:{'|'.join(legal_forms)})(?!{_WORD}).*$", "")
    text = F.nullif(F.regexp_replace(text, r"^[ ,;.\-]+|[ ,;.\-]+$", ""), F.lit(""))
    text = F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))
    return F.regexp_replace(text, f"(?iu){marker}", marker.upper())


def semantic_text(c: Column | str, phrase=fv.TAIL_PHRASE) -> Column:
    """Lower-cased text with one kind of space; all after the phrase is dropped."""
    text = F.translate(F.lower(F.coalesce(_col(c).cast("string"), F.lit(""))), "ё", "е")
    text = F.trim(F.regexp_replace(text, r"[\s\u00a0\u202f\u2007]+", " "))
    cut = F.substring_index(text, phrase, 1)
    has_phrase = F.contains(text, F.lit(phrase))
    kept = F.regexp_replace(F.concat(cut, F.lit(phrase)), "^[ ,;:\\-]+|[ ,;:\\-]+$", "")
    return F.when(has_phrase, kept).otherwise(text)


def semantic_text_key(c: Column | str, phrase=fv.TAIL_PHRASE) -> Column:
    """Letters and digits of the semantic text."""
    return F.regexp_replace(semantic_text(c, phrase), "[^0-9a-zа-я]+", "")


def marker_tag(c: Column | str, rules, default: str | None = None) -> Column:
    """Tag of the first rule all of whose patterns occur in the text, else the default."""
    text = _col(c)
    tag = None
    for patterns, label in rules:
        hit = F.lit(True)
        for pattern in patterns:
            hit = hit & text.rlike(pattern)
        tag = F.when(hit, F.lit(label)) if tag is None else tag.when(hit, F.lit(label))
    return tag.otherwise(F.lit(default) if default is not None else text)
