"""Numbers and months: parsing, rounding, shares, calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import fixed_values as fv
from .text import _col, blank_to_null, empty_to_null

_NBSP = "\u00a0"
_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_num(c: Column | str, to: str = "double") -> Column:
    """Number from text with spaces and a decimal comma, null when it is none."""
    text = F.translate(F.trim(_col(c).cast("string")), f",{_NBSP} ", ".")
    return F.when(text.rlike(_NUMBER), text.try_cast(to))


def text_num(c: Column | str, to: str = "decimal(38,6)") -> Column:
    """Number from a text column, zero when blank."""
    return F.coalesce(empty_to_null(c).try_cast(to), F.lit(0).cast(to))


def money2(c: Column | str, mode: str = "half_even") -> Column:
    """Amount with two decimals: ``half_even`` or ``half_up``."""
    value = _col(c).cast("decimal(38,10)")
    rounded = F.bround(value, 2) if mode == "half_even" else F.round(value, 2)
    return rounded.cast("decimal(38,2)")


def month_key(c: Column | str) -> Column:
    """``YYYY-MM`` of a text month or date."""
    return F.nullif(F.substring(F.trim(_col(c).cast("string")), 1, 7), F.lit(""))


def month_int(c: Column | str) -> Column:
    """``yyyymm`` as a number from a text month or date."""
    digits = F.regexp_replace(F.trim(_col(c).cast("string")), "[^0-9]", "")
    return F.when(F.length(digits) >= 6, F.substring(digits, 1, 6).try_cast("int"))


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "MM")


def months_between_cal(start: Column | str, end: Column | str) -> Column:
    """Whole calendar months from one month to another."""
    start, end = _col(start), _col(end)
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def safe_pct(delta: Column | str, reference: Column | str) -> Column:
    """Absolute percent of the reference, null when that is null or zero."""
    delta, reference = _col(delta).cast("double"), _col(reference).cast("double")
    return F.when(reference != 0, F.abs(delta) / F.abs(reference) * 100.0)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double, null when b is null or zero."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    return F.when(b != 0, a / b)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percent with rounding, null for an empty whole."""
    part, whole = part.cast("double"), whole.cast("double")
    return F.when(whole != 0, F.round(part * 100.0 / whole, digits))


def bounded_count(x: Column | str, cap: Column | str) -> Column:
    """Count clamped to the range from zero to the cap; missing values are zero."""
    zero = F.lit(0)
    return F.least(F.greatest(F.coalesce(_col(x), zero), zero), F.coalesce(_col(cap), zero))


def passive_terms(total: Column | str, active: Column | str) -> Column:
    """Devices without activity, never negative."""
    return F.greatest(_col(total) - _col(active), F.lit(0))


def fill_from_fallbacks(*cols: Column | str) -> Column:
    """First value that is not blank."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def coalesce_by_source(cols, names, default: str | None = None, blank=None) -> tuple[Column, Column]:
    """First usable value, and the name of the column it came from."""
    values = [blank(c) if blank else _col(c) for c in cols]
    source = None
    for value, name in zip(values, names):
        source = F.when(value.isNotNull(), name) if source is None else source.when(value.isNotNull(), name)
    return F.coalesce(*values), (source if default is None else source.otherwise(default))


def drop_bad_rows(df: DataFrame, cols) -> DataFrame:
    """Rows where at least one of the columns holds a value."""
    keep = F.lit(False)
    for c in cols:
        keep = keep | empty_to_null(F.translate(F.col(c).cast("string"), f"{_NBSP} ", "")).isNotNull()
    return df.filter(keep)


def profit_formulas(df: DataFrame, unit_cost: int = fv.OUTLET_UNIT_COST) -> DataFrame:
    """Total commission, outlet cost, income and result; missing inputs count as zero."""

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0))

    df = df.withColumns(
        {
            "commission_total": zero("commission_from_ops") + zero("commission_monthly"),
            "aur": zero("retl_cnt") * F.lit(unit_cost),
        }
    )
    df = df.withColumn("chod", F.col("commission_total") + zero("int_component"))
    return df.withColumn("fin_result", F.col("chod") - F.col("aur") - zero("amortization"))
