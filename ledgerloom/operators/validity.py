"""Validity intervals, soft deletes and month expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv


def not_deleted(df: DataFrame, flag: str = "ods_deleted_flg", values=("1",)) -> DataFrame:
    """Rows whose soft-delete flag is none of the values."""
    return df.filter(~F.coalesce(F.col(flag).cast("string"), F.lit("0")).isin(*values))


def active_in_period(
    df: DataFrame, start, end, closed_end: bool = True, valid_from="d_valid_from", valid_to="d_valid_to"
) -> DataFrame:
    """Rows valid on some day of [start, end]; with an open end, not those ending on ``start``."""
    start, end = F.lit(start).cast("date"), F.lit(end).cast("date")
    last = F.col(valid_to)
    alive = (last >= start) if closed_end else (last > start)
    return df.filter((F.col(valid_from) <= end) & (last.isNull() | alive))


def active_at(df: DataFrame, day, valid_from="d_valid_from", valid_to="d_valid_to") -> DataFrame:
    """Rows valid on a day."""
    day = F.lit(day).cast("date")
    return df.filter((F.col(valid_from) <= day) & (F.col(valid_to).isNull() | (F.col(valid_to) >= day)))


def active_months(
    df: DataFrame,
    start,
    end,
    until: str = "month_start",
    valid_from="d_valid_from",
    valid_to="d_valid_to",
    month: str = "month_start",
) -> DataFrame:
    """One row per month of [start, end] in which the row is valid.

    A month counts when the row starts by its last day and ends

    * ``month_start``: on its first day or later,
    * ``after_month_start``: after its first day,
    * ``month_end``: on its last day or later.

    A row expands in place: no join, no shuffle.
    """
    first = F.trunc(F.lit(start).cast("date"), "MM")
    last = F.trunc(F.lit(end).cast("date"), "MM")
    ends = F.col(valid_to)
    if until == "month_start":
        last_month = F.trunc(ends, "MM")
    elif until == "after_month_start":
        last_month = F.trunc(F.date_sub(ends, 1), "MM")
    elif until == "month_end":
        last_month = F.add_months(F.trunc(F.date_add(ends, 1), "MM"), -1)
    else:
        raise ValueError(f"unknown end rule: {until}")
    lo = F.greatest(F.trunc(F.col(valid_from), "MM"), first)
    hi = F.least(F.coalesce(last_month, last), last)
    months = F.sequence(lo, hi, F.expr("interval 1 month"))
    known = df.filter(F.col(valid_from).isNotNull() & (lo <= hi))
    return known.withColumn(month, F.explode(months))


def month_end(month: Column | str = "month_start") -> Column:
    return F.last_day(month)


def interval_join(
    facts: DataFrame,
    dim: DataFrame,
    on,
    fact_date: str,
    start,
    end,
    valid_from="d_valid_from",
    valid_to="d_valid_to",
    how: str = "left",
) -> DataFrame:
    """Facts with the dimension rows valid on the fact's date.

    The month of the date is part of the join key, so a dimension row meets only
    facts of the months it covers and one busy key is spread over its months.
    """
    on = [on] if isinstance(on, str) else list(on)
    wide = active_months(dim, start, end, valid_from=valid_from, valid_to=valid_to, month="_month")
    keyed = facts.withColumn("_month", F.trunc(F.col(fact_date), "MM"))
    right = wide.select(
        *[F.col(c).alias(f"_r_{c}") for c in on],
        F.col("_month").alias("_r_month"),
        F.col(valid_from).alias("_r_from"),
        F.coalesce(F.col(valid_to), F.lit(fv.OPEN_END).cast("date")).alias("_r_to"),
        *[c for c in dim.columns if c not in (*on, valid_from, valid_to)],
    )
    condition = (F.col("_month") == F.col("_r_month")) & F.col(fact_date).between(F.col("_r_from"), F.col("_r_to"))
    for c in on:
        condition = condition & (F.col(c) == F.col(f"_r_{c}"))
    dropped = ["_month", "_r_month", "_r_from", "_r_to", *[f"_r_{c}" for c in on]]
    return keyed.join(right, condition, how).drop(*dropped)
