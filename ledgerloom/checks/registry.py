"""Register of queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .standins import STANDINS, Inputs, sql_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BLOCKS: dict[str, str] = {}

_WORD = re.compile(r"[a-z_][a-z0-9_]*")
_LITERAL = re.compile(r"'[^']*'")


def block(name: str, sql: str) -> None:
    """A named part of SQL twins, used as a common table expression."""
    BLOCKS[name] = sql


def _needed(sql: str, seen: dict[str, str]) -> None:
    for word in _WORD.findall(_LITERAL.sub("", sql)):
        if word in seen or (word not in BLOCKS and word not in STANDINS):
            continue
        text = BLOCKS[word] if word in BLOCKS else sql_of(word)
        seen[word] = ""
        _needed(text, seen)
        del seen[word]
        seen[word] = text


def with_blocks(sql: str) -> str:
    """The SQL with every block and stand-in it names in front."""
    parts: dict[str, str] = {}
    _needed(sql, parts)
    if not parts:
        return sql
    # ``materialized`` keeps the SQL engine from evaluating shared parts again and again.
    head = ",\n".join(f"{n} as materialized ({t.strip()})" for n, t in parts.items())
    return f"with {head}\n{sql.strip()}"


def plain(df: DataFrame) -> DataFrame:
    """Comparable column types: decimals as double, dates as text, flags as numbers."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a function of ``Inputs`` as a query, with its SQL twin."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Inputs(spark, sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_blocks(sql)
        return fn

    return register
