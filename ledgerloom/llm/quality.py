"""Quality rules as a ledger of bits.

Every document is measured once and every rule is evaluated once; the ledger row holds the
measurements and a bit mask of the rules the document fails. Policies are named versions of a
set of rules; applying one, or finding what a rule alone costs, is bit arithmetic on the ledger
and reads no text again.

Documents: null, empty and blank texts have no words and measure zero. Each input row gives one
ledger row; repeated rows and null identifiers are kept. An empty table gives an empty ledger.
Columns other than the identifier and the text are not read.
"""

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerloom.llm.common import free_name, text_blocks

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals",
    "n_spaced_words", "spaced_chars",
)

# The white space between words and the symbols that are counted.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"

CONTINUATION = bytes(range(0x80, 0xC0))
#: Characters beyond ASCII count as letters, so that a script without capitals passes.
NOT_LETTERS = CONTINUATION + bytes(b for b in range(0x80) if not chr(b).isalpha())
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Scripts written without blanks between words, and their punctuation: Thai, Lao, Tibetan, Myanmar, Khmer,
#: Tai, kana, bopomofo, Han, Yi, wide forms and the planes of rarer signs.
UNSPACED = re.compile(
    "[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u2e80-\u312f\u3190-\ua4cf"
    "\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\ufe30-\ufe4f\uff00-\uffef\U0001aff0-\U0001b16f\U00020000-\U0003ffff]+"
)

#: Rule name -> SQL condition under which a document fails. The bit of a rule is its place in this table: rules are
#: only ever added at the end, so that a stored ledger serves every policy, later ones too.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_phrases": "100 * n_repeat_words > 50 * n_words",
    "many_words": "n_words > 1000000",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "symbols": "4 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "few_letters": "100 * n_letters < 40 * word_chars",
    "capitals": "100 * n_capitals > 60 * n_letters",
    "long_spaced_words": "spaced_chars > 20 * n_spaced_words",
    "no_words": "n_words = 0",
}

#: Policy version -> rules that reject a document under it. v3 rejects no text for its length in words, and counts
#: long words only where blanks part words; v4 keeps short texts too.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_phrases"),
    "v1": ("few_words", "repeated_phrases", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_phrases", "many_words", "short_words", "long_words", "symbols", "repeated_lines", "few_letters", "capitals"),
    "v3": ("few_words", "repeated_phrases", "short_words", "symbols", "repeated_lines", "few_letters", "capitals", "long_spaced_words"),
    "v4": ("no_words", "repeated_phrases", "short_words", "symbols", "repeated_lines", "few_letters", "capitals", "long_spaced_words"),
}


def measure_text(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    dense = raw.translate(None, BLANKS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        count = Counter(windows)
        end = 0
        for i, window in enumerate(windows):
            if count[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    word_chars = len(dense.translate(None, CONTINUATION))
    spaced_words, spaced_chars = len(words), word_chars
    if not text.isascii() and UNSPACED.search(text):
        spaced = UNSPACED.sub(" ", text).encode("utf-8", "surrogatepass")
        spaced_words, spaced_chars = len(spaced.split()), len(spaced.translate(None, BLANKS + CONTINUATION))
    return (
        len(words),
        word_chars,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(dense.translate(None, NOT_LETTERS)),
        len(raw) - len(raw.translate(None, CAPITALS)),
        spaced_words,
        spaced_chars,
    )


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            columns = list(zip(*map(measure_text, texts), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=[id_col, *MEASURES])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES))


def bits(conditions: list[str] | None = None) -> Column:
    """The mask of the rules that a row of measurements fails; conditions are those of RULES, or the same over other columns."""
    conditions = list(RULES.values()) if conditions is None else conditions
    if len(conditions) > 63:
        raise ValueError("a mask holds 63 rules")
    out = F.lit(0).cast("long")
    for bit, condition in enumerate(conditions):
        out = out.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def mask(policy: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(name) for name in policy)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements, failed): failed is the mask of the failed rules."""
    return measurements(docs, id_col, text_col).withColumn("failed", bits())


def fails(policy: str | tuple[str, ...], failed: str = "failed") -> Column:
    """Whether a ledger row is rejected under a policy (a version of POLICIES or rule names)."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col(failed).bitwiseAND(F.lit(mask(names)).cast("long")) != 0


def ablations(book: DataFrame, policy: str | tuple[str, ...], failed: str = "failed") -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that are kept without it.

    The ledger is first counted by mask, so that few rows remain whatever its size.
    """
    names = POLICIES[policy] if isinstance(policy, str) else policy
    whole = mask(names)
    counts = book.groupBy(F.col(failed).bitwiseAND(F.lit(whole).cast("long")).alias("m")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("long").alias("bit")) for r in names))).alias("r")
    return (
        counts.select("m", "n", rules)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(F.col("m").bitwiseAND(F.lit(whole) - F.col("r.bit")) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def kept(docs: DataFrame, policy: str | tuple[str, ...], text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that a policy keeps.

    The measurements come from a column function, so that no other column passes through Python.
    """
    book, failed = free_name(docs, "ledger"), free_name(docs, "failed")
    fields = {m: f"`{book}`.{m}" for m in MEASURES}
    with_row = docs.withColumn(book, measured(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    with_row = with_row.withColumn(failed, bits([_inside(condition, fields) for condition in RULES.values()]))
    return with_row.where(~fails(policy, failed)).select(*(F.col(f"`{c}`") for c in docs.columns))


def _inside(condition: str, fields: dict[str, str]) -> str:
    return re.sub(r"\b(" + "|".join(fields) + r")\b", lambda m: fields[m[0]], condition)


@F.pandas_udf(StructType([StructField(m, LongType()) for m in MEASURES]))
def measured(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(list(map(measure_text, text)), columns=list(MEASURES))
