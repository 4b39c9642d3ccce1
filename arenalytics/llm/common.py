"""Helpers shared by the training-data operators.

Scratch tables go below the shared folder named in ``spark.checkpoint.dir``
(see ``arenalytics.session``); they are plain Parquet, so a lost executor only
re-reads files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import read_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Fixed by the query contracts: a word is a run of anything but these bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

__all__ = ["UPPER", "LOWER", "WORD_PATTERN", "ascii_lower", "bounded_rows", "doubles_literal",
           "id_and_text", "let", "materialize", "small_batches", "read_table", "spare_name", "text_bytes", "text_or_empty",
           "words_of"]


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only (doc_id, text); every other column, whatever its name, is left
    behind.  A null text counts as empty; null ids stay null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty().alias("text"))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts (one aggregate row reaches the driver)."""
    row = docs.select(F.sum(F.octet_length(text_or_empty())).alias("b")).first()
    return int(row["b"] or 0)


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def doubles_literal(values) -> Column:
    """A constant array<double> of a fixed table (folded once by the
    optimizer, so a lookup by index costs nothing per row)."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def bounded_rows(df: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` rows with the smallest hash of their id: a sample of a
    documented size, the same one on every run."""
    return df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the
    body (or a lambda in it) uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def spare_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def small_batches(spark: SparkSession) -> None:
    """Texts may be long: bound what a Python task gets at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
