"""What several operators share: stored tables, batches of texts, words, text as bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.session import configure
from lamina.sources.shared import materialise

# The white space of the word pattern [^\x20\x09-\x0D]+.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Rows in an Arrow batch; with long texts the default of 10,000 rows would be gigabytes.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def prepare(spark: SparkSession) -> None:
    """Session options of these operators: small batches, and skewed joins split before they are aggregated."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def store(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage for every later read."""
    return materialise(df, name, **options)


def text_bytes(text: str | Column = "text") -> Column:
    """UTF-8 of a text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def n_words(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(name: str, columns: list[str]) -> str:
    """A column name that the table doesn't have."""
    while name in columns:
        name += "_"
    return name
