"""Partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import fixed


def write_partitions(df: DataFrame, path: str, keys: Sequence[str] = (), overwrite: str = "dynamic") -> None:
    """Snappy Parquet partitioned by those ``keys`` that exist.

    ``overwrite="dynamic"`` replaces only the partitions that ``df`` produces, for
    incremental loads; ``"static"`` replaces the whole table, for full rebuilds, so that
    a partition which no longer has rows does not survive.

    Rows are brought together by partition with a rebalancing hint: small partitions
    end up in one file each, and one that holds most of the table is spread over many
    tasks at run time instead of being written by one.
    """
    if overwrite not in ("dynamic", "static"):
        raise ValueError("overwrite must be 'dynamic' or 'static'")
    present = [k for k in keys if k in df.columns]
    writer = (df.hint("rebalance", *present) if present else df).write.mode("overwrite")
    writer = writer.option("compression", "snappy").option("partitionOverwriteMode", overwrite)
    (writer.partitionBy(*present) if present else writer).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Table with its partition columns; a declared schema keeps codes such as ``01`` text."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def bronze_schema(columns: Sequence[str] = fixed.BRONZE_COLUMNS) -> T.StructType:
    """All-text data columns and the integer year and month of the partition."""
    fields = [T.StructField(n, T.StringType()) for n in columns]
    return T.StructType(fields + [T.StructField("annee", T.IntegerType()), T.StructField("mois", T.IntegerType())])


def with_month_keys(df: DataFrame, date_text: str) -> DataFrame:
    """Adds ``annee`` and ``mois`` of a text date, for the bronze layout."""
    day = F.try_to_date(F.trim(F.col(date_text)), "yyyy-MM-dd")
    return df.withColumns({"annee": F.year(day), "mois": F.month(day)})


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long metrics table stamped with the time of the run."""
    metrics.withColumn("execute_le", F.current_timestamp()).write.mode("overwrite").parquet(path)


def read_reference(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Reference CSV with declared types, so that codes stay text.

    It is not hinted: its file size tells Spark whether it may be broadcast.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def year_window(df: DataFrame, since: int | None, column: str = "annee_etablissement") -> DataFrame:
    """Rows from a year on, where the column exists; a null year is outside any window.

    On a table partitioned by the column the filter prunes whole folders.
    """
    if since is None or column not in df.columns:
        return df
    return df.filter(F.col(column) >= since)


def dropped_by_window(df: DataFrame, column: str = "annee_etablissement") -> DataFrame:
    """How many rows a year window can never see, because their year is null."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("n_rows"))
