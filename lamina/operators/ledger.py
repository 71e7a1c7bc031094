"""Partition bookkeeping: month calendar, manifest, completeness and work lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import fixed

MONTH = ("annee", "mois")


def expand_months(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """Months that cover [start, end] of each row of ``bounds``, with first and last day."""
    last = F.greatest(F.trunc(start, "MM"), F.trunc(end, "MM"))
    months = F.sequence(F.trunc(start, "MM"), last, F.expr("interval 1 month"))
    first = bounds.filter(start <= end).select(F.explode(months).alias("premier_jour"))
    return first.select(
        F.year("premier_jour").alias("annee"),
        F.month("premier_jour").alias("mois"),
        "premier_jour",
        F.last_day("premier_jour").alias("dernier_jour"),
    )


def month_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return expand_months(spark.range(1), F.lit(start), F.lit(end))


def month_slice(df: DataFrame, column: str, year: int, month: int) -> DataFrame:
    """Rows dated from the first to the last day of the month, both included."""
    first = dt.date(year, month, 1)
    return df.filter(F.col(column).between(F.lit(first), F.last_day(F.lit(first))))


def rolling_months(run_date: Column, bounds: DataFrame, n: int = 3) -> DataFrame:
    """Months from ``n`` months before the run date through the run date."""
    return expand_months(bounds, F.add_months(F.trunc(run_date, "MM"), -n), run_date)


def partition_name(year: str = "annee", month: str = "mois") -> Column:
    return F.format_string("annee=%04d/mois=%02d", F.col(year), F.col(month))


def manifest(
    written: DataFrame,
    announced: DataFrame,
    source_filter: Column,
    ingested_at: Column | None = None,
    keys: Sequence[str] = MONTH,
) -> DataFrame:
    """One record per written partition: rows, announced rows, load time, filter, files.

    ``written`` is a table read from files, with the partition columns ``keys``; its
    data columns are not read.  ``announced`` has the keys and ``annonces``.  A partition
    that nobody announced gets a record too, incomplete.  For the partitions of one load
    pass ``written`` through ``only_months``, which prunes the others.
    """
    stored = written.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.sort_array(F.collect_set(F.col("_metadata.file_name"))).alias("files"),
    )
    joined = stored.join(announced, list(keys), "left")
    return joined.select(
        *keys,
        partition_name(*keys).alias("partition"),
        "rows_written",
        F.col("annonces").cast("bigint").alias("rows_announced_by_source"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at_utc"),
        source_filter.alias("source_filter"),
        "files",
    ).withColumn(
        "is_complete", F.coalesce(F.col("rows_written") == F.col("rows_announced_by_source"), F.lit(False))
    )


def only_months(df: DataFrame, months: Sequence[tuple[int, int]], keys: Sequence[str] = MONTH) -> DataFrame:
    """Rows of the listed months, by a condition on the partition columns that prunes folders."""
    wanted = F.lit(False)
    for values in sorted(set(months)):
        here = F.lit(True)
        for key, value in zip(keys, values):
            here = here & (F.col(key) == F.lit(value))
        wanted = wanted | here
    return df.filter(wanted)


def requested(months: Sequence[tuple[int, int]], keys: Sequence[str] = MONTH) -> Column:
    """Whether a row is of one of the months; false for other months and without a date."""
    if not months:
        return F.lit(False)
    wanted = F.struct(*keys).isin([F.struct(*[F.lit(v) for v in values]) for values in sorted(set(months))])
    return F.coalesce(wanted, F.lit(False))


def load_accounts(report: DataFrame, strays: DataFrame) -> DataFrame:
    """The load report with the rows that went to no requested month: stray, and undated."""
    return report.join(strays.select("hors_chargement", "sans_date"))  # one row each


def completeness(df: DataFrame, announced: DataFrame, keys: Sequence[str] = MONTH) -> DataFrame:
    """Rows written and announced per partition; complete when they are equal."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_written"))
    joined = counted.join(announced, list(keys), "left")
    return joined.select(
        *keys,
        "rows_written",
        F.col("annonces").cast("bigint").alias("rows_announced_by_source"),
        F.coalesce(F.col("rows_written") == F.col("annonces"), F.lit(False)).alias("is_complete"),
    )


def work_list(
    calendar: DataFrame,
    ledger: DataFrame,
    announced: DataFrame,
    force: bool = False,
    cap: int | None = None,
    keys: Sequence[str] = MONTH,
) -> DataFrame:
    """Months to load, oldest first: announced, not complete unless forced, at most ``cap``."""
    todo = calendar.join(announced.filter(F.col("annonces") > 0), list(keys))
    if not force:
        todo = todo.join(ledger.filter("is_complete").select(*keys), list(keys), "left_anti")
    ordered = todo.orderBy(*keys)
    return ordered if cap is None else ordered.limit(cap)


def status(calendar: DataFrame, ledger: DataFrame, keys: Sequence[str] = MONTH) -> DataFrame:
    """Rows, announced rows and state of every month of the calendar."""
    known = ledger.select(*keys, "rows_written", "rows_announced_by_source", "is_complete")
    state = (
        F.when(F.col("is_complete").isNull(), F.lit(fixed.STATE_ABSENT))
        .when(F.col("is_complete"), F.lit(fixed.STATE_OK))
        .otherwise(F.lit(fixed.STATE_INCOMPLETE))
    )
    return calendar.join(known, list(keys), "left").select(
        *keys, "rows_written", "rows_announced_by_source", state.alias("etat")
    )


def status_totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.coalesce(F.sum("rows_written"), F.lit(0)).cast("bigint").alias("total_local"),
        F.count_if(F.col("etat") == fixed.STATE_ABSENT).alias("partitions_absentes"),
    )


def load_report(ledger: DataFrame) -> DataFrame:
    """Rows over the written partitions, and the names of the incomplete ones."""
    return ledger.agg(
        F.count(F.lit(1)).alias("partitions_ecrites"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.sort_array(F.collect_list(F.when(~F.col("is_complete"), F.col("partition")))).alias("incomplete"),
    )
