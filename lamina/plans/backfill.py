"""Backfill: months from a source into bronze, in loads that a rerun takes up again.

The work list is the calendar without the months whose record is complete, so that what a
run has committed is never loaded again, however it ended.  Each load is one commit of data
and ledger (``load_bronze``).  What was tried, and how it ended, is appended to a table of
attempts, a row per month and attempt.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators.ledger import MONTH, expand_months, rolling_months, status, work_list
from lamina.plans.flow import Lake, load_bronze, read_ledger
from lamina.sources.snapshots import exists

Month = tuple[int, int]

ATTEMPTS = "passage string, annee int, mois int, etat string, lignes long, erreur string, debut timestamp, fin timestamp"
DONE, FAILED = "charge", "echec"
NO_RECORDS = "annee int, mois int, rows_written long, rows_announced_by_source long, is_complete boolean"


class Source(Protocol):
    """Where months come from."""

    def announced(self, calendar: DataFrame) -> DataFrame:
        """``annee``, ``mois`` and the announced rows ``annonces`` of the calendar's months."""

    def land(self, months: Sequence[Month], folder: str) -> None:
        """Lands the months' rows as CSV files in a folder."""

    def filter_of(self) -> Column:
        """What the source was asked for, from ``annee`` and ``mois``."""


@dataclass(frozen=True)
class BackfillReport:
    """The months that were loaded, and those whose load failed, with the error."""

    run: str
    loaded: list[Month]
    failed: dict[Month, str]


def attempts_path(lake: Lake) -> str:
    return lake.path("bronze", "passages")


def records(spark: SparkSession, lake: Lake) -> DataFrame:
    """The ledger, or an empty one before the first load."""
    found = read_ledger(spark, lake)
    return spark.createDataFrame([], NO_RECORDS) if found is None else found


def backfill(
    spark: SparkSession,
    lake: Lake,
    source: Source,
    calendar: DataFrame,
    force: bool = False,
    cap: int | None = None,
    batch: int = 1,
    stop_on_failure: bool = False,
) -> BackfillReport:
    """Loads the calendar's months that are announced and not complete, oldest first.

    ``force`` loads complete months again; ``cap`` limits the months of this run; ``batch``
    months share a load and its commit.  A load that fails leaves its months as they were;
    the run goes on with the next unless ``stop_on_failure``.
    """
    run = uuid.uuid4().hex
    calendar = calendar.select(*MONTH)
    announced = source.announced(calendar)
    todo = [(r["annee"], r["mois"]) for r in work_list(calendar, records(spark, lake), announced, force, cap).collect()]  # months
    said = {(r["annee"], r["mois"]): r["annonces"] for r in announced.collect()}  # a row per month
    loaded, failed = [], {}
    for i in range(0, len(todo), batch):
        months, began, error, report = todo[i : i + batch], dt.datetime.now(), None, None
        try:
            folder = f"{lake.root}/landing/{run}/{i:05d}"
            source.land(months, folder)
            asked = spark.createDataFrame([(*m, said[m]) for m in months], "annee int, mois int, annonces long")
            report = load_bronze(spark, lake, folder, asked, source.filter_of(), _name(months))
            loaded += months
        except Exception as e:
            error = f"{type(e).__name__}: {e}".splitlines()[0][:500]
            failed |= dict.fromkeys(months, error)
            if stop_on_failure:
                raise
        finally:
            _note(spark, lake, run, months, report, error, began)
    return BackfillReport(run, loaded, failed)


def _name(months: Sequence[Month]) -> str:
    return "_".join(f"{a:04d}-{m:02d}" for a, m in months)


def _note(spark: SparkSession, lake: Lake, run: str, months, report: DataFrame | None, error: str | None, began: dt.datetime) -> None:
    """Appends an attempt per month; rows are those of the month's record."""
    rows = {}
    if report is not None:
        rows = {(r["annee"], r["mois"]): r["rows_written"] for r in records(spark, lake).select(*MONTH, "rows_written").collect()}
    noted = [(run, *m, DONE if report is not None else FAILED, rows.get(m), error, began, dt.datetime.now()) for m in months]
    spark.createDataFrame(noted, ATTEMPTS).coalesce(1).write.mode("append").parquet(attempts_path(lake))


def refresh(spark: SparkSession, lake: Lake, source: Source, run_date: Column, n: int = 3, **options) -> BackfillReport:
    """Loads the rolling window anew: the ``n`` months before the run date's, and that one."""
    return backfill(spark, lake, source, rolling_months(run_date, spark.range(1), n), force=True, **options)


def months_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return expand_months(spark.range(1), F.lit(start), F.lit(end))


def progress(spark: SparkSession, lake: Lake, calendar: DataFrame) -> DataFrame:
    """The state of every month of the calendar, with the number of attempts and the last one's error."""
    path = attempts_path(lake)
    known = spark.read.schema(ATTEMPTS).parquet(path) if exists(spark, path) else spark.createDataFrame([], ATTEMPTS)
    tried = known.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("passages"), F.max_by("erreur", "fin").alias("derniere_erreur")
    )
    found = status(calendar.select(*MONTH), records(spark, lake)).join(tried, list(MONTH), "left")
    return found.withColumn("passages", F.coalesce("passages", F.lit(0).cast("bigint")))
