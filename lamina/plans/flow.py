"""End to end: landed CSV to bronze, silver, warehouse slice, gold, checks and exports."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators.checks import check_freshness, gate, run_checks
from lamina.operators.ledger import load_accounts, load_report, manifest, requested
from lamina.operators.quality import with_share
from lamina.plans import gold
from lamina.plans.contracts import all_contracts
from lamina.plans.silver import SilverPaths, build_silver, silver_schemas
from lamina.sources.exports import Export, export_all
from lamina.sources.landing import read_landing
from lamina.sources.snapshots import LOAD, STRAY, MonthTable, next_strays
from lamina.sources.tables import bronze_schema, dropped_by_window, read_table, with_month_keys
from lamina.sources.warehouse import Sink, load_table, parquet_sink

MONTH_KEYS = ("annee", "mois")


@dataclass(frozen=True)
class Lake:
    """Where the layers live: one folder per layer under ``root``."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    @property
    def months(self) -> MonthTable:
        """Bronze: the rows of each load, and the ledger that says which load holds a month."""
        return MonthTable(
            self.path("bronze", "dpe_existant"), self.ledger, self.path("bronze", "hors_chargement"), bronze_schema()
        )

    @property
    def ledger(self) -> str:
        return self.path("bronze", "ledger")

    @property
    def silver(self) -> SilverPaths:
        return SilverPaths.under(f"{self.root}/silver")


def load_bronze(
    spark: SparkSession, lake: Lake, landing: str, announced: DataFrame, source_filter: Column, load: str | None = None
) -> DataFrame:
    """Lands CSV files as the requested months and records what was written.

    ``announced`` holds the rows that the source announces per ``annee``, ``mois`` as
    ``annonces``, for the months that this load requests.  Only these months are replaced,
    each as a whole, so that a load never replaces part of another's.  Rows of other months
    and rows without a readable date are kept under the load's name (``load``, or the
    requested months), and a load of that name replaces them.

    The landed rows are written once, by destination; months and their records change
    together when the next version of the ledger is committed.

    Returns the load report with the numbers of such rows.
    """
    months = [(r["annee"], r["mois"]) for r in announced.select(*MONTH_KEYS).distinct().collect()]  # what one load requests
    name = load or "_".join(f"{a:04d}-{m:02d}" for a, m in sorted(months))
    table, at = lake.months, lake.months.version(spark)
    rows = with_month_keys(read_landing(spark, landing), fixed.PARTITION_DATE)
    folder = table.put(rows.withColumn("_stray", ~requested(months)), "_stray")
    written = table.loaded(spark, folder)
    record = manifest(written.filter(~F.col(STRAY)), announced, source_filter).withColumn(LOAD, F.lit(folder))
    record = spark.createDataFrame(record.collect(), record.schema)  # a row per requested month
    strays = next_strays(table.stray_records(spark, at), name, folder, written.filter(STRAY))
    ledger = table.records(spark, at)
    if ledger is not None:
        ledger = ledger.join(record.select(*MONTH_KEYS), list(MONTH_KEYS), "left_anti").unionByName(record)
    at = table.commit(spark, at, record if ledger is None else ledger, strays)
    loaded = table.records(spark, at).filter(F.col(LOAD) == folder)
    return load_accounts(load_report(loaded), table.stray_records(spark, at).filter(F.col(LOAD) == folder))


def read_ledger(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """A record per loaded month; None before the first load."""
    return lake.months.records(spark)


def read_months(spark: SparkSession, lake: Lake) -> DataFrame:
    """The loaded months."""
    return lake.months.rows(spark)


def read_strays(spark: SparkSession, lake: Lake) -> DataFrame:
    """Landed rows that belong to no month of their load, by load (``chargement``)."""
    return lake.months.stray_rows(spark)


def read_bronze(spark: SparkSession, lake: Lake, version: int | None = None) -> DataFrame:
    """The loaded months, and the undated rows of all loads: silver rejects these with a motive.

    Stray rows of other months stay out until their month is loaded.
    """
    at = lake.months.version(spark) if version is None else version
    undated = lake.months.stray_rows(spark, at).filter("annee is null").drop("chargement")
    return lake.months.rows(spark, at).unionByName(undated)


def read_silver(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Current rows and rejects under their declared schemas, so that region codes stay text."""
    current, rejects = silver_schemas(spark)
    return read_table(spark, lake.silver.current, current), read_table(spark, lake.silver.rejects, rejects)


def load_warehouse(
    spark: SparkSession, lake: Lake, since: int | None = None, sinks: dict[str, Sink] | None = None
) -> dict[str, int]:
    """Loads both silver tables through the sinks, or as Parquet tables of the lake."""
    current, rejects = read_silver(spark, lake)
    out = sinks or {n: parquet_sink(lake.path("warehouse", n)) for n in ("dpe_courant", "dpe_rejets")}
    return {
        "dpe_courant": load_table(current, out["dpe_courant"], fixed.WAREHOUSE_COLUMNS, since),
        "dpe_rejets": load_table(rejects, out["dpe_rejets"], (), since),
    }


def outside_window(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Silver rows that no year window can ever see, because they have no year."""
    current, rejects = read_silver(spark, lake)
    return {n: dropped_by_window(df).first()["n_rows"] for n, df in (("dpe_courant", current), ("dpe_rejets", rejects))}


def build_gold(spark: SparkSession, lake: Lake, reference: DataFrame) -> dict[str, DataFrame]:
    """Writes the fact, the dimension and the marts in dependency order; returns all tables.

    Each table is read back before the next is built, so that no mart recomputes what
    it stands on and joins are planned with real sizes.
    """

    def store(name: str, df: DataFrame) -> DataFrame:
        path = lake.path("gold", name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    silver = {n: spark.read.parquet(lake.path("warehouse", n)) for n in ("dpe_courant", "dpe_rejets")}
    staged = gold.staging(silver["dpe_courant"])
    facts = store("fct_dpe", gold.fact(staged))
    communes = store("dim_commune", gold.dim_commune(staged))
    return {
        **silver,
        "ref_departement": reference,
        "fct_dpe": facts,
        "dim_commune": communes,
        "mart_performance_commune": store("mart_performance_commune", gold.mart_commune(facts, communes)),
        "mart_performance_departement": store(
            "mart_performance_departement", gold.mart_departement(facts, communes, reference)
        ),
        "mart_profil_batiment": store("mart_profil_batiment", gold.mart_profil(facts)),
    }


def exports_of(tables: dict[str, DataFrame]) -> dict[str, Export]:
    """What is exported and how: marts as CSV with coordinates, facts as Parquet."""
    located = ("dim_commune", "mart_performance_commune", "mart_performance_departement")
    out = {n: Export(tables[n], "csv", reproject=True) for n in located}
    out["mart_profil_batiment"] = Export(tables["mart_profil_batiment"], "csv")
    out["fct_dpe"] = Export(tables["fct_dpe"], "parquet")
    return out


@dataclass(frozen=True)
class RunReport:
    """What a run did: exported rows, loaded rows, rows without a year, shares, checks."""

    exported: dict[str, int]
    loaded: dict[str, int]
    outside_window: dict[str, int] = field(default_factory=dict)
    shares: dict[str, str] = field(default_factory=dict)
    checks: list = field(default_factory=list)


def run(
    spark: SparkSession,
    lake: Lake,
    reference: DataFrame,
    as_of: Column | None = None,
    since: int | None = None,
    overwrite: str = "static",
    fresh_at: dt.datetime | Column | None = None,
) -> RunReport:
    """Everything after bronze; stops before the exports if a contract is broken.

    The age of the newest certificate is checked at ``fresh_at`` (now, unless given); it
    warns, and an old slice is reported as ``error`` but does not stop the run.
    """
    build_silver(read_bronze(spark, lake), lake.silver, as_of, overwrite)
    metrics = with_share(spark.read.parquet(lake.silver.metrics))
    shares = {r["metrique"]: r["part"] for r in metrics.collect()}  # a row per metric
    loaded = load_warehouse(spark, lake, since)
    tables = build_gold(spark, lake, reference)
    summary = run_checks(tables, all_contracts(tables))
    summary.write.mode("overwrite").parquet(lake.path("gold", "checks"))
    checked = gate(spark.read.parquet(lake.path("gold", "checks")))
    now = F.current_timestamp() if fresh_at is None else fresh_at
    fresh = check_freshness(tables["dpe_courant"], "date_etablissement_dpe", "dpe_courant", now).collect()
    exported = export_all(exports_of(tables), lake.path("exports", "report"))
    lost = outside_window(spark, lake) if since is not None else {}
    return RunReport(exported, loaded, lost, shares, [*checked, *fresh])
