"""A month table whose data and ledger change together, by one pointer.

Data of a load goes to a folder of its own, which nobody reads yet.  Then the next version
of the ledger is written as a whole: a row per month with its record and the folder that
holds its rows.  A version exists once its success marker does, which Spark writes last, so
that this write is the commit.  Readers take the newest version and read only the folders
it names: they see a month's old rows with its old record, or both new, whatever a load
that fails leaves behind.  Loads of one table run one after the other; one that finds its
version committed by another fails and changes nothing.

The stray rows of a load (of months that it does not own) lie in its folder too, and which
load's strays count is kept under the same version number, written before the commit.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.ledger import MONTH
from lamina.sources.tables import write_partitions

LOAD, STRAY = "depot", "hors_chargement"
STRAYS = f"chargement string, {LOAD} string, hors_chargement bigint, sans_date bigint"


class VersionConflict(Exception):
    """Another load was committed since this one read the ledger."""


@dataclass(frozen=True)
class MonthTable:
    """Where data, ledger and stray records lie, and the schema of the rows (with the month columns last)."""

    data: str
    ledger: str
    strays: str
    schema: T.StructType
    keys: Sequence[str] = MONTH

    def put(self, rows: DataFrame, stray: str) -> str:
        """Writes a load's rows, in one pass, to a folder that no version names yet; returns its name.

        ``stray`` names the boolean column that tells the load's strays.
        """
        load = uuid.uuid4().hex
        placed = rows.withColumnRenamed(stray, STRAY)
        write_partitions(placed, f"{self.data}/{LOAD}={load}", [STRAY, *self.keys], "static")
        return load

    def loaded(self, spark: SparkSession, load: str) -> DataFrame:
        """All rows of a load, with the column that tells strays."""
        schema = T.StructType([*self.schema.fields, T.StructField(STRAY, T.BooleanType())])
        return spark.read.schema(schema).parquet(f"{self.data}/{LOAD}={load}")

    def commit(self, spark: SparkSession, base: int, ledger: DataFrame, strays: DataFrame) -> int:
        """Makes version ``base + 1`` of the ledger the current one."""
        version = base + 1
        if self.version(spark) != base:
            raise VersionConflict(f"{self.ledger}: version {version} exists")
        strays.coalesce(1).write.mode("overwrite").parquet(f"{self.strays}/version={version}")
        # A failed attempt may have left files without a marker.
        ledger.coalesce(1).write.mode("overwrite").parquet(f"{self.ledger}/version={version}")
        for folder in (self.ledger, self.strays):
            for old in _versions(spark, folder):
                if old < version:
                    _delete(spark, f"{folder}/version={old}")
        return version

    def version(self, spark: SparkSession) -> int:
        """The newest committed version; 0 before the first load."""
        done = [v for v in _versions(spark, self.ledger) if exists(spark, f"{self.ledger}/version={v}/_SUCCESS")]
        return max(done, default=0)

    def records(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """The ledger: a row per month; None before the first load."""
        at = self.version(spark) if version is None else version
        return spark.read.parquet(f"{self.ledger}/version={at}") if at else None

    def stray_records(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """Whose strays count: a row per name of a load."""
        at = self.version(spark) if version is None else version
        return spark.read.schema(STRAYS).parquet(f"{self.strays}/version={at}") if at else spark.createDataFrame([], STRAYS)

    def rows(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of all months, from the folders that the version names."""
        ledger = self.records(spark, version)
        months = [] if ledger is None else ledger.select(LOAD, *self.keys).collect()  # a row per month
        return self._read(spark, [
            "/".join([f"{LOAD}={r[LOAD]}", f"{STRAY}=false", *(f"{k}={r[k]}" for k in self.keys)]) for r in months
        ])

    def stray_rows(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The strays of all loads, with ``chargement``."""
        records = self.stray_records(spark, version).filter("hors_chargement + sans_date > 0").collect()  # a row per name
        named = spark.createDataFrame([(r[LOAD], r["chargement"]) for r in records], f"{LOAD} string, chargement string")
        found = self._read(spark, [f"{LOAD}={r[LOAD]}/{STRAY}=true" for r in records], [LOAD])
        # Spark knows the size of neither: it would broadcast the rows, whose many null columns make them look few.
        return found.join(F.broadcast(named), LOAD).drop(LOAD)

    def _read(self, spark: SparkSession, folders: list[str], extra: Sequence[str] = ()) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *(T.StructField(n, T.StringType()) for n in extra)])
        if not folders:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema).option("basePath", self.data)
        return reader.parquet(*[f"{self.data}/{f}" for f in folders]).select(*schema.names)

    def vacuum(self, spark: SparkSession) -> list[str]:
        """Deletes the folders of loads that the current version doesn't name; returns their names.

        For times when no load runs and no reader is still on an older version.
        """
        at = self.version(spark)
        ledger = self.records(spark, at)
        used = {r[LOAD] for r in self.stray_records(spark, at).select(LOAD).collect()}
        used |= set() if ledger is None else {r[LOAD] for r in ledger.select(LOAD).distinct().collect()}
        unused = [n for n in _names(spark, self.data, LOAD) if n not in used]
        for name in unused:
            _delete(spark, f"{self.data}/{LOAD}={name}")
        return unused


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _path(spark, path)
    return files.exists(at)


def _delete(spark: SparkSession, path: str) -> None:
    files, at = _path(spark, path)
    files.delete(at, True)


def _names(spark: SparkSession, folder: str, key: str) -> list[str]:
    """The values of the folders ``key=value``."""
    files, at = _path(spark, folder)
    if not files.exists(at):
        return []
    found = (re.fullmatch(rf"{key}=(.+)", s.getPath().getName()) for s in files.listStatus(at))
    return [m[1] for m in found if m]


def _versions(spark: SparkSession, folder: str) -> list[int]:
    return [int(n) for n in _names(spark, folder, "version") if n.isdigit()]


@dataclass(frozen=True)
class Versions:
    """Tables that belong together; a version exists once the last of them is complete."""

    root: str
    names: Sequence[str]

    def version(self, spark: SparkSession) -> int:
        last = f"{self.root}/{self.names[-1]}"
        return max((v for v in _versions(spark, last) if exists(spark, f"{last}/version={v}/_SUCCESS")), default=0)

    def read(self, spark: SparkSession) -> dict[str, DataFrame] | None:
        """The newest version's tables; None before the first."""
        at = self.version(spark)
        return {n: spark.read.parquet(f"{self.root}/{n}/version={at}") for n in self.names} if at else None

    def put(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> int:
        """Writes the next version, then deletes older ones."""
        version = self.version(spark) + 1
        for name in self.names:
            tables[name].write.mode("overwrite").parquet(f"{self.root}/{name}/version={version}")
        for name in self.names:
            for old in _versions(spark, f"{self.root}/{name}"):
                if old < version:
                    _delete(spark, f"{self.root}/{name}/version={old}")
        return version

    @staticmethod
    def drop_partition(spark: SparkSession, path: str, values: Mapping[str, object]) -> None:
        """Deletes a partition of a table."""
        named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        _delete(spark, "/".join([path, *(named(k, None if v is None else str(v)) for k, v in values.items())]))


def next_strays(current: DataFrame, name: str, load: str, outside: DataFrame, keys: Sequence[str] = MONTH) -> DataFrame:
    """Stray records after a load: those of its name are replaced."""
    undated = F.col(keys[0]).isNull()
    counted = outside.agg(F.count_if(~undated).alias("hors_chargement"), F.count_if(undated).alias("sans_date"))
    own = counted.select(F.lit(name).alias("chargement"), F.lit(load).alias(LOAD), "hors_chargement", "sans_date")
    return current.filter(F.col("chargement") != name).unionByName(own)
