"""CSV and Parquet exports with declared types and a row-count check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import fixed
from lamina.operators.geo import reproject


class ExportMismatch(Exception):
    """The files hold another number of rows than the table."""


@dataclass(frozen=True)
class Export:
    """A table to export: its format, whether to add coordinates, its declared types."""

    df: DataFrame
    format: str
    reproject: bool = False
    fields: Sequence[tuple[str, str]] | None = None


def export_schema(fields: Sequence[tuple[str, str]]) -> T.StructType:
    """Schema of ``(column, declared type)`` pairs; an unknown type becomes text."""
    names = [(n, fixed.EXPORT_TYPES.get(t.strip(), "string")) for n, t in fields]
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in names)) if names else T.StructType()


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def export_csv(df: DataFrame, path: str) -> int:
    """Whole table as CSV part files with a header; returns the rows written."""
    watched, seen = _observed(df)
    watched.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return seen.get["n"]


def export_parquet(df: DataFrame, path: str, fields: Sequence[tuple[str, str]] | None = None) -> int:
    """Parquet with declared types; fails unless the files hold every row of the table.

    The rows are counted while they are written, so the table is worked out once.
    """
    watched, seen = _observed(df if fields is None else cast_to(df, export_schema(fields)))
    watched.write.mode("overwrite").option("compression", "snappy").parquet(path)
    stored = df.sparkSession.read.schema(watched.schema).parquet(path).count()
    if stored != seen.get["n"]:
        raise ExportMismatch(f"{path}: {stored} rows stored for {seen.get['n']} expected")
    return stored


def export_all(tables: Mapping[str, Export], root: str, only: Sequence[str] | None = None) -> dict[str, int]:
    """Exports the chosen tables (all by default) under ``root``; rows per table."""
    unknown = set(only or ()) - set(tables)
    if unknown:
        raise ValueError(f"no such table: {sorted(unknown)}")
    rows = {}
    for name in only or tables:
        table = tables[name]
        df = reproject(table.df) if table.reproject else table.df
        path = f"{root}/{name}"
        if table.format == "csv":
            rows[name] = export_csv(df, path)
        elif table.format == "parquet":
            rows[name] = export_parquet(df, path, table.fields)
        else:
            raise ValueError(f"{name}: unknown format {table.format}")
    return rows
