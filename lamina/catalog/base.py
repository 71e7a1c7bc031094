"""Registry of queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without ``sql`` it is checked on fixtures only."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles: SQL engines give them different precisions."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
          for f in df.schema.fields]
    )


# SQL counterparts of the rounding rules, on integers wherever the value is a ratio of
# integers, so that no binary fraction is ever rounded.


def sql_rate(part: str, whole: str, digits: int = 2) -> str:
    scale = 10**digits
    return (
        f"case when {whole} <> 0 then "
        f"cast((200 * {scale} * cast({part} as hugeint) + {whole}) // (2 * cast({whole} as hugeint)) as double) / {scale}.0 end"
    )


def sql_located(source: str, columns: str, x: str, y: str) -> str:
    """``columns`` of ``source`` with the latitude and longitude of a planar point, null off the map."""
    return f"""(
        with k as (select *, cast({x} as double) - 700000 as dx_, cast('6055612.049875985' as double) - (cast({y} as double) - 6600000) as dy_,
            cast('0.08181919104281579' as double) as e_, cast('0.7256077650532695' as double) as n_,
            cast('1.8428979224021063' as double) as f_ from {source}),
        r as (select *, pi() / 2 - 2 * atan(pow(sqrt(dx_ * dx_ + dy_ * dy_) / (cast(6378137 as double) * f_), 1 / n_)) as chi_ from k),
        g as (select *, round(3 + degrees(atan2(dx_, dy_) / n_), 6) as lon_, round(degrees(chi_
            + (pow(e_, 2) / 2 + 5 * pow(e_, 4) / 24 + pow(e_, 6) / 12 + 13 * pow(e_, 8) / 360) * sin(2 * chi_)
            + (7 * pow(e_, 4) / 48 + 29 * pow(e_, 6) / 240 + 811 * pow(e_, 8) / 11520) * sin(4 * chi_)
            + (7 * pow(e_, 6) / 120 + 81 * pow(e_, 8) / 1120) * sin(6 * chi_)
            + (4279 * pow(e_, 8) / 161280) * sin(8 * chi_)), 6) as lat_ from r)
        select {columns}, case when lat_ between 41 and 51.5 and lon_ between -5.5 and 10 then lat_ end as latitude,
            case when lat_ between 41 and 51.5 and lon_ between -5.5 and 10 then lon_ end as longitude from g)"""


def sql_round(x: str, digits: int) -> str:
    return f"cast(round(cast({x} as decimal(20,6)), {digits}) as double)"
