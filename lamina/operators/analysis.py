"""The published analytical questions, over facts and marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.measures import rate, round_exact
from lamina.operators.clean import mark_superseded
from lamina.operators.quantiles import exact_quantiles


def score_quantiles(
    df: DataFrame, column: str, probs: dict[str, float] | None = None, method: str = "ranges"
) -> DataFrame:
    """Exact quantiles of a whole column, 1/25/50/75/90 % unless told otherwise."""
    wanted = probs or {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
    return exact_quantiles(df, [], column, wanted, method)


def share_where(df: DataFrame, condition: Column, name: str = "part_pct") -> DataFrame:
    """Rows, rows that meet the condition, and their share."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(condition).alias("n_match"))
    return counted.withColumn(name, rate(F.col("n_match"), F.col("n_rows")))


def status_share(df: DataFrame, column: str, name: str = "part_pct") -> DataFrame:
    """Rows per value and their share of all rows."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy())  # one row per value
    return counted.withColumn(name, rate(F.col("n_rows"), total))


def predecessor_shares(df: DataFrame, key: str, replaces: str) -> DataFrame:
    """Share of rows that name a predecessor against the share really superseded."""
    named = F.coalesce(F.trim(F.col(replaces)) != "", F.lit(False))
    counted = mark_superseded(df.select(key, replaces), key, replaces).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(named).alias("n_naming"),
        F.count_if(F.col("est_remplace")).alias("n_superseded"),
    )
    return counted.withColumns(
        {
            "naming_pct": rate(F.col("n_naming"), F.col("n_rows")),
            "superseded_pct": rate(F.col("n_superseded"), F.col("n_rows")),
        }
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"))


def filtered_totals(mart: DataFrame, where: Column, columns: Sequence[str]) -> DataFrame:
    """Sums of counted columns over the rows of interest."""
    return mart.filter(where).agg(*[F.sum(c).alias(c) for c in columns])


def rate_correlation(mart: DataFrame, a: str, b: str, name: str = "r", digits: int = 4) -> DataFrame:
    return mart.agg(F.round(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), digits).alias(name))


def extreme_ratio(mart: DataFrame, column: str) -> DataFrame:
    """Highest and lowest rate and how many times one is the other."""
    ends = mart.agg(F.max(column).alias("highest"), F.min(column).alias("lowest"))
    safe = F.nullif(F.col("lowest").cast("decimal(20,6)"), F.lit(0).cast("decimal(20,6)"))
    return ends.withColumn("factor", F.round(F.col("highest").cast("decimal(20,6)") / safe, 2))


def cost_per_size(df: DataFrame, label: str, cost: str, size: str, name: str = "cout_par_m2") -> DataFrame:
    """Cost per unit of size by label, as the ratio of the sums over complete rows."""
    complete = df.filter(F.col(cost).isNotNull() & F.col(size).isNotNull())
    return complete.groupBy(label).agg(
        round_exact(F.sum(cost) / F.nullif(F.sum(size), F.lit(0.0)), 1).alias(name)
    )


def label_anomalies(
    df: DataFrame, label: str, use: str, size: str, best: str = "A", max_use: float = 100, min_size: float = 40
) -> DataFrame:
    """Best-label rows with too high a use, below the size where the two must agree."""
    odd = df.filter((F.col(label) == best) & (F.col(use) > max_use) & (F.col(size) < min_size))
    return odd.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(size).alias("smallest"), F.max(size).alias("largest")
    )
