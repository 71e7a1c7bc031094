"""Most frequent description per key, and plain centroids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label_frequency(df: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    return df.groupBy(key, *attrs).agg(F.count(F.lit(1)).alias("occurrences"))


def mode_label(df: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Most frequent combination of ``attrs`` per key; ties go to the smallest values.

    Ranks grouped counts, never raw rows, and only one candidate per key and task
    crosses the second shuffle.
    """
    order = [F.desc("occurrences"), *[F.asc_nulls_last(a) for a in attrs]]
    w = Window.partitionBy(key).orderBy(*order)
    ranked = label_frequency(df, key, attrs).withColumn("_rank", F.row_number().over(w))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def centroids(df: DataFrame, key: str, x: str, y: str, where: Column | None, out_x: str, out_y: str, out_n: str) -> DataFrame:
    """Mean point and number of points per key over the located rows."""
    located = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    if where is not None:
        located = located.filter(where)
    return located.groupBy(key).agg(
        F.avg(x).alias(out_x), F.avg(y).alias(out_y), F.count(F.lit(1)).alias(out_n)
    )


def described_points(
    df: DataFrame, key: str, attrs: Sequence[str], x: str, y: str, where: Column, out_x: str, out_y: str, out_n: str
) -> DataFrame:
    """``mode_label`` and ``centroids`` of a key together, from one pass over the rows.

    The mean point is null, and the number of points 0, where no row is located.
    """
    located = F.coalesce(where & F.col(x).isNotNull() & F.col(y).isNotNull(), F.lit(False))
    counted = df.groupBy(key, *attrs).agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.count_if(located).alias("_n"),
        F.sum(F.when(located, F.col(x))).alias("_x"),
        F.sum(F.when(located, F.col(y))).alias("_y"),
    )
    # The least of (-occurrences, nulls last, value, ...) is the most frequent description.
    order = [(-F.col("occurrences")).alias("_o")]
    for a in attrs:
        order += [F.col(a).isNull().alias(f"_null_{a}"), F.col(a)]
    grouped = counted.groupBy(key).agg(
        F.min(F.struct(*order)).alias("_best"), F.sum("_n").alias(out_n), F.sum("_x").alias("_x"), F.sum("_y").alias("_y")
    )
    count = F.nullif(F.col(out_n), F.lit(0))
    return grouped.select(
        key,
        *[F.col(f"_best.{a}").alias(a) for a in attrs],
        (F.col("_x") / count).alias(out_x),
        (F.col("_y") / count).alias(out_y),
        out_n,
    )
