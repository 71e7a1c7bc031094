"""Adds geographic coordinates to a table of planar points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.geo import latitude_longitude, within_bounds


def reproject(
    df: DataFrame,
    x: str = "centroide_x_lambert93",
    y: str = "centroide_y_lambert93",
    latitude: str = "latitude",
    longitude: str = "longitude",
) -> DataFrame:
    """Points outside the bounding box keep their row but lose both coordinates."""
    if x not in df.columns or y not in df.columns:
        return df
    lat, lon = latitude_longitude(F.col(x).cast("double"), F.col(y).cast("double"))
    located = df.withColumns({latitude: lat, longitude: lon})
    inside = within_bounds(F.col(latitude), F.col(longitude))
    return located.withColumn("_inside", inside).withColumns(
        {latitude: F.when(F.col("_inside"), F.col(latitude)), longitude: F.when(F.col("_inside"), F.col(longitude))}
    ).drop("_inside")
