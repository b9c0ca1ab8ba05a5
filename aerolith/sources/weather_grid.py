"""Worldwide sampling points for weather readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.keyed import first_per_key

# Blocks of the grid as (name, latitudes, longitudes); each range
# is (first, last inclusive, step). Where blocks overlap the later one names the point.
BLOCKS = [
    ("grid", (-60, 75, 20), (-180, 180, 20)),
    ("dense", (-50, 59, 10), (-130, -61, 10)),
    ("dense", (30, 69, 10), (-10, 39, 10)),
    ("dense", (10, 59, 10), (60, 139, 10)),
    ("polar", (-80, 80, 160), (-180, 180, 60)),
]


def weather_grid(spark: SparkSession) -> DataFrame:
    """Sampling points: name, lat, lon, unique by place."""
    points = None
    for number, (name, lats, lons) in enumerate(BLOCKS):
        south, north, lat_step = lats
        west, east, lon_step = lons
        block = (
            spark.range(south, north + 1, lat_step)
            .withColumnRenamed("id", "_lat")
            .withColumn("_lon", F.explode(F.sequence(F.lit(west), F.lit(east), F.lit(lon_step))))
            .select(
                F.concat_ws("_", F.lit(name), F.col("_lat"), F.col("_lon")).alias("name"),
                F.col("_lat").cast("double").alias("lat"),
                F.col("_lon").cast("double").alias("lon"),
                F.lit(number).alias("_block"),
            )
        )
        points = block if points is None else points.unionByName(block)
    return first_per_key(points, ["lat", "lon"], [F.desc("_block")]).drop("_block")
