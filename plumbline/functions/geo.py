"""Distances, bounding boxes, tiles and the cells of a grid."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EARTH_M, DEGREE_M = 6371008.8, 111320.0
MILAN_BOX = (45.35, 45.58, 9.00, 9.35)


def haversine_m(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Metres between (latitude a, longitude b) and (c, d)."""
    h = F.pow(F.sin(F.radians(a - c) / 2), 2) + F.cos(F.radians(a)) * F.cos(F.radians(c)) * F.pow(F.sin(F.radians(b - d) / 2), 2)
    return 2 * EARTH_M * F.atan2(F.sqrt(F.least(F.lit(1.0), h)), F.sqrt(F.greatest(F.lit(0.0), 1 - h)))


def valid_coordinate(la: Column, lo: Column) -> Column:
    """Both there, finite, and not the point 0, 0."""
    return F.coalesce(la.isNotNull() & lo.isNotNull() & ~F.isnan(la) & ~F.isnan(lo) & ~((la == 0) & (lo == 0)), F.lit(False))


def in_box(la: Column, lo: Column, box: tuple[float, float, float, float] = MILAN_BOX) -> Column:
    return F.coalesce(la.between(box[0], box[1]) & lo.between(box[2], box[3]), F.lit(False))


def cell_degrees(radius_m: float) -> float:
    return max(radius_m / DEGREE_M, 1e-4)


def tile_grid(spark: SparkSession, la: float, lo: float, radius_m: float, step_m: float) -> DataFrame:
    """Centres (row, col, latitude, longitude) of a grid clipped to a circle."""
    k = int(math.floor(radius_m / step_m))
    rows = spark.range(-k, k + 1).select(F.col("id").cast("int").alias("row"))
    both = rows.select("row", F.explode(F.sequence(F.lit(-k), F.lit(k))).alias("col"))
    inside = both.where(F.hypot(F.col("row") * step_m, F.col("col") * step_m) <= radius_m)
    return inside.select("row", "col", (F.lit(la) + F.col("row") * step_m / DEGREE_M).alias("latitude"), (F.lit(lo) + F.col("col") * step_m / (DEGREE_M * math.cos(math.radians(la)))).alias("longitude"))


def tile_union(tiles: DataFrame, step_m: float, order: str = "seq") -> DataFrame:
    """Tiles of several centres snapped to one grid; of those in a cell the first by `order` stays."""
    deg = step_m / DEGREE_M
    w = Window.partitionBy("cell_y", "cell_x").orderBy(order)
    snapped = tiles.withColumn("cell_y", F.floor(F.col("latitude") / deg)).withColumn("cell_x", F.floor(F.col("longitude") / deg))
    return snapped.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def collapse_anchors(anchors: DataFrame) -> DataFrame:
    """Anchors (name, latitude, longitude, radius) whose names differ in a last _number only: their mean centre and largest radius."""
    return anchors.groupBy(F.regexp_replace("name", r"_\d+$", "").alias("name")).agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"), F.max("radius").alias("radius"))
