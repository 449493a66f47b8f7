"""Polygons against points and cells: dealt to the buckets of their extents, then measured exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import geometry


def deal(polygons: DataFrame, size: float, ring: str = "ring", keep: bool = False) -> DataFrame:
    """Each polygon with every cell ``col, row`` that its extent meets, and the extent ``__x0, __y0, __x1, __y1`` if it is kept."""
    sized = polygons.withColumns({f"__{k}": v for k, v in geometry.extent(F.col(ring)).items()})
    run = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / size).cast("long"), F.floor(F.col(hi) / size).cast("long")))
    dealt = sized.withColumn("col", run("__x0", "__x1")).withColumn("row", run("__y0", "__y1"))
    return dealt if keep else dealt.drop("__x0", "__y0", "__x1", "__y1")


def points_in(points: DataFrame, polygons: DataFrame, point: str, polygon: str, size: float, ring: str = "ring") -> DataFrame:
    """``point, polygon`` for points inside a polygon or on its edge: equal cells first, crossings then."""
    here = points.withColumns({"col": F.floor(F.col("x") / size).cast("long"), "row": F.floor(F.col("y") / size).cast("long")})
    met = here.join(deal(polygons.select(polygon, ring), size, ring), ["col", "row"])
    return met.where(geometry.contains(F.col(ring), F.col("x"), F.col("y"))).select(point, polygon)


def counts_in(points: DataFrame, polygons: DataFrame, point: str, polygon: str, size: float, ring: str = "ring") -> DataFrame:
    """``polygon, n, first`` (the smallest ``point``) of the points inside each polygon or on its edge; polygons without any are left out.

    Points at one place are tested once, however many there are, and only against polygons whose extent holds them. Polygons are
    dealt to all tasks first, as the little room that they take does not show how much work they are.
    """
    spark = points.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    places = points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.min(point).alias("first"))
    here = places.withColumns({"col": F.floor(F.col("x") / size).cast("long"), "row": F.floor(F.col("y") / size).cast("long")})
    met = here.join(deal(polygons.select(polygon, ring).repartition(tasks, polygon), size, ring, keep=True), ["col", "row"])
    met = met.where(F.col("x").between(F.col("__x0"), F.col("__x1")) & F.col("y").between(F.col("__y0"), F.col("__y1")))
    held = met.where(geometry.contains(F.col(ring), F.col("x"), F.col("y")))
    return held.groupBy(polygon).agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def cell_overlaps(polygons: DataFrame, polygon: str, size: float, ring: str = "ring") -> DataFrame:
    """``polygon, col, row, area`` of each polygon in each cell that it covers; with cells of a raster, its pixels' weights."""
    dealt = deal(polygons.select(polygon, ring), size, ring)
    boxed = dealt.withColumns({"__a": F.col("col") * size, "__b": F.col("row") * size, "__c": (F.col("col") + 1) * size, "__d": (F.col("row") + 1) * size})
    cut = geometry.clip(boxed, ring, "__a", "__b", "__c", "__d")
    return cut.select(polygon, "col", "row", geometry.area(F.col(ring)).alias("area")).where("area > 0")
