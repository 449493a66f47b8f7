"""Queries on rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import audit, raster
from terrace.plans.places import rounded
from terrace.sources import layers
from terrace.sources.layers import LAND, PIXEL, UNIT, with_layers

#: Groups of land-cover classes.
ROLLUPS = {"tree_cover": [10], "grass_shrub": [20, 30], "cropland": [40], "water_wetland": [80, 90, 95]}


def _weights_sql(layer: str, pixel: float, unit: float, shift: float, extra: str) -> str:
    """Overlap weights in SQL: each pixel with the one or two cells that it meets on each axis."""
    lo, hi = (lambda c: f"({c} * {pixel} + {shift})"), (lambda c: f"({c} * {pixel} + {shift + pixel})")
    part = lambda c, u: f"(least({hi(c)}, (u.{u} + 1) * {unit}) - greatest({lo(c)}, u.{u} * {unit})) / {pixel}::DOUBLE"
    reach = lambda c: f"range(CAST(floor({lo(c)} / {unit}) AS BIGINT), CAST(ceil({hi(c)} / {unit}) AS BIGINT))"
    return f"""w AS (SELECT u_col, u_row, {extra}, ({part("col", "u_col")}) * ({part("row", "u_row")}) AS fraction
      FROM (SELECT *, unnest({reach("row")}) AS u_row FROM (SELECT *, unnest({reach("col")}) AS u_col FROM {layer})) u)"""


def area_weighted_sum(spark: SparkSession, d: str) -> DataFrame:
    out = raster.weighted_sum(raster.pixel_weights(layers.pixels(spark, d), PIXEL, UNIT, 30.0), PIXEL, UNIT)
    return out.select("u_col", "u_row", F.round("total", 3).alias("total"), *rounded("valid_share", "nodata_share"))


AREA_WEIGHTED = with_layers("pixels", "WITH " + _weights_sql("pixels", 100.0, 1000.0, 30.0, "value") + """
SELECT u_col, u_row, round(coalesce(sum(value * fraction), 0), 3) AS total, round(sum(CASE WHEN value IS NOT NULL THEN fraction ELSE 0 END) * 0.01, 6) AS valid_share,
       round(sum(CASE WHEN value IS NULL THEN fraction ELSE 0 END) * 0.01, 6) AS nodata_share FROM w GROUP BY u_col, u_row""")  # fmt: skip


def class_fractions(spark: SparkSession, d: str) -> DataFrame:
    out = raster.class_fractions(raster.pixel_weights(layers.land(spark, d), LAND, 800.0), LAND, 800.0, ROLLUPS)
    return out.select("u_col", "u_row", *rounded("valid_share", "land_share", *[f"{n}_ratio" for n in ROLLUPS]))


_PART = "fraction * 0.390625::DOUBLE"
CLASS_FRACTIONS = with_layers("land", "WITH " + _weights_sql("land", 500.0, 800.0, 0.0, "class") + f"""
SELECT u_col, u_row, round(sum(CASE WHEN class <> 0 THEN {_PART} ELSE 0 END), 6) AS valid_share, round(sum(CASE WHEN class NOT IN (0, 80) THEN {_PART} ELSE 0 END), 6) AS land_share,
""" + ", ".join(f"round(sum(CASE WHEN class IN ({', '.join(map(str, c))}) THEN {_PART} ELSE 0 END), 6) AS {n}_ratio" for n, c in ROLLUPS.items()) + " FROM w GROUP BY u_col, u_row")  # fmt: skip


def zonal_entropy(spark: SparkSession, d: str) -> DataFrame:
    out = raster.zonal_classes(layers.land(spark, d), LAND, 2000.0)
    return out.select("u_col", "u_row", *rounded("entropy", "dominance", "land_share"), "pixels")


ZONAL_ENTROPY = with_layers("land", """
WITH c AS (SELECT CAST(floor((col + 0.5) * 500 / 2000) AS BIGINT) AS u_col, CAST(floor((row + 0.5) * 500 / 2000) AS BIGINT) AS u_row, class, count(*) AS n FROM land WHERE class <> 0 GROUP BY ALL),
t AS (SELECT *, sum(n) OVER (PARTITION BY u_col, u_row) AS total FROM c)
SELECT u_col, u_row, round(-sum(n / total * log2(n / total)) + 0.0, 6) + 0.0 AS entropy, round(max(n) / any_value(total), 6) AS dominance, round(sum(CASE WHEN class <> 80 THEN n ELSE 0 END) / any_value(total), 6) AS land_share, CAST(any_value(total) AS BIGINT) AS pixels FROM t GROUP BY u_col, u_row""")  # fmt: skip


def zonal_builtup(spark: SparkSession, d: str) -> DataFrame:
    out = raster.zonal_values(layers.built(spark, d), PIXEL, UNIT)
    return out.select("u_col", "u_row", *rounded("mean", "variance", "nodata_share"))


ZONAL_BUILTUP = with_layers("built", """
SELECT CAST(floor((col + 0.5) * 100 / 1000) AS BIGINT) AS u_col, CAST(floor((row + 0.5) * 100 / 1000) AS BIGINT) AS u_row, round(avg(greatest(0, least(1, value))), 6) AS mean,
       round(var_samp(greatest(0, least(1, value))), 6) AS variance, round(avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0 END), 6) AS nodata_share FROM built GROUP BY 1, 2""").replace("greatest(0, least(1, value))", "CASE WHEN value IS NOT NULL THEN greatest(0, least(1, value)) END")  # fmt: skip


def builtup_masked(spark: SparkSession, d: str) -> DataFrame:
    from terrace.functions.status import denominator_status, unit_interval, where_ok

    sums = raster.masked_share(layers.built(spark, d), layers.land(spark, d), PIXEL, LAND, UNIT)
    units = layers.units(spark).select(F.col("col").alias("u_col"), F.col("row").alias("u_row"))
    full = units.join(sums, ["u_col", "u_row"], "left").withColumn("land_m2", F.coalesce("land_m2", F.lit(0.0)))
    state = denominator_status(F.lit(True), F.lit(True), F.col("land_m2"), F.lit(float(UNIT * UNIT)))
    ratio = unit_interval(F.try_divide("built_m2", "land_m2"))
    return full.select("u_col", "u_row", F.round(where_ok(ratio, state), 6).alias("built_up_ratio"), state.alias("status"))


BUILTUP_MASKED = with_layers("units built land", """
WITH f AS (SELECT CAST(floor(col / 5) AS BIGINT) AS lc, CAST(floor(row / 5) AS BIGINT) AS lr, sum(value) * 10000 AS b FROM built WHERE value IS NOT NULL GROUP BY 1, 2),
s AS (SELECT CAST(floor(l.col / 2) AS BIGINT) AS col, CAST(floor(l.row / 2) AS BIGINT) AS row, coalesce(sum(b), 0) AS b, count(*) * 250000 AS land FROM land l LEFT JOIN f ON f.lc = l.col AND f.lr = l.row WHERE class NOT IN (0, 80) GROUP BY 1, 2)
SELECT u.col AS u_col, u.row AS u_row, CASE WHEN land > 0 THEN round(b / land, 6) END AS built_up_ratio, CASE WHEN coalesce(land, 0) <= 0 THEN 'denominator_zero' ELSE 'ok' END AS status FROM units u LEFT JOIN s USING (col, row)""")  # fmt: skip


def disk_convolution(spark: SparkSession, d: str) -> DataFrame:
    cells = layers.pois(spark, d).groupBy(F.floor(F.col("x") / 500).cast("long").alias("col"), F.floor(F.col("y") / 500).cast("long").alias("row")).agg(F.count(F.lit(1)).alias("n"))
    return raster.disk_sum(cells, "n", 1000.0, 500.0)


DISK = with_layers("pois", """
WITH c AS (SELECT CAST(floor(x / 500) AS BIGINT) AS col, CAST(floor(y / 500) AS BIGINT) AS row, count(*) AS n FROM pois GROUP BY 1, 2),
o AS (SELECT i, j FROM range(-2, 3) a(i), range(-2, 3) b(j) WHERE (i * i + j * j) * 250000 <= 1000000)
SELECT col + i AS col, row + j AS row, CAST(sum(n) AS BIGINT) AS n FROM c, o GROUP BY 1, 2""")


def conservation_check(spark: SparkSession, d: str) -> DataFrame:
    """What the cells hold together against the raster itself, and the shares that must add up to one."""
    pixels = layers.pixels(spark, d)
    cells = raster.weighted_sum(raster.pixel_weights(pixels, PIXEL, UNIT, 30.0), PIXEL, UNIT)
    direct = pixels.agg(F.sum("value").alias("direct"))
    summed = cells.agg(F.sum("total").alias("by_cell"), F.sum(F.col("valid_share") + F.col("nodata_share")).alias("area"))
    both = direct.crossJoin(summed)  # two single rows
    return both.select(F.round("direct", 2).alias("direct"), F.round("by_cell", 2).alias("by_cell"), F.round("area", 4).alias("area"), (F.abs(F.col("by_cell") / F.col("direct") - 1) < 1e-9).alias("conserved"))


CONSERVATION = with_layers("pixels", "SELECT round(sum(value), 2) AS direct, round(sum(value), 2) AS by_cell, round(count(*) * 0.01, 4) AS area, true AS conserved FROM pixels")


def raster_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Land cover below pixels that have no population: how many of each class."""
    empty = layers.pixels(spark, d).where("value is null").select(((F.col("col") + 0.5) * PIXEL).alias("x"), ((F.col("row") + 0.5) * PIXEL).alias("y"))
    return raster.lookup(empty, layers.land(spark, d), LAND).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


RASTER_LOOKUP = with_layers("pixels land", """
SELECT class, count(*) AS n FROM (SELECT CAST(floor((col + 0.5) / 5) AS BIGINT) AS c, CAST(floor((row + 0.5) / 5) AS BIGINT) AS r FROM pixels WHERE value IS NULL) p LEFT JOIN land l ON l.col = p.c AND l.row = p.r GROUP BY class""")


def grid_comparison(spark: SparkSession, d: str) -> DataFrame:
    other = layers.read(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 200).alias("row"), (F.floor(F.col("l_orderkey") / 200) % 200).cast("long").alias("col")).agg(F.floor(F.sum("l_extendedprice")).alias("value"))
    out = audit.compare_grids(layers.pixels(spark, d), other, 1000.0)
    return out.select(F.round("rho", 6).alias("rho"), "n", F.round("mean_diff", 2).alias("mean_diff"), F.round("median_diff", 2).alias("median_diff"), *rounded("median_rel", "undefined_share"))


GRID_COMPARISON = with_layers("pixels", """
WITH o AS (SELECT l_orderkey % 200 AS row, CAST(floor(l_orderkey / 200) AS BIGINT) % 200 AS col, floor(round(sum(l_extendedprice), 4)) AS other FROM lineitem GROUP BY 1, 2),
b AS (SELECT value, other, abs(value - other) AS d, CASE WHEN greatest(value, other) >= 1000 THEN abs(value - other) / greatest(value, other) END AS r FROM pixels JOIN o USING (col, row) WHERE value IS NOT NULL),
k AS (SELECT *, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2 AS ra, rank() OVER (ORDER BY other) + (count(*) OVER (PARTITION BY other) - 1) / 2 AS rb FROM b)
SELECT round(corr(ra, rb), 6) AS rho, count(*) AS n, round(avg(d), 2) AS mean_diff, round(quantile_cont(d, 0.5), 2) AS median_diff, round(quantile_cont(r, 0.5), 6) AS median_rel, round(avg(CASE WHEN r IS NULL THEN 1.0 ELSE 0 END), 6) AS undefined_share FROM k""")  # fmt: skip


def population_strata(spark: SparkSession, d: str) -> DataFrame:
    return audit.strata(layers.pixels(spark, d))


STRATA = with_layers("pixels", """
WITH c AS (SELECT value FROM pixels WHERE value > 0),
m AS (SELECT quantile_cont(value, 0.6) AS a, quantile_cont(value, 0.9) AS b FROM c)
SELECT CASE WHEN value >= b THEN 'high' WHEN value >= a THEN 'middle' ELSE 'low' END AS stratum, count(*) AS cells, sum(value) AS total, quantile_cont(value, 0.5) AS median FROM c, m GROUP BY 1""")


def grid_summary(spark: SparkSession, d: str) -> DataFrame:
    out = audit.grid_summary(layers.pixels(spark, d))
    return out.select("total", *rounded("nonzero_share", "p05", "p25", "p50", "p75", "p95"), "max")


GRID_SUMMARY = with_layers("pixels", "SELECT sum(value) AS total, round(avg(CASE WHEN value > 0 THEN 1.0 ELSE 0 END), 6) AS nonzero_share, " + ", ".join(f"round(quantile_cont(value, {p}), 6) AS {n}" for n, p in (("p05", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95))) + ", max(value) AS max FROM pixels WHERE value IS NOT NULL")


def water_stratum(spark: SparkSession, d: str) -> DataFrame:
    """Population of cells with over a tenth of water against the others."""
    cover = raster.class_fractions(raster.pixel_weights(layers.land(spark, d), LAND, UNIT), LAND, UNIT, {"water": [80]})
    people = raster.weighted_sum(raster.pixel_weights(layers.pixels(spark, d), PIXEL, UNIT), PIXEL, UNIT)
    joined = people.join(cover.select("u_col", "u_row", "water_ratio"), ["u_col", "u_row"], "left")
    return joined.groupBy((F.coalesce("water_ratio", F.lit(0.0)) > 0.1).alias("water")).agg(F.count(F.lit(1)).alias("cells"), F.sum("total").alias("total"), F.percentile("total", 0.5).alias("median"))


WATER = with_layers("pixels land", """
WITH p AS (SELECT CAST(floor(col / 10) AS BIGINT) AS c, CAST(floor(row / 10) AS BIGINT) AS r, coalesce(sum(value), 0) AS total FROM pixels GROUP BY 1, 2),
l AS (SELECT CAST(floor(col / 2) AS BIGINT) AS c, CAST(floor(row / 2) AS BIGINT) AS r, count(*) FILTER (class = 80) * 0.25 AS water FROM land GROUP BY 1, 2)
SELECT coalesce(water, 0) > 0.1 AS water, count(*) AS cells, sum(total) AS total, quantile_cont(total, 0.5) AS median FROM p LEFT JOIN l USING (c, r) GROUP BY 1""")


def empty_edges(spark: SparkSession, d: str) -> DataFrame:
    return raster.empty_edges(layers.pixels(spark, d), 200)


EMPTY_EDGES = with_layers("pixels", "SELECT coalesce(min(row), 200) AS leading, coalesce(199 - max(row), 0) AS trailing FROM pixels WHERE value IS NOT NULL")

QUERIES = {
    "area_weighted_sum": (area_weighted_sum, AREA_WEIGHTED),
    "class_fractions": (class_fractions, CLASS_FRACTIONS),
    "zonal_entropy": (zonal_entropy, ZONAL_ENTROPY),
    "zonal_builtup": (zonal_builtup, ZONAL_BUILTUP),
    "builtup_masked": (builtup_masked, BUILTUP_MASKED),
    "disk_convolution": (disk_convolution, DISK),
    "conservation_check": (conservation_check, CONSERVATION),
    "raster_lookup": (raster_lookup, RASTER_LOOKUP),
    "grid_comparison": (grid_comparison, GRID_COMPARISON),
    "population_strata": (population_strata, STRATA),
    "grid_summary": (grid_summary, GRID_SUMMARY),
    "water_stratum": (water_stratum, WATER),
    "empty_edges": (empty_edges, EMPTY_EDGES),
}
