"""Queries on units and joins by place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import geometry, grid
from terrace.operators import audit, features, polygons, spatial_join
from terrace.sources import layers
from terrace.sources.layers import with_layers

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def rounded(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def _centres(spark: SparkSession) -> DataFrame:
    units = features.centres(layers.units(spark))
    return units.withColumn("radius", features.complete_radius(layers.SIDE))


def cell_lookup(spark: SparkSession, d: str) -> DataFrame:
    points = layers.pois(spark, d)
    x, y = F.col("x"), F.col("y")
    (c, r), (q, h) = grid.square_index(x, y, 750.0, 125.0, 125.0), grid.hex_index(x, y, 400.0)
    named = points.select("poi_id", grid.square_id("sq750", c, r).alias("unit_id"), q.alias("hex_q"), h.alias("hex_r"))
    back = grid.parse_square_id(F.col("unit_id"))
    return named.withColumns({"col": back[0], "row": back[1]})


CELL_LOOKUP = with_layers("pois", """
WITH h AS (SELECT poi_id, x, y, (sqrt(3) / 3 * x - y / 3) / 400.0::DOUBLE AS q, (2.0::DOUBLE / 3 * y) / 400.0::DOUBLE AS r FROM pois),
c AS (SELECT *, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(-q - r + 0.5) AS rs FROM h),
e AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs + q + r) AS ds FROM c),
k AS (SELECT *, CAST(floor((x - 125) / 750) AS BIGINT) AS col, CAST(floor((y - 125) / 750) AS BIGINT) AS row FROM e)
SELECT poi_id, 'sq750|' || col || '_' || row AS unit_id, col, row,
       CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS hex_q,
       CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS hex_r
FROM k""")  # fmt: skip


def cell_counts(spark: SparkSession, d: str) -> DataFrame:
    c, r = grid.square_index(F.col("x"), F.col("y"), layers.UNIT)
    counted = layers.pois(spark, d).groupBy(c.alias("col"), r.alias("row")).agg(*[F.count_if(F.col("category") == s).alias(s.lower()) for s in SEGMENTS], F.sum("weight").alias("weight"))
    joined = layers.units(spark).join(counted, ["col", "row"], "left")
    return joined.select("unit_id", *[F.coalesce(s.lower(), F.lit(0)).alias(s.lower()) for s in SEGMENTS], F.round(F.coalesce("weight", F.lit(0.0)), 4).alias("weight"))


CELL_COUNTS = with_layers("pois units", """
SELECT unit_id, """ + ", ".join(f"count(*) FILTER (category = '{s}') AS {s.lower()}" for s in SEGMENTS) + """, round(coalesce(sum(weight), 0), 4) AS weight
FROM units u LEFT JOIN pois p ON floor(p.x / 1000) = u.col AND floor(p.y / 1000) = u.row GROUP BY unit_id""")  # fmt: skip

SPECS = [features.Count("shops_1km", ["AUTOMOBILE", "BUILDING"]), features.Count("all_1km", SEGMENTS), features.Count("machinery_3km", ["MACHINERY"], features.REGIONAL)]


def distance_counts(spark: SparkSession, d: str) -> DataFrame:
    units = _centres(spark)
    found = features.counts(units, layers.pois(spark, d), SPECS, SEGMENTS)
    names = [*[s.name for s in SPECS], "richness"]
    return features.count_statuses(found.join(units.select("unit_id", "radius"), "unit_id"), names).drop("radius")


_DISTANCE_BODY = """
WITH c AS (SELECT *, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM units),
r AS (SELECT *, greatest(0, least(x, y, 20000 - x, 20000 - y)) AS radius FROM c),
m AS (SELECT r.unit_id, p.category, sqrt((r.x - p.x) * (r.x - p.x) + (r.y - p.y) * (r.y - p.y)) AS dist
      FROM r JOIN pois p ON (r.x - p.x) * (r.x - p.x) + (r.y - p.y) * (r.y - p.y) <= 9000000),
n AS (SELECT unit_id, count(*) FILTER (category IN ('AUTOMOBILE', 'BUILDING') AND dist <= 1000) AS shops_1km, count(*) FILTER (dist <= 1000) AS all_1km,
             count(*) FILTER (category = 'MACHINERY') AS machinery_3km, count(DISTINCT CASE WHEN dist <= 1000 THEN category END) AS richness FROM m GROUP BY unit_id)
"""
DISTANCE_COUNTS = with_layers("pois units", _DISTANCE_BODY + "SELECT r.unit_id, " + ", ".join(
    f"CASE WHEN radius >= 3000 THEN CAST(coalesce({n}, 0) AS DOUBLE) END AS {n}, CASE WHEN radius >= 3000 THEN 'ok' ELSE 'coverage_incomplete' END AS {n}_status"
    for n in ("shops_1km", "all_1km", "machinery_3km", "richness")) + " FROM r LEFT JOIN n USING (unit_id)")


def nearest_distance_status(spark: SparkSession, d: str) -> DataFrame:
    targets = layers.places(spark, d).where("category = 'MACHINERY'")
    out = features.nearest_distance(_centres(spark), targets, 5000.0, "distance_m")
    return out.select("unit_id", *rounded("distance_m"), "distance_m_status")


NEAREST = with_layers("places units", """
WITH c AS (SELECT *, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM units),
r AS (SELECT *, greatest(0, least(x, y, 20000 - x, 20000 - y)) AS radius FROM c),
m AS (SELECT r.unit_id, any_value(radius) AS radius, min(sqrt((r.x - p.x) * (r.x - p.x) + (r.y - p.y) * (r.y - p.y))) AS dist
      FROM r LEFT JOIN places p ON p.category = 'MACHINERY' GROUP BY r.unit_id),
s AS (SELECT *, CASE WHEN dist <= 5000 AND dist <= radius THEN 'ok' WHEN radius >= 5000 THEN 'not_found_within_cap' ELSE 'search_truncated_by_extract' END AS st FROM m)
SELECT unit_id, CASE WHEN st = 'ok' THEN round(dist, 6) END AS distance_m, st AS distance_m_status FROM s""")  # fmt: skip


def proximity_match(spark: SparkSession, d: str) -> DataFrame:
    return audit.matches(layers.pois(spark, d), layers.places(spark, d), 300.0, "category", "poi_id")


PROXIMITY = with_layers("pois places", """
WITH f AS (SELECT category, EXISTS (SELECT 1 FROM places q WHERE q.category = p.category AND (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= 90000) AS hit FROM pois p)
SELECT category, count(*) FILTER (hit) AS matched, count(*) FILTER (NOT hit) AS alone FROM f GROUP BY category""")


def kring_neighbors(spark: SparkSession, d: str) -> DataFrame:
    c, r = grid.square_index(F.col("x"), F.col("y"), layers.UNIT)
    units = layers.units(spark)
    counted = layers.pois(spark, d).groupBy(c.alias("col"), r.alias("row")).agg(F.count(F.lit(1)).alias("n"))
    filled = units.join(counted, ["col", "row"], "left").select("unit_id", F.coalesce("n", F.lit(0)).alias("n"))
    pairs = grid.neighbours(units, "unit_id", "col", "row", grid.square_ring(1))
    near = pairs.join(filled.select(F.col("unit_id").alias("neighbour"), "n"), "neighbour")
    return near.groupBy("unit_id").agg(F.count(F.lit(1)).alias("neighbours"), F.sum("n").alias("ring_count"))


KRING = with_layers("pois units", """
WITH n AS (SELECT u.unit_id, u.col, u.row, count(p.poi_id) AS n FROM units u LEFT JOIN pois p ON floor(p.x / 1000) = u.col AND floor(p.y / 1000) = u.row GROUP BY ALL)
SELECT a.unit_id, count(*) AS neighbours, CAST(sum(b.n) AS BIGINT) AS ring_count FROM n a JOIN n b ON abs(a.col - b.col) <= 1 AND abs(a.row - b.row) <= 1 AND a.unit_id <> b.unit_id GROUP BY a.unit_id""")


def hex_neighbors(spark: SparkSession, d: str) -> DataFrame:
    q, r = grid.hex_index(F.col("x"), F.col("y"), 600.0)
    cells = layers.pois(spark, d).groupBy(q.alias("q"), r.alias("r")).agg(F.count(F.lit(1)).alias("n"))
    named = cells.withColumn("cell", F.concat_ws("_", F.col("q").cast("string"), F.col("r").cast("string")))
    return grid.neighbours(named, "cell", "q", "r", grid.hex_ring(1)).groupBy("cell").agg(F.count(F.lit(1)).alias("present"))


HEX_NEIGHBORS = with_layers("pois", """
WITH h AS (SELECT (sqrt(3) / 3 * x - y / 3) / 600.0::DOUBLE AS q, (2.0::DOUBLE / 3 * y) / 600.0::DOUBLE AS r FROM pois),
c AS (SELECT *, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(-q - r + 0.5) AS rs FROM h),
e AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs + q + r) AS ds FROM c),
k AS (SELECT DISTINCT CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS q, CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS r FROM e)
SELECT a.q || '_' || a.r AS cell, count(*) AS present FROM k a JOIN k b ON abs(a.q - b.q) <= 1 AND abs(a.r - b.r) <= 1 AND abs(a.q - b.q + a.r - b.r) <= 1 AND (a.q <> b.q OR a.r <> b.r) GROUP BY 1""")  # fmt: skip


def first_box(spark: SparkSession, d: str) -> DataFrame:
    boxes = layers.units(spark).select("unit_id", (F.col("row") * 20 + F.col("col")).alias("ord"), *[(F.col(c) - 100).alias(c) for c in ("x0", "y0")], *[(F.col(c) + 100).alias(c) for c in ("x1", "y1")])
    return spatial_join.in_boxes(layers.pois(spark, d), boxes, "poi_id", "unit_id", "ord", layers.UNIT)


FIRST_BOX = with_layers("pois units", """
SELECT p.poi_id, arg_min(u.unit_id, u.row * 20 + u.col) AS unit_id FROM pois p LEFT JOIN units u ON p.x BETWEEN u.x0 - 100 AND u.x1 + 100 AND p.y BETWEEN u.y0 - 100 AND u.y1 + 100 GROUP BY p.poi_id""")


def polygon_overlap(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    side = ((F.col("p_size") % 10 + 1) * 50).cast("double")
    shapes = layers.read(spark, d, "part").select((p * 7919 % 380 * 50).cast("double").alias("x0"), (p * 104_729 % 380 * 50).cast("double").alias("y0"), side.alias("side"))
    boxes = shapes.select("x0", "y0", (F.col("x0") + F.col("side")).alias("x1"), (F.col("y0") + F.col("side")).alias("y1"))
    return spatial_join.overlap_areas(boxes, 1000.0, 50.0)


POLYGON_OVERLAP = """
WITH b AS (SELECT p_partkey * 7919 % 380 AS gx, p_partkey * 104729 % 380 AS gy, p_size % 10 + 1 AS n FROM part),
c AS (SELECT DISTINCT gx + i AS gx, gy + j AS gy FROM (SELECT gx, gy, n, unnest(range(n)) AS i FROM b) JOIN (SELECT unnest(range(10)) AS j) ON j < n)
SELECT CAST(floor(gx * 50 / 1000.0) AS BIGINT) AS col, CAST(floor(gy * 50 / 1000.0) AS BIGINT) AS row, CAST(count(*) * 2500 AS DOUBLE) AS area FROM c GROUP BY 1, 2"""


def utm_projection(spark: SparkSession, d: str) -> DataFrame:
    points = layers.read(spark, d, "customer").select("c_custkey", ((F.col("c_custkey") * 7919 % 36_000) / 100.0 - 180).alias("lon"), ((F.col("c_custkey") * 104_729 % 16_000) / 100.0 - 80).alias("lat"))
    zone = grid.utm_zone(F.col("lon"))
    east, north = grid.utm(F.col("lon"), F.col("lat"), zone)
    return points.select("c_custkey", zone.alias("zone"), F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


_N = 0.0016792203863836474
_A = 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_C = 2 * _N**0.5 / (1 + _N)
UTM = f"""
WITH p AS (SELECT c_custkey, CAST(c_custkey * 7919 % 36000 AS DOUBLE) / 100 - 180 AS lon, CAST(c_custkey * 104729 % 16000 AS DOUBLE) / 100 - 80 AS lat FROM customer),
z AS (SELECT *, CAST(floor((lon + 180) / 6) + 1 AS INTEGER) AS zone, sin(radians(lat)) AS s FROM p),
t AS (SELECT *, sinh(atanh(s) - {_C!r}::DOUBLE * atanh({_C!r}::DOUBLE * s)) AS t, radians(lon - (zone * 6 - 183)) AS dl FROM z),
x AS (SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t * t)) AS eta FROM t)
SELECT c_custkey, zone,
  round(500000 + 0.9996::DOUBLE * {_A!r}::DOUBLE * (eta + {" + ".join(f"{k!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, k in enumerate(_ALPHA, 1))}), 3) AS east,
  round(CASE WHEN lat < 0 THEN 10000000 ELSE 0 END + 0.9996::DOUBLE * {_A!r}::DOUBLE * (xi + {" + ".join(f"{k!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, k in enumerate(_ALPHA, 1))}), 3) AS north
FROM x"""


def tile_cover(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    w, s = k * 7919 % 3400 / 10.0 - 170, k * 104_729 % 1500 / 10.0 - 75
    box = [grid.outward(v, 4, up) for v, up in ((w - 0.75, False), (s - 0.75, False), (w + 0.75, True), (s + 0.75, True))]
    return layers.read(spark, d, "customer").select("c_custkey", F.explode(grid.tiles(*box, 3)).alias("t")).groupBy(F.col("t.x").alias("x"), F.col("t.y").alias("y")).agg(F.count(F.lit(1)).alias("boxes"))


TILE_COVER = """
WITH b AS (SELECT CAST(c_custkey * 7919 % 3400 AS DOUBLE) / 10 - 170 AS w, CAST(c_custkey * 104729 % 1500 AS DOUBLE) / 10 - 75 AS s FROM customer),
o AS (SELECT floor((w - 0.75) * 10000) / 10000 AS x0, floor((s - 0.75) * 10000) / 10000 AS y0, ceil((w + 0.75) * 10000) / 10000 AS x1, ceil((s + 0.75) * 10000) / 10000 AS y1 FROM b),
x AS (SELECT y0, y1, unnest(range(CAST(floor(x0 / 3) * 3 AS BIGINT), CAST(ceil(x1 / 3) * 3 AS BIGINT), 3)) AS x FROM o),
t AS (SELECT x, unnest(range(CAST(floor(y0 / 3) * 3 AS BIGINT), CAST(ceil(y1 / 3) * 3 AS BIGINT), 3)) AS y FROM x)
SELECT CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, count(*) AS boxes FROM t GROUP BY x, y"""


def feature_flagship(spark: SparkSession, d: str) -> DataFrame:
    """Population, its density on land, counts and a distance for every unit, each with its status."""
    from terrace.operators import raster

    units = _centres(spark)
    cells = {"u_col": "col", "u_row": "row"}
    people = raster.weighted_sum(raster.pixel_weights(layers.pixels(spark, d), layers.PIXEL, layers.UNIT, 30.0), layers.PIXEL, layers.UNIT).withColumnsRenamed(cells).select("col", "row", F.col("total").alias("population"))
    cover = raster.class_fractions(raster.pixel_weights(layers.land(spark, d), layers.LAND, layers.UNIT), layers.LAND, layers.UNIT, {}).withColumnsRenamed(cells)
    base = units.join(people, ["col", "row"], "left").join(cover, ["col", "row"], "left")
    base = base.withColumns({"population": F.coalesce("population", F.lit(0.0)), "land_km2": F.coalesce("land_share", F.lit(0.0)), "valid_share": F.coalesce("valid_share", F.lit(0.0))})
    dense = features.density(base, "population_density", "population", "land_km2", 1.0, F.col("valid_share") >= 0.999)
    counted = features.count_statuses(features.counts(units, layers.pois(spark, d), SPECS, SEGMENTS).join(units.select("unit_id", "radius"), "unit_id"), ["all_1km", "richness"]).select("unit_id", "all_1km", "all_1km_status", "richness", "richness_status")
    near = nearest_distance_status(spark, d)
    wide = dense.join(counted, "unit_id").join(near, "unit_id")
    names = ["population_density_status", "all_1km", "all_1km_status", "richness", "richness_status", "distance_m", "distance_m_status"]
    return wide.select("unit_id", F.round("population", 4).alias("population"), F.round("land_km2", 6).alias("land_km2"), F.round("population_density", 4).alias("population_density"), *names)


FLAGSHIP = with_layers("pois places units pixels land", _DISTANCE_BODY.strip() + """,
g AS (SELECT CAST(floor((i + 0.0) / 1) AS BIGINT) AS i FROM range(20) t(i)),
w AS (
  SELECT a.i AS col, b.i AS row, value,
    greatest(0, least(p.col * 100 + 130, (a.i + 1) * 1000) - greatest(p.col * 100 + 30, a.i * 1000)) / 100.0::DOUBLE * (greatest(0, least(p.row * 100 + 130, (b.i + 1) * 1000) - greatest(p.row * 100 + 30, b.i * 1000)) / 100.0::DOUBLE) AS f
  FROM pixels p JOIN g a ON a.i IN (CAST(floor((p.col * 100 + 30) / 1000) AS BIGINT), CAST(floor((p.col * 100 + 129) / 1000) AS BIGINT)) JOIN g b ON b.i IN (CAST(floor((p.row * 100 + 30) / 1000) AS BIGINT), CAST(floor((p.row * 100 + 129) / 1000) AS BIGINT))),
pop AS (SELECT col, row, coalesce(sum(value * f), 0) AS population FROM w GROUP BY col, row),
lc AS (SELECT CAST(floor(col / 2) AS BIGINT) AS col, CAST(floor(row / 2) AS BIGINT) AS row, count(*) FILTER (class <> 0) * 0.25::DOUBLE AS valid_share, count(*) FILTER (class NOT IN (0, 80)) * 0.25::DOUBLE AS land FROM land GROUP BY 1, 2),
b AS (SELECT r.unit_id, r.radius, coalesce(population, 0) AS population, coalesce(valid_share, 0) AS valid_share, coalesce(land, 0) AS land_km2 FROM r LEFT JOIN pop USING (col, row) LEFT JOIN lc USING (col, row)),
st AS (SELECT *, CASE WHEN valid_share < 0.999 THEN 'coverage_incomplete' WHEN land_km2 <= 0 THEN 'denominator_zero' WHEN land_km2 < 0.01 THEN 'denominator_below_minimum' ELSE 'ok' END AS ds FROM b),
nd AS (SELECT r.unit_id, any_value(radius) AS radius, min(sqrt((r.x - p.x) * (r.x - p.x) + (r.y - p.y) * (r.y - p.y))) AS dist FROM r LEFT JOIN places p ON p.category = 'MACHINERY' GROUP BY r.unit_id),
ns AS (SELECT unit_id, dist, CASE WHEN dist <= 5000 AND dist <= radius THEN 'ok' WHEN radius >= 5000 THEN 'not_found_within_cap' ELSE 'search_truncated_by_extract' END AS st FROM nd)
SELECT st.unit_id, round(population, 4) AS population, round(land_km2, 6) AS land_km2, CASE WHEN ds = 'ok' THEN round(population / land_km2, 4) END AS population_density, ds AS population_density_status,
  CASE WHEN radius >= 3000 THEN CAST(coalesce(all_1km, 0) AS DOUBLE) END AS all_1km, CASE WHEN radius >= 3000 THEN 'ok' ELSE 'coverage_incomplete' END AS all_1km_status,
  CASE WHEN radius >= 3000 THEN CAST(coalesce(richness, 0) AS DOUBLE) END AS richness, CASE WHEN radius >= 3000 THEN 'ok' ELSE 'coverage_incomplete' END AS richness_status,
  CASE WHEN ns.st = 'ok' THEN round(dist, 6) END AS distance_m, ns.st AS distance_m_status
FROM st LEFT JOIN n USING (unit_id) JOIN ns USING (unit_id)""")  # fmt: skip

def _triangles(spark: SparkSession, d: str) -> DataFrame:
    """A triangle at every supplier, by whole numbers."""
    s = F.col("s_suppkey")
    x, y = (s * 6007 % 18_000).cast("double"), (s * 15_013 % 18_000).cast("double")
    corners = ((x, y), (x + s % 13 * 100 + 300, y + s % 5 * 100), (x + s % 7 * 100, y + s % 11 * 100 + 500))
    return layers.read(spark, d, "supplier").select(s.alias("shape"), geometry.ring(*corners).alias("ring"))


_TRIANGLES = """t AS (SELECT s_suppkey AS shape, CAST(s_suppkey * 6007 % 18000 AS DOUBLE) AS ax, CAST(s_suppkey * 15013 % 18000 AS DOUBLE) AS ay, CAST(s_suppkey * 6007 % 18000 + s_suppkey % 13 * 100 + 300 AS DOUBLE) AS bx, CAST(s_suppkey * 15013 % 18000 + s_suppkey % 5 * 100 AS DOUBLE) AS b_y,
  CAST(s_suppkey * 6007 % 18000 + s_suppkey % 7 * 100 AS DOUBLE) AS cx, CAST(s_suppkey * 15013 % 18000 + s_suppkey % 11 * 100 + 500 AS DOUBLE) AS cy FROM supplier)"""


def polygon_points(spark: SparkSession, d: str) -> DataFrame:
    """Points inside each triangle or on its edge."""
    return polygons.counts_in(layers.pois(spark, d), _triangles(spark, d), "poi_id", "shape", 500.0)


POLYGON_POINTS = with_layers("pois", "WITH " + _TRIANGLES + """,
s AS (SELECT shape, poi_id, (bx - ax) * (y - ay) - (b_y - ay) * (x - ax) AS e1, (cx - bx) * (y - b_y) - (cy - b_y) * (x - bx) AS e2, (ax - cx) * (y - cy) - (ay - cy) * (x - cx) AS e3
      FROM t JOIN pois ON x BETWEEN least(ax, bx, cx) AND greatest(ax, bx, cx) AND y BETWEEN least(ay, b_y, cy) AND greatest(ay, b_y, cy))
SELECT shape, count(*) AS n, min(poi_id) AS first FROM s WHERE (e1 >= 0 AND e2 >= 0 AND e3 >= 0) OR (e1 <= 0 AND e2 <= 0 AND e3 <= 0) GROUP BY shape""")


def polygon_cells(spark: SparkSession, d: str) -> DataFrame:
    """Triangles cut at cells of 300 m: their pieces hold the triangle's area together. One without area has no piece, and sums of 0."""
    shapes = _triangles(spark, d)
    sums = polygons.cell_overlaps(shapes.distinct(), "shape", 300.0).groupBy("shape").agg(F.sum("area").alias("area"), F.max("area").alias("largest"))
    every = shapes.select("shape", geometry.area(F.col("ring")).alias("whole")).join(sums, "shape", "left").fillna(0.0, ["area", "largest"])
    return every.select("shape", F.round("area", 3).alias("area"), (F.abs(F.col("area") - F.col("whole")) < 1e-3).alias("conserved"), (F.col("largest") <= 90_000.001).alias("fits"))


POLYGON_CELLS = "WITH " + _TRIANGLES + " SELECT shape, round(abs((bx - ax) * (cy - ay) - (b_y - ay) * (cx - ax)) / 2, 3) AS area, true AS conserved, true AS fits FROM t"

QUERIES = {
    "feature_flagship": (feature_flagship, FLAGSHIP),
    "cell_lookup": (cell_lookup, CELL_LOOKUP),
    "cell_counts": (cell_counts, CELL_COUNTS),
    "distance_counts": (distance_counts, DISTANCE_COUNTS),
    "nearest_distance_status": (nearest_distance_status, NEAREST),
    "proximity_match": (proximity_match, PROXIMITY),
    "kring_neighbors": (kring_neighbors, KRING),
    "hex_neighbors": (hex_neighbors, HEX_NEIGHBORS),
    "first_box": (first_box, FIRST_BOX),
    "polygon_overlap": (polygon_overlap, POLYGON_OVERLAP),
    "utm_projection": (utm_projection, UTM),
    "tile_cover": (tile_cover, TILE_COVER),
    "polygon_points": (polygon_points, POLYGON_POINTS),
    "polygon_cells": (polygon_cells, POLYGON_CELLS),
}
