"""The table of all atomic features over the driver's tables, and its SQL, block by block."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import grid, strings
from terrace.operators import atomic, experiment, features, graph, normalize
from terrace.plans import normalised
from terrace.plans.roads import _CLIPPED
from terrace.sources import layers
from terrace.sources.layers import with_layers

#: Caps of the query's searches: a tenth of the contract's, so that a square of 20 km has units that are searched completely.
CAPS = {t: cap / 10 for t, cap in atomic.CAPS.items()}
#: Metres by which the population's pixels are shifted against the units, and grid of the sites.
SHIFT, GRAIN = 30.0, 50.0


def entities(spark: SparkSession, d: str) -> DataFrame:
    """Points with one of the categories of the contract: kind, id, x, y, category, is_park."""
    k = F.col("poi_id")
    named = F.array(*[F.lit(c) for c in atomic.CATEGORIES])
    return layers.pois(spark, d).select(F.lit("node").alias("kind"), k.alias("id"), "x", "y", F.element_at(named, (k * 31 % len(atomic.CATEGORIES) + 1).cast("int")).alias("category"), (k % 2 == 0).alias("is_park"))


def sites(spark: SparkSession, d: str) -> DataFrame:
    """Boxes on a grid of 50 m, industrial sites and parks: kind, id, x0, y0, x1, y1, category."""
    s = F.col("s_suppkey")
    x, y, side = (s * 7919 % 380 * 50).cast("double"), (s * 104_729 % 380 * 50).cast("double"), ((s % 10 + 1) * 50).cast("double")
    return layers.read(spark, d, "supplier").select(F.lit("way").alias("kind"), s.alias("id"), x.alias("x0"), y.alias("y0"), (x + side).alias("x1"), (y + side).alias("y1"), F.when(s % 3 < 2, "industrial_site").otherwise("park_area").alias("category"))


def surface(spark: SparkSession) -> DataFrame:
    """Built-up share of every 100 m pixel of the square; a few have no data."""
    i = F.col("id")
    return spark.range(40_000).select(F.floor(i / 200).cast("long").alias("row"), (i % 200).alias("col"), F.when(i % 997 != 0, (i * 7919 % 101) / 100.0).alias("value"))


def inputs(spark: SparkSession, d: str) -> atomic.Inputs:
    """The bundle that the features are computed from."""
    units = features.centres(layers.units(spark)).withColumn("radius", features.complete_radius(layers.SIDE))
    failed = F.when(F.col("col") < 10, F.array(F.lit("marketplace"))).otherwise(F.array().cast("array<string>"))
    edges = graph.way_edges(layers.nodes(spark, d))
    n = F.col("node")
    crossings = graph.degrees(edges).where("degree >= 3").select((n * 7919 % 20_000).cast("double").alias("x"), (n * 104_729 % 20_000).cast("double").alias("y"))
    return atomic.Inputs(
        units=units.withColumns({"source_ok": F.col("row") != 19, "failed": failed}), unit=float(layers.UNIT),
        population=atomic.Raster(layers.pixels(spark, d), float(layers.PIXEL), SHIFT, 200), cover=atomic.Raster(layers.land(spark, d), float(layers.LAND)), built=atomic.Raster(surface(spark), float(layers.PIXEL)),
        roads=edges.select("ax", "ay", "bx", F.col("by"), "is_major"), crossings=crossings, entities=entities(spark, d), sites=sites(spark, d), grain=GRAIN,
    )


def atomic_features(spark: SparkSession, d: str) -> DataFrame:
    """All features of the contract for every unit; numbers rounded for the comparison."""
    table = atomic.atomic_features(inputs(spark, d), CAPS)
    return table.select(*[F.round(n, 4).alias(n) if kind == "double" else F.col(n) for n, kind in table.dtypes])


_ENTITIES = f"entities AS (SELECT 'node' AS kind, poi_id AS id, x, y, {atomic.CATEGORIES!r}[poi_id * 31 % {len(atomic.CATEGORIES)} + 1] AS category, poi_id % 2 = 0 AS is_park FROM pois)"
_SITES = """sites AS (SELECT 'way' AS kind, s_suppkey AS id, x AS x0, y AS y0, x + side AS x1, y + side AS y1, CASE WHEN s_suppkey % 3 < 2 THEN 'industrial_site' ELSE 'park_area' END AS category
  FROM (SELECT s_suppkey, CAST(s_suppkey * 7919 % 380 * 50 AS DOUBLE) AS x, CAST(s_suppkey * 104729 % 380 * 50 AS DOUBLE) AS y, CAST((s_suppkey % 10 + 1) * 50 AS DOUBLE) AS side FROM supplier))"""


def _in(names: list[str]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _sql() -> str:
    specs = atomic.count_specs()
    hits = ",\n  ".join(f"count(*) FILTER (category IN {_in(s.categories)} AND dist <= {s.radius}) AS {s.name}" for s in specs)
    points = {t: atomic.ROLLUPS.get(t, [t]) for t in ("transit_stop", "transport_hub", "higher_education", "hospital")}
    shapes = [f"SELECT '{t}' AS target, x AS x0, y AS y0, x AS x1, y AS y1 FROM entities WHERE category IN {_in(c)}" for t, c in points.items()]
    shapes += ["SELECT 'park', x, y, x, y FROM entities WHERE category = 'park_recreation' AND is_park"]
    shapes += [f"SELECT '{t}', x0, y0, x1, y1 FROM sites WHERE category = '{c}'" for c, t in atomic.AREA_TARGETS.items()]
    body = f"""
WITH {_CLIPPED.strip()},
{_ENTITIES},
{_SITES},
surface AS (SELECT i // 200 AS row, i % 200 AS col, CASE WHEN i % 997 <> 0 THEN (i * 7919 % 101) / 100.0::DOUBLE END AS value FROM range(40000) t(i)),
u AS (SELECT unit_id, col, row, x, y, row <> 19 AS source_ok, col < 10 AS broken, greatest(0, least(x, y, 20000 - x, 20000 - y)) AS radius,
        greatest(0, least(x0 + 1000, 20030) - greatest(x0, 30)) / 1000.0::DOUBLE * (greatest(0, least(y0 + 1000, 20030) - greatest(y0, 30)) / 1000.0::DOUBLE) AS win
      FROM (SELECT *, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM units)),
cell AS (SELECT CAST(i AS BIGINT) AS i FROM range(20) t(i)),
px AS (SELECT a.i AS col, b.i AS row, value,
         greatest(0, least(p.col * 100 + 130, (a.i + 1) * 1000) - greatest(p.col * 100 + 30, a.i * 1000)) / 100.0::DOUBLE * (greatest(0, least(p.row * 100 + 130, (b.i + 1) * 1000) - greatest(p.row * 100 + 30, b.i * 1000)) / 100.0::DOUBLE) AS f
       FROM pixels p JOIN cell a ON a.i IN ((p.col * 100 + 30) // 1000, (p.col * 100 + 129) // 1000) JOIN cell b ON b.i IN ((p.row * 100 + 30) // 1000, (p.row * 100 + 129) // 1000)),
pop AS (SELECT col, row, coalesce(sum(value * f), 0) AS people, coalesce(sum(f) FILTER (value IS NOT NULL), 0) * 0.01::DOUBLE AS pv FROM px GROUP BY 1, 2),
lc AS (SELECT col // 2 AS col, row // 2 AS row, count(*) FILTER (class <> 0) * 0.25::DOUBLE AS valid, count(*) FILTER (class NOT IN (0, 80)) * 0.25::DOUBLE AS land,
         {", ".join(f"count(*) FILTER (class IN ({', '.join(map(str, c))})) * 0.25::DOUBLE AS {n}" for n, c in atomic.LAND_RATIOS.items())} FROM land GROUP BY 1, 2),
dry AS (SELECT row, col FROM land WHERE class NOT IN (0, 80)),
bu AS (SELECT s.col // 10 AS col, s.row // 10 AS row, count(value) * 0.01::DOUBLE AS bv, coalesce(sum(value) FILTER (dry.col IS NOT NULL), 0) * 10000 AS built
       FROM surface s LEFT JOIN dry ON dry.col = s.col // 5 AND dry.row = s.row // 5 GROUP BY 1, 2),
km AS (SELECT col, row, sum(length) / 1000 AS km, coalesce(sum(length) FILTER (is_major), 0) / 1000 AS major FROM clipped GROUP BY 1, 2),
cr AS (SELECT node * 7919 % 20000 // 1000 AS col, node * 104729 % 20000 // 1000 AS row, count(*) AS crossings
       FROM (SELECT node FROM (SELECT a AS node FROM segments UNION ALL SELECT b FROM segments) GROUP BY node HAVING count(*) >= 3) GROUP BY 1, 2),
gr AS (SELECT DISTINCT gx + i AS gx, gy + j AS gy FROM (SELECT CAST(x0 / 50 AS BIGINT) AS gx, CAST(y0 / 50 AS BIGINT) AS gy, CAST((x1 - x0) / 50 AS BIGINT) AS n FROM sites WHERE category = 'industrial_site') JOIN range(10) a(i) ON i < n JOIN range(10) b(j) ON j < n),
si AS (SELECT gx // 20 AS col, gy // 20 AS row, count(*) * 2500 AS site_m2 FROM gr JOIN dry ON dry.col = gx // 10 AND dry.row = gy // 10 GROUP BY 1, 2),
met AS (SELECT u.unit_id, p.category, sqrt((u.x - p.x) * (u.x - p.x) + (u.y - p.y) * (u.y - p.y)) AS dist FROM u JOIN entities p ON (u.x - p.x) * (u.x - p.x) + (u.y - p.y) * (u.y - p.y) <= 9000000),
cnt AS (SELECT unit_id,
  {hits},
  count(DISTINCT category) FILTER (dist <= 1000) AS poi_category_richness_1km FROM met GROUP BY unit_id),
shapes AS ({" UNION ALL ".join(shapes)}),
near AS (SELECT unit_id, target, min(sqrt(pow(greatest(0, x0 - x, x - x1), 2) + pow(greatest(0, y0 - y, y - y1), 2))) AS dist FROM u, shapes GROUP BY 1, 2
  UNION ALL SELECT unit_id, 'major_road', min(sqrt(pow(x - (ax + t * (bx - ax)), 2) + pow(y - (ay + t * (b_y - ay)), 2)))
    FROM (SELECT *, greatest(0, least(1, coalesce(((x - ax) * (bx - ax) + (y - ay) * (b_y - ay)) / nullif((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay), 0), 0))) AS t FROM u, (SELECT ax, ay, bx, b_y FROM segments WHERE is_major)) GROUP BY 1),
dist AS (SELECT unit_id, {", ".join(f"min(dist) FILTER (target = '{t}') AS d_{t}" for t in CAPS)} FROM near GROUP BY 1),
w AS (SELECT * REPLACE (coalesce(people, 0) AS people, coalesce(pv, 0) AS pv, coalesce(valid, 0) AS valid, coalesce(land, 0) AS land, coalesce(built, 0) AS built, coalesce(bv, 0) AS bv, coalesce(km, 0) AS km, coalesce(major, 0) AS major, coalesce(crossings, 0) AS crossings, coalesce(site_m2, 0) AS site_m2)
      FROM u LEFT JOIN pop USING (col, row) LEFT JOIN lc USING (col, row) LEFT JOIN bu USING (col, row) LEFT JOIN km USING (col, row) LEFT JOIN cr USING (col, row) LEFT JOIN si USING (col, row) LEFT JOIN cnt USING (unit_id) LEFT JOIN dist USING (unit_id)),
st AS (SELECT *, valid >= 0.999 AS covered, CASE WHEN valid < 0.999 THEN 'coverage_incomplete' WHEN land <= 0 THEN 'denominator_zero' WHEN land < 0.01 THEN 'denominator_below_minimum' ELSE 'ok' END AS on_land FROM w)
SELECT """
    mapped = lambda state, broken=False: f"CASE WHEN NOT source_ok THEN 'source_unavailable' {'WHEN broken THEN ' + repr('entity_assembly_failed') if broken else ''} ELSE {state} END"
    covered, complete = "CASE WHEN covered THEN 'ok' ELSE 'coverage_incomplete' END", "CASE WHEN radius >= 3000 THEN 'ok' ELSE 'coverage_incomplete' END"
    out = {
        "population_count": ("people", "CASE WHEN win >= 0.999 THEN 'ok' ELSE 'coverage_incomplete' END"),
        "population_density": ("people / land", "CASE WHEN win < 0.999 THEN 'coverage_incomplete' ELSE on_land END"),
        "built_up_ratio": ("built / (land * 1e6)", "CASE WHEN bv < 0.999 THEN 'coverage_incomplete' ELSE on_land END"),
        **{f"{n}_ratio": (f"{n} / valid", covered) for n in atomic.LAND_RATIOS},
        "road_length_km": ("km", mapped("'ok'")), "major_road_length_km": ("major", mapped("'ok'")),
        "road_density_km_per_km2": ("km / land", mapped("on_land")), "intersection_density_per_km2": ("crossings / land", mapped("on_land")),
        "osm_industrial_site_area_ratio": ("site_m2 / (land * 1e6)", mapped("on_land")), "distance_nearest_urban_centre_km": ("NULL::DOUBLE", "'source_not_acquired'"),
        **{s.name: (f"coalesce({s.name}, 0)", mapped(complete, "marketplace" in s.categories)) for s in specs},
        "poi_category_richness_1km": ("coalesce(poi_category_richness_1km, 0)", mapped(complete, True)),
        **{f"distance_nearest_{t}_m": (f"d_{t}", mapped(f"CASE WHEN d_{t} <= least({cap}, radius) THEN 'ok' WHEN radius >= {cap} THEN 'not_found_within_cap' ELSE 'search_truncated_by_extract' END")) for t, cap in CAPS.items()},
    }
    beside = {
        "spatial_unit_id": "unit_id", "spatial_method": "'square'", "spatial_resolution": "1000::INTEGER", "spatial_unit_area_km2": "1.0::DOUBLE", "osm_query_complete": "radius >= 3000 AND source_ok",
        "population_coverage_fraction": "round(win, 4)", "built_up_coverage_fraction": "round(bv, 4)", "land_cover_coverage_fraction": "round(valid, 4)", "valid_land_support_area_km2": "CASE WHEN covered THEN land END",
        "land_cover_valid_area_km2": "CASE WHEN covered THEN valid END", "population_nodata_area_fraction": "round(win - pv, 4)", "distance_search_complete_radius_m": "CAST(radius AS DOUBLE)",
        "osm_entity_assembly_failures": "CASE WHEN broken THEN 'marketplace' ELSE 'none' END",
    }
    for name, (value, state) in out.items():
        beside |= {name: f"CASE WHEN ({state}) = 'ok' THEN round(CAST({value} AS DOUBLE), 4) END", atomic.status_of(name): state}
    return with_layers("pois units pixels land segments", body.strip() + " " + ",\n  ".join(f"{beside[c]} AS {c}" for c in atomic.contract_columns()) + " FROM st")


def park_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Parks as areas and, if not among these, as tagged points."""
    points = entities(spark, d).withColumn("kind", F.when(F.col("id") % 4 == 0, "way").otherwise("node"))
    return atomic.parks(sites(spark, d), points)


PARKS = with_layers("pois", f"""
WITH {_ENTITIES}, {_SITES},
a AS (SELECT kind, id, x0, y0, x1, y1 FROM sites WHERE category = 'park_area'),
p AS (SELECT CASE WHEN id % 4 = 0 THEN 'way' ELSE 'node' END AS kind, id, x AS x0, y AS y0, x AS x1, y AS y1 FROM entities WHERE category = 'park_recreation' AND is_park)
SELECT * FROM a UNION ALL SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.kind = p.kind AND a.id = p.id)""")  # fmt: skip


def json_columns(spark: SparkSession, d: str) -> DataFrame:
    """Lists and records as text and back: the sites of a category, by their numbers."""
    packed = sites(spark, d).groupBy("category").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    text = packed.select("category", F.to_json(F.struct(F.size("ids").alias("n"), F.slice("ids", 1, 3).alias("first"))).alias("record"))
    return text.withColumn("n", F.from_json("record", "n int, first array<long>")["n"])


JSON = f"WITH {_SITES} SELECT category, '{{\"n\":' || count(*) || ',\"first\":[' || array_to_string(list_slice(list_sort(list(id)), 1, 3), ',') || ']}}' AS record, CAST(count(*) AS INTEGER) AS n FROM sites GROUP BY category"


def release_listing(spark: SparkSession, d: str) -> DataFrame:
    """The newest release that a listing names, by nation: releases out of paths, the last of them by name."""
    n = F.col("s_suppkey")
    path = F.concat(F.lit("release/20"), (n % 7 + 20).cast("string"), F.lit("-0"), (n % 9 + 1).cast("string"), F.lit("-1"), (n % 10).cast("string"), F.lit("."), (n % 3).cast("string"), F.lit("/theme=places/"))
    listed = layers.read(spark, d, "supplier").select("s_nationkey", F.explode(strings.releases(path)).alias("release"))
    return listed.groupBy("s_nationkey").agg(F.max("release").alias("latest"))


RELEASES = "SELECT s_nationkey, max('20' || (s_suppkey % 7 + 20) || '-0' || (s_suppkey % 9 + 1) || '-1' || (s_suppkey % 10) || '.' || (s_suppkey % 3)) AS latest FROM supplier GROUP BY 1"

def window_cover(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 6 by 6 degrees, each held against the tiles of 5 degrees that are there."""
    n, i = F.col("s_suppkey"), F.col("id")
    x, y = (n * 7919 % 3400 / 10.0 - 170).cast("double"), (n * 104_729 % 1500 / 10.0 - 75).cast("double")
    windows = layers.read(spark, d, "supplier").select(n.alias("window"), x.alias("x0"), y.alias("y0"), (x + 6).alias("x1"), (y + 6).alias("y1"))
    lon, lat = (i % 72 * 5 - 180).cast("double"), (F.floor(i / 72) * 5 - 90).cast("double")
    tiles = spark.range(72 * 36).where("id % 11 <> 0").select(lon.alias("x0"), lat.alias("y0"), (lon + 5).alias("x1"), (lat + 5).alias("y1"))
    return experiment.windows_inside(windows, tiles, "window", 5.0, 0.01)


WINDOW_COVER = """
WITH w AS (SELECT s_suppkey AS "window", CAST(s_suppkey * 7919 % 3400 AS DOUBLE) / 10 - 170 AS x, CAST(s_suppkey * 104729 % 1500 AS DOUBLE) / 10 - 75 AS y FROM supplier),
a AS (SELECT "window", y, unnest(range(CAST(floor((x + 0.01 + 180) / 5) AS BIGINT), CAST(ceil((x + 5.99 + 180) / 5) AS BIGINT))) AS i FROM w),
b AS (SELECT "window", i, unnest(range(CAST(floor((y + 0.01 + 90) / 5) AS BIGINT), CAST(ceil((y + 5.99 + 90) / 5) AS BIGINT))) AS j FROM a)
SELECT "window", bool_and(i < 72 AND j < 36 AND (j * 72 + i) % 11 <> 0) AS inside FROM b GROUP BY 1"""


def ring_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Units whose eight neighbours all have places, inside the square and on its edge."""
    units, filled = layers.units(spark), layers.pois(spark, d).select(F.floor(F.col("x") / 1000).cast("long").alias("col"), F.floor(F.col("y") / 1000).cast("long").alias("row")).distinct()
    there = units.join(filled, ["col", "row"], "left_semi")
    pairs = grid.neighbours(units, "unit_id", "col", "row", grid.square_ring(1)).join(there.select(F.col("unit_id").alias("neighbour")), "neighbour", "left_semi")
    found = units.join(pairs.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n")), "unit_id", "left")
    inner = F.col("col").between(1, 18) & F.col("row").between(1, 18)
    sums = experiment.ring_completeness(found, inner, F.col("n") == F.when(inner, 8).when(F.col("col").isin(0, 19) & F.col("row").isin(0, 19), 3).otherwise(5))
    return sums.withColumns({c: F.round(c, 6) for c in ("share_interior", "share_edge")})


RING_COMPLETENESS = with_layers("pois units", """
WITH f AS (SELECT DISTINCT CAST(floor(x / 1000) AS BIGINT) AS col, CAST(floor(y / 1000) AS BIGINT) AS row FROM pois),
n AS (SELECT u.unit_id, u.col BETWEEN 1 AND 18 AND u.row BETWEEN 1 AND 18 AS own, count(f.col) = any_value((least(u.col + 1, 19) - greatest(u.col - 1, 0) + 1) * (least(u.row + 1, 19) - greatest(u.row - 1, 0) + 1) - 1) AS ok
      FROM units u LEFT JOIN f ON abs(f.col - u.col) <= 1 AND abs(f.row - u.row) <= 1 AND (f.col <> u.col OR f.row <> u.row) GROUP BY ALL)
SELECT count(*) AS cells, count(*) FILTER (own) AS interior, count(*) FILTER (NOT own) AS edge, count(*) FILTER (ok) AS complete, round(avg(ok::INTEGER) FILTER (own), 6) AS share_interior, round(avg(ok::INTEGER) FILTER (NOT own), 6) AS share_edge FROM n""")


def fit_summary(spark: SparkSession, d: str) -> DataFrame:
    """What was fitted, by area, in order of the areas' numbers."""
    table = normalize.fit_ecdf(normalised.atomic(spark, d), ["area"])
    return normalize.fit_summary(table, ["area"])


FIT_SUMMARY = normalised.ATOMIC + """
SELECT area, CASE WHEN count(*) < 30 THEN 'cohort_too_small' WHEN count(DISTINCT value) < 2 THEN 'cohort_degenerate' ELSE 'fitted' END AS fit_status, count(*) AS n_obs,
  CASE WHEN count(*) >= 30 AND count(DISTINCT value) >= 2 THEN count(DISTINCT value) ELSE 0 END AS n_distinct, CASE WHEN count(*) >= 30 AND count(DISTINCT value) >= 2 THEN CAST(count(*) AS DOUBLE) END AS weight_total
FROM a WHERE status = 'ok' GROUP BY area"""


def candidate_order(spark: SparkSession, d: str) -> DataFrame:
    """Places of candidates in order of the number in their names."""
    from pyspark.sql import Window

    named = layers.read(spark, d, "nation").select(F.concat(F.lit("grid"), F.when(F.col("n_nationkey") % 6 != 0, F.concat(F.lit("_r"), (F.col("n_nationkey") % 13).cast("string"))).otherwise(F.col("n_nationkey").cast("string"))).alias("candidate")).distinct()
    return named.select("candidate", F.row_number().over(Window.orderBy(*experiment.by_resolution(F.col("candidate")))).alias("place"))  # as many rows as candidates


CANDIDATES = """
WITH c AS (SELECT DISTINCT 'grid' || CASE WHEN n_nationkey % 6 <> 0 THEN '_r' || (n_nationkey % 13) ELSE CAST(n_nationkey AS VARCHAR) END AS candidate FROM nation)
SELECT candidate, CAST(row_number() OVER (ORDER BY coalesce(CAST(nullif(regexp_extract(candidate, '_r([0-9]+)', 1), '') AS INTEGER), 0), candidate) AS INTEGER) AS place FROM c"""

QUERIES = {
    "window_cover": (window_cover, WINDOW_COVER),
    "ring_completeness": (ring_completeness, RING_COMPLETENESS),
    "fit_summary": (fit_summary, FIT_SUMMARY),
    "candidate_order": (candidate_order, CANDIDATES),
    "atomic_features": (atomic_features, _sql()),
    "park_shapes": (park_shapes, PARKS),
    "json_columns": (json_columns, JSON),
    "release_listing": (release_listing, RELEASES),
}
