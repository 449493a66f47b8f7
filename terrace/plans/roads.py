"""Queries on roads and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.status import denominator_status, where_ok
from terrace.operators import audit, entities, graph, spatial_join
from terrace.plans.places import rounded
from terrace.sources import layers
from terrace.sources.layers import with_layers


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.way_edges(layers.nodes(spark, d))


_LENGTH = "sqrt((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay))"


def _axis(a: str, b: str, lo: str) -> str:
    return f"CASE WHEN {a} = {b} THEN CASE WHEN {a} < {lo} OR {a} > {lo} + 1000 THEN 1.0::DOUBLE ELSE 0 END ELSE least(({lo} - {a}) / ({b} - {a}), ({lo} + 1000 - {a}) / ({b} - {a})) END", f"CASE WHEN {a} = {b} THEN CASE WHEN {a} < {lo} OR {a} > {lo} + 1000 THEN 0.0::DOUBLE ELSE 1 END ELSE greatest(({lo} - {a}) / ({b} - {a}), ({lo} + 1000 - {a}) / ({b} - {a})) END"


_X, _Y = _axis("ax", "bx", "(col * 1000)"), _axis("ay", "b_y", "(row * 1000)")
_CLIPPED = f"""
e AS (SELECT *, unnest(range(CAST(floor(least(ax, bx) / 1000) AS BIGINT), CAST(floor(greatest(ax, bx) / 1000) AS BIGINT) + 1)) AS col FROM segments),
f AS (SELECT *, unnest(range(CAST(floor(least(ay, b_y) / 1000) AS BIGINT), CAST(floor(greatest(ay, b_y) / 1000) AS BIGINT) + 1)) AS row FROM e),
g AS (SELECT *, greatest(0, {_X[0]}, {_Y[0]}) AS t0, least(1, {_X[1]}, {_Y[1]}) AS t1 FROM f),
clipped AS (SELECT *, (t1 - t0) * {_LENGTH} AS length FROM g WHERE t1 > t0)"""


def clipped_length(spark: SparkSession, d: str) -> DataFrame:
    cut = spatial_join.clipped_lengths(_edges(spark, d), 1000.0)
    sums = cut.groupBy("col", "row").agg(F.sum("length").alias("total"), F.sum(F.when(F.col("is_major"), F.col("length")).otherwise(0.0)).alias("major"))
    return sums.select("col", "row", F.round("total", 3).alias("total"), F.round("major", 3).alias("major"))


CLIPPED = with_layers("segments", "WITH " + _CLIPPED.strip() + "\nSELECT col, row, round(sum(length), 3) AS total, round(sum(CASE WHEN is_major THEN length ELSE 0 END), 3) AS major FROM clipped GROUP BY col, row")


def road_density(spark: SparkSession, d: str) -> DataFrame:
    """Road length by square kilometre of land, with the ladder of statuses."""
    roads = spatial_join.clipped_lengths(_edges(spark, d), 1000.0).groupBy("col", "row").agg((F.sum("length") / 1000).alias("km"))
    dry = layers.land(spark, d).groupBy(F.floor(F.col("col") / 2).cast("long").alias("col"), F.floor(F.col("row") / 2).cast("long").alias("row")).agg((F.count_if(~F.col("class").isin(0, 80)) * 0.25).alias("land"), (F.count_if(F.col("class") != 0) * 0.25).alias("valid"))
    full = layers.units(spark).join(roads, ["col", "row"], "left").join(dry, ["col", "row"], "left")
    km, land, valid = (F.coalesce(c, F.lit(0.0)) for c in ("km", "land", "valid"))
    state = denominator_status(F.lit(True), valid >= 0.999, land, F.lit(1.0))
    return full.select("unit_id", F.round(where_ok(F.try_divide(km, land), state), 6).alias("road_density"), state.alias("status"))


ROAD_DENSITY = with_layers("units segments land", "WITH " + _CLIPPED.strip() + """,
k AS (SELECT col, row, sum(length) / 1000 AS km FROM clipped GROUP BY col, row),
l AS (SELECT CAST(floor(col / 2) AS BIGINT) AS col, CAST(floor(row / 2) AS BIGINT) AS row, count(*) FILTER (class NOT IN (0, 80)) * 0.25::DOUBLE AS land, count(*) FILTER (class <> 0) * 0.25::DOUBLE AS valid FROM land GROUP BY 1, 2),
s AS (SELECT unit_id, coalesce(km, 0) AS km, coalesce(land, 0) AS land, CASE WHEN coalesce(valid, 0) < 0.999 THEN 'coverage_incomplete' WHEN coalesce(land, 0) <= 0 THEN 'denominator_zero' WHEN land < 0.01 THEN 'denominator_below_minimum' ELSE 'ok' END AS status FROM units LEFT JOIN k USING (col, row) LEFT JOIN l USING (col, row))
SELECT unit_id, CASE WHEN status = 'ok' THEN round(km / land, 6) END AS road_density, status FROM s""")  # fmt: skip


def length_by_class(spark: SparkSession, d: str) -> DataFrame:
    length = F.sqrt((F.col("bx") - F.col("ax")) ** 2 + (F.col("by") - F.col("ay")) ** 2)
    return _edges(spark, d).groupBy("class").agg(F.round(F.sum(length), 3).alias("length"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("length"))


LENGTH_BY_CLASS = with_layers("segments", f"SELECT class, round(sum({_LENGTH}), 3) AS length, count(*) AS n FROM segments GROUP BY class")


def intersections(spark: SparkSession, d: str) -> DataFrame:
    return graph.degrees(_edges(spark, d)).where("degree >= 3")


INTERSECTIONS = with_layers("segments", "SELECT node, count(*) AS degree FROM (SELECT a AS node FROM segments UNION ALL SELECT b FROM segments) GROUP BY node HAVING count(*) >= 3")


def induced_subgraph(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    places = layers.read(spark, d, "part").select(p.alias("node"), (p * 7919 % 20_000).alias("x"), (p * 104_729 % 20_000).alias("y"))
    kept = graph.induced(_edges(spark, d), places, F.col("x").between(4000, 16_000) & F.col("y").between(4000, 16_000))
    return kept.groupBy("a").agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("b").alias("neighbours"))


INDUCED = with_layers("segments", """
WITH k AS (SELECT p_partkey AS node FROM part WHERE p_partkey * 7919 % 20000 BETWEEN 4000 AND 16000 AND p_partkey * 104729 % 20000 BETWEEN 4000 AND 16000)
SELECT a, count(*) AS edges, count(DISTINCT b) AS neighbours FROM segments WHERE a IN (SELECT node FROM k) AND b IN (SELECT node FROM k) GROUP BY a""")


def component_shares(spark: SparkSession, d: str) -> DataFrame:
    """Length of each connected component of the road graph."""
    edges = _edges(spark, d)
    out = graph.component_lengths(edges, graph.components(edges))
    return out.select("root", F.round("length", 3).alias("length"), *rounded("share")).orderBy(F.desc("length"), "root")


_SHARES = """
WITH e AS (SELECT a, b FROM segments UNION SELECT b, a FROM segments),
cc(node, root) USING KEY (node) AS (
  SELECT DISTINCT a, a FROM e
  UNION SELECT e.b, min(cc.root) FROM cc JOIN e ON cc.node = e.a JOIN recurring.cc AS old ON old.node = e.b WHERE cc.root < old.root GROUP BY e.b),
l AS (SELECT root, sum(sqrt((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay))) AS length FROM segments JOIN cc ON node = a GROUP BY root)
SELECT root, round(length, 3) AS length, round(length / sum(length) OVER (), 6) AS share FROM l"""
SHARES = with_layers("segments", _SHARES).replace("WITH ", "WITH RECURSIVE ", 1)


def largest_components(spark: SparkSession, d: str) -> DataFrame:
    """The ten longest components of the graph of every fourth way's edges between nodes of equal rest."""
    edges = _edges(spark, d).where("way % 4 = 0 AND a % 3 = b % 3")
    out = graph.largest_components(graph.component_lengths(edges, graph.components(edges)), 10)
    return out.select("root", F.round("length", 3).alias("length"), *rounded("share"))


LARGEST = (with_layers("segments", "WITH part_of AS (SELECT * FROM segments WHERE way % 4 = 0 AND a % 3 = b % 3),\n" + _SHARES.strip()[5:].replace("segments", "part_of")) + " ORDER BY l.length DESC, root LIMIT 10").replace("WITH ", "WITH RECURSIVE ", 1)


def connector_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of segments with connectors by their place along the segment."""
    at = F.struct((F.col("seq") / 8.0).alias("at"), F.col("node").cast("string").alias("connector_id"))
    segments = layers.nodes(spark, d).groupBy("way").agg(F.collect_list(at).alias("connectors"))
    return graph.connector_edges(segments).groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("first"))


CONNECTORS = with_layers("segments", "SELECT CAST(a AS VARCHAR) AS a, count(*) AS n, min(CAST(b AS VARCHAR)) AS first FROM segments GROUP BY a")


def road_class(spark: SparkSession, d: str) -> DataFrame:
    classes = F.array(*[F.lit(c) for c in ("motorway", "trunk_link", "primary", "footway", "residential", "secondary_link", "track")])
    tagged = layers.read(spark, d, "part").select(F.element_at(classes, (F.col("p_partkey") % 7 + 1).cast("int")).alias("highway"))
    driveable, major, link = entities.road_class(F.col("highway"))
    return tagged.groupBy("highway", driveable.alias("driveable"), major.alias("major"), link.alias("link")).agg(F.count(F.lit(1)).alias("n"))


_DRIVE, _MAJOR = (", ".join(f"'{c}'" for c in x) for x in (entities.DRIVEABLE, entities.MAJOR))
ROAD_CLASS = f"""
WITH t AS (SELECT ['motorway', 'trunk_link', 'primary', 'footway', 'residential', 'secondary_link', 'track'][p_partkey % 7 + 1] AS highway FROM part),
b AS (SELECT highway, regexp_replace(highway, '_link$', '') AS base FROM t)
SELECT highway, base IN ({_DRIVE}) AS driveable, base IN ({_MAJOR}) AS major, highway LIKE '%\\_link' ESCAPE '\\' AS link, count(*) AS n FROM b GROUP BY ALL"""


def _beside(spark: SparkSession, d: str) -> DataFrame:
    """Major roads with the length that lies within 30.7 m of another source's roads (the others, moved by 20 m)."""
    edges = _edges(spark, d)
    a = edges.where("is_major").select("way", "seq", "ax", "ay", "bx", "by")
    b = edges.where("not is_major").select(*[(F.col(c) + 20).alias(c) for c in ("ax", "ay", "bx", "by")])
    return audit.buffered_lengths(a, b, 30.7, 500.0)


def line_match(spark: SparkSession, d: str) -> DataFrame:
    """Length of major roads by whether most of it lies beside another source's road, and the longest part without."""
    out = _beside(spark, d).withColumn("open", F.round(F.col("length") - F.col("covered"), 4))
    return out.groupBy((F.col("open") > F.round(0.5 * F.col("length"), 4)).alias("unmatched")).agg(F.count(F.lit(1)).alias("ways"), F.round(F.sum("length"), 2).alias("length"), F.round(F.max("open"), 2).alias("longest_open"))


def unmatched_top(spark: SparkSession, d: str) -> DataFrame:
    """The twenty roads with the most length that no other source's road covers."""
    return audit.unmatched(_beside(spark, d), "way", 20).select("way", F.round("length", 2).alias("length"), F.round("open", 2).alias("open"))


_CELLS = lambda a, b, r: f"unnest(range(CAST(floor((least({a}, {b}) - {r}) / 500) AS BIGINT), CAST(floor((greatest({a}, {b}) + {r}) / 500) AS BIGINT) + 1))"
# A pair's interval, step by step: k is the pair, z its differences, l the strip and the ends, i the interval within the segment.
_OPEN = f"""
WITH s AS (SELECT way, seq, is_major, ax, ay, bx, b_y FROM segments),
a AS (SELECT *, sqrt((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay)) AS len FROM s WHERE is_major),
a0 AS (SELECT * FROM a WHERE len > 0), b AS (SELECT DISTINCT ax + 20 AS qax, ay + 20 AS qay, bx + 20 AS qbx, b_y + 20 AS qby FROM s WHERE NOT is_major),
a1 AS (SELECT *, {_CELLS('ax', 'bx', 0)} AS i FROM a0), a2 AS (SELECT *, {_CELLS('ay', 'b_y', 0)} AS j FROM a1), b1 AS (SELECT *, {_CELLS('qax', 'qbx', 30.7)} AS i FROM b), b2 AS (SELECT *, {_CELLS('qay', 'qby', 30.7)} AS j FROM b1),
k AS (SELECT DISTINCT way, seq, len, ax, ay, bx, b_y, qax, qay, qbx, qby FROM a2 JOIN b2 USING (i, j)),
z AS (SELECT way, seq, len, bx - ax AS dx, b_y - ay AS dy, qbx - qax AS ex, qby - qay AS ey, ax - qax AS ux, ay - qay AS uy, ax - qbx AS vx, ay - qby AS vy FROM k),
c AS (SELECT *, ex * ex + ey * ey AS far, len * len AS sq, ux * ey - uy * ex AS c0, dx * ey - dy * ex AS c1, ux * ex + uy * ey AS p0, dx * ex + dy * ey AS p1, ux * dx + uy * dy AS hu, vx * dx + vy * dy AS hv FROM z),
r AS (SELECT *, 30.7::DOUBLE * sqrt(far) AS wide, hu * hu - sq * (ux * ux + uy * uy - 30.7::DOUBLE * 30.7::DOUBLE) AS ru, hv * hv - sq * (vx * vx + vy * vy - 30.7::DOUBLE * 30.7::DOUBLE) AS rv FROM c),
l AS (SELECT *,
  CASE WHEN c1 = 0 THEN CASE WHEN abs(c0) <= wide THEN 0 ELSE 2 END ELSE least((-wide - c0) / c1, (wide - c0) / c1) END AS w0, CASE WHEN c1 = 0 THEN CASE WHEN abs(c0) <= wide THEN 1 ELSE -1 END ELSE greatest((-wide - c0) / c1, (wide - c0) / c1) END AS w1,
  CASE WHEN p1 = 0 THEN CASE WHEN p0 BETWEEN 0 AND far THEN 0 ELSE 2 END ELSE least(-p0 / p1, (far - p0) / p1) END AS y0, CASE WHEN p1 = 0 THEN CASE WHEN p0 BETWEEN 0 AND far THEN 1 ELSE -1 END ELSE greatest(-p0 / p1, (far - p0) / p1) END AS y1 FROM r),
m AS (SELECT *, far > 0 AND greatest(w0, y0) <= least(w1, y1) AS strip FROM l),
i AS (SELECT way, seq, len,
  greatest(0, least(CASE WHEN strip THEN greatest(w0, y0) END, CASE WHEN ru >= 0 THEN (-hu - sqrt(greatest(ru, 0))) / sq END, CASE WHEN rv >= 0 THEN (-hv - sqrt(greatest(rv, 0))) / sq END)) AS t0,
  least(1, greatest(CASE WHEN strip THEN least(w1, y1) END, CASE WHEN ru >= 0 THEN (-hu + sqrt(greatest(ru, 0))) / sq END, CASE WHEN rv >= 0 THEN (-hv + sqrt(greatest(rv, 0))) / sq END)) AS t1
  FROM m WHERE strip OR ru >= 0 OR rv >= 0),
f AS (SELECT way, len * greatest(0, t1 - greatest(t0, coalesce(max(t1) OVER (PARTITION BY way, seq ORDER BY t0, t1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS own FROM i WHERE t0 < t1),
t AS (SELECT way, sum(len) AS length FROM a0 GROUP BY way), h AS (SELECT way, sum(own) AS covered FROM f GROUP BY way),
o AS (SELECT way, length, round(length - coalesce(covered, 0), 4) AS open FROM t LEFT JOIN h USING (way))
"""
LINE_MATCH = with_layers("segments", _OPEN + "SELECT open > round(0.5 * length, 4) AS unmatched, count(*) AS ways, round(sum(length), 2) AS length, round(max(open), 2) AS longest_open FROM o GROUP BY 1")
UNMATCHED_TOP = with_layers("segments", _OPEN + "SELECT way, round(length, 2) AS length, round(open, 2) AS open FROM o WHERE open > 0.5 * length ORDER BY o.open DESC, way LIMIT 20")

QUERIES = {
    "clipped_length": (clipped_length, CLIPPED),
    "road_density": (road_density, ROAD_DENSITY),
    "length_by_class": (length_by_class, LENGTH_BY_CLASS),
    "intersections": (intersections, INTERSECTIONS),
    "induced_subgraph": (induced_subgraph, INDUCED),
    "component_shares": (component_shares, SHARES),
    "largest_components": (largest_components, LARGEST),
    "connector_edges": (connector_edges, CONNECTORS),
    "road_class": (road_class, ROAD_CLASS),
    "line_match": (line_match, LINE_MATCH),
    "unmatched_top": (unmatched_top, UNMATCHED_TOP),
}
