"""Queries of the spatial experiment: metrics of candidate grids, sensitivity, gates; and windows over events (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import grid
from terrace.operators import experiment, grids
from terrace.plans.normalised import UNIT_VALUES, _unit_values
from terrace.plans.places import rounded
from terrace.sources import layers
from terrace.sources.layers import with_layers
from terrace.streaming import windows

#: Cell sizes of the candidates.
SIZES = [500, 1000, 2000]


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Points with their cell in each candidate grid: poi_id, x, y, category, weight, size, col, row."""
    points = layers.pois(spark, d).withColumn("size", F.explode(F.array(*[F.lit(s).cast("long") for s in SIZES])))
    return points.withColumns({"col": F.floor(F.col("x") / F.col("size")).cast("long"), "row": F.floor(F.col("y") / F.col("size")).cast("long")})


CANDIDATES = "c AS (SELECT poi_id, x, y, category, weight, size, CAST(floor(x / size) AS BIGINT) AS col, CAST(floor(y / size) AS BIGINT) AS row FROM pois, (SELECT unnest([500, 1000, 2000])::BIGINT AS size))"


def metric_quantiles(spark: SparkSession, d: str) -> DataFrame:
    units = _candidates(spark, d).groupBy("size", "col", "row").agg(F.count(F.lit(1)).alias("n"))
    out = experiment.unit_quantiles(units, ["size"], "n")
    return out.select("size", "metric", "spatial_support", F.round("value", 6).alias("value"))


_QUANTILES = {"n": "count(n)", "min": "min(n)", "mean": "avg(n)", "max": "max(n)", "p05": "quantile_cont(n, 0.05)", "p50": "quantile_cont(n, 0.5)", "p95": "quantile_cont(n, 0.95)", "cv": "stddev_samp(n) / avg(n)"}
METRIC_QUANTILES = with_layers("pois", f"WITH {CANDIDATES}, u AS (SELECT size, col, row, count(*) AS n FROM c GROUP BY ALL)\n" + " UNION ALL ".join(f"SELECT size, '{n}' AS metric, 'unit' AS spatial_support, round(CAST({e} AS DOUBLE), 6) AS value FROM u GROUP BY size" for n, e in _QUANTILES.items()))


def sparsity(spark: SparkSession, d: str) -> DataFrame:
    counts = _candidates(spark, d).groupBy("size", "col", "row").agg(F.count_if(F.col("category") == "MACHINERY").alias("machinery"), F.count_if(F.col("category") == "BUILDING").alias("building"))
    out = experiment.sparsity(counts, ["size"], ["machinery", "building"])
    return out.select("size", *rounded("zero_machinery", "zero_building"), "units")


SPARSITY = with_layers("pois", f"""WITH {CANDIDATES}, u AS (SELECT size, col, row, count(*) FILTER (category = 'MACHINERY') AS m, count(*) FILTER (category = 'BUILDING') AS b FROM c GROUP BY size, col, row)
SELECT size, round(avg(CASE WHEN m = 0 THEN 1.0 ELSE 0 END), 6) AS zero_machinery, round(avg(CASE WHEN b = 0 THEN 1.0 ELSE 0 END), 6) AS zero_building, count(*) AS units FROM u GROUP BY size""")


def within_loss(spark: SparkSession, d: str) -> DataFrame:
    samples = _candidates(spark, d).withColumn("unit", F.struct("col", "row"))
    out = experiment.within_unit_loss(samples, ["size"], "unit", "weight")
    return out.select("size", *rounded("within", "between", "ratio"))


WITHIN_LOSS = with_layers("pois", f"""WITH {CANDIDATES}, u AS (SELECT size, col, row, max(weight) - min(weight) AS r, avg(weight) AS m, count(*) AS n FROM c GROUP BY size, col, row),
s AS (SELECT size, quantile_cont(CASE WHEN n >= 2 THEN r END, 0.5) AS w, quantile_cont(m, 0.75) - quantile_cont(m, 0.25) AS b FROM u GROUP BY size)
SELECT size, round(w, 6) AS within, round(b, 6) AS between, CASE WHEN b > 0 THEN round(w / b, 6) END AS ratio FROM s""".replace("AS between", 'AS "between"').replace("AS within", 'AS "within"'))  # fmt: skip


def _jittered(rows: DataFrame) -> DataFrame:
    moved = rows.withColumns({"x": F.col("x") + (F.col("poi_id") * 37 % 201 - 100), "y": F.col("y") + (F.col("poi_id") * 53 % 201 - 100)})
    return moved.withColumns({"col": F.floor(F.col("x") / F.col("size")).cast("long"), "row": F.floor(F.col("y") / F.col("size")).cast("long")})


def jitter_change(spark: SparkSession, d: str) -> DataFrame:
    """Share of points whose cell changes when they move by up to 100 m."""
    base = _candidates(spark, d)
    cell = F.concat_ws("_", F.col("col").cast("string"), F.col("row").cast("string"))
    out = experiment.change_share(base.withColumn("unit", cell), _jittered(base).withColumn("unit", cell), "poi_id", "unit", ["size"])
    return out.select("size", *rounded("change_share"), "points")


JITTER = with_layers("pois", f"""WITH {CANDIDATES}
SELECT size, round(avg(CASE WHEN floor((x + poi_id * 37 % 201 - 100) / size) <> col OR floor((y + poi_id * 53 % 201 - 100) / size) <> row THEN 1.0 ELSE 0 END), 6) AS change_share, count(*) AS points FROM c GROUP BY size""")


def origin_flips(spark: SparkSession, d: str) -> DataFrame:
    """Of pairs of consecutive points, the share that shares a cell in one of two origins only."""
    points = layers.pois(spark, d)
    cell = lambda shift: F.concat_ws("_", *[F.floor((F.col(c) + shift) / 1000).cast("string") for c in ("x", "y")])
    a, b = (points.select("poi_id", cell(s).alias("unit")) for s in (0, 500))
    pairs = points.select(F.col("poi_id").alias("p"), (F.col("poi_id") + 48).alias("q"))
    out = experiment.copartition_flips(a, b, pairs, "poi_id", "unit")
    return out.select(*rounded("flip_share"), "pairs")


ORIGIN = with_layers("pois", """
WITH u AS (SELECT poi_id, floor(x / 1000) * 100000 + floor(y / 1000) AS a, floor((x + 500) / 1000) * 100000 + floor((y + 500) / 1000) AS b FROM pois)
SELECT round(avg(CASE WHEN (p.a = q.a) <> (p.b = q.b) THEN 1.0 ELSE 0 END), 6) AS flip_share, count(*) AS pairs FROM u p JOIN u q ON q.poi_id = p.poi_id + 48""")


def maup(spark: SparkSession, d: str) -> DataFrame:
    """Values at points by 500 m cells against those by 1 000 m cells, by category of the point."""
    c = _candidates(spark, d)
    counts = c.groupBy("size", "col", "row").agg(F.avg("weight").alias("v"))
    at = c.join(counts, ["size", "col", "row"]).groupBy("poi_id", "category").agg(F.max(F.when(F.col("size") == 500, F.col("v"))).alias("a"), F.max(F.when(F.col("size") == 1000, F.col("v"))).alias("b"))
    out = experiment.maup(at.withColumns({"a": F.round("a", 6), "b": F.round("b", 6)}), ["category"], "a", "b")
    return out.select("category", *rounded("rho", "median_change", "top_jaccard"), "n")


MAUP = with_layers("pois", f"""WITH {CANDIDATES}, v AS (SELECT size, col, row, avg(weight) AS v FROM c GROUP BY size, col, row),
p AS (SELECT poi_id, category, round(max(v) FILTER (size = 500), 6) AS a, round(max(v) FILTER (size = 1000), 6) AS b FROM c JOIN v USING (size, col, row) GROUP BY poi_id, category),
k AS (SELECT *, rank() OVER (PARTITION BY category ORDER BY a) + (count(*) OVER (PARTITION BY category, a) - 1) / 2 AS ra, rank() OVER (PARTITION BY category ORDER BY b) + (count(*) OVER (PARTITION BY category, b) - 1) / 2 AS rb FROM p),
t AS (SELECT category, quantile_cont(a, 0.9) AS ta, quantile_cont(b, 0.9) AS tb FROM p GROUP BY category)
SELECT category, round(corr(ra, rb), 6) AS rho, round(quantile_cont(CASE WHEN a <> 0 THEN abs(b - a) / abs(a) END, 0.5), 6) AS median_change, round(count(*) FILTER (a >= ta AND b >= tb) / count(*) FILTER (a >= ta OR b >= tb), 6) AS top_jaccard, count(*) AS n FROM k JOIN t USING (category) GROUP BY category""")  # fmt: skip


def indistinct_pairs(spark: SparkSession, d: str) -> DataFrame:
    units = _unit_values(spark, d)
    pairs = grid.neighbours(units, "unit_id", "col", "row", grid.square_ring(1))
    out = experiment.indistinct_pairs(units, pairs, "unit_id", ["value"], 2.0)
    return out.select(*rounded("indistinct_share"), "pairs")


INDISTINCT = with_layers("pois units", UNIT_VALUES + """
SELECT round(avg(CASE WHEN coalesce(abs(a.value - b.value) < 2, true) THEN 1.0 ELSE 0 END), 6) AS indistinct_share, count(*) AS pairs FROM v a JOIN v b ON abs(a.col - b.col) <= 1 AND abs(a.row - b.row) <= 1 AND a.unit_id < b.unit_id""")


def ring_circle(spark: SparkSession, d: str) -> DataFrame:
    """The ring order of a square lattice that fits a circle best."""
    n = 10
    cells = spark.range((2 * n + 1) ** 2).select((F.col("id") % (2 * n + 1) - n).alias("i"), (F.floor(F.col("id") / (2 * n + 1)) - n).alias("j"))
    lattice = cells.select((F.sqrt(F.col("i") ** 2 + F.col("j") ** 2) * 500).alias("distance"), F.greatest(F.abs("i"), F.abs("j")).alias("order"))
    out = experiment.ring_against_circle(lattice.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n)))), 3000.0)
    return out.select(F.col("k").cast("long").alias("k"), *rounded("jaccard"))


RING = """
WITH l AS (SELECT sqrt(i * i + j * j) * 500 AS dist, greatest(abs(i), abs(j)) AS o FROM range(-10, 11) a(i), range(-10, 11) b(j)),
s AS (SELECT k, count(*) FILTER (o <= k AND dist <= 3000) / count(*) FILTER (o <= k OR dist <= 3000) AS jac FROM l, range(0, 11) t(k) GROUP BY k)
SELECT k, round(jac, 6) AS jaccard FROM s ORDER BY jac DESC, k LIMIT 1"""


def _ratios(spark: SparkSession, d: str) -> DataFrame:
    """Loss ratios of anchors (segments) by candidate (size), with some missing and some exactly at the limit."""
    n = layers.read(spark, d, "nation").select("n_nationkey", "n_regionkey")
    return n.select(F.col("n_regionkey").alias("candidate"), F.col("n_nationkey").alias("anchor"), F.when(F.col("n_nationkey") % 7 != 0, (F.col("n_nationkey") % 9 / 16.0).cast("double")).alias("ratio"))


def coarse_gate(spark: SparkSession, d: str) -> DataFrame:
    return experiment.coarse_gate(_ratios(spark, d), ["candidate"], "anchor", "ratio")


COARSE = """
WITH r AS (SELECT n_regionkey AS candidate, CASE WHEN n_nationkey % 7 <> 0 THEN CAST(n_nationkey % 9 AS DOUBLE) / 16 END AS ratio FROM nation)
SELECT candidate, count(*) FILTER (ratio > 0.25) AS triggered, count(*) AS anchors, count(*) FILTER (ratio > 0.25) >= 2 AS too_coarse FROM r GROUP BY candidate"""


def _suppliers(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as candidates of families (nations): area, cost, loss, indistinct."""
    s = F.col("s_suppkey")
    return layers.read(spark, d, "supplier").select(
        s.alias("id"), F.col("s_nationkey").alias("family"), (s * 7919 % 1009).alias("area"), (s * 31 % 97 + 1).cast("double").alias("cost"), (s * 17 % 53 / 10.0).cast("double").alias("loss"), (s * 13 % 101 / 100.0).cast("double").alias("indistinct"),
    )


SUPPLIERS = "WITH s AS (SELECT s_suppkey AS id, s_nationkey AS family, s_suppkey * 7919 % 1009 AS area, CAST(s_suppkey * 31 % 97 + 1 AS DOUBLE) AS cost, CAST(s_suppkey * 17 % 53 AS DOUBLE) / 10 AS loss, CAST(s_suppkey * 13 % 101 AS DOUBLE) / 100 AS indistinct FROM supplier)"


def fine_gate(spark: SparkSession, d: str) -> DataFrame:
    s = _suppliers(spark, d)
    pairs = experiment.finer_pairs(s, "family", "area", "id")
    other = s.select(F.col("id").alias("coarser"), F.col("cost").alias("coarser_cost"), F.col("loss").alias("coarser_loss"))
    out = experiment.fine_gate(pairs.join(other, "coarser"))
    return out.select("id", "coarser", *rounded("cost_ratio", "gain"), "verdict")


FINE = SUPPLIERS + """, p AS (SELECT *, lead(id) OVER w AS coarser, lead(cost) OVER w AS cc, lead(loss) OVER w AS cl FROM s WINDOW w AS (PARTITION BY family ORDER BY area, id)),
r AS (SELECT id, coarser, cost / cc AS cr, (cl - loss) / nullif(cl, 0) AS gain, indistinct FROM p WHERE coarser IS NOT NULL)
SELECT id, coarser, round(cr, 6) AS cost_ratio, round(gain, 6) AS gain, CASE WHEN gain IS NULL THEN 'undetermined' WHEN cr > 2 AND gain < 0.05 AND indistinct > 0.8 THEN 'too_fine' ELSE 'kept' END AS verdict FROM r"""


def robustness_gate(spark: SparkSession, d: str) -> DataFrame:
    return experiment.robustness(_suppliers(spark, d), ["family"], "id", "cost", "loss")


ROBUST = SUPPLIERS + """, r AS (SELECT family, rank() OVER (PARTITION BY family ORDER BY cost) + (count(*) OVER (PARTITION BY family, cost) - 1) / 2 AS a, rank() OVER (PARTITION BY family ORDER BY loss) + (count(*) OVER (PARTITION BY family, loss) - 1) / 2 AS b FROM s)
SELECT family, count(*) FILTER (abs(a - b) > 2) AS large_moves, count(*) FILTER (abs(a - b) > 2) <= 1 AS robust FROM r GROUP BY family"""


def pareto_frontier(spark: SparkSession, d: str) -> DataFrame:
    s = _suppliers(spark, d).withColumn("loss", F.when(F.col("id") % 19 != 0, F.col("loss")))
    return experiment.pareto(s, "id", ["cost", "loss", "indistinct"])


PARETO = SUPPLIERS + """, o AS (SELECT id, cost, CASE WHEN id % 19 <> 0 THEN loss END AS loss, indistinct FROM s)
SELECT a.id, CASE WHEN a.loss IS NULL THEN 'undetermined' WHEN EXISTS (SELECT 1 FROM o b WHERE b.cost <= a.cost AND b.loss <= a.loss AND b.indistinct <= a.indistinct AND (b.cost < a.cost OR b.loss < a.loss OR b.indistinct < a.indistinct)) THEN 'dominated' ELSE 'frontier' END AS state FROM o a"""


def completeness_gate(spark: SparkSession, d: str) -> DataFrame:
    """Candidates (regions) by area (segments): pairs without rows, and pairs of too little coverage."""
    c = layers.read(spark, d, "customer").join(F.broadcast(layers.read(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    present = c.where("n_nationkey % 6 <> 1").groupBy(F.col("n_nationkey").alias("candidate"), F.col("c_mktsegment").alias("area")).agg(F.avg((F.col("c_custkey") % 10 > 0).cast("double")).alias("coverage"))
    areas = layers.read(spark, d, "customer").select(F.col("c_mktsegment").alias("area")).distinct()
    candidates = layers.read(spark, d, "nation").select(F.col("n_nationkey").alias("candidate"))
    return experiment.completeness(present, areas, candidates, "coverage", 0.9)


COMPLETENESS = """
WITH p AS (SELECT c_nationkey AS candidate, c_mktsegment AS area, avg(CASE WHEN c_custkey % 10 > 0 THEN 1.0::DOUBLE ELSE 0 END) AS coverage FROM customer WHERE c_nationkey % 6 <> 1 GROUP BY 1, 2),
w AS (SELECT n_nationkey AS candidate, area FROM nation, (SELECT DISTINCT c_mktsegment AS area FROM customer))
SELECT candidate, count(*) FILTER (coverage IS NULL) AS absent, count(*) FILTER (coverage < 0.9) AS thin, count(*) FILTER (coverage IS NULL) = 0 AND count(*) FILTER (coverage < 0.9) = 0 AS complete FROM w LEFT JOIN p USING (candidate, area) GROUP BY candidate"""


def resolution_choice(spark: SparkSession, d: str) -> DataFrame:
    """The coarsest supplier that passes made-up gates."""
    s = _suppliers(spark, d).select("id", "area", (F.col("id") % 3 != 0).alias("complete"), (F.col("loss") > 3).alias("too_coarse"), F.when(F.col("indistinct") > 0.5, "too_fine").otherwise("kept").alias("verdict"))
    return experiment.select_resolution(s, "id", "area")


CHOICE = SUPPLIERS + """, f AS (SELECT * FROM s WHERE id % 3 <> 0 AND loss <= 3 AND indistinct <= 0.5)
SELECT (SELECT id FROM f ORDER BY area DESC, id DESC LIMIT 1) AS chosen, CASE WHEN (SELECT count(*) FROM f) = 0 THEN 'no_candidate_passes' ELSE 'selected' END AS reason, (SELECT count(*) FROM s) AS candidates"""


def edge_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Corners and edge middles of all units: to which cell the half-open lookup gives them, against the unit they come from."""
    points = experiment.edge_points(layers.units(spark), "unit_id")
    c, r = grid.square_index(F.col("x"), F.col("y"), layers.UNIT)
    named = points.withColumn("found", F.concat_ws("_", F.lit("u"), c.cast("string"), r.cast("string")))
    return named.groupBy((F.col("found") == F.col("unit_id")).alias("own")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("found").alias("cells"))


EDGE = with_layers("units", """
WITH p AS (SELECT unit_id, x0 + u / 2 * 1000 AS x, y0 + v / 2 * 1000 AS y FROM units, range(3) a(u), range(3) b(v) WHERE NOT (u = 1 AND v = 1)),
f AS (SELECT unit_id, 'u_' || CAST(floor(x / 1000) AS BIGINT) || '_' || CAST(floor(y / 1000) AS BIGINT) AS found FROM p)
SELECT found = unit_id AS own, count(*) AS n, count(DISTINCT found) AS cells FROM f GROUP BY 1""")


def tumbling_events(spark: SparkSession, d: str) -> DataFrame:
    out = windows.tumbling(layers.read(spark, d, "events"), "6 hours")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


TUMBLING = "SELECT strftime(time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"


def session_events(spark: SparkSession, d: str) -> DataFrame:
    out = windows.sessions(layers.read(spark, d, "events"), "3 hours")
    return out.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


SESSIONS = """
WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 3 HOURS THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k"""

#: An area that cuts through cells.
AREA = grids.Area(1250.0, 700.0, 18_900.0, 19_333.0)


def square_units(spark: SparkSession, d: str) -> DataFrame:
    """Units of a shifted square grid over an area: how many points each holds inside the area."""
    square = grids.SquareGrid(900.0, 100.0, 50.0)
    a, b = square.lookup(F.col("x"), F.col("y"))
    inside = layers.pois(spark, d).where(F.col("x").between(AREA.x0, AREA.x1) & F.col("y").between(AREA.y0, AREA.y1))
    counts = inside.groupBy(a.alias("a"), b.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    units = square.units(spark, AREA).join(counts, ["a", "b"], "left")
    return units.select("unit_id", "overlap_m2", F.round("overlap_share", 6).alias("overlap_share"), "rep_x", "rep_y", F.coalesce("n", F.lit(0)).alias("n"))


SQUARE_UNITS = with_layers("pois", """
WITH u AS (SELECT a, b, 900.0::DOUBLE * a + 100 AS x0, 900.0::DOUBLE * b + 50 AS y0 FROM range(1, 21) t(a), range(0, 22) s(b)),
o AS (SELECT *, greatest(0, least(x0 + 900, 18900) - greatest(x0, 1250)) * greatest(0, least(y0 + 900, 19333) - greatest(y0, 700)) AS overlap FROM u),
n AS (SELECT CAST(floor((x - 100) / 900) AS BIGINT) AS a, CAST(floor((y - 50) / 900) AS BIGINT) AS b, count(*) AS n FROM pois WHERE x BETWEEN 1250 AND 18900 AND y BETWEEN 700 AND 19333 GROUP BY 1, 2)
SELECT 'sq900|' || a || '_' || b AS unit_id, overlap AS overlap_m2, round(overlap / 810000, 6) AS overlap_share, x0 + 450 AS rep_x, y0 + 450 AS rep_y, coalesce(n, 0) AS n FROM o LEFT JOIN n USING (a, b)""")  # fmt: skip


def hex_units(spark: SparkSession, d: str) -> DataFrame:
    """Hexagons that meet an area cover it once: their parts add up to it; and every point inside is in one of them."""
    hexes = grids.HexGrid(700.0)
    units = hexes.units(spark, AREA)
    q, r = hexes.lookup(F.col("x"), F.col("y"))
    inside = layers.pois(spark, d).where(F.col("x").between(AREA.x0, AREA.x1) & F.col("y").between(AREA.y0, AREA.y1))
    held = inside.select(q.alias("a"), r.alias("b")).join(units.select("a", "b"), ["a", "b"])
    total = units.agg(F.round(F.sum("overlap_m2"), 2).alias("covered"))
    return total.crossJoin(held.agg(F.count(F.lit(1)).alias("points")))  # two single rows


HEX_UNITS = with_layers("pois", "SELECT round((18900.0::DOUBLE - 1250) * (19333 - 700), 2) AS covered, count(*) AS points FROM pois WHERE x BETWEEN 1250 AND 18900 AND y BETWEEN 700 AND 19333")


def hash_places(spark: SparkSession, d: str) -> DataFrame:
    """How many of a thousand seeded places fall to each cell of 2 km."""
    points = grids.hash_points(spark, 1000, AREA, "20260914")
    return points.groupBy(F.floor(F.col("x") / 2000).cast("long").alias("col"), F.floor(F.col("y") / 2000).cast("long").alias("row")).agg(F.count(F.lit(1)).alias("n"))


HASH_PLACES = """
WITH h AS (SELECT md5('20260914' || i) AS m FROM range(1000) t(i)),
p AS (SELECT 1250 + CAST(CAST('0x' || m[1:8] AS BIGINT) AS DOUBLE) / 4294967296 * 17650 AS x, 700 + CAST(CAST('0x' || m[9:16] AS BIGINT) AS DOUBLE) / 4294967296 * 18633 AS y FROM h)
SELECT CAST(floor(x / 2000) AS BIGINT) AS col, CAST(floor(y / 2000) AS BIGINT) AS row, count(*) AS n FROM p GROUP BY 1, 2"""


def admin_qualification(spark: SparkSession, d: str) -> DataFrame:
    """What a table of places offers for each region: rows, named ones, kinds, extents; one conditional aggregation."""
    joined = layers.pois(spark, d).join(F.broadcast(layers.read(spark, d, "nation")), F.col("nation") == F.col("n_nationkey"))  # 25 rows at any size
    return joined.groupBy("n_regionkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("weight") < 0, 1).otherwise(0)).cast("long").alias("negative"), F.countDistinct("category").alias("kinds"),
        F.min("x").alias("west"), F.max("x").alias("east"), F.min("y").alias("south"), F.max("y").alias("north"),
    )


ADMIN = with_layers("pois", "SELECT n_regionkey, count(*) AS n, CAST(sum(CASE WHEN weight < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative, count(DISTINCT category) AS kinds, min(x) AS west, max(x) AS east, min(y) AS south, max(y) AS north FROM pois JOIN nation ON n_nationkey = nation GROUP BY n_regionkey")

QUERIES = {
    "square_units": (square_units, SQUARE_UNITS),
    "hex_units": (hex_units, HEX_UNITS),
    "hash_places": (hash_places, HASH_PLACES),
    "admin_qualification": (admin_qualification, ADMIN),
    "metric_quantiles": (metric_quantiles, METRIC_QUANTILES),
    "sparsity": (sparsity, SPARSITY),
    "within_loss": (within_loss, WITHIN_LOSS),
    "jitter_change": (jitter_change, JITTER),
    "origin_flips": (origin_flips, ORIGIN),
    "maup": (maup, MAUP),
    "indistinct_pairs": (indistinct_pairs, INDISTINCT),
    "ring_circle": (ring_circle, RING),
    "coarse_gate": (coarse_gate, COARSE),
    "fine_gate": (fine_gate, FINE),
    "robustness_gate": (robustness_gate, ROBUST),
    "pareto_frontier": (pareto_frontier, PARETO),
    "completeness_gate": (completeness_gate, COMPLETENESS),
    "resolution_choice": (resolution_choice, CHOICE),
    "edge_lookup": (edge_lookup, EDGE),
    "tumbling_events": (tumbling_events, TUMBLING),
    "session_events": (session_events, SESSIONS),
}
