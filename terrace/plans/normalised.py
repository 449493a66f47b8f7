"""Queries on normalisation: statuses, transforms, percentiles, local ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import grid
from terrace.functions.stats import adjusted_skewness
from terrace.operators import normalize
from terrace.plans.places import rounded
from terrace.sources import layers
from terrace.sources.layers import with_layers


def atomic(spark: SparkSession, d: str) -> DataFrame:
    """A feature with ties and failures: unit, area (region), context (nation), value, status."""
    k = F.col("c_custkey")
    status = F.when(k % 11 == 0, "coverage_incomplete").when(k % 13 == 0, "source_unavailable").otherwise("ok")
    areas = layers.read(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("area"))
    value = F.greatest(F.lit(0.0), F.floor(F.col("c_acctbal") / 50).cast("double"))
    rows = layers.read(spark, d, "customer").join(F.broadcast(areas), "c_nationkey")  # 25 nations at any size
    return rows.select(k.alias("unit"), "area", F.col("c_nationkey").alias("context"), F.when(status == "ok", value).alias("value"), status.alias("status"))


ATOMIC = """
WITH a0 AS (SELECT c_custkey AS unit, n_regionkey AS area, c_nationkey AS context, greatest(0, floor(c_acctbal / 50)) AS v,
  CASE WHEN c_custkey % 11 = 0 THEN 'coverage_incomplete' WHEN c_custkey % 13 = 0 THEN 'source_unavailable' ELSE 'ok' END AS status FROM customer JOIN nation ON n_nationkey = c_nationkey),
a AS (SELECT unit, area, context, CASE WHEN status = 'ok' THEN v END AS value, status FROM a0)"""


def log1p_features(spark: SparkSession, d: str) -> DataFrame:
    rows = atomic(spark, d)
    return rows.select("unit", F.round(normalize.log1p(F.col("value"), F.col("status"), "value"), 6).alias("log1p_value"), "status")


LOG1P = ATOMIC + "SELECT unit, round(ln(1 + value), 6) AS log1p_value, status FROM a"


def skew_publish(spark: SparkSession, d: str) -> DataFrame:
    """By area whether the logarithm is published: skewness of at least 1 that it lowers."""
    rows = atomic(spark, d).where("status = 'ok'").withColumn("value", F.col("value") * F.col("value"))
    out = rows.groupBy("area").agg(adjusted_skewness(F.col("value")).alias("raw"), adjusted_skewness(F.log1p("value")).alias("logged"))
    return out.select("area", *rounded("raw", "logged"), ((F.col("raw") >= 1) & (F.abs("logged") < F.abs("raw"))).alias("published"))


SKEW = ATOMIC + """, s AS (SELECT area, skewness(value * value) AS raw, skewness(ln(1 + value * value)) AS logged FROM a WHERE status = 'ok' GROUP BY area)
SELECT area, round(raw, 6) AS raw, round(logged, 6) AS logged, raw >= 1 AND abs(logged) < abs(raw) AS published FROM s"""


def ecdf_fit(spark: SparkSession, d: str) -> DataFrame:
    rows = atomic(spark, d).withColumn("area", F.when(F.col("unit") % 97 == 1, 99).otherwise(F.col("area")))
    table = normalize.fit_ecdf(rows, ["area"])
    return table.select("area", "value", "w_equal", "w_below", "w_total", "n_obs", "fit_status")


ECDF_FIT = ATOMIC + """, b AS (SELECT CASE WHEN unit % 97 = 1 THEN 99 ELSE area END AS area, value FROM a WHERE status = 'ok'),
g AS (SELECT area, value, count(*) AS n FROM b GROUP BY ALL),
w AS (SELECT area, value, n, sum(n) OVER (PARTITION BY area) AS total, count(*) OVER (PARTITION BY area) AS k, coalesce(sum(n) OVER (PARTITION BY area ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, row_number() OVER (PARTITION BY area ORDER BY value) AS i FROM g),
s AS (SELECT *, CASE WHEN total < 30 THEN 'cohort_too_small' WHEN k < 2 THEN 'cohort_degenerate' ELSE 'fitted' END AS fs FROM w)
SELECT area, CASE WHEN fs = 'fitted' THEN value END AS value, CASE WHEN fs = 'fitted' THEN CAST(n AS DOUBLE) END AS w_equal, CASE WHEN fs = 'fitted' THEN CAST(below AS DOUBLE) END AS w_below, CASE WHEN fs = 'fitted' THEN CAST(total AS DOUBLE) END AS w_total, CAST(total AS BIGINT) AS n_obs, fs AS fit_status FROM s WHERE fs = 'fitted' OR i = 1"""  # fmt: skip


def percentiles(spark: SparkSession, d: str) -> DataFrame:
    rows = atomic(spark, d)
    out = normalize.apply_ecdf(rows, normalize.fit_ecdf(rows, ["area"]), ["area"])
    return out.select("unit", *rounded("pct_midrank", "pct_min", "pct_max"), "pct_status")


PERCENTILES = ATOMIC + """, o AS (SELECT unit, rank() OVER w AS r, count(*) OVER (PARTITION BY area) AS n, cume_dist() OVER w AS cd FROM a WHERE status = 'ok' WINDOW w AS (PARTITION BY area ORDER BY value))
SELECT unit, CASE WHEN n >= 30 THEN round(((r - 1) / n + cd) / 2, 6) END AS pct_midrank, CASE WHEN n >= 30 THEN round((r - 1) / n, 6) END AS pct_min, CASE WHEN n >= 30 THEN round(cd, 6) END AS pct_max, CASE WHEN n >= 30 THEN 'ok' ELSE 'cohort_too_small' END AS pct_status FROM o
UNION ALL SELECT unit, NULL, NULL, NULL, status FROM a WHERE status <> 'ok'"""


def unseen_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers against the customers' table: most values were not seen when it was fitted."""
    table = normalize.fit_ecdf(atomic(spark, d), ["area"])
    areas = layers.read(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("area"))
    asked = layers.read(spark, d, "supplier").join(F.broadcast(areas), "s_nationkey").select(F.col("s_suppkey").alias("unit"), F.when(F.col("s_suppkey") % 10 == 0, 77).otherwise(F.col("area")).alias("area"), (F.col("s_acctbal") / 50).alias("value"), F.lit("ok").alias("status"))
    out = normalize.apply_ecdf(asked, table, ["area"], methods=("midrank",))
    return out.select("unit", "area", F.round("pct_midrank", 6).alias("pct"), "pct_status")


UNSEEN = ATOMIC + """, q AS (SELECT s_suppkey AS unit, CASE WHEN s_suppkey % 10 = 0 THEN 77 ELSE n_regionkey END AS area, s_acctbal / 50 AS value FROM supplier JOIN nation ON n_nationkey = s_nationkey),
n AS (SELECT area, count(*) AS n FROM a WHERE status = 'ok' GROUP BY area)
SELECT q.unit, q.area, CASE WHEN n.n >= 30 THEN round((SELECT count(*) FILTER (a.value < q.value) + 0.5 * count(*) FILTER (a.value = q.value) FROM a WHERE a.area = q.area AND a.status = 'ok') / n.n, 6) END AS pct, CASE WHEN n.n IS NULL THEN 'cohort_not_fitted' WHEN n.n < 30 THEN 'cohort_too_small' ELSE 'ok' END AS pct_status FROM q LEFT JOIN n USING (area)"""  # fmt: skip


def weighted_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """One pooled cohort in which every area counts alike."""
    rows = atomic(spark, d).withColumn("cohort", F.lit("pooled"))
    weighed = rows.withColumn("w", normalize.equal_weights("area"))
    table = normalize.fit_ecdf(weighed, ["cohort"], weight=F.col("w"))
    out = normalize.apply_ecdf(rows, table, ["cohort"], methods=("midrank",))
    return out.select("unit", F.round("pct_midrank", 6).alias("pct"), "pct_status")


WEIGHTED = ATOMIC + """, w AS (SELECT unit, value, 1.0::DOUBLE / count(*) OVER (PARTITION BY area) AS w FROM a WHERE status = 'ok'),
g AS (SELECT value, sum(w) AS e FROM w GROUP BY value),
c AS (SELECT value, e, coalesce(sum(e) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, sum(e) OVER () AS t FROM g)
SELECT unit, round((b + e / 2) / t, 6) AS pct, 'ok' AS pct_status FROM w JOIN c USING (value) UNION ALL SELECT unit, NULL, status FROM a WHERE status <> 'ok'"""


def held_out_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    """How far a unit's pooled percentile moves when another area is left out of the fit: largest move by area left out."""
    rows = atomic(spark, d)
    left_out = rows.select(F.col("area").alias("held_out")).distinct()  # as many rows as areas
    dealt = rows.withColumn("__g", F.lit(1)).join(F.broadcast(left_out.withColumn("__g", F.lit(1))), "__g").drop("__g").where("area <> held_out")
    refitted = normalize.apply_ecdf(dealt, normalize.fit_ecdf(dealt, ["held_out"]), ["held_out"], methods=("midrank",)).where("pct_status = 'ok'").select("unit", "held_out", F.col("pct_midrank").alias("p1"))
    pooled = rows.withColumn("cohort", F.lit("pooled"))
    base = normalize.apply_ecdf(pooled, normalize.fit_ecdf(pooled, ["cohort"]), ["cohort"], methods=("midrank",)).select("unit", F.col("pct_midrank").alias("p0"))
    moved = refitted.join(base, "unit").withColumn("move", F.abs(F.col("p1") - F.col("p0")))
    return moved.groupBy("held_out").agg(F.round(F.max("move"), 6).alias("largest"), F.round(F.percentile("move", 0.5), 6).alias("median"), F.count(F.lit(1)).alias("n"))


HELD_OUT = ATOMIC + """, o AS (SELECT unit, area, value FROM a WHERE status = 'ok'),
p0 AS (SELECT unit, ((rank() OVER w - 1) / (SELECT count(*) FROM o) + cume_dist() OVER w) / 2 AS p0 FROM o WINDOW w AS (ORDER BY value)),
x AS (SELECT h.area AS held_out, o.unit, o.value FROM o JOIN (SELECT DISTINCT area FROM a) h ON h.area <> o.area),
p1 AS (SELECT held_out, unit, ((rank() OVER w - 1) / count(*) OVER (PARTITION BY held_out) + cume_dist() OVER w) / 2 AS p1 FROM x WINDOW w AS (PARTITION BY held_out ORDER BY value))
SELECT held_out, round(max(abs(p1 - p0)), 6) AS largest, round(quantile_cont(abs(p1 - p0), 0.5), 6) AS median, count(*) AS n FROM p1 JOIN p0 USING (unit) GROUP BY held_out"""  # fmt: skip


def _unit_values(spark: SparkSession, d: str) -> DataFrame:
    c, r = grid.square_index(F.col("x"), F.col("y"), layers.UNIT)
    counted = layers.pois(spark, d).groupBy(c.alias("col"), r.alias("row")).agg(F.count(F.lit(1)).alias("n"))
    status = F.when((F.col("col") * 31 + F.col("row")) % 17 == 0, "coverage_incomplete").otherwise("ok")
    return layers.units(spark).join(counted, ["col", "row"], "left").select("unit_id", "col", "row", F.when(status == "ok", F.coalesce("n", F.lit(0)).cast("double")).alias("value"), status.alias("status"))


UNIT_VALUES = """
WITH n AS (SELECT u.unit_id, u.col, u.row, count(p.poi_id) AS n FROM units u LEFT JOIN pois p ON floor(p.x / 1000) = u.col AND floor(p.y / 1000) = u.row GROUP BY ALL),
v AS (SELECT unit_id, col, row, CASE WHEN (col * 31 + row) % 17 <> 0 THEN CAST(n AS DOUBLE) END AS value, CASE WHEN (col * 31 + row) % 17 = 0 THEN 'coverage_incomplete' ELSE 'ok' END AS status FROM n)"""


def local_ratio(spark: SparkSession, d: str) -> DataFrame:
    units = _unit_values(spark, d)
    pairs = grid.neighbours(units, "unit_id", "col", "row", grid.square_ring(1))
    out = normalize.local_ratio(units, pairs, F.lit(8), normalize.NeighbourhoodPolicy(1, 6, "median"))
    return out.select("unit_id", *rounded("ratio"), "ratio_status")


LOCAL_RATIO = with_layers("pois units", UNIT_VALUES + """,
r AS (SELECT a.unit_id, count(*) AS k, count(b.value) AS valid, quantile_cont(b.value, 0.5) AS ref FROM v a JOIN v b ON abs(a.col - b.col) <= 1 AND abs(a.row - b.row) <= 1 AND a.unit_id <> b.unit_id GROUP BY a.unit_id),
s AS (SELECT v.unit_id, value, ref, CASE WHEN status <> 'ok' THEN status WHEN k < 8 THEN 'neighborhood_incomplete' WHEN valid < 6 THEN 'neighborhood_insufficient_valid' WHEN ref <= 0 THEN 'neighborhood_reference_zero' ELSE 'ok' END AS ratio_status FROM v JOIN r USING (unit_id))
SELECT unit_id, CASE WHEN ratio_status = 'ok' THEN round(value / ref, 6) END AS ratio, ratio_status FROM s""")  # fmt: skip


def peer_sufficiency(spark: SparkSession, d: str) -> DataFrame:
    return normalize.peers_are_sufficient(atomic(spark, d), "area", "context", 5)


PEERS = ATOMIC + "SELECT area, count(DISTINCT context) AS areas, count(DISTINCT context) >= 5 AS sufficient FROM a GROUP BY area"

QUERIES = {
    "log1p_features": (log1p_features, LOG1P),
    "skew_publish": (skew_publish, SKEW),
    "ecdf_fit": (ecdf_fit, ECDF_FIT),
    "percentiles": (percentiles, PERCENTILES),
    "unseen_percentiles": (unseen_percentiles, UNSEEN),
    "weighted_percentiles": (weighted_percentiles, WEIGHTED),
    "held_out_sensitivity": (held_out_sensitivity, HELD_OUT),
    "local_ratio": (local_ratio, LOCAL_RATIO),
    "peer_sufficiency": (peer_sufficiency, PEERS),
}
