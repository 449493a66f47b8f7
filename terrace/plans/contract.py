"""Queries on the tables' contracts, and summaries of features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import normalize, validate
from terrace.plans.normalised import ATOMIC, atomic
from terrace.plans.places import rounded
from terrace.sources import layers


def _table(spark: SparkSession, d: str) -> DataFrame:
    """A feature table with some faults planted by key."""
    k = F.col("unit")
    rows = atomic(spark, d).withColumn("ratio", F.when(F.col("status") == "ok", (k % 113) / 110.0)).withColumn("ratio_status", F.col("status"))
    bad = F.when(k % 101 == 7, F.lit("odd")).when(k % 89 == 3, F.lit("ok")).otherwise(F.col("status"))
    return rows.withColumn("status", bad)


TABLE = ATOMIC + """, t AS (SELECT unit, area, context, value, CASE WHEN unit % 101 = 7 THEN 'odd' WHEN unit % 89 = 3 THEN 'ok' ELSE status END AS status, CASE WHEN status = 'ok' THEN CAST(unit % 113 AS DOUBLE) / 110 END AS ratio, status AS ratio_status FROM a)"""


def validate_atomic(spark: SparkSession, d: str) -> DataFrame:
    checks = validate.violations({"value": "status", "ratio": "ratio_status"}, {"value": 0.0, "ratio": 0.0}, {"ratio": 1.0})
    return validate.report(_table(spark, d), checks, ["unit"])


_VOCABULARY = "('ok', 'source_unavailable', 'source_not_acquired', 'coverage_incomplete', 'denominator_zero', 'denominator_below_minimum', 'not_found_within_cap', 'search_truncated_by_extract', 'entity_assembly_failed')"


def _checks(v: str, s: str, high: bool) -> str:
    tests = {"status_unknown": f"{s} NOT IN {_VOCABULARY}", "bare_null": f"{v} IS NULL AND {s} = 'ok'", "value_despite_failure": f"{v} IS NOT NULL AND {s} <> 'ok'", "not_finite": f"NOT isfinite({v})", "below_range": f"{v} < 0"} | ({"above_range": f"{v} > 1"} if high else {})
    return " UNION ALL ".join(f"SELECT '{v}:{n}' AS check, count(*) FILTER ({t}) AS violations FROM t" for n, t in tests.items())


VALIDATE_ATOMIC = (TABLE + " " + _checks("value", "status", False) + " UNION ALL " + _checks("ratio", "ratio_status", True) + " UNION ALL SELECT 'key:repeated', count(*) FROM (SELECT unit FROM t GROUP BY unit HAVING count(*) > 1)").replace("AS check", 'AS "check"')


def validate_contextual(spark: SparkSession, d: str) -> DataFrame:
    source = atomic(spark, d)
    derived = source.where("unit % 50 <> 9").select("unit", F.when(F.col("unit") % 77 == 11, 1.0).otherwise(F.log1p("value")).alias("log_value"), F.when(F.col("unit") % 143 == 0, "ok").otherwise(F.col("status")).alias("log_status"))
    return validate.contextual_checks(derived, source, "unit", {"log_value": "value"}, {"log_status": "status"})


VALIDATE_CONTEXTUAL = ATOMIC + """, g AS (SELECT unit, CASE WHEN unit % 77 = 11 THEN 1.0 ELSE ln(1 + value) END AS lv, CASE WHEN unit % 143 = 0 THEN 'ok' ELSE status END AS ls FROM a WHERE unit % 50 <> 9),
j AS (SELECT g.unit, a.unit AS k, lv, ls, value, status FROM g FULL JOIN a ON a.unit = g.unit)
SELECT 'key:missing' AS "check", count(*) FILTER (unit IS NULL) AS violations FROM j UNION ALL SELECT 'key:unknown', count(*) FILTER (k IS NULL) FROM j
UNION ALL SELECT 'log_value:imputed', count(*) FILTER (lv IS NOT NULL AND value IS NULL) FROM j
UNION ALL SELECT 'log_status:not_verbatim', count(*) FILTER (status <> 'ok' AND ls <> status) FROM j
UNION ALL SELECT 'log_status:unknown', count(*) FILTER (k IS NOT NULL AND (ls IS NULL OR ls NOT IN ('ok', 'coverage_incomplete', 'source_unavailable'))) FROM j"""


def _long(spark: SparkSession, d: str) -> DataFrame:
    return validate.long_format(_table(spark, d).withColumn("status", F.when(F.col("value").isNull(), "source_unavailable").otherwise("ok")), ["unit", "area"], {"value": "status", "ratio": "ratio_status"})


LONG = TABLE + """, l AS (SELECT unit, area, 'value' AS feature, value, CASE WHEN value IS NULL THEN 'source_unavailable' ELSE 'ok' END AS status FROM t UNION ALL SELECT unit, area, 'ratio', ratio, ratio_status FROM t)"""


def null_zero_rates(spark: SparkSession, d: str) -> DataFrame:
    out = validate.null_and_zero_rates(_long(spark, d), ["feature"])
    return out.select("feature", "n", "nulls", "zeros", *rounded("null_rate", "zero_rate"))


NULL_ZERO = LONG + "SELECT feature, count(*) AS n, count(*) FILTER (value IS NULL) AS nulls, count(*) FILTER (value = 0) AS zeros, round(count(*) FILTER (value IS NULL) / count(*), 6) AS null_rate, round(count(*) FILTER (value = 0) / count(*), 6) AS zero_rate FROM l GROUP BY feature"


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return validate.status_counts(_long(spark, d), ["feature", "area"])


STATUS_COUNTS = LONG + "SELECT feature, area, status, count(*) AS n FROM l GROUP BY ALL"


def area_summary(spark: SparkSession, d: str) -> DataFrame:
    out = validate.area_summary(_long(spark, d), ["area", "feature"])
    return out.select("area", "feature", *rounded("null_rate", "zero_rate", "p05", "p50", "p95"))


AREA_SUMMARY = LONG + "SELECT area, feature, round(avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0 END), 6) AS null_rate, round(avg(CASE WHEN value = 0 THEN 1.0 WHEN value IS NOT NULL THEN 0 END), 6) AS zero_rate, round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM l GROUP BY area, feature"


def distributions(spark: SparkSession, d: str) -> DataFrame:
    out = validate.distributions(_long(spark, d), "area")
    return out.select("feature", F.coalesce(F.col("area").cast("string"), F.lit("all")).alias("area"), "pooled", *rounded("null_rate", "zero_share"), "n_values", *rounded("min", "p50", "p95", "max", "skew", "skew_log1p"))


DISTRIBUTIONS = LONG + """SELECT feature, coalesce(CAST(area AS VARCHAR), 'all') AS area, grouping(area)::INTEGER AS pooled, round(avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0 END), 6) AS null_rate, round(avg(CASE WHEN value = 0 THEN 1.0 WHEN value IS NOT NULL THEN 0 END), 6) AS zero_share, count(DISTINCT value) AS n_values,
round(min(value), 6) AS min, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(max(value), 6) AS max, round(skewness(value), 6) AS skew, round(skewness(ln(1 + value)), 6) AS skew_log1p FROM l GROUP BY GROUPING SETS ((feature, l.area), (feature))""".replace("CAST(area AS", "CAST(l.area AS").replace("grouping(area)", "grouping(l.area)")


def feature_manifest(spark: SparkSession, d: str) -> DataFrame:
    rows = _long(spark, d)
    extra = rows.where("feature = 'ratio'").select("unit", "area", F.lit("empty").alias("feature"), F.lit(None).cast("double").alias("value"), F.lit("source_not_acquired").alias("status"))
    out = validate.disposition(rows.unionByName(extra))
    return out.select("feature", "disposition", *rounded("ok_share"))


MANIFEST = LONG + """, m AS (SELECT feature, value FROM l UNION ALL SELECT 'empty', NULL FROM t)
SELECT feature, CASE WHEN count(value) = 0 THEN 'all_null' WHEN min(value) = max(value) THEN 'constant' WHEN count(value) / count(*) < 0.5 THEN 'partial' ELSE 'published' END AS disposition, round(count(value) / count(*), 6) AS ok_share FROM m GROUP BY feature"""


def selection_bias(spark: SparkSession, d: str) -> DataFrame:
    """Known and censored distances by area, against the radius that is known completely."""
    k = F.col("unit")
    rows = atomic(spark, d).withColumns({"radius": (k * 37 % 5000).cast("double"), "dist": (k * 91 % 6000).cast("double")})
    state = F.when((F.col("dist") <= 4000) & (F.col("dist") <= F.col("radius")), "ok").when(F.col("radius") >= 4000, "not_found_within_cap").otherwise("search_truncated_by_extract")
    named = rows.select("area", "radius", state.alias("status"), F.when(state == "ok", F.col("dist")).alias("value"))
    out = validate.selection_bias(named, ["area"], "radius")
    return out.select("area", "n_ok", "n_not_found", "n_truncated", *rounded("ok_share", "p50"), "max", *rounded("radius_p50"), "beyond_radius")


BIAS = ATOMIC + """, r AS (SELECT area, CAST(unit * 37 % 5000 AS DOUBLE) AS radius, CAST(unit * 91 % 6000 AS DOUBLE) AS dist FROM a),
s AS (SELECT *, CASE WHEN dist <= 4000 AND dist <= radius THEN 'ok' WHEN radius >= 4000 THEN 'not_found_within_cap' ELSE 'search_truncated_by_extract' END AS st FROM r),
v AS (SELECT *, CASE WHEN st = 'ok' THEN dist END AS value FROM s)
SELECT area, count(*) FILTER (st = 'ok') AS n_ok, count(*) FILTER (st = 'not_found_within_cap') AS n_not_found, count(*) FILTER (st = 'search_truncated_by_extract') AS n_truncated, round(avg(CASE WHEN st = 'ok' THEN 1.0 ELSE 0 END), 6) AS ok_share, round(quantile_cont(value, 0.5), 6) AS p50, max(value) AS max, round(quantile_cont(radius, 0.5), 6) AS radius_p50, count(*) FILTER (value > radius) AS beyond_radius FROM v GROUP BY area"""  # fmt: skip


def key_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Keys of lines and orders that the other table lacks, and required pairs that are absent."""
    a = layers.read(spark, d, "orders").select(F.col("o_orderkey").alias("k")).distinct()
    b = layers.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")).distinct()
    only = a.exceptAll(b).select(F.lit("orders").alias("side"), "k").unionByName(b.exceptAll(a).select(F.lit("lines").alias("side"), "k"))
    return only.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first"))


ALIGNMENT = """
WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT side, count(*) AS n, min(k) AS first FROM (SELECT 'orders' AS side, k FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT 'lines', k FROM b WHERE k NOT IN (SELECT k FROM a)) GROUP BY side"""

QUERIES = {
    "validate_atomic": (validate_atomic, VALIDATE_ATOMIC),
    "validate_contextual": (validate_contextual, VALIDATE_CONTEXTUAL),
    "null_zero_rates": (null_zero_rates, NULL_ZERO),
    "status_counts": (status_counts, STATUS_COUNTS),
    "area_summary": (area_summary, AREA_SUMMARY),
    "distributions": (distributions, DISTRIBUTIONS),
    "feature_manifest": (feature_manifest, MANIFEST),
    "selection_bias": (selection_bias, BIAS),
    "key_alignment": (key_alignment, ALIGNMENT),
}
