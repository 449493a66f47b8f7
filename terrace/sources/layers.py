"""Input layers of the engine from the star schema, by whole-number arithmetic, in metres of a 20 km square.

The tables hold no geometry, so places are derived from keys. The same derivations stand as SQL beside
them: both engines then start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Side of the area, of a unit, of a raster's pixel and of a land-cover pixel.
SIDE, UNIT, PIXEL, LAND = 20_000, 1000, 100, 500
#: Land-cover classes in order of their number.
CLASSES = [10, 20, 30, 40, 80, 95]


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _at(key: str, factor: int) -> Column:
    return (F.col(key) * factor % SIDE).cast("double")


def pois(spark: SparkSession, d: str) -> DataFrame:
    """Points of interest: poi_id, x, y, category, name, weight."""
    return read(spark, d, "customer").select(
        F.col("c_custkey").alias("poi_id"), _at("c_custkey", 7919).alias("x"), _at("c_custkey", 104_729).alias("y"),
        F.col("c_mktsegment").alias("category"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("weight"), F.col("c_nationkey").alias("nation"),
    )


def places(spark: SparkSession, d: str) -> DataFrame:
    """A second source of points: place_id, x, y, category, confidence, name."""
    segments = F.array(*[F.lit(s) for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")])
    return read(spark, d, "supplier").select(
        F.col("s_suppkey").alias("place_id"), _at("s_suppkey", 6007).alias("x"), _at("s_suppkey", 15_013).alias("y"),
        F.element_at(segments, (F.col("s_nationkey") % 5 + 1).cast("int")).alias("category"),
        (F.col("s_suppkey") % 100 / 100.0).cast("double").alias("confidence"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
    )


def units(spark: SparkSession) -> DataFrame:
    """The square cells of the area: unit_id, col, row, x0, y0, x1, y1."""
    n = SIDE // UNIT
    cells = spark.range(n * n).select((F.col("id") % n).alias("col"), F.floor(F.col("id") / n).cast("long").alias("row"))
    x0, y0 = (F.col("col") * UNIT).cast("double"), (F.col("row") * UNIT).cast("double")
    return cells.select(F.concat_ws("_", F.lit("u"), F.col("col").cast("string"), F.col("row").cast("string")).alias("unit_id"), "col", "row", x0.alias("x0"), y0.alias("y0"), (x0 + UNIT).alias("x1"), (y0 + UNIT).alias("y1"))


def nodes(spark: SparkSession, d: str) -> DataFrame:
    """Places of a way's nodes: way, seq, node, x, y, is_major."""
    o, n = F.col("l_orderkey"), F.col("l_linenumber").cast("long")
    lines = read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber")
    once = lines.agg(F.min("l_partkey").alias("node"), F.max(F.col("l_returnflag") == "R").alias("is_major"), F.min("l_linestatus").alias("class"))
    x, y = o * 7919 % 19_000 + n * 137 % 1000, o * 104_729 % 19_000 + n * 311 % 1000
    return once.select(o.alias("way"), n.alias("seq"), "node", x.cast("double").alias("x"), y.cast("double").alias("y"), "is_major", "class")


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """A raster of counts: row, col, value (null: no data), one row for each pixel."""
    o = F.col("o_orderkey")
    cells = read(spark, d, "orders").select((o % 200).alias("row"), (F.floor(o / 200) % 200).cast("long").alias("col"), o, F.floor("o_totalprice").cast("long").alias("v"))
    grouped = cells.groupBy("row", "col").agg(F.min("o_orderkey").alias("k"), F.max("v").alias("v"))
    return grouped.select("row", "col", F.when(F.col("k") % 13 != 0, F.col("v").cast("double")).alias("value"))


def built(spark: SparkSession, d: str) -> DataFrame:
    """Built-up share of 100 m pixels: row, col, value in 0..1, null for no data."""
    return pixels(spark, d).select("row", "col", (F.pmod(F.col("value"), F.lit(101.0)) / 100.0).alias("value")).withColumn("value", F.least("value", F.lit(1.0)))


def land(spark: SparkSession, d: str) -> DataFrame:
    """Land-cover classes of 500 m pixels: row, col, class (0: no data)."""
    p = F.col("p_partkey")
    cells = read(spark, d, "part").select((p % 40).alias("row"), (F.floor(p / 40) % 40).cast("long").alias("col"), p)
    classes = F.array(*[F.lit(c) for c in CLASSES])
    grouped = cells.groupBy("row", "col").agg(F.min("p_partkey").alias("k"))
    return grouped.select("row", "col", F.when(F.col("k") % 17 == 0, 0).otherwise(F.element_at(classes, (F.col("k") * 31 % 6 + 1).cast("int"))).alias("class"))


#: The same layers for DuckDB, as common table expressions.
SQL = {
    "pois": "pois AS (SELECT c_custkey AS poi_id, CAST(c_custkey * 7919 % 20000 AS DOUBLE) AS x, CAST(c_custkey * 104729 % 20000 AS DOUBLE) AS y, c_mktsegment AS category, c_name AS name, c_acctbal AS weight, c_nationkey AS nation FROM customer)",
    "places": "places AS (SELECT s_suppkey AS place_id, CAST(s_suppkey * 6007 % 20000 AS DOUBLE) AS x, CAST(s_suppkey * 15013 % 20000 AS DOUBLE) AS y, ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][s_nationkey % 5 + 1] AS category, CAST(s_suppkey % 100 AS DOUBLE) / 100 AS confidence, s_name AS name, s_nationkey AS nation FROM supplier)",
    "units": "units AS (SELECT 'u_' || c || '_' || r AS unit_id, CAST(c AS BIGINT) AS col, CAST(r AS BIGINT) AS row, CAST(c * 1000 AS DOUBLE) AS x0, CAST(r * 1000 AS DOUBLE) AS y0, CAST(c * 1000 + 1000 AS DOUBLE) AS x1, CAST(r * 1000 + 1000 AS DOUBLE) AS y1 FROM range(20) a(c), range(20) b(r))",
    "nodes": "nodes AS (SELECT l_orderkey AS way, CAST(l_linenumber AS BIGINT) AS seq, min(l_partkey) AS node, CAST(l_orderkey * 7919 % 19000 + l_linenumber * 137 % 1000 AS DOUBLE) AS x, CAST(l_orderkey * 104729 % 19000 + l_linenumber * 311 % 1000 AS DOUBLE) AS y, bool_or(l_returnflag = 'R') AS is_major, min(l_linestatus) AS class FROM lineitem GROUP BY l_orderkey, l_linenumber)",
    "segments": "segments AS (SELECT * FROM (SELECT way, seq, node AS a, lead(node) OVER w AS b, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS b_y, is_major, class FROM nodes WINDOW w AS (PARTITION BY way ORDER BY seq)) WHERE b IS NOT NULL)",
    "pixels": "pixels AS (SELECT row, col, CASE WHEN k % 13 <> 0 THEN CAST(v AS DOUBLE) END AS value FROM (SELECT o_orderkey % 200 AS row, CAST(floor(o_orderkey / 200) AS BIGINT) % 200 AS col, min(o_orderkey) AS k, max(CAST(floor(o_totalprice) AS BIGINT)) AS v FROM orders GROUP BY 1, 2))",
    "built": "built AS (SELECT row, col, least((value % 101.0) / 100.0, 1.0) AS value FROM pixels)",
    "land": "land AS (SELECT row, col, CASE WHEN k % 17 = 0 THEN 0 ELSE [10, 20, 30, 40, 80, 95][k * 31 % 6 + 1] END AS class FROM (SELECT p_partkey % 40 AS row, CAST(floor(p_partkey / 40) AS BIGINT) % 40 AS col, min(p_partkey) AS k FROM part GROUP BY 1, 2))",
}


def with_layers(names: str, body: str) -> str:
    """A statement over the named layers, with the layers that these need."""
    needs = {"segments": ["nodes"], "built": ["pixels"]}
    wanted: list[str] = []
    for n in names.split():
        wanted += [x for x in [*needs.get(n, []), n] if x not in wanted]
    body = body.strip()
    return "WITH " + ",\n".join(SQL[n] for n in wanted) + ((",\n" + body[5:]) if body.startswith("WITH ") else ("\n" + body))
