"""Road graphs as edge tables: degrees, induced subgraphs, components."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rounds after which components are given up; a round shortens every path, so rounds follow its logarithm.
MAX_ROUNDS = 60


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage in the cluster's shared checkpoint folder; only where none is set (local work) a folder is made."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(shared or "file://" + tempfile.mkdtemp(prefix="terrace-"))
    return df.checkpoint()


def way_edges(nodes: DataFrame) -> DataFrame:
    """Consecutive nodes of a way as edges: way, seq, a, b, their places and the way's columns."""
    w = Window.partitionBy("way").orderBy("seq")
    ahead = {"b": F.lead("node").over(w), "bx": F.lead("x").over(w), "by": F.lead("y").over(w)}
    return nodes.withColumns(ahead).where("b is not null").withColumnsRenamed({"node": "a", "x": "ax", "y": "ay"})


def connector_edges(segments: DataFrame, connectors: str = "connectors") -> DataFrame:
    """Edges of segments that list ``{connector_id, at}``: connectors in order of ``at``, each with the next."""
    ordered = F.transform(F.array_sort(F.transform(connectors, lambda c: F.struct(c["at"].alias("at"), c["connector_id"].alias("id")))), lambda c: c["id"])
    n = F.size(ordered) - 1
    pairs = F.when(n > 0, F.arrays_zip(F.slice(ordered, F.lit(1), n).alias("a"), F.slice(ordered, F.lit(2), n).alias("b")))
    return segments.withColumn("__e", F.explode(pairs)).select(*[c for c in segments.columns if c != connectors], F.col("__e.a").alias("a"), F.col("__e.b").alias("b"))


def degrees(edges: DataFrame) -> DataFrame:
    """``node, degree``: parallel edges count each, a loop counts twice."""
    ends = edges.select(F.col("a").alias("node")).unionAll(edges.select(F.col("b").alias("node")))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def induced(edges: DataFrame, places: DataFrame, inside: Column) -> DataFrame:
    """Edges both of whose ends lie inside (the box's edge counts)."""
    kept = places.where(inside).select("node").distinct()
    return edges.join(kept.withColumnRenamed("node", "a"), "a", "left_semi").join(kept.withColumnRenamed("node", "b"), "b", "left_semi")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the smallest node that each node is connected with, by alternating star steps."""
    ordered = lambda e: e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    alone = edges.where(F.col(a) == F.col(b)).select(F.col(a).alias("node")).distinct()
    now, state = cut(ordered(edges.select(F.col(a).alias("a"), F.col(b).alias("b")))), None
    for _ in range(MAX_ROUNDS):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
        large = ordered(both.join(least, both.a == least.c).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "c")
        joined = large.join(small, large.a == small.c).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(ordered(joined.unionAll(small.select(F.col("c").alias("a"), F.col("m").alias("b")))))
        state, before = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first(), state
        if state == before:
            stars = now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root")))
            return stars.unionAll(alone.join(stars, "node", "left_anti").select("node", F.col("node").alias("root")))
    raise RuntimeError("components did not converge")


def component_lengths(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``root, length, share`` of each component's edges, from the ends' places."""
    length = F.sqrt((F.col("bx") - F.col("ax")) ** 2 + (F.col("by") - F.col("ay")) ** 2)
    sums = edges.join(roots, F.col("a") == F.col("node")).groupBy("root").agg(F.sum(length).alias("length"))
    total = sums.agg(F.sum("length").alias("total"))
    return sums.crossJoin(F.broadcast(total)).select("root", "length", F.try_divide("length", "total").alias("share"))  # one row


def largest_components(lengths: DataFrame, n: int) -> DataFrame:
    """The ``n`` longest components, ties to the smaller root."""
    return lengths.orderBy(F.desc("length"), "root").limit(n)
