"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm._store import Scratch

#: Rounds after which a run is given up; each round shortens every path, so the rounds follow its logarithm.
MAX_ROUNDS = 60


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``node, root`` for every node of an edge: ``root`` is the smallest node that it is connected with.

    ``edges`` has columns ``a, b`` of one ordered type. Large-star and small-star steps alternate until nothing
    changes: every step links neighbours to the smallest of them. All state stays distributed; the minima are
    aggregated before they are shuffled, and a node with very many neighbours is a skewed join key at worst.
    """
    now = scratch.save(_pairs(edges.select("a", "b")), f"{tag}-0")
    size = _state(now)
    for k in range(1, MAX_ROUNDS):
        now = scratch.save(_small_star(_large_star(now)), f"{tag}-{k}")
        scratch.drop(f"{tag}-{k - 1}")
        size, before = _state(now), size
        if size == before:
            roots = now.select("b").distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
    raise RuntimeError("components did not converge")


def _pairs(edges: DataFrame) -> DataFrame:
    """Edges from the larger node to the smaller, each once."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    return _pairs(both.join(least, both.a == least.c).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "c")
    return _pairs(edges.join(least, edges.a == least.c).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("c").alias("a"), F.col("m").alias("b"))))
