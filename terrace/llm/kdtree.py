"""Exact top-k by inner product over KD-trees, one for each shard.

A shard's tree splits at the median of its widest component down to leaves of at most ``LEAF`` rows; every node
keeps the tight box of its rows. For a query, a box bounds the inner product from above (the larger of the two corner
products in each component), and nodes are visited best bound first until the bound falls below the kth score. Queries of
a block take their steps together, and those at one leaf are multiplied with its rows at once. The kth score starts from a
bounded set of long vectors that all tasks know, and rises within the shard.

Vectors are whole numbers here: ``floor(256 x)`` of each component; sums are exact (in doubles while they stay below
2 to the 53rd, in Python's integers beyond; a score beyond a long is an error). Otherwise see ``vectors``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import vectors
from terrace.llm._store import Scratch, small_batches

LEAF, SCALE = 512, 256
#: Rows (those of greatest length) from which the first kth score comes, of all shards.
SEEDS = 1024


class Tree:
    """Nodes in arrays: boxes, children, and the rows of leaves."""

    def __init__(self, points: np.ndarray):
        self.points, self.low, self.high, self.children, self.rows = points, [], [], [], []
        if len(points):
            self._node(np.arange(len(points)))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _node(self, rows: np.ndarray) -> int:
        at, own = len(self.rows), self.points[rows]
        low, high = own.min(axis=0), own.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.children.append(())
        self.rows.append(rows)
        wide = int((high - low).argmax())
        if len(rows) > LEAF and high[wide] > low[wide]:
            order = rows[np.argsort(own[:, wide], kind="stable")]
            half = len(order) // 2
            self.rows[at] = None
            self.children[at] = (self._node(np.sort(order[:half])), self._node(np.sort(order[half:])))
        return at

    def search(self, queries: np.ndarray, own_rows: list[slice], floors: np.ndarray, k: int):
        """For each query, positions and scores of its ``k`` best rows outside ``own_rows`` among those that can reach its floor."""
        if not len(self.points):
            for _ in queries:
                yield np.zeros(0, np.int64), np.zeros(0)
            return
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        found = [(np.zeros(0, np.int64), np.zeros(0, self.points.dtype))] * len(queries)
        kth, live = np.array(floors, self.points.dtype), np.arange(len(queries))
        ahead = np.full(bounds.shape, -np.inf, bounds.dtype)  # bounds of the nodes that a query may visit next
        ahead[:, 0] = bounds[:, 0]
        while len(live):
            node = ahead[live].argmax(axis=1)
            top = ahead[live, node]
            on = (top >= kth[live]) & (top > -np.inf)
            live, node = live[on], node[on]
            ahead[live, node] = -np.inf
            for at in np.unique(node).tolist():  # queries at the same node go together
                here = live[node == at]
                if self.children[at]:
                    for child in self.children[at]:
                        ahead[here, child] = bounds[here, child]
                    continue
                rows = self.rows[at]
                own = queries[here] @ self.points[rows].T
                which, hits = np.nonzero(own >= kth[here, None])
                starts = np.flatnonzero(np.diff(which, prepend=-1))
                for i, hit in zip(which[starts].tolist(), np.split(hits, starts[1:])):
                    query, new = int(here[i]), rows[hit]
                    skip, (where, scores) = own_rows[query], found[query]
                    other = (new < skip.start) | (new >= skip.stop)
                    found[query] = where, scores = vectors.best(np.concatenate([scores, own[i, hit[other]]]), np.concatenate([where, new[other]]), k)
                    if len(where) == k:
                        kth[query] = max(kth[query], scores[-1])
        yield from found


def whole(v: np.ndarray) -> np.ndarray:
    """``floor(256 x)``, as doubles while all inner products are exact in them, else as Python integers."""
    out = np.floor(SCALE * v)
    if out.size and v.shape[1] * float(np.abs(out).max()) ** 2 >= 2**53:
        return np.vectorize(int, otypes=[object])(out)
    return out


def _together(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if their products are exact, else both as Python integers."""
    exact = a.dtype != object and b.dtype != object
    exact = exact and (not a.size or not b.size or a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) < 2**53)
    return (a, b) if exact else tuple(x if x.dtype == object else np.vectorize(int, otypes=[object])(x) for x in (a, b))


def top_k(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """The ``k`` rows of highest inner product for every row of ``queries``: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "kdtree")
    kept = vectors.usable(rows, key, vector)
    n = kept.count()
    shards = max(1, -(-n // vectors.SHARD_ROWS))
    packed = scratch.save(vectors.packed(kept, vectors.SHARD_ROWS, "shard", n), "shards")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    seeds: dict[int, tuple] = {}
    # Written and read again: collected at once, every task would send its own longest vectors to the driver.
    longest = scratch.save(kept.select("dim", "id", "v").orderBy(F.desc(length), "id").limit(SEEDS), "seeds")
    for dim, ident, v in sorted(longest.collect(), key=lambda r: r[:2]):
        seeds.setdefault(dim, ({}, None))[0].setdefault(ident, v)  # an id counts once
    seeds = {dim: (np.array(list(by_id)), whole(np.array(list(by_id.values())))) for dim, (by_id, _) in seeds.items()}
    asked = vectors.usable(queries, key, vector)
    blocks = vectors.packed(asked, vectors.BLOCK, "block", asked.count())

    def prepare(ids, own, _):
        return ids, Tree(whole(own))

    def find(ready, q_ids, q, k):
        ids, tree = ready
        q = whole(q)
        floors = np.full(len(q), -np.inf, object)
        if (seed := seeds.get(q.shape[1])) and len(seed[0]) > k:
            left, right = _together(q, seed[1])
            scores = np.where(seed[0][None] == q_ids[:, None], -np.inf, left @ right.T)
            floors = np.sort(scores, axis=1)[:, -k]
        points, q = _together(tree.points, q)
        if points is not tree.points:
            tree = Tree(points)
        own_rows = [slice(np.searchsorted(ids, i), np.searchsorted(ids, i, side="right")) for i in q_ids]
        for where, scores in tree.search(q, own_rows, floors, k):
            yield where, np.array([int(s) for s in scores], np.int64)

    return vectors.search(vectors.meetings(packed, blocks, shards), prepare, find, k, "long")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(rows, rows.where("vec_id % 50 = 0"), "vec_id", "embedding", 5)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""
