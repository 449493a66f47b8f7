"""What the two vector searches share: packed shards of all rows, packed blocks of queries, and the merge of their finds.

Every block of queries meets every shard once (an equi-join on the shard's number, with the blocks dealt out to all
shards); each meeting gives its few best rows, and the best of those are the result. Only vectors of one length are compared.

Defined results: rows without an id or with a null, empty or not wholly finite vector take no part; rows that repeat both
id and vector count once; an id with several vectors is a query for each of them, and never finds its own id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard and queries of a block, on average.
SHARD_ROWS, BLOCK = 8192, 1024


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v, dim, mark`` of the rows that take part; ``mark`` tells different vectors of one id apart."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    kept = kept.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where((F.size("v") > 0) & finite)
    return kept.withColumn("dim", F.size("v")).withColumn("mark", F.xxhash64("v"))


def packed(rows: DataFrame, size: int, name: str, n: int) -> DataFrame:
    """Rows dealt out by a hash of id and vector: ``dim, name, ids, marks, vectors`` (the vectors end to end)."""
    parts = max(1, -(-n // size))
    dealt = rows.withColumn(name, F.pmod(F.xxhash64("id", "mark"), F.lit(parts)).cast("int"))
    lists = dealt.groupBy("dim", name).agg(F.collect_list(F.struct("id", "mark", "v")).alias("rows"))
    return lists.select("dim", name, F.col("rows.id").alias("ids"), F.col("rows.mark").alias("marks"), F.flatten("rows.v").alias("vectors"))


def meetings(shards: DataFrame, queries: DataFrame, n_shards: int) -> DataFrame:
    """Each shard with each block of queries of its dimension.

    Blocks are copied for every shard behind the exchange whose size Spark knows, so it would take many for few, send all copies
    to the driver and broadcast them: the join is bound to be a merge, whatever the thresholds say.
    """
    blocks = queries.select(F.col("dim").alias("q_dim"), "block", F.col("ids").alias("q_ids"), F.col("marks").alias("q_marks"), F.col("vectors").alias("q_vectors"))
    dealt = blocks.withColumn("q_shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    return shards.join(dealt.hint("merge"), (F.col("dim") == F.col("q_dim")) & (F.col("shard") == F.col("q_shard"))).drop("q_dim", "q_shard")


def unpack(ids: pa.Scalar, marks: pa.Scalar, vectors: pa.Scalar, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids in ascending order, marks and vectors, each different row once."""
    ids, marks = ids.values.to_numpy(zero_copy_only=False), marks.values.to_numpy(zero_copy_only=False)
    order = np.lexsort([marks, ids])
    ids, marks = ids[order], marks[order]
    first = np.ones(len(ids), bool)
    first[1:] = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])
    return ids[first], marks[first], vectors.values.to_numpy(zero_copy_only=False).reshape(-1, dim)[order[first]]


def search(met: DataFrame, prepare: Callable, find: Callable, k: int, score_type: str) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best over all meetings, ties to the smaller id.

    ``prepare(ids, vectors, extra)`` makes a shard ready, ``find(ready, q_ids, q_vectors, k)`` yields for each query the positions of its
    rows and their scores. A shard is made ready once while its meetings follow each other.
    """
    extra = "codes" in met.columns
    names = met.columns
    at = {n: names.index(n) for n in names}
    kind = pa.int64() if score_type == "long" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, ready, ids = None, None, None
        for b in batches:
            for r in range(b.num_rows):
                col = lambda n, r=r, b=b: b.column(at[n])[r]
                dim, shard = col("dim").as_py(), col("shard").as_py()
                if have != (dim, shard):
                    ids, _, own = unpack(col("ids"), col("marks"), col("vectors"), dim)
                    ready, have = prepare(ids, own, col("codes").as_py() if extra else None), (dim, shard)
                q_ids, q_marks, q = unpack(col("q_ids"), col("q_marks"), col("q_vectors"), dim)
                out = ([], [], [], [])
                for i, (where, scores) in enumerate(find(ready, q_ids, q, k)):
                    out[0].append(np.full(len(where), q_ids[i]))
                    out[1].append(np.full(len(where), q_marks[i]))
                    out[2].append(ids[where])
                    out[3].append(scores)
                cols = [pa.array(np.concatenate(x) if x else [], t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), kind))]
                yield pa.RecordBatch.from_arrays(cols, ["query_id", "mark", "vec_id", "score"])

    found = met.mapInArrow(run, f"query_id long, mark long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def best(scores: np.ndarray, where: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties to the smaller position."""
    order = np.lexsort([where, -scores])[:k]
    return where[order], scores[order]
