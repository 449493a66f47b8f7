"""Approximate nearest neighbours by score-aware anisotropic quantisation.

Vectors are brought to length one and split into subspaces of two components, each coded in four bits. The
codebooks minimise the residual with its part parallel to the vector weighed ``eta`` times as much as the rest:
it is the parallel error that changes high inner products. Codes are chosen and centres solved by coordinate
descent on that loss. A query adds up its tables over the codes of a shard, two codes to a byte; the best rows are
ranked again by their exact cosine on the original vectors.

The codebooks are fitted on a sample of at most ``SAMPLE`` rows (by a hash of their ids); every row is coded.
Zero vectors take no part; otherwise see ``vectors``. A shard of up to ``RERANK`` rows is searched exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import vectors
from terrace.llm._store import Scratch, small_batches

#: Rows that codebooks are fitted on, rounds of the fit, rows of a shard that are ranked exactly for a query.
SAMPLE, ROUNDS, RERANK = 16_384, 8, 256
#: Inner products from this share of the greatest are the ones to keep exact.
THRESHOLD = 0.2
CENTRES = 16
#: Rows whose distances to all centres are held at a time.
ROWS = 512


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def _pairs(v: np.ndarray) -> np.ndarray:
    """(rows, subspaces, 2): components two by two, an odd last one beside 0."""
    if v.shape[1] % 2:
        v = np.concatenate([v, np.zeros((len(v), 1))], axis=1)
    return v.reshape(len(v), -1, 2)


class Codebook:
    """Four-bit centres of every subspace, (subspaces, 16, 2)."""

    def __init__(self, centres: np.ndarray, eta: float):
        self.centres, self.eta = centres, eta

    def encode(self, unit: np.ndarray, rounds: int = 2) -> np.ndarray:
        """Codes by row and subspace: coordinate descent on the anisotropic loss."""
        parts = _pairs(unit)
        near = lambda some: ((some[:, :, None, :] - self.centres[None]) ** 2).sum(axis=3).argmin(axis=2)
        codes = np.concatenate([near(parts[at : at + ROWS]) for at in range(0, len(parts), ROWS)]) if len(parts) else near(parts)
        return self._descend(parts, codes, rounds)

    def _descend(self, parts: np.ndarray, codes: np.ndarray, rounds: int) -> np.ndarray:
        subspaces = np.arange(parts.shape[1])
        along = lambda s, c: ((parts[:, s] - c) * parts[:, s]).sum(axis=-1)
        parallel = ((parts - self.centres[subspaces, codes]) * parts).sum(axis=(1, 2))
        for _ in range(rounds):
            for s in subspaces:
                rest = parallel - along(s, self.centres[s][codes[:, s]])
                residual = parts[:, s, None, :] - self.centres[s][None]
                inner = (residual * parts[:, s, None, :]).sum(axis=2)
                loss = (residual**2).sum(axis=2) + (self.eta - 1) * (rest[:, None] + inner) ** 2
                codes[:, s] = loss.argmin(axis=1)
                parallel = rest + inner[np.arange(len(parts)), codes[:, s]]
        return codes

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(queries, bytes, 256): what each byte of two codes adds to a query's score."""
        q = _pairs(queries)
        one = np.einsum("qsd,scd->qsc", q, self.centres).astype(np.float32)
        if one.shape[1] % 2:
            one = np.concatenate([one, np.zeros((len(one), 1, CENTRES), np.float32)], axis=1)
        return (one[:, 0::2, None, :] + one[:, 1::2, :, None]).reshape(len(q), -1, CENTRES * CENTRES)


def pack(codes: np.ndarray) -> np.ndarray:
    """Two codes to a byte, the first in the low half; (bytes, rows)."""
    if codes.shape[1] % 2:
        codes = np.concatenate([codes, np.zeros((len(codes), 1), codes.dtype)], axis=1)
    return np.ascontiguousarray((codes[:, 0::2] | codes[:, 1::2] << 4).astype(np.uint8).T)


def fit(sample: np.ndarray, seed: int = 11) -> Codebook:
    """Alternate codes and centres; centres solve the weighted least squares of their rows."""
    unit, dim = _unit(sample), sample.shape[1]
    eta = max(1.0, THRESHOLD**2 / (1 - THRESHOLD**2) * (dim - 1))
    parts, rng = _pairs(unit), np.random.default_rng(seed)
    book = Codebook(parts[rng.integers(0, len(parts), CENTRES)].transpose(1, 0, 2).copy(), eta)
    codes = None
    for _ in range(ROUNDS):
        codes = book.encode(unit, 1) if codes is None else book._descend(parts, codes, 1)
        subspaces = np.arange(parts.shape[1])
        for s in subspaces:
            x, c = parts[:, s], book.centres[s]
            parallel = ((parts - book.centres[subspaces, codes]) * parts).sum(axis=(1, 2))
            target = parallel + (c[codes[:, s]] * x).sum(axis=1)  # the parallel residual, had this subspace no centre
            for k in range(CENTRES):
                own = x[codes[:, s] == k]
                if len(own):
                    left = len(own) * np.eye(2) + (eta - 1) * own.T @ own
                    right = own.sum(axis=0) + (eta - 1) * (target[codes[:, s] == k, None] * own).sum(axis=0)
                    book.centres[s, k] = np.linalg.solve(left, right)
                else:
                    book.centres[s, k] = x[rng.integers(0, len(x))]
    return book


def build_index(rows: DataFrame, scratch: Scratch, key: str, vector: str) -> tuple[DataFrame, dict[int, Codebook], int]:
    """(packed shards with the codes of every row, codebooks by dimension, number of shards)."""
    spark = rows.sparkSession
    small_batches(spark)
    kept = vectors.usable(rows, key, vector).where(F.exists("v", lambda x: x != 0))
    sizes = {r[0]: r[1] for r in kept.groupBy("dim").count().collect()}  # a row for each vector length
    n = sum(sizes.values())
    share = F.create_map(*[F.lit(x) for d, m in sizes.items() for x in (d, min(1.0, SAMPLE / m))]) if sizes else None
    books: dict[int, Codebook] = {}
    if sizes:
        some = kept.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1_000_003)) / 1_000_003.0 < share[F.col("dim")]).select("dim", "v")
        found: dict[int, list] = {}
        for r in some.limit(2 * SAMPLE * len(sizes)).collect():
            found.setdefault(r[0], []).append(r[1])
        books = {d: fit(np.array(found.get(d) or [[1.0] + [0.0] * (d - 1)])) for d in sizes}
    shards = max(1, -(-n // vectors.SHARD_ROWS))
    plain = vectors.packed(kept, vectors.SHARD_ROWS, "shard", n)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in range(b.num_rows):
                dim = b.column(0)[r].as_py()
                _, _, own = vectors.unpack(b.column(2)[r], b.column(3)[r], b.column(4)[r], dim)
                out.append(pack(books[dim].encode(_unit(own))).tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "codes"])

    index = plain.mapInArrow(code, "dim int, shard int, ids array<long>, marks array<long>, vectors array<double>, codes binary")
    return scratch.save(index, "index"), books, shards


def nearest(index: DataFrame, books: dict[int, Codebook], shards: int, queries: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """The ``k`` nearest rows of the index by cosine for every row of ``queries``."""
    asked = vectors.usable(queries, key, vector).where(F.exists("v", lambda x: x != 0))
    blocks = vectors.packed(asked, vectors.BLOCK, "block", asked.count())

    def prepare(ids, own, codes):
        return ids, own, np.sqrt((own * own).sum(axis=1)), np.frombuffer(codes, np.uint8).reshape(-1, len(ids))

    def find(ready, q_ids, q, k):
        ids, own, lengths, codes = ready
        book = books[own.shape[1]]
        q_lengths = np.sqrt((q * q).sum(axis=1))
        for at in range(0, len(q), 32):
            tables = book.tables(q[at : at + 32])
            scores = np.zeros((len(tables), len(ids)), np.float32)
            for j in range(tables.shape[1]):
                scores += tables[:, j].take(codes[j], axis=1)
            for i, row in enumerate(scores, at):
                row[np.searchsorted(ids, q_ids[i]) : np.searchsorted(ids, q_ids[i], side="right")] = -np.inf
                if len(row) > RERANK:
                    edge = np.partition(row, len(row) - RERANK)[len(row) - RERANK]
                    sure, even = np.flatnonzero(row > edge), np.flatnonzero(row == edge)
                    where = np.concatenate([sure, even[: RERANK - len(sure)]])  # ties to smaller ids
                else:
                    where = np.arange(len(row))
                where = where[np.isfinite(row[where])]
                exact = (own[where] * q[i]).sum(axis=1) / (lengths[where] * q_lengths[i])
                yield vectors.best(exact, where, k)

    return vectors.search(vectors.meetings(index, blocks, shards), prepare, find, k, "double")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    index, books, shards = build_index(rows, Scratch(spark, "ann"), "vec_id", "embedding")
    return nearest(index, books, shards, rows.where("vec_id % 50 = 0"), "vec_id", "embedding", 5)
