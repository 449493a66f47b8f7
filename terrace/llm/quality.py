"""A quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its lower-cased words hashed to ``BUCKETS`` (square roots of their shares), statistics of its
structure (character classes, repetition, lines) and metadata that the row carries about its text (its length class).
The machine adds to a linear score all pairwise interactions as inner products of low-rank vectors, in time linear in the
features: half of (square of the sum less the sum of squares) in each of ``RANK`` dimensions. Fitted by AdaGrad on the
logistic loss over a sample of at most ``SAMPLE`` labelled documents (those of smallest id hash).

Defined results: null and empty texts are scored as having no words; a document labelled several times has the mean
of its labels; without any labelled row every score is 0.5; repeated rows score alike.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm._store import small_batches, worker_own
from terrace.llm.langid import held_out

#: Word buckets, rank of the interactions, labelled documents that the fit sees, passes over them.
BUCKETS, RANK, SAMPLE, PASSES = 1 << 14, 8, 6000, 8
#: Entries of words that a worker keeps; words of a text whose shares are counted at a time.
CACHE, CHUNK = 250_000, 1 << 18
#: Length classes by powers of four of the number of characters.
LENGTHS = 10
CLASSES = [("upper", b"[A-Z]"), ("digit", b"[0-9]"), ("space", rb"[\x20\x09-\x0D]"), ("line", b"\n"), ("stop", b"[.,;:]"), ("mark", b"[!-+/<-@[-`{-~]"), ("wide", b"[\x80-\xff]")]
STATISTICS = [name for name, _ in CLASSES] + ["word length", "distinct words", "distinct pairs", "most frequent word", "distinct lines", "words a line", "marked words", "log words"]


class Words(dict):
    """Bucket of a lower-cased word; the bucket is negated and less one if the word ends in a mark other than a stop."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        k = zlib.crc32(word.lower()) % BUCKETS
        own = self[word] = -k - 1 if word[-1:] in b"!\"#$%&'()*+/<=>?@[\\]^_`{|}~-" else k
        return own


_OF_CLASS = np.array([[bool(re.match(c, bytes([b]))) for b in range(256)] for _, c in CLASSES], float)


def features(text: bytes, hashes: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, their values, and the statistics."""
    words = text.split()
    stats = np.zeros(len(STATISTICS) + LENGTHS)
    chars = max(1, len(text))
    stats[: len(CLASSES)] = _OF_CLASS @ np.bincount(np.frombuffer(text, np.uint8), minlength=256) / chars
    stats[len(STATISTICS) + min(LENGTHS - 1, int(np.log2(chars) / 2))] = 1
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), stats
    raw = np.fromiter(map(hashes.__getitem__, words), np.int64, len(words))
    index = np.where(raw < 0, -raw - 1, raw)
    counts = np.bincount(index, minlength=BUCKETS) if len(index) > 2000 else None
    at, n = (np.flatnonzero(counts), counts[counts > 0]) if counts is not None else np.unique(index, return_counts=True)
    pairs = index[1:] * BUCKETS + index[:-1]
    pairs.sort()
    lines = text.split(b"\n")
    stats[len(CLASSES) : len(STATISTICS)] = (
        (chars - text.count(b" ")) / len(words) / 10,
        len(at) / len(words),
        (1 + np.count_nonzero(np.diff(pairs))) / max(1, len(pairs)),
        n.max() / len(words),
        len(set(lines)) / len(lines),
        min(1.0, len(words) / len(lines) / 50),
        np.count_nonzero(raw < 0) / len(words),
        np.log1p(len(words)) / 10,
    )
    return at.astype(np.int32), np.sqrt(n / len(words)).astype(np.float32), stats


class Machine:
    """Bias, linear weights and interaction vectors; the statistics stand behind the word buckets, scaled."""

    def __init__(self, bias: float, weights: np.ndarray, vectors: np.ndarray, centre: np.ndarray, scale: np.ndarray):
        self.bias, self.weights, self.vectors, self.centre, self.scale = bias, weights, vectors, centre, scale

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.centre) / self.scale, -3, 3) / 3

    def score(self, at: np.ndarray, x: np.ndarray, dense: np.ndarray) -> float:
        v, u = self.vectors, BUCKETS
        own = v[at] * x[:, None]
        rest = v[u:] * dense[:, None]
        total = own.sum(axis=0) + rest.sum(axis=0)
        pairs = 0.5 * (total @ total - (own * own).sum() - (rest * rest).sum())
        z = self.bias + self.weights[at] @ x + self.weights[u:] @ dense + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[float, np.ndarray, np.ndarray, np.ndarray]], seed: int = 5) -> Machine:
    """Fit on (label, buckets, values, statistics)."""
    n_stats, size = len(STATISTICS) + LENGTHS, 64
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.02, (BUCKETS + n_stats, RANK))
    machine = Machine(0.0, np.zeros(BUCKETS + n_stats), vectors, np.zeros(n_stats), np.ones(n_stats))
    if not rows:
        machine.vectors[:] = 0
        return machine
    stats = np.array([r[3] for r in rows])
    machine.centre, machine.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-3
    label, dense = np.array([r[0] for r in rows]), machine.dense(stats)
    gw, gv, gb, rate = np.full(BUCKETS + n_stats, 1e-2), np.full(vectors.shape, 1e-2), 1e-2, 0.1
    columns = np.arange(BUCKETS, BUCKETS + n_stats)
    for _ in range(PASSES):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), size):
            own = order[lo : lo + size]
            at = np.concatenate([np.concatenate([rows[i][1], columns]) for i in own])
            x = np.concatenate([np.concatenate([rows[i][2], dense[i]]) for i in own])
            n = np.array([len(rows[i][1]) + n_stats for i in own])
            doc, ends = np.repeat(np.arange(len(own)), n), np.cumsum(n) - n
            vx = machine.vectors[at] * x[:, None]
            total = np.add.reduceat(vx, ends)
            z = machine.bias + np.add.reduceat(machine.weights[at] * x, ends) + 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((vx**2).sum(axis=1), ends))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[own]) / len(own)
            near, inverse = np.unique(at, return_inverse=True)
            w = np.bincount(inverse, g[doc] * x) + 1e-5 * machine.weights[near]
            each = (g[doc] * x)[:, None] * (total[doc] - vx)
            v = np.stack([np.bincount(inverse, each[:, k]) for k in range(RANK)], axis=1) + 1e-4 * machine.vectors[near]
            gw[near] += w * w
            gv[near] += v * v
            gb += g.sum() ** 2
            machine.weights[near] -= rate * w / np.sqrt(gw[near])
            machine.vectors[near] -= rate * 0.2 * v / np.sqrt(gv[near])
            machine.bias -= rate * g.sum() / np.sqrt(gb)
    return machine


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = worker_own("quality", Words)
    for b in batches:
        rows = [features(t or b"", hashes) for t in b.column(1).cast(pa.binary()).to_pylist()]
        cols = [pa.array([r[k].astype(t).tobytes() for r in rows], pa.binary()) for k, t in enumerate(("<i4", "<f4", "<f8"))]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["y", "at", "x", "stats"])


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Machine:
    """Fit on at most ``SAMPLE`` labelled documents; their ids go to all tasks, their features to the driver."""
    small_batches(docs.sparkSession)
    y = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.avg(label).alias("__y"))
    chosen = y.orderBy(F.xxhash64(F.col("__key").cast("string"), F.lit(29)), "__key").limit(SAMPLE)
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text"))
    found = rows.join(F.broadcast(chosen), F.col("__id") == F.col("__key"))  # at most SAMPLE rows of two numbers
    got = found.select("__y", "__text").mapInArrow(_extract, "y double, at binary, x binary, stats binary").limit(2 * SAMPLE).collect()
    unpack = lambda r: (float(r[0]), np.frombuffer(r[1], "<i4"), np.frombuffer(r[2], "<f4"), np.frombuffer(r[3], "<f8"))
    return fit([unpack(r) for r in sorted(got, key=lambda r: (r[0], bytes(r[3]), bytes(r[1])))])


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Add ``score``: the chance of label 1."""
    spark = docs.sparkSession
    small_batches(spark)
    shared, names = spark.sparkContext.broadcast(machine), docs.columns  # of fixed size
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, hashes = shared.value, worker_own("quality", Words)
        for b in batches:
            out = []
            for t in b.column(at).cast(pa.binary()).to_pylist():
                k, x, stats = features(t or b"", hashes)
                out.append(m.score(k, x, m.dense(stats)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*names, "score"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{columns}, score double")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id", 4, 2))
    scored = score(docs, learn(docs, labels))
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", F.coalesce(held_out("doc_id", 4, 2), F.lit(False)).alias("held_out"), "score", predicted)
