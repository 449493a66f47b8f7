"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents may belong to several sources. They are aggregated by membership pattern (the set of
sources of a document); a small min-cost flow routes the words of each pattern to source quotas,
where the r-th repetition of a pattern costs r squared a word, so repetition is spread before it
deepens. Documents are then chosen in a seeded order: a pattern's flow covers a prefix of that order.

Defined results: a null text or size counts 0 words and takes 0; a null membership is the source
``null``; an empty table gives an empty result; repeated rows are separate documents; rows that tie
in the seeded order are ordered by size and by a hash of all their columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm._store import Scratch

#: Words are maximal runs of other characters than ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"
#: Distinct membership patterns that the driver's flow accepts.
MAX_PATTERNS = 20_000
#: No source: null is one.
_NONE = object()
#: Hex digits of the seeded key that make a bucket of the distributed prefix sum.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def capped_targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[int], share: float, cap: float) -> dict:
    """Split ``share`` of all sizes by weight; a target stops at ``cap`` times its size and the excess is shared again.

    ``sizes`` is in source order, ``weights`` repeat along it. The fixpoint is met in one walk: sources
    fill up in the order of cap by weight.
    """
    rows = [(cap * s, weights[i % len(weights)], i) for i, (_, s) in enumerate(sizes)]
    left, weight = share * sum(s for _, s in sizes), sum(w for _, w, _ in rows)
    out, level = {}, None
    for limit, w, i in sorted(rows, key=lambda r: (r[0] / r[1], r[2])):
        if level is None and limit < (left / weight) * w:
            out[sizes[i][0]] = float(limit)
            left, weight = left - limit, weight - w
        else:
            level = left / weight if level is None else level
            out[sizes[i][0]] = level * w
    return out


def min_cost_flow(patterns: Mapping[tuple, int], quotas: Mapping, repeats: int) -> dict[tuple, dict]:
    """Words that each pattern gives each of its sources, at least cost.

    Arcs: start to pattern once per repetition r (capacity: the pattern's words, cost r*r), pattern to each
    of its sources (no limit, no cost), source to end (its quota). Costs rise with r alone, so successive
    shortest paths are blocking flows level by level; each augmenting path may reroute earlier flow.
    """
    flow = {p: {s: 0 for s in p} for p in patterns}
    need = {s: int(q) for s, q in quotas.items()}
    holders: dict = {}
    for p in patterns:
        for s in p:
            holders.setdefault(s, []).append(p)
    for _ in range(repeats):
        left = dict(patterns)
        for start in patterns:
            while left[start] > 0:
                seen, queue, found = {start: _NONE}, [start], _NONE
                while queue and found is _NONE:
                    p = queue.pop(0)
                    for s in p:
                        if ("s", s) in seen or s not in need:
                            continue
                        seen["s", s] = p
                        if need[s] > 0:
                            found = s
                            break
                        for other in holders[s]:
                            if other not in seen and flow[other][s] > 0:
                                seen[other] = s
                                queue.append(other)
                if found is _NONE:
                    break
                path, s = [], found
                while True:
                    p = seen["s", s]
                    path.append((p, s, seen[p]))
                    if p == start:
                        break
                    s = seen[p]
                amount = min([left[start], need[found], *(flow[p][back] for p, _, back in path if back is not _NONE)])
                for p, s, back in path:
                    flow[p][s] += amount
                    if back is not _NONE:
                        flow[p][back] -= amount
                left[start] -= amount
                need[found] -= amount
    return flow


def mix(docs: DataFrame, quotas: Mapping, members: str, size: str, key: str, *, repeats: int = 2, seed: int = 17) -> DataFrame:
    """Choose documents so that every source comes near its quota of words.

    ``members`` is an array column of sources, ``size`` a long column, ``key`` the document's id. Adds
    ``copies`` (int), ``taken`` (long, ``size`` times ``copies``) and ``given`` (array of the source that each
    copy goes to). A copy is taken if its middle lies in the flow's prefix, so a source misses its flow
    by half a document at most. ``docs`` is read twice: write it first if it is costly. A column named like a result is
    replaced by it; all others keep their names and values.
    """
    spark = docs.sparkSession
    docs = docs.drop("copies", "taken", "given")
    n, pattern, order, bucket, before = (f"__mix_{x}" for x in ("size", "pattern", "order", "bucket", "before"))
    rows = (
        docs.withColumn(n, F.coalesce(F.col(size).cast("long"), F.lit(0)))
        .withColumn(pattern, F.array_sort(F.array_distinct(F.coalesce(F.col(members), F.array(F.lit(None).cast("string"))))))
        .withColumn(order, F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("null")))))
        .withColumn(bucket, F.substring(order, 1, BUCKET_DIGITS))
    )
    sums = rows.groupBy(pattern, bucket).agg(F.sum(n).alias("words"))
    total = sums.groupBy(pattern).agg(F.sum("words").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(total) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns: merge rare sources first")
    sizes = {tuple(r[0]): int(r[1]) for r in sorted(total, key=lambda r: [(x is None, x or "") for x in r[0]])}
    flow = min_cost_flow(sizes, quotas, repeats)
    plan = spark.createDataFrame(
        [(list(p), sizes[p], sum(f.values()), [s for s in f], _running([f[s] for s in f])) for p, f in flow.items()],
        f"{pattern} array<string>, __mix_all long, __mix_flow long, __mix_to array<string>, __mix_ends array<long>",
    )
    # Prefix sums in two steps: over the fixed number of buckets of a pattern, then inside one bucket.
    starts = sums.withColumn("__mix_start", F.sum("words").over(Window.partitionBy(pattern).orderBy(bucket)) - F.col("words")).drop("words")
    starts = starts.join(F.broadcast(plan), pattern)  # at most MAX_PATTERNS rows
    inside = Window.partitionBy(pattern, bucket).orderBy(order, n, F.xxhash64(*[F.col(c) for c in docs.columns])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(starts, [pattern, bucket]).withColumn(before, F.col("__mix_start") + F.sum(n).over(inside) - F.col(n))
    at = lambda r: F.col(before) + F.col("__mix_all") * r
    source_at = lambda r: F.element_at("__mix_to", F.least(F.size("__mix_to"), F.size(F.filter("__mix_ends", lambda e: e <= at(r))) + 1))
    copies = F.filter(
        F.array(*[F.when(2 * at(r) + F.col(n) <= 2 * F.col("__mix_flow"), F.struct(F.lit(r).alias("r"), source_at(r).alias("to"))) for r in range(repeats)]),
        lambda x: x.isNotNull(),
    )
    return placed.withColumn("__mix_copies", copies).select(
        *docs.columns,
        F.size("__mix_copies").alias("copies"),
        (F.size("__mix_copies") * F.col(n)).cast("long").alias("taken"),
        F.transform("__mix_copies", lambda x: x["to"]).alias("given"),
    )


def _running(parts: Sequence[int]) -> list[int]:
    out, total = [], 0
    for x in parts:
        total += x
        out.append(total)
    return out


def source_targets(docs: DataFrame, source: str, size: str, *, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> tuple[list, dict]:
    """(sources with their sizes in code point order with null last, their targets)."""
    rows = docs.groupBy(source).agg(F.sum(size).alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sources")
    sizes = sorted(((r[0], int(r[1] or 0)) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))
    return sizes, capped_targets(sizes, weights, share, cap)


def mix_by_source(docs: DataFrame, *, seed: int = 17) -> DataFrame:
    """Mix ``documents``-shaped rows by their ``source``: adds size, source_size, target, copies, taken, given (in place of columns named so)."""
    spark = docs.sparkSession
    docs = docs.drop("size", "source_size", "target", "copies", "taken", "given")
    sized = docs.withColumn("size", word_count(F.col("text"))).withColumn("__members", F.array("source"))
    sizes, targets = source_targets(sized, "source", "size")
    mixed = mix(sized, targets, "__members", "size", "doc_id", seed=seed)
    info = spark.createDataFrame([(s, n, targets[s]) for s, n in sizes], "__s string, source_size long, target double")
    return mixed.join(F.broadcast(info), F.col("source").eqNullSafe(F.col("__s"))).drop("__s", "__members")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Counting words reads all texts: done once, and only ids, sources and sizes go on.
    sized = Scratch(spark, "mix").save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    sizes, targets = source_targets(sized, "source", "size")
    mixed = mix(sized.withColumn("members", F.array("source")), targets, "members", "size", "doc_id")
    info = spark.createDataFrame([(s, n, targets[s]) for s, n in sizes], "__s string, source_size long, target double")
    return mixed.join(F.broadcast(info), F.col("source").eqNullSafe(F.col("__s"))).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('17|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, CASE i % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, CAST(2.0 AS DOUBLE) * n AS cap FROM s),
c AS (
  SELECT *, row_number() OVER o AS rn,
         (CAST(1.5 AS DOUBLE) * (SELECT sum(n) FROM s) - (sum(cap) OVER o - cap)) / ((SELECT sum(w) FROM w) - (sum(w) OVER o - w)) AS level
  FROM w WINDOW o AS (ORDER BY cap / w, i ROWS UNBOUNDED PRECEDING)),
f AS (SELECT min(rn) AS rn FROM c WHERE NOT cap < level * w),
t AS (
  SELECT c.source, c.n, CASE WHEN c.rn < f.rn THEN c.cap ELSE (SELECT level FROM c x WHERE x.rn = f.rn) * c.w END AS target FROM c, f),
p AS (
  SELECT d.doc_id, d.size, t.n, t.target, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) - d.size AS b
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target,
       CAST(size * ((CASE WHEN 2 * b + size <= 2 * floor(target) THEN 1 ELSE 0 END) + (CASE WHEN 2 * (b + n) + size <= 2 * floor(target) THEN 1 ELSE 0 END)) AS BIGINT) AS taken
FROM p
"""
