"""The spatial experiment: tidy metrics of candidate grids, sensitivity measures, and the gates that choose among them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.stats import average_rank, quantiles, spearman

#: Ratio that triggers the coarse gate and in how many anchors; cost, gain and indistinct share of the fine gate.
COARSE_RATIO, COARSE_NEED, FINE_COST, FINE_GAIN, FINE_INDISTINCT = 0.25, 2, 2.0, 0.05, 0.80


def tidy(wide: DataFrame, keys: list[str], support: str) -> DataFrame:
    """One row for each metric: ``keys, metric, spatial_support, value``."""
    metrics = [c for c in wide.columns if c not in keys]
    cast = wide.select(*keys, *[F.col(c).cast("double").alias(c) for c in metrics])
    return cast.unpivot(keys, metrics, "metric", "value").withColumn("spatial_support", F.lit(support)).select(*keys, "metric", "spatial_support", "value")


def unit_quantiles(units: DataFrame, by: list[str], value: str) -> DataFrame:
    return tidy(units.groupBy(*by).agg(*quantiles(value)), by, "unit")


def sparsity(units: DataFrame, by: list[str], counts: list[str]) -> DataFrame:
    """Shares of units that are zero in each count, by candidate."""
    return units.groupBy(*by).agg(*[F.avg((F.col(c) == 0).cast("double")).alias(f"zero_{c}") for c in counts], F.count(F.lit(1)).alias("units"))


def within_unit_loss(samples: DataFrame, by: list[str], unit: str, value: str) -> DataFrame:
    """Median range of a value within units (of two samples or more) over the interquartile range between units' means."""
    units = samples.where(F.col(value).isNotNull()).groupBy(*by, unit).agg((F.max(value) - F.min(value)).alias("range"), F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    iqr = F.percentile("mean", 0.75) - F.percentile("mean", 0.25)
    out = units.groupBy(*by).agg(F.percentile(F.when(F.col("n") >= 2, F.col("range")), 0.5).alias("within"), iqr.alias("between"))
    return out.withColumn("ratio", F.when(F.col("between") > 0, F.col("within") / F.col("between")))


def change_share(a: DataFrame, b: DataFrame, point: str, unit: str, by: list[str]) -> DataFrame:
    """Share of points whose unit differs between two lookups."""
    both = a.join(b.select(point, *by, F.col(unit).alias("__other")), [point, *by])
    return both.groupBy(*by).agg(F.avg((F.col(unit) != F.col("__other")).cast("double")).alias("change_share"), F.count(F.lit(1)).alias("points"))


def copartition_flips(a: DataFrame, b: DataFrame, pairs: DataFrame, point: str, unit: str) -> DataFrame:
    """Share of point pairs that share a unit in one grid and not in the other. ``pairs``: p, q."""
    side = lambda t, c, name: t.select(F.col(point).alias(c), F.col(unit).alias(name))
    joined = pairs.join(side(a, "p", "pa"), "p").join(side(a, "q", "qa"), "q").join(side(b, "p", "pb"), "p").join(side(b, "q", "qb"), "q")
    flipped = (F.col("pa") == F.col("qa")) != (F.col("pb") == F.col("qb"))
    return joined.agg(F.avg(flipped.cast("double")).alias("flip_share"), F.count(F.lit(1)).alias("pairs"))


def maup(rows: DataFrame, by: list[str], a: str, b: str, least: int = 10) -> DataFrame:
    """Of two supports' values at the same points: rank correlation, median relative change (zero bases left out), Jaccard of the top tenths."""
    both = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    tops = both.groupBy(*by).agg(F.percentile(a, 0.9).alias("__ta"), F.percentile(b, 0.9).alias("__tb"))
    flagged = both.join(tops, by)
    ta, tb = F.col(a) >= F.col("__ta"), F.col(b) >= F.col("__tb")
    change = F.when(F.col(a) != 0, F.abs(F.col(b) - F.col(a)) / F.abs(a))
    out = flagged.groupBy(*by).agg(F.percentile(change, 0.5).alias("median_change"), (F.count_if(ta & tb) / F.count_if(ta | tb)).alias("top_jaccard"))
    rho = spearman(both, by, a, b).where(F.col("n") >= least)
    return rho.join(out, by).select(*by, "rho", "median_change", "top_jaccard", "n")


def indistinct_pairs(units: DataFrame, pairs: DataFrame, ident: str, anchors: list[str], tolerance: float) -> DataFrame:
    """Share of neighbour pairs (each once) that differ by less than the tolerance in every anchor; a missing value doesn't tell apart."""
    other = units.select(F.col(ident).alias("neighbour"), *[F.col(c).alias(f"__{c}") for c in anchors])
    joined = pairs.where(F.col(ident) < F.col("neighbour")).join(units.select(ident, *anchors), ident).join(other, "neighbour")
    even = F.lit(True)
    for c in anchors:
        even = even & F.coalesce(F.abs(F.col(c) - F.col(f"__{c}")) < tolerance, F.lit(True))
    return joined.agg(F.avg(even.cast("double")).alias("indistinct_share"), F.count(F.lit(1)).alias("pairs"))


def ring_against_circle(rings: DataFrame, radius: float) -> DataFrame:
    """Best ring order for a circle on a lattice, by Jaccard. ``rings``: k, distance, order (of every lattice cell)."""
    a, b = F.col("order") <= F.col("k"), F.col("distance") <= radius
    shares = rings.groupBy("k").agg((F.count_if(a & b) / F.count_if(a | b)).alias("jaccard"))
    return shares.agg(F.max_by("k", F.struct("jaccard", -F.col("k"))).alias("k"), F.max("jaccard").alias("jaccard"))


def coarse_gate(ratios: DataFrame, by: list[str], anchor: str, ratio: str, limit: float = COARSE_RATIO, need: int = COARSE_NEED) -> DataFrame:
    """A candidate is too coarse if enough anchors pass the limit; the limit itself and missing ratios never do."""
    hits = ratios.groupBy(*by).agg(F.count_if(F.col(ratio) > limit).alias("triggered"), F.count(F.lit(1)).alias("anchors"))
    return hits.withColumn("too_coarse", F.col("triggered") >= need)


def finer_pairs(candidates: DataFrame, family: str, area: str, ident: str) -> DataFrame:
    """Each candidate with the next coarser one of its family."""
    return candidates.withColumn("coarser", F.lead(ident).over(Window.partitionBy(family).orderBy(area, ident))).where("coarser is not null")


def fine_gate(pairs: DataFrame) -> DataFrame:
    """Too fine: costs over twice the coarser one, gains under 5 %, and over 80 % of neighbours indistinct. ``pairs``: cost, coarser_cost, loss, coarser_loss, indistinct."""
    ratio, gain = F.try_divide("cost", "coarser_cost"), F.try_divide(F.col("coarser_loss") - F.col("loss"), F.col("coarser_loss"))
    verdict = F.when(ratio.isNull() | gain.isNull() | F.col("indistinct").isNull(), "undetermined")
    verdict = verdict.when((ratio > FINE_COST) & (gain < FINE_GAIN) & (F.col("indistinct") > FINE_INDISTINCT), "too_fine").otherwise("kept")
    return pairs.withColumns({"cost_ratio": ratio, "gain": gain, "verdict": verdict})


def robustness(ranks: DataFrame, by: list[str], ident: str, a: str, b: str, move: int = 2, most: int = 1) -> DataFrame:
    """Rank moves between two orderings: more than ``most`` moves over ``move`` places fail."""
    ranked = ranks.select(*by, ident, average_rank(a, by).alias("ra"), average_rank(b, by).alias("rb"))
    return ranked.groupBy(*by).agg(F.count_if(F.abs(F.col("ra") - F.col("rb")) > move).alias("large_moves")).withColumn("robust", F.col("large_moves") <= most)


def _frontier(points: np.ndarray) -> np.ndarray:
    """Rows that no other row beats: met in order of their sum, a row can only be beaten by one that was kept before."""
    kept = np.zeros((0, points.shape[1]))
    for row in points[np.lexsort([*points.T[::-1], points.sum(axis=1)])]:
        below = (kept <= row).all(axis=1)
        if not (below & (kept < row).any(axis=1)).any():
            kept = np.concatenate([kept, row[None]])
    return kept


def pareto(objectives: DataFrame, ident: str, columns: list[str]) -> DataFrame:
    """``ident, state``: ``frontier`` or ``dominated`` (lower is better); ``undetermined`` without all objectives.

    Each partition hands on its own frontier; the frontier of those is the whole one. A row is on it if its values are.
    """
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    known = objectives.where(complete)
    points = known.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def run(batches):
        kept = np.zeros((0, len(columns)))
        for b in batches:
            kept = _frontier(np.concatenate([kept, np.column_stack([c.to_numpy() for c in b.columns])]))
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(kept[:, k])) for k in range(len(columns))], names=columns)

    schema = ", ".join(f"`{c}` double" for c in columns)
    best = points.mapInArrow(run, schema).repartition(1).mapInArrow(run, schema).distinct().select(*[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("__best"))
    on = F.lit(True)
    for c in columns:
        on = on & (F.col(c).cast("double") == F.col(f"b_{c}"))
    stated = known.join(best, on, "left").select(ident, F.when(F.col("__best"), "frontier").otherwise("dominated").alias("state"))
    return stated.unionByName(objectives.where(~complete).select(ident, F.lit("undetermined").alias("state")))


def completeness(present: DataFrame, areas: DataFrame, candidates: DataFrame, coverage: str, floor: float) -> DataFrame:
    """By candidate: areas without a row, areas below the coverage floor, and whether the candidate is complete."""
    wanted = candidates.withColumn("__g", F.lit(1)).join(areas.withColumn("__g", F.lit(1)), "__g").drop("__g")  # two short lists
    met = wanted.join(present, wanted.columns, "left")
    out = met.groupBy(*candidates.columns).agg(F.count_if(F.col(coverage).isNull()).alias("absent"), F.count_if(F.col(coverage) < floor).alias("thin"))
    return out.withColumn("complete", (F.col("absent") == 0) & (F.col("thin") == 0))


def select_resolution(table: DataFrame, ident: str, area: str) -> DataFrame:
    """The coarsest candidate that no gate rejects and that is complete, if any: one row with its name or null, and why."""
    fit = table.where("complete and not too_coarse and verdict = 'kept'")
    return table.agg(F.count(F.lit(1)).alias("candidates")).crossJoin(fit.agg(F.max_by(ident, F.struct(area, ident)).alias("chosen"))).select(  # two single rows
        "chosen", F.when(F.col("chosen").isNull(), "no_candidate_passes").otherwise("selected").alias("reason"), "candidates"
    )


def edge_points(units: DataFrame, ident: str) -> DataFrame:
    """Corners and edge middles of square units: the boundary cases of a lookup."""
    places = F.array(*[F.struct(F.lit(i / 2).alias("u"), F.lit(j / 2).alias("v")) for i in range(3) for j in range(3) if (i, j) != (1, 1)])
    dealt = units.withColumn("p", F.explode(places))
    return dealt.select(ident, (F.col("x0") + F.col("p.u") * (F.col("x1") - F.col("x0"))).alias("x"), (F.col("y0") + F.col("p.v") * (F.col("y1") - F.col("y0"))).alias("y"))


def hash_sample(rows: DataFrame, by: list[str], ident: Column, n: int, seed: str) -> DataFrame:
    """The same ``n`` rows of every group each time: those of smallest seeded hash."""
    order = F.md5(F.concat(F.lit(seed), ident.cast("string")))
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where(F.col("__r") <= n).drop("__r")


def by_resolution(ident: Column) -> list[Column]:
    """Order of candidates by the number that their name ends with after ``_r`` (0 without one), then by name."""
    return [F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(ident, "_r([0-9]+)", 1), F.lit("")), F.lit("999999999")), F.lit(0)), ident]


def ring_completeness(units: DataFrame, inside: Column, complete: Column) -> DataFrame:
    """Cells inside the area and on its edge, cells whose ring is complete, and the share of these in either; null without such cells."""
    flag = lambda c: F.coalesce(c, F.lit(False))
    own, ring = flag(inside), flag(complete).cast("double")
    return units.agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(own).alias("interior"), F.count_if(~own).alias("edge"), F.count_if(flag(complete)).alias("complete"),
        F.avg(F.when(own, ring)).alias("share_interior"), F.avg(F.when(~own, ring)).alias("share_edge"),
    )


def windows_inside(windows: DataFrame, extents: DataFrame, ident: str, size: float, tolerance: float = 0.0) -> DataFrame:
    """``ident, inside``: whether a window, drawn in by the tolerance, lies in the union of the extents; not if there are none.

    The edges of the extents that a window meets cut it into boxes; it is inside if each box's middle is in some extent. Both sides
    are dealt to buckets of ``size``, so a window meets the extents around it only.
    """
    run = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / size).cast("long"), F.floor(F.col(hi) / size).cast("long")))
    bare = windows.select(ident, *[(F.col(c) + F.lit(s * tolerance)).alias(c) for c, s in (("x0", 1), ("y0", 1), ("x1", -1), ("y1", -1))])
    dealt = extents.select(*[F.col(c).alias(f"e_{c}") for c in ("x0", "y0", "x1", "y1")]).withColumn("__i", run("e_x0", "e_x1")).withColumn("__j", run("e_y0", "e_y1"))
    near = bare.withColumn("__i", run("x0", "x1")).withColumn("__j", run("y0", "y1")).join(dealt, ["__i", "__j"])
    near = near.where("e_x0 <= x1 AND e_x1 >= x0 AND e_y0 <= y1 AND e_y1 >= y0").drop("__i", "__j")
    boxes = near.groupBy(ident, "x0", "y0", "x1", "y1").agg(F.collect_set(F.struct("e_x0", "e_y0", "e_x1", "e_y1")).alias("e"))

    def cuts(v: str) -> Column:
        lo, hi = F.col(f"{v}0"), F.col(f"{v}1")
        inner = F.filter(F.flatten(F.transform("e", lambda e: F.array(e[f"e_{v}0"], e[f"e_{v}1"]))), lambda c: (c > lo) & (c < hi))
        marks = F.array_sort(F.array_distinct(F.concat(F.array(lo, hi), inner)))
        return F.zip_with(F.slice(marks, F.lit(1), F.greatest(F.size(marks) - 1, F.lit(1))), F.slice(marks, F.lit(2), F.greatest(F.size(marks) - 1, F.lit(1))), lambda a, b: (a + F.coalesce(b, a)) / 2)

    held = lambda x, y: F.exists("e", lambda e: (e["e_x0"] <= x) & (e["e_x1"] >= x) & (e["e_y0"] <= y) & (e["e_y1"] >= y))
    sure = boxes.select(ident, F.forall(cuts("x"), lambda x: F.forall(cuts("y"), lambda y: held(x, y))).alias("inside"))
    return windows.select(ident).join(sure, ident, "left").select(ident, F.coalesce("inside", F.lit(False)).alias("inside"))
