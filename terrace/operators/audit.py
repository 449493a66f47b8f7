"""Audits of one source against another: counts under policies, matches by distance, density grids, strata."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.stats import relative_difference, spearman
from terrace.operators.spatial_join import within

#: Pairs of segments that a task compares at a time.
PAIRS = 1_000_000
#: Most cells along a side of a bucket.
CELLS = 32


def counts_by_policy(left: DataFrame, right: DataFrame, group: str, confidence: str, floors: list[float]) -> DataFrame:
    """By group (null kept): the left's rows, and the right's under each floor of confidence; 0 where a source has none."""
    a = left.groupBy(group).agg(F.count(F.lit(1)).alias("n_left"))
    b = right.groupBy(F.col(group).alias("__g")).agg(*[F.count_if(F.col(confidence) >= f).alias(f"n_right_{int(f * 100)}") for f in floors])
    counts = ["n_left", *[f"n_right_{int(f * 100)}" for f in floors]]
    return a.join(b, F.col(group).eqNullSafe(F.col("__g")), "full").select(F.coalesce(group, "__g").alias(group), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


def confidence_band(confidence: Column) -> Column:
    """(-0.01, 0.3], (0.3, 0.6], (0.6, 1]; null outside."""
    return F.when((confidence > -0.01) & (confidence <= 0.3), "low").when((confidence > 0.3) & (confidence <= 0.6), "middle").when((confidence > 0.6) & (confidence <= 1), "high")


def contact_proxy(rows: DataFrame, group: str, confidence: str, flags: list[str]) -> DataFrame:
    """By band and group (null kept): rows, and the share of each flag."""
    return rows.groupBy(confidence_band(F.col(confidence)).alias("band"), group).agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(f).cast("double")).alias(f) for f in flags])


def missing_rates(rows: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    return rows.agg(*[F.avg(p.cast("double")).alias(n) for n, p in predicates.items()])


def provider_confidence(rows: DataFrame, confidence: str, providers: str) -> DataFrame:
    """Overall and by band in one pass of grouping sets: places, providers named, places with none, one, several."""
    n = F.size(providers)
    banded = rows.withColumn("band", confidence_band(F.col(confidence))).withColumn("n", n)
    return banded.groupingSets([[F.col("band")], []], F.col("band")).agg(
        F.grouping("band").cast("int").alias("overall"), F.count(F.lit(1)).alias("places"), F.sum("n").alias("named"),
        F.count_if(F.col("n") == 0).alias("none"), F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") > 1).alias("several"),
    )


def matches(a: DataFrame, b: DataFrame, distance: float, key: str, ident: str) -> DataFrame:
    """By ``key``: rows of ``a`` with and without a row of ``b`` of the same key within the distance."""
    near = within(a, b, distance, keys=(key,)).select(ident).distinct()
    flagged = a.join(near.withColumn("__hit", F.lit(1)), ident, "left")
    return flagged.groupBy(key).agg(F.count("__hit").alias("matched"), F.count_if(F.col("__hit").isNull()).alias("alone"))


def density_grid(points: DataFrame, side: float, cell: float) -> DataFrame:
    """Every cell of the box with its points, empty ones too; places outside are clamped into the edge cells."""
    n = int(side // cell)
    inside = lambda c: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor(F.col(c) / cell))).cast("long")
    counts = points.groupBy(inside("x").alias("col"), inside("y").alias("row")).agg(F.count(F.lit(1)).alias("n"))
    cells = points.sparkSession.range(n * n).select((F.col("id") % n).alias("col"), F.floor(F.col("id") / n).cast("long").alias("row"))
    return cells.join(counts, ["col", "row"], "left").select("col", "row", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def compare_grids(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """Two grids on equal cells: rank correlation, mean and median difference, median relative difference, share undefined."""
    both = a.join(b.withColumnRenamed("value", "other"), ["col", "row"]).where("value is not null and other is not null").withColumn("g", F.lit(1))
    d, r = F.abs(F.col("value") - F.col("other")), relative_difference(F.col("value"), F.col("other"), least)
    stats = both.groupBy("g").agg(F.avg(d).alias("mean_diff"), F.percentile(d, 0.5).alias("median_diff"), F.percentile(r, 0.5).alias("median_rel"), F.avg(r.isNull().cast("double")).alias("undefined_share"))
    return stats.join(spearman(both, ["g"], "value", "other"), "g").drop("g")


def strata(grid: DataFrame, value: str = "value", least: int = 10) -> DataFrame:
    """Cells above 0 in three strata by the 60th and 90th percentile: cells, total, median. Fewer than ``least`` cells give no row."""
    cells = grid.where(F.col(value) > 0)
    marks = cells.agg(F.percentile(value, 0.6).alias("p60"), F.percentile(value, 0.9).alias("p90"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    placed = cells.crossJoin(F.broadcast(marks))  # one row
    stratum = F.when(F.col(value) >= F.col("p90"), "high").when(F.col(value) >= F.col("p60"), "middle").otherwise("low")
    return placed.groupBy(stratum.alias("stratum")).agg(F.count(F.lit(1)).alias("cells"), F.sum(value).alias("total"), F.percentile(value, 0.5).alias("median"))


def grid_summary(grid: DataFrame, value: str = "value") -> DataFrame:
    """Total, share above 0, quantiles of valid cells."""
    v = F.col(value)
    marks = [F.percentile(v, p).alias(n) for n, p in (("p05", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95))]
    return grid.where(v.isNotNull()).agg(F.sum(v).alias("total"), F.avg((v > 0).cast("double")).alias("nonzero_share"), *marks, F.max(v).alias("max"))


def covered_lengths(a: DataFrame, b: DataFrame, step: float, buffer: float, ident: str = "way") -> DataFrame:
    """By line of ``a``: its length and the part within ``buffer`` of a line of ``b``; both are taken as points every ``step``.

    ``a`` and ``b`` are segments; a piece of a segment counts by its middle.
    """
    near = within(pieces(a, step).withColumn("__p", F.monotonically_increasing_id()), pieces(b, step).select("x", "y").distinct(), buffer)
    hit = near.select(ident, "seq", "k", "length").distinct().groupBy(ident).agg(F.sum("length").alias("covered"))
    total = pieces(a, step).groupBy(ident).agg(F.sum("length").alias("length"))
    return total.join(hit, ident, "left").select(ident, "length", F.coalesce("covered", F.lit(0.0)).alias("covered"))


def buffered_lengths(a: DataFrame, b: DataFrame, buffer: float, size: float, ident: str = "way") -> DataFrame:
    """By line of ``a``: its length and the part of it within ``buffer`` of any segment of ``b``, exactly.

    The part of a segment within the buffer of another is one interval: a buffer of a segment (a rectangle and two disks) is convex.
    Segments of ``a`` that repeat are measured once. Each bucket of ``size`` measures what lies in it: first small cells that lie wholly
    within the buffer of one segment of ``b``, then the stretches in other cells, against each segment near them.
    """
    corners = ["ax", "ay", "bx", "by"]
    near = b.select(*corners).distinct()
    low, high = (lambda v: F.least(f"a{v}", f"b{v}")), (lambda v: F.greatest(f"a{v}", f"b{v}"))
    bucket = lambda c: F.floor(c / size).cast("long")
    deal = lambda df, more: df.withColumn("__i", F.explode(F.sequence(bucket(low("x") - more), bucket(high("x") + more)))).withColumn("__j", F.explode(F.sequence(bucket(low("y") - more), bucket(high("y") + more))))
    whole = F.sqrt((F.col("bx") - F.col("ax")) ** 2 + (F.col("by") - F.col("ay")) ** 2)
    here = a.select(ident, "seq", *corners, whole.alias("length")).where("length > 0")
    shapes = here.select(*corners).distinct()
    n = max(1, min(CELLS, math.ceil(1.5 * size / buffer))) if buffer > 0 else 1

    def covered(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        one, other = ({c: t.column(c).to_numpy() for c in t.column_names} for t in (left, right))
        x, y = (size * (k.as_py() + np.arange(n + 1) / n) for k in key)
        share = shares(one, other, x, y, buffer)
        out = {c: one[c][share > 0] for c in corners}
        return pa.table(out | {"__share": share[share > 0]})

    met = deal(shapes, 0.0).groupBy("__i", "__j").cogroup(deal(near, buffer).groupBy("__i", "__j"))
    hit = met.applyInArrow(covered, ", ".join(f"{c} double" for c in (*corners, "__share"))).groupBy(*corners).agg(F.sum("__share").alias("__share"))
    part = F.coalesce(F.sum(F.col("__share") * F.col("length")), F.lit(0.0))
    return here.join(hit, corners, "left").groupBy(ident).agg(F.sum("length").alias("length"), part.alias("covered"))


def shares(a: dict[str, np.ndarray], b: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, buffer: float) -> np.ndarray:
    """Of each segment of ``a`` the share that lies between the outer lines of ``x`` and ``y`` and within the buffer of any segment of ``b``."""
    share = np.zeros(len(a["ax"]))
    if not len(share) or not len(b["ax"]):
        return share
    full, rows, step = full_cells(b, x, y, buffer), max(1, PAIRS // (2 * len(x) + 2)), max(1, PAIRS // len(b["ax"]))
    if full.all():  # then only the outer lines matter
        x, y, full = x[[0, -1]], y[[0, -1]], full[:1, :1]
    for at in range(0, len(share), rows):
        some = {c: v[at : at + rows] for c, v in a.items()}
        share[at : at + rows], which, s0, s1 = stretches(some, x, y, full)
        for k in range(0, len(which), step):
            of = which[k : k + step]
            piece, t0, t1 = unite(*intervals({c: v[of] for c, v in some.items()} | {"s0": s0[k : k + step], "s1": s1[k : k + step]}, b, buffer))
            np.add.at(share, at + of[piece], t1 - t0)
    return share


def full_cells(b: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, buffer: float) -> np.ndarray:
    """Cells between the lines ``x`` and ``y`` that lie wholly within the buffer of one segment of ``b``: as it is convex, their corners tell."""
    full, least = np.zeros((len(x) - 1, len(y) - 1), bool), buffer * (1 - 1e-9)
    for at in range(0, len(b["ax"]), 64):
        ax, ay, bx, by = (b[c][at : at + 64, None, None] for c in ("ax", "ay", "bx", "by"))
        dx, dy, px, py = bx - ax, by - ay, x[:, None] - ax, y - ay
        far = dx * dx + dy * dy
        far[far == 0] = 1.0
        t = np.clip((px * dx + py * dy) / far, 0.0, 1.0)
        inside = (px - t * dx) ** 2 + (py - t * dy) ** 2 <= least * least
        beside = inside[:, :-1] & inside[:, 1:]
        full |= (beside[:, :, :-1] & beside[:, :, 1:]).any(0)
        if full.all():
            break
    return full


def stretches(a: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, full: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each segment the share in full cells between the lines; positions and stretches ``s0 < s1`` of 0..1 in the other cells.

    A segment along one axis must lie between the other axis' outer lines.
    """
    ax, ay, dx, dy = a["ax"][:, None], a["ay"][:, None], (a["bx"] - a["ax"])[:, None], (a["by"] - a["ay"])[:, None]
    low, high, at = np.zeros_like(ax), np.ones_like(ax), []
    for lines, start, slope in ((x, ax, dx), (y, ay, dy)):
        t = np.where(slope == 0, 0.0, (lines - start) / np.where(slope == 0, 1.0, slope))
        at.append(t)
        low = np.where(slope == 0, low, np.maximum(low, np.minimum(t[:, :1], t[:, -1:])))
        high = np.where(slope == 0, high, np.minimum(high, np.maximum(t[:, :1], t[:, -1:])))
    at = np.sort(np.clip(np.hstack([*at, low, high]), low, np.maximum(low, high)), axis=1)
    t0, t1 = at[:, :-1], at[:, 1:]
    middle = (t0 + t1) / 2
    col, row = (np.clip(np.searchsorted(lines, start + middle * slope, "right") - 1, 0, len(lines) - 2) for lines, start, slope in ((x, ax, dx), (y, ay, dy)))
    inner = full[col, row]
    rest = np.pad(~inner & (t0 < t1), ((0, 0), (1, 1)))
    which, first = np.nonzero(rest[:, 1:-1] & ~rest[:, :-2])
    last = np.nonzero(rest[:, 1:-1] & ~rest[:, 2:])[1]
    return np.where(inner, t1 - t0, 0.0).sum(1), which, t0[which, first], t1[which, last]


def intervals(a: dict[str, np.ndarray], b: dict[str, np.ndarray], buffer: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in ``a`` and the intervals ``t0 < t1`` of their stretches ``s0..s1`` that lie within the buffer of a segment of ``b``."""
    apart = np.zeros((len(a["ax"]), len(b["ax"])), bool)
    for p, q in (("ax", "bx"), ("ay", "by")):
        u, v = (a[p] + a[s] * (a[q] - a[p]) for s in ("s0", "s1"))
        apart |= np.minimum(u, v)[:, None] > np.maximum(b[p], b[q])[None] + buffer * (1 + 1e-9)
        apart |= np.maximum(u, v)[:, None] < np.minimum(b[p], b[q])[None] - buffer * (1 + 1e-9)
    i, j = np.nonzero(~apart)
    ax, ay, bx, by = (a[n][i] for n in ("ax", "ay", "bx", "by"))
    rax, ray, rbx, rby = (b[n][j] for n in ("ax", "ay", "bx", "by"))
    dx, dy, ex, ey, ux, uy, vx, vy = bx - ax, by - ay, rbx - rax, rby - ray, ax - rax, ay - ray, ax - rbx, ay - rby
    far, square = ex * ex + ey * ey, np.sqrt(dx * dx + dy * dy) ** 2
    hu, hv, wide = ux * dx + uy * dy, vx * dx + vy * dy, buffer * np.sqrt(far)

    def between(start, slope, lo, hi):
        """Where a linear function lies between two values; from above to below if nowhere."""
        flat, p, q = (start >= lo) & (start <= hi), (lo - start) / slope, (hi - start) / slope
        return np.where(slope == 0, np.where(flat, 0.0, 2.0), np.minimum(p, q)), np.where(slope == 0, np.where(flat, 1.0, -1.0), np.maximum(p, q))

    with np.errstate(divide="ignore", invalid="ignore"):
        ru = np.sqrt(hu * hu - square * (ux * ux + uy * uy - buffer * buffer))  # not a number if the disk is missed
        rv = np.sqrt(hv * hv - square * (vx * vx + vy * vy - buffer * buffer))
        across = between(ux * ey - uy * ex, dx * ey - dy * ex, -wide, wide)
        along = between(ux * ex + uy * ey, dx * ex + dy * ey, 0.0, far)
        s0, s1 = np.maximum(across[0], along[0]), np.minimum(across[1], along[1])
        strip = (far > 0) & (s0 <= s1)
        t0 = np.fmin(np.where(strip, s0, np.nan), np.fmin((-hu - ru) / square, (-hv - rv) / square))
        t1 = np.fmax(np.where(strip, s1, np.nan), np.fmax((-hu + ru) / square, (-hv + rv) / square))
        t0, t1 = np.maximum(t0, a["s0"][i]), np.minimum(t1, a["s1"][i])
        some = t0 < t1
    return i[some], t0[some], t1[some]


def unite(which: np.ndarray, t0: np.ndarray, t1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each position united: positions and disjoint intervals in order."""
    if not len(which):
        return which, t0, t1
    order = np.lexsort([t0, which])
    which, t0, t1, n = which[order], t0[order], t1[order], len(order)
    by_end = np.argsort(t1, kind="stable")
    place = np.empty(n, np.int64)
    place[by_end] = np.arange(n)
    top = np.maximum.accumulate(which.astype(np.int64) * n + place)  # the furthest end so far, of the same position
    end = t1[by_end[top % n]]
    first = np.ones(n, bool)
    first[1:] = (which[1:] != which[:-1]) | (t0[1:] > end[:-1])
    starts = np.flatnonzero(first)
    return which[starts], t0[starts], end[np.append(starts[1:], n) - 1]


def unmatched(lengths: DataFrame, ident: str, n: int, share: float = 0.5) -> DataFrame:
    """The ``n`` lines with the most length that nothing covers, of those that are mostly uncovered."""
    left = lengths.withColumn("open", F.round(F.col("length") - F.col("covered"), 4))
    return left.where(F.col("open") > share * F.col("length")).orderBy(F.desc("open"), ident).limit(n)


def pieces(segments: DataFrame, step: float) -> DataFrame:
    """Segments cut into equal pieces of at most ``step``: all columns, the piece ``k``, its middle ``x, y`` and its length."""
    whole = F.sqrt((F.col("bx") - F.col("ax")) ** 2 + (F.col("by") - F.col("ay")) ** 2)
    n = F.greatest(F.lit(1), F.ceil(whole / step)).cast("int")
    cut = segments.withColumn("__n", n).withColumn("__l", whole).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    t = (F.col("k") + 0.5) / F.col("__n")
    return cut.withColumns({"x": F.col("ax") + t * (F.col("bx") - F.col("ax")), "y": F.col("ay") + t * (F.col("by") - F.col("ay")), "length": F.col("__l") / F.col("__n")}).drop("__n", "__l")
