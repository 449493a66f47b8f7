"""Joins by place, as equal-key joins on buckets with an exact predicate behind them.

A bucket key is a pair of whole numbers, so nothing is planned as a nested loop, and adaptive execution can split a
dense bucket. A side is dealt out to its neighbour buckets only where the predicate reaches across an edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def within(left: DataFrame, right: DataFrame, radius: float, *, x: str = "x", y: str = "y", keys: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of at most ``radius`` apart (the edge counts), with ``distance``; columns of the right get the prefix ``r_``.

    The right side, which should be the smaller, goes to nine buckets of the radius; ``keys`` are equal columns to join on as well.
    """
    step = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    near = right.select([F.col(c).alias(f"r_{c}") for c in right.columns])
    near = near.withColumn("i", F.explode(step)).withColumn("j", F.explode(step))
    near = near.withColumn("__bx", _bucket(F.col(f"r_{x}"), radius) + F.col("i")).withColumn("__by", _bucket(F.col(f"r_{y}"), radius) + F.col("j")).drop("i", "j")
    here = left.withColumn("__lx", _bucket(F.col(x), radius)).withColumn("__ly", _bucket(F.col(y), radius))
    on = (F.col("__bx") == F.col("__lx")) & (F.col("__by") == F.col("__ly"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"r_{k}"))
    dx, dy = F.col(x) - F.col(f"r_{x}"), F.col(y) - F.col(f"r_{y}")
    square = dx * dx + dy * dy
    return here.join(near, on).where(square <= radius * radius).withColumn("distance", F.sqrt(square)).drop("__lx", "__ly", "__bx", "__by")


def nearest(left: DataFrame, right: DataFrame, key: str, *, first: float, limit: float, x: str = "x", y: str = "y") -> DataFrame:
    """``key, distance`` to the nearest right row up to ``limit``, for rows of the left that have one.

    Rings widen fourfold; only rows without a find go on to the next ring, so dense places are done in the first.
    """
    found, rest, radius = None, left.select(key, x, y), first
    while True:
        hit = within(rest, right.select(x, y), radius).groupBy(key).agg(F.min("distance").alias("distance"))
        found = hit if found is None else found.unionByName(hit)
        if radius >= limit:
            return found
        rest, radius = rest.join(hit, key, "left_anti"), min(radius * 4, limit)


def shape_distance(x: Column, y: Column) -> Column:
    """Distance from a point to a shape ``line, ax, ay, bx, by``: a segment, or else a box (0 inside)."""
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    dx, dy = bx - ax, by - ay
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((x - ax) * dx + (y - ay) * dy, dx * dx + dy * dy), F.lit(0.0))))
    px, py = x - (ax + t * dx), y - (ay + t * dy)
    ox, oy = F.greatest(F.lit(0.0), ax - x, x - bx), F.greatest(F.lit(0.0), ay - y, y - by)
    return F.when(F.col("line"), F.sqrt(px * px + py * py)).otherwise(F.sqrt(ox * ox + oy * oy))


def nearest_shapes(points: DataFrame, shapes: DataFrame, keys: list[str], group: str, *, first: float) -> DataFrame:
    """``keys, distance`` to the nearest shape of the same ``group``, for points that have one within their own ``radius``.

    Rings widen fourfold; only points without a find whose radius reaches further go on. Shapes are dealt to the buckets of
    their extents, widened by the ring.
    """
    limit = points.agg(F.max("radius")).first()[0] or 0.0
    found, rest, ring = None, points.select(*keys, "x", "y", "radius"), first
    extent = {"x": (F.least("ax", "bx"), F.greatest("ax", "bx")), "y": (F.least("ay", "by"), F.greatest("ay", "by"))}
    while True:
        run = lambda c, ring=ring: F.explode(F.sequence(_bucket(extent[c][0] - ring, ring), _bucket(extent[c][1] + ring, ring)))
        dealt = shapes.withColumn("__bx", run("x")).withColumn("__by", run("y"))
        here = rest.withColumn("__bx", _bucket(F.col("x"), ring)).withColumn("__by", _bucket(F.col("y"), ring))
        measured = here.join(dealt, [group, "__bx", "__by"]).withColumn("distance", shape_distance(F.col("x"), F.col("y"))).where(F.col("distance") <= ring)
        hit = measured.groupBy(*keys).agg(F.min("distance").alias("distance"))
        found = hit if found is None else found.unionByName(hit)
        if ring >= limit:
            return found
        rest, ring = rest.where(F.col("radius") > ring).join(hit, keys, "left_anti"), min(ring * 4, limit)


def in_boxes(points: DataFrame, boxes: DataFrame, key: str, box: str, order: str, size: float) -> DataFrame:
    """``key, box``: the first box (by ``order``) that holds a point, edges included; null for none. Each point comes once."""
    spread = lambda lo, hi: F.explode(F.sequence(_bucket(F.col(lo), size), _bucket(F.col(hi), size)))
    dealt = boxes.select(F.col(box).alias("__box"), F.col(order).alias("__order"), "x0", "y0", "x1", "y1").withColumn("__bx", spread("x0", "x1")).withColumn("__by", spread("y0", "y1"))
    here = points.select(key, "x", "y").withColumn("__lx", _bucket(F.col("x"), size)).withColumn("__ly", _bucket(F.col("y"), size))
    inside = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    met = here.join(dealt, (F.col("__bx") == F.col("__lx")) & (F.col("__by") == F.col("__ly")) & inside, "left")
    return met.groupBy(key).agg(F.min_by("__box", "__order").alias(box))


def clip(ax: Column, ay: Column, bx: Column, by: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> tuple[Column, Column]:
    """Liang-Barsky: the part of a segment inside a box, as parameters ``(from, to)``; empty if from is not below to."""
    dx, dy = bx - ax, by - ay
    low, high = [F.lit(0.0)], [F.lit(1.0)]
    for a, d, lo, hi in ((ax, dx, x0, x1), (ay, dy, y0, y1)):
        t0, t1 = F.try_divide(lo - a, d), F.try_divide(hi - a, d)
        outside = (a < lo) | (a > hi)
        low.append(F.when(d == 0, F.when(outside, 1.0).otherwise(0.0)).otherwise(F.least(t0, t1)))
        high.append(F.when(d == 0, F.when(outside, 0.0).otherwise(1.0)).otherwise(F.greatest(t0, t1)))
    return F.greatest(*low), F.least(*high)


def clipped_lengths(segments: DataFrame, size: float) -> DataFrame:
    """Segments cut at the cells they cross: all columns, ``col, row`` of the cell, ``length`` inside it (zero lengths are dropped).

    A segment is dealt to the cells of its bounding box only.
    """
    run = lambda a, b: F.explode(F.sequence(_bucket(F.least(F.col(a), F.col(b)), size), _bucket(F.greatest(F.col(a), F.col(b)), size)))
    dealt = segments.withColumn("col", run("ax", "bx")).withColumn("row", run("ay", "by"))
    x0, y0 = F.col("col") * size, F.col("row") * size
    start, end = clip(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), x0, y0, x0 + size, y0 + size)
    whole = F.sqrt((F.col("bx") - F.col("ax")) ** 2 + (F.col("by") - F.col("ay")) ** 2)
    return dealt.withColumn("__from", start).withColumn("__to", end).where("__to > __from").withColumn("length", (F.col("__to") - F.col("__from")) * whole).where("length > 0").drop("__from", "__to")


def overlap_areas(shapes: DataFrame, size: float, grid: float) -> DataFrame:
    """``col, row, area`` of the union of boxes in each cell of ``size``: overlaps count once.

    Boxes whose edges lie on a grid are dissolved into its cells first, which are distinct however many boxes cover them.
    """
    run = lambda lo, hi: F.explode(F.sequence(_bucket(F.col(lo), grid), (F.ceil(F.col(hi) / grid) - 1).cast("long")))
    covered = shapes.withColumn("gx", run("x0", "x1")).withColumn("gy", run("y0", "y1")).select("gx", "gy").distinct()
    return covered.groupBy(_bucket(F.col("gx") * grid, size).alias("col"), _bucket(F.col("gy") * grid, size).alias("row")).agg((F.count(F.lit(1)) * grid * grid).alias("area"))


def first_of(rows: DataFrame, by: list[str], order: list) -> DataFrame:
    """The first row of each key in a total order."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__n = 1").drop("__n")
