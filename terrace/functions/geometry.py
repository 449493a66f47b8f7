"""Lines and polygons as arrays of points, measured and cut by array functions alone.

A ring is an ``array<struct<x: double, y: double>>`` whose last point may repeat the first or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ring(*points: tuple[Column, Column]) -> Column:
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points])


def edges(points: Column, closed: bool = True) -> Column:
    """Consecutive pairs ``{a, b}``; of a closed ring also the last with the first."""
    ahead = F.slice(points, F.lit(2), F.greatest(F.size(points) - 1, F.lit(0)))
    if closed:
        ahead = F.concat(ahead, F.slice(points, F.lit(1), F.lit(1)))
        return F.zip_with(points, ahead, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.zip_with(F.slice(points, F.lit(1), F.greatest(F.size(points) - 1, F.lit(0))), ahead, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _total(items: Column, of) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, e: acc + of(e))


def area(points: Column) -> Column:
    """Area of a simple ring, whichever way it turns."""
    return F.abs(_total(edges(points), lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2


def length(points: Column, closed: bool = False) -> Column:
    return _total(edges(points, closed), lambda e: F.sqrt((e["b"]["x"] - e["a"]["x"]) * (e["b"]["x"] - e["a"]["x"]) + (e["b"]["y"] - e["a"]["y"]) * (e["b"]["y"] - e["a"]["y"])))


def extent(points: Column) -> dict[str, Column]:
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}


def contains(points: Column, x: Column, y: Column, edge: bool = True) -> Column:
    """Whether a ring holds a point, by crossings of a ray; points on an edge count as ``edge`` says."""
    e = edges(points)
    cross = lambda s: (s["b"]["x"] - s["a"]["x"]) * (y - s["a"]["y"]) - (s["b"]["y"] - s["a"]["y"]) * (x - s["a"]["x"])
    between = lambda v, a, b: (v >= F.least(a, b)) & (v <= F.greatest(a, b))
    on_edge = F.exists(e, lambda s: (cross(s) == 0) & between(x, s["a"]["x"], s["b"]["x"]) & between(y, s["a"]["y"], s["b"]["y"]))
    # An edge crosses the ray to the right if its ends lie on both sides of the height and the point lies left of it.
    crosses = lambda s: ((s["a"]["y"] > y) != (s["b"]["y"] > y)) & ((cross(s) > 0) == (s["b"]["y"] > s["a"]["y"]))
    inside = F.size(F.filter(e, crosses)) % 2 == 1
    return on_edge | inside if edge else inside & ~on_edge


def _cut(points: Column, axis: str, limit: Column, above: bool) -> Column:
    """A ring's part on one side of a line along an axis."""
    other = "y" if axis == "x" else "x"
    inside = lambda p: (p[axis] >= limit) if above else (p[axis] <= limit)

    def piece(e: Column) -> Column:
        a, b = e["a"], e["b"]
        t = F.try_divide(limit - a[axis], b[axis] - a[axis])
        at = a[other] + t * (b[other] - a[other])
        met = F.struct(*[(limit if c == axis else at).cast("double").alias(c) for c in ("x", "y")])
        end = F.struct(b["x"].alias("x"), b["y"].alias("y"))
        none = F.array().cast("array<struct<x:double,y:double>>")
        return F.when(inside(a) & inside(b), F.array(end)).when(inside(a), F.array(met)).when(inside(b), F.array(met, end)).otherwise(none)

    return F.flatten(F.transform(edges(points), piece))


def clip(df: DataFrame, points: str, x0: str, y0: str, x1: str, y1: str) -> DataFrame:
    """The ring in column ``points`` cut at a box given by columns. A concave ring may keep edges of no width, which hold no area.

    Each cut is exploded from an array of one, which keeps the optimizer from writing it out wherever the next one
    names its result: four cuts would else become hundreds.
    """
    for axis, limit, above in (("x", x0, True), ("x", x1, False), ("y", y0, True), ("y", y1, False)):
        df = df.withColumn(points, F.explode(F.array(_cut(F.col(points), axis, F.col(limit).cast("double"), above))))
    return df


def inner_point(points: Column) -> tuple[Column, Column]:
    """The ring's centre of gravity: a representative point of convex rings."""
    e, twice = edges(points), lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]
    total = _total(e, twice)
    return tuple(F.try_divide(_total(e, lambda s, c=c: (s["a"][c] + s["b"][c]) * twice(s)), 3 * total) for c in ("x", "y"))
