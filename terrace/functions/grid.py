"""Spatial units as column expressions: square cells, planar hexagons, rings, tiles, and projection to metres."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def square_index(x: Column, y: Column, size: float, ox: float = 0.0, oy: float = 0.0) -> tuple[Column, Column]:
    """Half-open cells: a point on an edge belongs to the upper cell."""
    return F.floor((x - ox) / size).cast("long"), F.floor((y - oy) / size).cast("long")


def square_id(name: str, col: Column, row: Column) -> Column:
    return F.concat(F.lit(f"{name}|"), col.cast("string"), F.lit("_"), row.cast("string"))


def parse_square_id(ident: Column) -> tuple[Column, Column]:
    parts = F.split(F.element_at(F.split(ident, r"\|"), -1), "_")
    return parts[0].cast("long"), parts[1].cast("long")


def hex_index(x: Column, y: Column, size: float) -> tuple[Column, Column]:
    """Axial coordinates of the pointy-top hexagon of edge ``size`` whose centre is nearest (cube rounding)."""
    q, r = (math.sqrt(3) / 3 * x - y / 3) / size, (2.0 / 3 * y) / size
    rq, rr, rs = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(-q - r + 0.5)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs + q + r)
    far_q, far_r = (dq > dr) & (dq > ds), dr > ds
    return F.when(far_q, -rr - rs).otherwise(rq).cast("long"), F.when(~far_q & far_r, -rq - rs).otherwise(rr).cast("long")


def square_ring(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(-k, k + 1) for j in range(-k, k + 1) if (i, j) != (0, 0)]


def hex_ring(k: int) -> list[tuple[int, int]]:
    return [(q, r) for q in range(-k, k + 1) for r in range(-k, k + 1) if (q, r) != (0, 0) and abs(q + r) <= k]


def neighbours(units: DataFrame, ident: str, a: str, b: str, offsets: list[tuple[int, int]]) -> DataFrame:
    """``ident, neighbour`` for neighbours that are in the table: offsets are exploded and joined on equal coordinates."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets]))
    near = units.select(ident, F.col(a).alias("a"), F.col(b).alias("b"), steps.alias("s")).select(ident, (F.col("a") + F.col("s.i")).alias("a"), (F.col("b") + F.col("s.j")).alias("b"))
    return near.join(units.select(F.col(ident).alias("neighbour"), F.col(a).alias("a"), F.col(b).alias("b")), ["a", "b"]).select(ident, "neighbour")


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def utm(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing on the WGS84 ellipsoid by Krüger's series to the third order."""
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    c = 2 * math.sqrt(n) / (1 + n)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - c * F.atanh(c * s))
    dl = F.radians(lon - (zone * 6 - 183))
    xi, eta = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, k in enumerate(alpha, 1):
        east = east + k * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + k * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500_000 + 0.9996 * big * east, F.when(lat < 0, 10_000_000.0).otherwise(0.0) + 0.9996 * big * north


def outward(value: Column, digits: int, up: bool) -> Column:
    """Rounded away from the box's inside."""
    return (F.ceil(value * 10**digits) if up else F.floor(value * 10**digits)) / 10**digits


def tiles(west: Column, south: Column, east: Column, north: Column, size: int) -> Column:
    """Lower left corners of the tiles that a box's extent touches; upper edges are open."""
    lows = lambda lo, hi: F.sequence((F.floor(lo / size) * size).cast("int"), (F.ceil(hi / size) * size - size).cast("int"), F.lit(size))
    return F.flatten(F.transform(lows(west, east), lambda x: F.transform(lows(south, north), lambda y: F.struct(x.alias("x"), y.alias("y")))))
