"""Candidate grids behind one interface: lookup, units of an area, rings, and shifted copies."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import grid


@dataclass(frozen=True)
class Area:
    """A rectangle in metres."""

    x0: float
    y0: float
    x1: float
    y1: float

    def grown(self, by: float) -> Area:
        return Area(self.x0 - by, self.y0 - by, self.x1 + by, self.y1 + by)


class Grid(Protocol):
    """What every candidate grid offers."""

    @property
    def name(self) -> str: ...

    @property
    def nominal_km2(self) -> float: ...

    def lookup(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Coordinates of the cell that holds a place."""

    def units(self, spark: SparkSession, area: Area) -> DataFrame:
        """``unit_id, a, b, area_m2, overlap_m2, overlap_share, rep_x, rep_y`` of all cells that meet the area."""

    def ring(self, k: int) -> list[tuple[int, int]]:
        """Offsets of the cells within ``k`` steps."""


def _span(first: int, last: int, name: str) -> Column:
    return F.explode(F.sequence(F.lit(first), F.lit(last))).alias(name)


@dataclass(frozen=True)
class SquareGrid:
    """Half-open squares on a common origin."""

    size: float
    ox: float = 0.0
    oy: float = 0.0

    @property
    def name(self) -> str:
        return f"sq{self.size:g}"

    @property
    def nominal_km2(self) -> float:
        return self.size * self.size / 1e6

    def lookup(self, x: Column, y: Column) -> tuple[Column, Column]:
        return grid.square_index(x, y, self.size, self.ox, self.oy)

    def units(self, spark: SparkSession, area: Area) -> DataFrame:
        low = lambda v, o: math.floor((v - o) / self.size)
        high = lambda v, o: math.ceil((v - o) / self.size) - 1
        columns = spark.range(1).select(_span(low(area.x0, self.ox), high(area.x1, self.ox), "a"))
        cells = columns.select("a", _span(low(area.y0, self.oy), high(area.y1, self.oy), "b")).select(F.col("a").cast("long"), F.col("b").cast("long"))
        x0, y0 = F.col("a") * self.size + self.ox, F.col("b") * self.size + self.oy
        shared = lambda v, lo, hi: F.greatest(F.lit(0.0), F.least(v + self.size, F.lit(hi)) - F.greatest(v, F.lit(lo)))
        overlap = shared(x0, area.x0, area.x1) * shared(y0, area.y0, area.y1)
        whole = F.lit(self.size * self.size)
        return cells.select(grid.square_id(self.name, F.col("a"), F.col("b")).alias("unit_id"), "a", "b", whole.alias("area_m2"), overlap.alias("overlap_m2"), (overlap / whole).alias("overlap_share"), (x0 + self.size / 2).alias("rep_x"), (y0 + self.size / 2).alias("rep_y"))

    def ring(self, k: int) -> list[tuple[int, int]]:
        return grid.square_ring(k)

    def shifted(self, parts: int) -> list[SquareGrid]:
        """Copies whose origin moves by equal parts of a cell, itself left out."""
        step = self.size / parts
        return [replace(self, ox=self.ox + i * step, oy=self.oy + j * step) for i in range(parts) for j in range(parts) if (i, j) != (0, 0)]


@dataclass(frozen=True)
class HexGrid:
    """Pointy-top hexagons of edge ``size`` in a plane, by axial coordinates."""

    size: float

    @property
    def name(self) -> str:
        return f"hex{self.size:g}"

    @property
    def nominal_km2(self) -> float:
        return 1.5 * math.sqrt(3) * self.size * self.size / 1e6

    def lookup(self, x: Column, y: Column) -> tuple[Column, Column]:
        return grid.hex_index(x, y, self.size)

    def centre(self, a: Column, b: Column) -> tuple[Column, Column]:
        return self.size * math.sqrt(3) * (a + b / 2), self.size * 1.5 * b

    def ring_of(self, a: Column, b: Column) -> Column:
        """The cell's corners."""
        x, y = self.centre(a, b)
        turns = [math.radians(60 * k - 30) for k in range(6)]
        return F.array(*[F.struct((x + self.size * math.cos(t)).alias("x"), (y + self.size * math.sin(t)).alias("y")) for t in turns])

    def units(self, spark: SparkSession, area: Area) -> DataFrame:
        """Candidates come from the area grown by two edges; those whose cut at the area holds any of it stay."""
        from terrace.functions import geometry

        wide = area.grown(2 * self.size)
        rows = spark.range(1).select(_span(math.floor(wide.y0 / 1.5 / self.size), math.ceil(wide.y1 / 1.5 / self.size), "b"))
        step = self.size * math.sqrt(3)
        starts = F.sequence(F.floor(F.lit(wide.x0 / step) - F.col("b") / 2).cast("int"), F.ceil(F.lit(wide.x1 / step) - F.col("b") / 2).cast("int"))
        cells = rows.select(F.explode(starts).alias("a"), "b").select(F.col("a").cast("long"), F.col("b").cast("long"))
        placed = cells.withColumns({"ring": self.ring_of(F.col("a"), F.col("b")), **{n: F.lit(v) for n, v in zip(("x0", "y0", "x1", "y1"), (area.x0, area.y0, area.x1, area.y1))}})
        cut = geometry.clip(placed, "ring", "x0", "y0", "x1", "y1").withColumn("overlap_m2", geometry.area(F.col("ring"))).where("overlap_m2 > 1e-6")
        whole = F.lit(self.nominal_km2 * 1e6)
        x, y = self.centre(F.col("a"), F.col("b"))
        return cut.select(F.concat(F.lit(f"{self.name}|"), F.col("a").cast("string"), F.lit("_"), F.col("b").cast("string")).alias("unit_id"), "a", "b", whole.alias("area_m2"), "overlap_m2", (F.col("overlap_m2") / whole).alias("overlap_share"), x.alias("rep_x"), y.alias("rep_y"))

    def ring(self, k: int) -> list[tuple[int, int]]:
        return grid.hex_ring(k)


def build(spec: list[dict]) -> list[Grid]:
    """Grids of a configuration: ``{family: square | hex, size}``."""
    kinds = {"square": SquareGrid, "hex": HexGrid}
    return [kinds[s["family"]](float(s["size"])) for s in spec]


def hash_points(spark: SparkSession, n: int, area: Area, seed: str) -> DataFrame:
    """``point, x, y``: places spread evenly over the area, the same for a seed everywhere."""
    part = lambda at: F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("id").cast("string"))), at, 8), 16, 10).cast("double") / 2.0**32
    return spark.range(n).select(F.col("id").alias("point"), (area.x0 + part(1) * (area.x1 - area.x0)).alias("x"), (area.y0 + part(9) * (area.y1 - area.y0)).alias("y"))


def unit_samples(units: DataFrame, ident: str, size: float) -> DataFrame:
    """The middle of a square unit and of its four quarters."""
    places = F.array(*[F.struct(F.lit(u).alias("u"), F.lit(v).alias("v")) for u, v in ((0.0, 0.0), (-0.25, -0.25), (-0.25, 0.25), (0.25, -0.25), (0.25, 0.25))])
    dealt = units.withColumn("p", F.explode(places))
    return dealt.select(ident, (F.col("rep_x") + F.col("p.u") * size).alias("x"), (F.col("rep_y") + F.col("p.v") * size).alias("y"))


def reference_grid(x0: float, y0: float, x1: float, y1: float, cell: float, pad: float) -> dict:
    """The grid of cells, aligned to whole multiples, that covers a box with a margin: its lower corner and its cells a side."""
    corner = [math.floor((v - pad) / cell) * cell for v in (x0, y0)]
    n = [math.ceil((v + pad - lo) / cell) for v, lo in zip((x1, y1), corner)]
    return {"x0": corner[0], "y0": corner[1], "nx": n[0], "ny": n[1], "cell": cell}
