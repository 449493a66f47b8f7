"""Atomic features of units: counts, distances, densities and ratios, each with its status."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.status import denominator_status, distance_status, where_ok
from terrace.operators.spatial_join import nearest, within

#: Radii of counts in metres; counts need a search radius that is complete out to the regional one.
LOCAL, REGIONAL = 1000.0, 3000.0


@dataclass(frozen=True)
class Count:
    """How many entities of the categories lie within the radius of a unit's centre."""

    name: str
    categories: list[str]
    radius: float = LOCAL


def centres(units: DataFrame) -> DataFrame:
    return units.withColumns({"x": (F.col("x0") + F.col("x1")) / 2, "y": (F.col("y0") + F.col("y1")) / 2})


def complete_radius(side: float):
    """Distance from a unit's centre to the edge of what was extracted."""
    return F.greatest(F.lit(0.0), F.least(F.col("x"), F.col("y"), side - F.col("x"), side - F.col("y")))


def counts(units: DataFrame, entities: DataFrame, specs: list[Count], known: list[str]) -> DataFrame:
    """``unit_id`` and one count for each spec, and ``richness``: different categories within the local radius. All in one join and aggregation."""
    for s in specs:
        if unknown := set(s.categories) - set(known):
            raise ValueError(f"{s.name}: unknown categories {sorted(unknown)}")
    met = within(units.select("unit_id", "x", "y"), entities.select("x", "y", "category"), max(s.radius for s in specs))
    hit = lambda s: F.count_if(F.col("r_category").isin(s.categories) & (F.col("distance") <= s.radius))
    local = F.countDistinct(F.when(F.col("distance") <= LOCAL, F.col("r_category")))
    found = met.groupBy("unit_id").agg(*[hit(s).alias(s.name) for s in specs], local.alias("richness"))
    names = [*[s.name for s in specs], "richness"]
    return units.select("unit_id").join(found, "unit_id", "left").select("unit_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def count_statuses(table: DataFrame, names: list[str], radius: str = "radius") -> DataFrame:
    """Counts are values only where the extract is complete out to the regional radius."""
    state = F.when(F.col(radius) >= REGIONAL, "ok").otherwise("coverage_incomplete")
    return table.withColumns({f"{n}_status": state for n in names}).withColumns({n: where_ok(F.col(n).cast("double"), state) for n in names})


def nearest_distance(units: DataFrame, targets: DataFrame, cap: float, name: str, first: float = LOCAL) -> DataFrame:
    """``unit_id``, the distance to the nearest target and its status; ``units`` has ``radius``, what is known completely."""
    found = nearest(units, targets, "unit_id", first=first, limit=cap)
    joined = units.select("unit_id", "radius").join(found, "unit_id", "left")
    state = distance_status(F.col("distance"), F.lit(cap), F.col("radius"))
    return joined.select("unit_id", where_ok(F.col("distance"), state).alias(name), state.alias(f"{name}_status"))


def density(table: DataFrame, name: str, numerator: str, land_km2: str, unit_km2: float, covered) -> DataFrame:
    """A numerator per square kilometre of land, where there is enough land."""
    state = denominator_status(F.col(numerator).isNotNull(), covered, F.col(land_km2), F.lit(unit_km2))
    return table.withColumns({name: where_ok(F.try_divide(F.col(numerator), F.col(land_km2)), state), f"{name}_status": state})
