"""The table of all atomic features of units: rasters, roads, counts, distances and areas, each with its status, in the order of the contract.

Every block is aggregated by cell on its own; the blocks meet in one union and one aggregation, not in a chain of joins.
All distances, whatever the target, come out of one search by rings.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.status import COVERAGE_FLOOR, OK, denominator_status, distance_status, unit_interval, where_ok
from terrace.operators import raster, spatial_join
from terrace.operators.features import LOCAL, REGIONAL, Count, counts

#: The features in order, their categories, what counts and distances read, caps of searches in metres, groups of land classes.
FEATURES = [
    "population_count", "population_density", "built_up_ratio", "tree_cover_ratio", "grass_shrub_ratio", "cropland_ratio", "water_wetland_ratio",
    "road_length_km", "road_density_km_per_km2", "major_road_length_km", "intersection_density_per_km2", "distance_nearest_major_road_m",
    "distance_nearest_urban_centre_km", "transit_stop_count_1km", "distance_nearest_transit_stop_m", "distance_nearest_transport_hub_m",
    "school_count_1km", "higher_education_count_3km", "distance_nearest_higher_education_m", "hospital_count_3km", "clinic_count_1km",
    "pharmacy_count_1km", "distance_nearest_hospital_m", "food_drink_count_1km", "retail_count_1km", "marketplace_count_1km", "mall_count_3km",
    "lodging_count_1km", "attraction_culture_count_3km", "park_recreation_count_1km", "distance_nearest_park_m", "osm_industrial_site_area_ratio",
    "distance_nearest_osm_industrial_site_m", "poi_total_count_1km", "poi_category_richness_1km",
]
CATEGORIES = [
    "early_childhood", "school", "higher_education", "hospital", "clinic", "pharmacy", "food_drink", "convenience", "supermarket", "mall",
    "marketplace", "retail_other", "financial_service", "civic_service", "lodging", "attraction_culture", "park_recreation", "manufacturing",
    "warehouse_logistics", "transport_bus_stop", "transport_bus_station", "transport_rail_stop", "transport_rail_station", "transport_air_water_hub",
]
ROLLUPS = {
    "transit_stop": ["transport_bus_stop", "transport_rail_stop", "transport_rail_station"],
    "transport_hub": ["transport_bus_station", "transport_rail_station", "transport_air_water_hub"],
    "retail": ["convenience", "supermarket", "retail_other"],
    "poi_total": CATEGORIES,
}
CAPS = {"major_road": 50_000.0, "transit_stop": 50_000.0, "transport_hub": 100_000.0, "higher_education": 100_000.0, "hospital": 100_000.0, "park": 50_000.0, "osm_industrial_site": 100_000.0}
LAND_RATIOS = {"tree_cover": [10], "grass_shrub": [20, 30], "cropland": [40], "water_wetland": [80, 90, 95]}
#: Features that share a status column, and columns beside the features.
SHARED_STATUS = {
    **{f"{name}_ratio": "land_cover_ratio_status" for name in LAND_RATIOS}, "road_length_km": "road_features_status", "major_road_length_km": "road_features_status",
    "road_density_km_per_km2": "road_density_status", "intersection_density_per_km2": "intersection_density_status",
}
METADATA = ["spatial_unit_id", "spatial_method", "spatial_resolution", "spatial_unit_area_km2"]
SOURCE_STATUS = ["osm_query_complete", "population_coverage_fraction", "built_up_coverage_fraction", "land_cover_coverage_fraction"]
EXTRA = ["valid_land_support_area_km2", "land_cover_valid_area_km2", "population_nodata_area_fraction", "distance_search_complete_radius_m", "osm_entity_assembly_failures"]

#: What a distance reads beside points of its own category: areas of these categories.
AREA_TARGETS = {"park_area": "park", "industrial_site": "osm_industrial_site"}
#: Categories whose failed assembly takes a distance's value.
READ_BY = {"park": ["park_recreation", "park_area"], "osm_industrial_site": ["industrial_site"], "major_road": []}


def status_of(feature: str) -> str:
    return SHARED_STATUS.get(feature, f"{feature}_status")


def contract_columns(metadata: list[str] = METADATA, features: list[str] = FEATURES, source: list[str] = SOURCE_STATUS, extra: list[str] = EXTRA) -> list[str]:
    """Every column of the table once, in order: metadata, features, sources' status, statuses of features, the rest."""
    return list(dict.fromkeys([*metadata, *features, *source, *map(status_of, features), *extra]))


def radius_of(feature: str) -> float:
    """The radius that a feature's name ends with."""
    for suffix, radius in (("_1km", LOCAL), ("_3km", REGIONAL)):
        if feature.endswith(suffix):
            return radius
    raise ValueError(f"{feature}: the name gives no radius")


def count_specs() -> list[Count]:
    """One count for every feature of the contract that counts; richness is no count of its own."""
    named = [(f, f.rsplit("_count_", 1)[0]) for f in FEATURES if "_count_" in f]
    return [Count(f, ROLLUPS.get(stem, [stem]), radius_of(f)) for f, stem in named]


@dataclass(frozen=True)
class Raster:
    """Pixels ``row, col, value`` (or ``class``) of a side in metres, its lower corner shifted against the units' grid, and pixels a side."""

    pixels: DataFrame
    size: float
    shift: float = 0.0
    count: int = 0

    def window_share(self, unit: float) -> Column:
        """Share of a cell ``x0, y0`` that lies in the raster's window."""

        def along(lo: str) -> Column:
            return F.greatest(F.lit(0.0), F.least(F.col(lo) + unit, F.lit(self.shift + self.size * self.count)) - F.greatest(F.col(lo), F.lit(self.shift))) / unit

        return along("x0") * along("y0")


@dataclass(frozen=True)
class Inputs:
    """What one run reads.

    ``units``: unit_id, col, row, x0, y0, x, y, radius (known completely), source_ok (the map's source is there), failed (categories
    with entities that could not be assembled); ``roads``: ax, ay, bx, by, is_major; ``crossings``: x, y; ``entities``: x, y, category,
    is_park; ``sites``: x0, y0, x1, y1, category, with edges on a grid of ``grain`` metres that divides the land pixels.
    """

    units: DataFrame
    unit: float
    population: Raster
    cover: Raster
    built: Raster
    roads: DataFrame
    crossings: DataFrame
    entities: DataFrame
    sites: DataFrame
    grain: float


def parks(areas: DataFrame, points: DataFrame) -> DataFrame:
    """Areas of parks, and points that are tagged as parks themselves, as boxes: each element once, areas first (``areas`` and ``points`` may share ids)."""
    both = areas.where("category = 'park_area'").select("kind", "id", "x0", "y0", "x1", "y1", F.lit(0).alias("__o"))
    own = points.where("category = 'park_recreation' AND is_park").select("kind", "id", F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.lit(1).alias("__o"))
    first = both.unionByName(own).groupBy("kind", "id").agg(F.min_by(F.struct("x0", "y0", "x1", "y1"), "__o").alias("b"))
    return first.select("kind", "id", "b.*")


def gather(blocks: list[DataFrame], keys: list[str]) -> DataFrame:
    """Blocks of numbers by the same keys side by side: a union and one aggregation. A block has a row for a key, or none (null)."""
    names = [c for b in blocks for c in b.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), blocks)
    return stacked.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])


def site_land(sites: DataFrame, cover: DataFrame, land_size: float, grain: float, unit: float) -> DataFrame:
    """``col, row, site_m2``: area of the union of sites over land, by cell; sites are dissolved into grid cells first."""
    run = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / grain).cast("long"), (F.ceil(F.col(hi) / grain) - 1).cast("long")))
    covered = sites.withColumn("gx", run("x0", "x1")).withColumn("gy", run("y0", "y1")).select("gx", "gy").distinct()
    down = lambda c, size: F.floor(F.col(c) * grain / size).cast("long")
    by_land = covered.groupBy(down("gx", land_size).alias("lc"), down("gy", land_size).alias("lr"), down("gx", unit).alias("col"), down("gy", unit).alias("row")).agg(F.count(F.lit(1)).alias("n"))
    dry = cover.where("class not in (0, 80)").select(F.col("col").alias("lc"), F.col("row").alias("lr"))
    return by_land.join(dry, ["lc", "lr"]).groupBy("col", "row").agg((F.sum("n") * grain * grain).alias("site_m2"))


def targets(inputs: Inputs) -> DataFrame:
    """All shapes that distances are measured to: ``target, line, ax, ay, bx, by``; a point is a box without width."""
    box = lambda x0, y0, x1, y1: [F.lit(False).alias("line"), *[F.col(c).alias(n) for c, n in ((x0, "ax"), (y0, "ay"), (x1, "bx"), (y1, "by"))]]
    read = {"transit_stop": ROLLUPS["transit_stop"], "transport_hub": ROLLUPS["transport_hub"], "higher_education": ["higher_education"], "hospital": ["hospital"]}
    hits = [F.when(F.col("category").isin(c), t) for t, c in read.items()] + [F.when((F.col("category") == "park_recreation") & F.col("is_park"), "park")]
    points = inputs.entities.select("x", "y", F.explode(F.array_compact(F.array(*hits))).alias("target")).select("target", *box("x", "y", "x", "y"))
    named = F.create_map(*[F.lit(v) for pair in AREA_TARGETS.items() for v in pair])
    areas = inputs.sites.select(F.try_element_at(named, F.col("category")).alias("target"), *box("x0", "y0", "x1", "y1")).where("target IS NOT NULL")
    lines = inputs.roads.where("is_major").select(F.lit("major_road").alias("target"), F.lit(True).alias("line"), "ax", "ay", "bx", "by")
    return points.unionByName(areas).unionByName(lines)


def atomic_features(inputs: Inputs, caps: dict[str, float] = CAPS) -> DataFrame:
    """All features of every unit, in the order of :func:`contract_columns`.

    Land ratios are shares of the classified area; densities and ratios on land need enough land; a count needs a search that is
    complete out to the regional radius; the distance to an urban centre has no source. A failed map source takes every feature of
    the map, entities of a category that failed take the features that read it.
    """
    unit, cell = inputs.unit, inputs.unit**2
    keys, renamed = ["col", "row"], {"u_col": "col", "u_row": "row"}
    units = inputs.units.withColumn("window", inputs.population.window_share(unit))
    people = raster.weighted_sum(raster.pixel_weights(inputs.population.pixels, inputs.population.size, unit, inputs.population.shift), inputs.population.size, unit).withColumnsRenamed(renamed)
    cover = raster.class_fractions(raster.pixel_weights(inputs.cover.pixels, inputs.cover.size, unit), inputs.cover.size, unit, LAND_RATIOS).withColumnsRenamed(renamed)
    seen = raster.weighted_sum(raster.pixel_weights(inputs.built.pixels, inputs.built.size, unit), inputs.built.size, unit).withColumnsRenamed(renamed)
    masked = raster.masked_share(inputs.built.pixels, inputs.cover.pixels, inputs.built.size, inputs.cover.size, unit).withColumnsRenamed(renamed)
    roads = spatial_join.clipped_lengths(inputs.roads, unit).groupBy(*keys).agg((F.sum("length") / 1000).alias("road_km"), (F.sum(F.when(F.col("is_major"), F.col("length"))) / 1000).alias("major_km"))
    place = lambda c: F.floor(F.col(c) / unit).cast("long")
    crossings = inputs.crossings.groupBy(place("x").alias("col"), place("y").alias("row")).agg(F.count(F.lit(1)).cast("double").alias("crossings"))
    blocks = [
        people.select(*keys, F.col("total").alias("people"), F.col("valid_share").alias("people_valid")),
        cover.select(*keys, F.col("valid_share").alias("valid"), F.col("land_share").alias("land"), *[f"{n}_ratio" for n in LAND_RATIOS]),
        seen.select(*keys, F.col("valid_share").alias("built_valid")), masked.select(*keys, "built_m2"), roads, crossings,
        site_land(inputs.sites.where("category = 'industrial_site'"), inputs.cover.pixels, inputs.cover.size, inputs.grain, unit),
    ]
    wide = units.join(gather(blocks, keys), keys, "left")
    counted = counts(units, inputs.entities, count_specs(), CATEGORIES).withColumnRenamed("richness", "poi_category_richness_1km")
    wide = wide.join(counted, "unit_id").join(_distances(units, targets(inputs)), "unit_id", "left")

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    land_km2, unit_km2 = zero("land") * cell / 1e6, F.lit(cell / 1e6)
    covered, peopled, built = zero("valid") >= COVERAGE_FLOOR, F.col("window") >= COVERAGE_FLOOR, zero("built_valid") >= COVERAGE_FLOOR
    on_land = denominator_status(F.lit(True), covered, land_km2, unit_km2)
    partial = lambda good: F.when(good, OK).otherwise("coverage_incomplete")
    broken = lambda names: F.coalesce(F.arrays_overlap(F.col("failed"), F.array(*[F.lit(n) for n in names]).cast("array<string>")), F.lit(False))
    mapped = lambda state, names=(): F.when(~F.col("source_ok"), "source_unavailable").when(broken(names), "entity_assembly_failed").otherwise(state)
    out: dict[str, tuple[Column, Column]] = {
        "population_count": (zero("people"), partial(peopled)),
        "population_density": (F.try_divide(zero("people"), land_km2), denominator_status(peopled, covered, land_km2, unit_km2)),
        "built_up_ratio": (unit_interval(F.try_divide(zero("built_m2"), land_km2 * 1e6)), denominator_status(built, covered, land_km2, unit_km2)),
        **{f"{n}_ratio": (unit_interval(F.try_divide(zero(f"{n}_ratio"), zero("valid"))), partial(covered)) for n in LAND_RATIOS},
        "road_length_km": (zero("road_km"), mapped(F.lit(OK))),
        "major_road_length_km": (zero("major_km"), mapped(F.lit(OK))),
        "road_density_km_per_km2": (F.try_divide(zero("road_km"), land_km2), mapped(on_land)),
        "intersection_density_per_km2": (F.try_divide(zero("crossings"), land_km2), mapped(on_land)),
        "osm_industrial_site_area_ratio": (unit_interval(F.try_divide(zero("site_m2"), land_km2 * 1e6)), mapped(on_land, ["industrial_site"])),
        "distance_nearest_urban_centre_km": (F.lit(None).cast("double"), F.lit("source_not_acquired")),
    }
    complete = F.col("radius") >= REGIONAL
    for spec in [*count_specs(), Count("poi_category_richness_1km", CATEGORIES)]:
        out[spec.name] = (F.col(spec.name).cast("double"), mapped(partial(complete), spec.categories))
    for target, cap in caps.items():
        reads = READ_BY.get(target, ROLLUPS.get(target, [target]))
        out[f"distance_nearest_{target}_m"] = (F.col(f"d_{target}"), mapped(distance_status(F.col(f"d_{target}"), F.lit(cap), F.col("radius")), reads))
    covered_km2 = F.when(covered, zero("valid") * cell / 1e6)
    beside = {
        "spatial_unit_id": F.col("unit_id"), "spatial_method": F.lit("square"), "spatial_resolution": F.lit(int(unit)), "spatial_unit_area_km2": unit_km2,
        "osm_query_complete": complete & F.col("source_ok"), "population_coverage_fraction": unit_interval(F.col("window")), "built_up_coverage_fraction": unit_interval(zero("built_valid")),
        "land_cover_coverage_fraction": unit_interval(zero("valid")), "valid_land_support_area_km2": F.when(covered, land_km2), "land_cover_valid_area_km2": covered_km2,
        "population_nodata_area_fraction": unit_interval(F.col("window") - zero("people_valid")), "distance_search_complete_radius_m": F.col("radius"),
        "osm_entity_assembly_failures": F.when(F.size("failed") > 0, F.array_join(F.array_sort("failed"), ";")).otherwise("none"),
    }
    for name, (value, state) in out.items():
        beside |= {name: where_ok(value, state), status_of(name): state}
    return wide.select(*[beside[c].alias(c) for c in contract_columns()])


def _distances(units: DataFrame, shapes: DataFrame) -> DataFrame:
    """``unit_id`` and the distance to the nearest shape of each target, as far as each unit's search is complete."""
    asked = units.select("unit_id", "x", "y", "radius", F.explode(F.array(*[F.lit(t) for t in CAPS])).alias("target"))
    found = spatial_join.nearest_shapes(asked, shapes, ["unit_id", "target"], "target", first=LOCAL)
    return found.groupBy("unit_id").agg(*[F.min(F.when(F.col("target") == t, F.col("distance"))).alias(f"d_{t}") for t in CAPS])
