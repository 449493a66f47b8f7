"""Candidate grids: one interface, units that cover an area once."""

from pyspark.sql import functions as F

from terrace.operators import grids

AREA = grids.Area(-150.0, 40.0, 1900.0, 1333.0)


def test_units_cover_the_area_once(spark):
    for g in (grids.SquareGrid(400.0), grids.SquareGrid(300.0, 50.0, 20.0), grids.HexGrid(250.0)):
        units = g.units(spark, AREA)
        total, least, n, ids = units.agg(F.sum("overlap_m2"), F.min("overlap_m2"), F.count(F.lit(1)), F.countDistinct("unit_id")).first()
        assert abs(total - 2050.0 * 1293.0) < 1e-3 and least > 0 and n == ids
        assert units.where("overlap_share > 1 + 1e-9").count() == 0


def test_a_unit_finds_itself_at_its_middle(spark):
    for g in (grids.SquareGrid(400.0, 7.0, 9.0), grids.HexGrid(250.0)):
        a, b = g.lookup(F.col("rep_x"), F.col("rep_y"))
        assert g.units(spark, AREA).where((a != F.col("a")) | (b != F.col("b"))).count() == 0


def test_names_sizes_and_shifts():
    square, hexagon = grids.build([{"family": "square", "size": 500}, {"family": "hex", "size": 100}])
    assert (square.name, hexagon.name, square.nominal_km2) == ("sq500", "hex100", 0.25) and round(hexagon.nominal_km2, 6) == 0.025981
    assert [(g.ox, g.oy) for g in square.shifted(2)] == [(0.0, 250.0), (250.0, 0.0), (250.0, 250.0)]
    assert len(square.ring(2)) == 24 and len(hexagon.ring(1)) == 6


def test_seeded_places_are_the_same_and_inside(spark):
    points = grids.hash_points(spark, 500, AREA, "s").collect()
    assert points == grids.hash_points(spark, 500, AREA, "s").collect() and points != grids.hash_points(spark, 500, AREA, "t").collect()
    assert all(AREA.x0 <= p.x <= AREA.x1 and AREA.y0 <= p.y <= AREA.y1 for p in points)
    units = grids.SquareGrid(400.0).units(spark, AREA)
    assert grids.unit_samples(units, "unit_id", 400.0).count() == 5 * units.count()
