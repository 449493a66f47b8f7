import re
import unicodedata
"""Column functions on literal values."""

import pytest
from pyspark.sql import functions as F

from terrace.functions import grid, stats, status, strings


def values(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_denominator_ladder(spark):
    rows = spark.createDataFrame([(0.5, True, True), (0.0, True, True), (0.005, True, True), (0.5, False, True), (0.5, True, False)], "land double, covered boolean, other boolean")
    got = [r[0] for r in rows.select(status.denominator_status(F.col("other"), F.col("covered"), F.col("land"), F.lit(1.0), failure="source_unavailable")).collect()]
    assert got == ["ok", "denominator_zero", "denominator_below_minimum", "coverage_incomplete", "source_unavailable"]


def test_distance_statuses(spark):
    rows = spark.createDataFrame([(500.0, 9000.0), (6000.0, 5500.0), (None, 4000.0), (None, 8000.0), (4000.0, 4000.0)], "d double, r double")
    got = [r[0] for r in rows.select(status.distance_status(F.col("d"), F.lit(5000.0), F.col("r"))).collect()]
    assert got == ["ok", "not_found_within_cap", "search_truncated_by_extract", "not_found_within_cap", "ok"]


def test_unit_interval_snaps_noise_only(spark):
    rows = spark.createDataFrame([(-1e-12,), (1 + 1e-12,), (1.2,), (0.4,), (-0.1,)], "v double")
    assert [r[0] for r in rows.select(status.unit_interval(F.col("v"))).collect()] == [0.0, 1.0, 1.2, 0.4, -0.1]


def test_square_cells_are_half_open(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (999.999, 0.0), (1000.0, -0.5)], "x double, y double")
    assert [tuple(r) for r in rows.select(*grid.square_index(F.col("x"), F.col("y"), 1000.0)).collect()] == [(0, 0), (0, 0), (1, -1)]
    col, row = grid.parse_square_id(F.lit("sq500|-3_12"))
    assert values(spark, col, row) == (-3, 12)


def test_hexagon_of_a_centre_is_itself(spark):
    q, r = 3, -2
    x, y = 400.0 * (3**0.5 * q + 3**0.5 / 2 * r), 400.0 * 1.5 * r
    assert values(spark, *grid.hex_index(F.lit(x), F.lit(y), 400.0)) == (3, -2)
    assert len(grid.hex_ring(1)) == 6 and len(grid.hex_ring(2)) == 18 and len(grid.square_ring(1)) == 8


def test_utm_of_known_places(spark):
    zone = grid.utm_zone(F.lit(108.22))
    east, north = grid.utm(F.lit(3.0), F.lit(0.0), F.lit(31))
    got = values(spark, zone, F.round(east, 3), F.round(north, 3))
    assert got == (49, 500000.0, 0.0)
    _, north = grid.utm(F.lit(9.0), F.lit(48.0), F.lit(32))
    assert values(spark, F.round(north, 1))[0] == pytest.approx(5316300.5, abs=60)


def test_tiles_have_open_upper_edges(spark):
    got = values(spark, grid.tiles(F.lit(105.0), F.lit(9.0), F.lit(108.0), F.lit(10.0), 3))[0]
    assert [(t.x, t.y) for t in got] == [(105, 9)]


def test_adjusted_skewness(spark):
    rows = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 3, 3, 3, 4, 5, 9, 12)], "v double")
    n, xs = 10, [1, 2, 2, 3, 3, 3, 4, 5, 9, 12]
    mean = sum(xs) / n
    g1 = (sum((x - mean) ** 3 for x in xs) / n) / (sum((x - mean) ** 2 for x in xs) / n) ** 1.5
    assert rows.agg(stats.adjusted_skewness(F.col("v"))).first()[0] == pytest.approx(g1 * (n * (n - 1)) ** 0.5 / (n - 2))
    assert rows.limit(2).agg(stats.adjusted_skewness(F.col("v"))).first()[0] is None
    assert spark.range(5).agg(stats.adjusted_skewness(F.lit(1.0))).first()[0] == 0.0


def test_relative_difference(spark):
    rows = spark.createDataFrame([(0.2, 0.5), (10.0, 9.0), (5.0, 10.0)], "a double, b double")
    assert [r[0] for r in rows.select(stats.relative_difference(F.col("a"), F.col("b"), 1.0)).collect()] == [None, pytest.approx(0.1), 0.5]


def test_spearman_with_ties(spark):
    rows = spark.createDataFrame([("g", 1.0, 10.0), ("g", 2.0, 20.0), ("g", 2.0, 30.0), ("g", 3.0, 40.0), ("g", None, 1.0)], "g string, a double, b double")
    assert stats.spearman(rows, ["g"], "a", "b").first()["rho"] == pytest.approx(0.9486832980505138)


def test_names(spark):
    want = {"  Café  Nº1 ": "cafe no1", "...": None, "Đà Nẵng": "a nang", "Bệnh viện Đà Nẵng": "benh vien a nang", "Phở Hạnh": "pho hanh", "ﬁne ½ Ⅷ": "fine 1 2 viii", "İÉe\u0301": "iee", "𝐚Ａ中 Ⅻ": "aa xii", "": None, "A-1": "a 1"}
    rows = spark.createDataFrame([(n,) for n in [*want, None]], "n string")
    assert [r[0] for r in rows.select(strings.normalize_name(F.col("n"))).collect()] == [*want.values(), None]


def test_names_of_all_characters(spark):
    """Every character between two letters, against the rule character by character."""
    names = [f"a{chr(c)}b" for c in [*range(1, 0xD800), *range(0xE000, 0x30000)]]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(strings.normalize_name(F.col("n"))).collect()]
    bare = ["".join(c for c in unicodedata.normalize("NFKD", n.lower()) if not unicodedata.combining(c)) for n in names]
    want = [" ".join(re.findall("[a-z0-9]+", b)) for b in bare]
    assert [(n, g, w) for n, g, w in zip(names, got, want) if g != (w or None)] == []


def test_failures(spark):
    got = spark.sql("SELECT map('b', 2, 'a', 1, 'c', 0) m UNION ALL SELECT map('x', 0)").select(strings.failures(F.col("m"))).collect()
    assert [r[0] for r in got] == ["a:1;b:2", "none"]


def test_releases(spark):
    text = "<p>release/2026-01-21.0/</p><p>release/2026-02-18.1/</p>"
    assert values(spark, strings.releases(F.lit(text)))[0] == ["2026-01-21.0", "2026-02-18.1"]
