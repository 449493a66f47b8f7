"""Operators on small tables with known results."""

import json

import pytest
from pyspark.sql import functions as F

from terrace.functions import grid
from terrace.operators import audit, entities, experiment, features, graph, normalize, raster, spatial_join, validate
from terrace.sources import artifacts, tables


def test_weights_of_a_box_over_ten_metre_pixels(spark):
    pixels = spark.range(100).select((F.col("id") % 10).alias("col"), F.floor(F.col("id") / 10).cast("long").alias("row"), F.lit(1.0).alias("value"))
    weights = raster.pixel_weights(pixels, 10.0, 25.0, -5.0).where("u_col = 0 and u_row = 0")  # the box from (5, 5) to (30, 30)
    got = weights.agg(F.sum("fraction"), F.collect_set("fraction")).first()
    assert got[0] == 6.25 and set(got[1]) == {0.25, 0.5, 1.0}


def test_half_nodata(spark):
    pixels = spark.range(4).select(F.col("id").alias("col"), F.lit(0).cast("long").alias("row"), F.when(F.col("id") < 2, 125.0).alias("value"))
    got = raster.weighted_sum(raster.pixel_weights(pixels, 25.0, 100.0), 25.0, 100.0).first()
    assert (got.total, got.valid_share, got.nodata_share) == (250.0, 0.125, 0.125)


def test_class_shares_add_up(spark):
    classes = [0, 10, 20, 30, 40, 80, 95, 10, 20, 10]
    pixels = spark.createDataFrame([(i % 10, 0, c) for i, c in enumerate(classes)], "col long, row long, class int")
    got = raster.class_fractions(raster.pixel_weights(pixels, 10.0, 100.0), 10.0, 100.0, {"tree": [10], "grass": [20, 30], "wet": [80, 90, 95]}).first()
    assert [round(got[c] * 10, 9) for c in ("valid_share", "land_share", "tree_ratio", "grass_ratio", "wet_ratio")] == [0.9, 0.8, 0.3, 0.3, 0.2]


def test_disk_sum_is_exact(spark):
    cells = spark.createDataFrame([(0, 0, 3), (5, 5, 1)], "col long, row long, n long")
    got = {(r.col, r.row): r.n for r in raster.disk_sum(cells, "n", 1.0, 1.0).collect()}
    assert got[0, 0] == 3 and got[1, 0] == 3 and (1, 1) not in got and len(got) == 10


def test_clipped_lengths(spark):
    lines = spark.createDataFrame([(1, True, 20.0, 50.0, 180.0, 50.0), (2, False, 50.0, 20.0, 50.0, 120.0), (3, False, 0.0, 0.0, 0.0, 0.0)], "way long, is_major boolean, ax double, ay double, bx double, by double")
    got = {(r.way, r.col, r.row): round(r.length, 9) for r in spatial_join.clipped_lengths(lines, 100.0).collect()}
    assert got == {(1, 0, 0): 80.0, (1, 1, 0): 80.0, (2, 0, 0): 80.0, (2, 0, 1): 20.0}


def test_within_includes_the_edge(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0)], "k long, x double, y double")
    right = spark.createDataFrame([(600.0, 800.0), (600.1, 800.0), (-1000.0, 0.0), (0.0, 0.0)], "x double, y double")
    assert sorted(r.distance for r in spatial_join.within(left, right, 1000.0).collect()) == [0.0, 1000.0, 1000.0]


def test_nearest_widens_its_rings(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, 10_000.0, 0.0), (3, 0.0, 90_000.0)], "k long, x double, y double")
    right = spark.createDataFrame([(30.0, 40.0), (0.0, 3000.0)], "x double, y double")
    got = {r.k: round(r.distance, 6) for r in spatial_join.nearest(left, right, "k", first=100.0, limit=20_000.0).collect()}
    assert got == {1: 50.0, 2: round((9970**2 + 1600) ** 0.5, 6)}


def test_first_box_takes_the_lowest_order_and_keeps_outsiders(spark):
    boxes = spark.createDataFrame([("b", 2, 0.0, 0.0, 10.0, 10.0), ("a", 5, 5.0, 0.0, 20.0, 10.0)], "unit string, o int, x0 double, y0 double, x1 double, y1 double")
    points = spark.createDataFrame([(1, 7.0, 5.0), (2, 15.0, 5.0), (3, 10.0, 10.0), (4, 50.0, 50.0)], "p long, x double, y double")
    got = {r.p: r.unit for r in spatial_join.in_boxes(points, boxes, "p", "unit", "o", 8.0).collect()}
    assert got == {1: "b", 2: "a", 3: "b", 4: None}


def test_overlaps_count_once(spark):
    shapes = spark.createDataFrame([(0.0, 0.0, 50.0, 100.0), (0.0, 0.0, 50.0, 100.0), (25.0, 0.0, 50.0, 50.0)], "x0 double, y0 double, x1 double, y1 double")
    assert [r.area for r in spatial_join.overlap_areas(shapes, 1000.0, 25.0).collect()] == [5000.0]


def test_unknown_category_is_an_error(spark):
    units = spark.createDataFrame([("u", 0.0, 0.0)], "unit_id string, x double, y double")
    with pytest.raises(ValueError, match="unknown"):
        features.counts(units, units.withColumn("category", F.lit("a")), [features.Count("n", ["zoo"])], ["a"])


TIES = [0.0, 0.0, 0.0, 0.0, 1.0, 2.0, 2.0, 5.0, 5.0, 5.0]


def test_percentiles_of_the_tie_vector(spark):
    rows = spark.createDataFrame([("c", v, "ok") for v in TIES], "cohort string, value double, status string")
    table = normalize.fit_ecdf(rows, ["cohort"], least=5)
    asked = spark.createDataFrame([("c", v, "ok") for v in (0.0, 2.0, 5.0, 3.0, -1.0, 99.0)] + [("c", None, "source_unavailable"), ("d", 1.0, "ok")], rows.schema)
    got = {(r.cohort, r.value): (r.pct_midrank, r.pct_min, r.pct_max, r.pct_status) for r in normalize.apply_ecdf(asked, table, ["cohort"]).collect()}
    assert got["c", 0.0] == (pytest.approx(0.2), 0.0, pytest.approx(0.4), "ok")
    assert got["c", 2.0][0] == pytest.approx(0.6) and got["c", 5.0][0] == pytest.approx(0.85) and got["c", 5.0][2] == pytest.approx(1.0)
    assert [got["c", v][0] for v in (3.0, -1.0, 99.0)] == [pytest.approx(0.7), 0.0, pytest.approx(1.0)]
    assert got["c", None] == (None, None, None, "source_unavailable") and got["d", 1.0][3] == "cohort_not_fitted"


def test_small_and_flat_cohorts_are_not_fitted(spark):
    rows = spark.createDataFrame([("few", 1.0, "ok")] * 3 + [("flat", 2.0, "ok")] * 40, "cohort string, value double, status string")
    got = {r.cohort: (r.fit_status, r.value, r.n_obs) for r in normalize.fit_ecdf(rows, ["cohort"]).collect()}
    assert got == {"few": ("cohort_too_small", None, 3), "flat": ("cohort_degenerate", None, 40)}


def test_groups_that_count_alike(spark):
    rows = spark.createDataFrame([("p", "a", float(v), "ok") for v in range(90)] + [("p", "b", float(v), "ok") for v in range(1000, 1010)], "cohort string, area string, value double, status string")
    asked = rows.where("value = 1000")
    plain = normalize.apply_ecdf(asked, normalize.fit_ecdf(rows, ["cohort"]), ["cohort"]).first().pct_midrank
    weighed = normalize.fit_ecdf(rows.withColumn("w", normalize.equal_weights("area")), ["cohort"], weight=F.col("w"))
    assert (plain, normalize.apply_ecdf(asked, weighed, ["cohort"]).first().pct_midrank) == (pytest.approx(0.905), pytest.approx(0.525))


def test_log1p_guards(spark):
    rows = spark.createDataFrame([(0.0, "ok"), (None, "source_unavailable")], "v double, s string")
    assert [r[0] for r in rows.select(normalize.log1p(F.col("v"), F.col("s"), "v")).collect()] == [0.0, None]
    for bad in ([(-1.0, "ok")], [(None, "ok")], [(1.0, "source_unavailable")]):
        frame = spark.createDataFrame(bad, "v double, s string")
        with pytest.raises(Exception, match="negative|contradict"):
            frame.select(normalize.log1p(F.col("v"), F.col("s"), "v")).collect()


def test_local_ratio_ladder(spark):
    units = spark.createDataFrame([(f"c{i}", i, 0, float(v), "ok") for i, v in enumerate([4, 2, 0, 0, 0, 8])], "unit_id string, col long, row long, value double, status string")
    pairs = grid.neighbours(units, "unit_id", "col", "row", [(-1, 0), (1, 0)])
    got = {r.unit_id: (r.ratio, r.ratio_status) for r in normalize.local_ratio(units, pairs, F.lit(2), normalize.NeighbourhoodPolicy(1, 2, "median")).collect()}
    assert got["c0"] == (None, "neighborhood_incomplete") and got["c1"] == (1.0, "ok") and got["c3"] == (None, "neighborhood_reference_zero")
    with pytest.raises(ValueError):
        normalize.NeighbourhoodPolicy(0)


def test_categories_in_order_with_exclusions(spark):
    rules = [entities.Rule("a", "g", [{"shop": ["x"], "brand": ["*"]}], [{"closed": ["yes"]}]), entities.Rule("b", "h", [{"shop": ["*"]}])]
    rows = spark.sql("SELECT map('shop','x','brand','q') t UNION ALL SELECT map('shop','x') UNION ALL SELECT map('shop','x','brand','q','closed','yes') UNION ALL SELECT map('k','v')")
    got = rows.select(entities.category(F.col("t"), rules).alias("c")).select("c", entities.group_of(F.col("c"), rules)).collect()
    assert [tuple(r) for r in got] == [("a", "g"), ("b", "h"), ("b", "h"), (None, None)]


def test_duplicates_link_points_and_shapes_only(spark):
    rows = [(1, "point", "shop", "A B", None, 0.0, 0.0), (2, "polygon", "shop", "a  b", None, 10.0, 0.0), (3, "point", "shop", "a b", None, 20.0, 0.0), (4, "point", "shop", "zz", "Q", 500.0, 0.0), (5, "point", "shop", "zz", "Q", 500.0, 0.0), (6, "polygon", "cafe", "a b", None, 0.0, 0.0)]
    frame = spark.createDataFrame(rows, "id long, kind string, category string, name string, brand string, x double, y double")
    assert {r.id: r.keeper for r in entities.deduplicate(frame).collect()} == {1: 2, 2: 2, 3: 2, 4: 4, 5: 5, 6: 6}


def test_relations_need_all_members(spark):
    relations = spark.createDataFrame([(1, "park"), (2, "park"), (3, "park"), (4, "school")], "relation long, category string")
    members = spark.createDataFrame([(1, 10, "way"), (1, 11, "way"), (2, 10, "way"), (2, 99, "way"), (4, 10, "relation")], "relation long, member long, kind string")
    here = spark.createDataFrame([(10,), (11,)], "member long")
    out = entities.assemble_relations(relations, members, here)
    assert {r.relation: r.outcome for r in out.collect()} == {1: "assembled", 2: "missing_member", 3: "empty", 4: "nested"}
    assert {r.category: (r.assembled, r.failed, r.reasons) for r in entities.assembly_report(out).collect()} == {"park": (1, 2, "empty:1;missing_member:1"), "school": (0, 1, "nested:1")}


def test_degrees_and_boxes(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (3, 3), (2, 4)], "a long, b long")
    assert {r.node: r.degree for r in graph.degrees(edges).collect()} == {1: 2, 2: 3, 3: 2, 4: 1}
    places = spark.createDataFrame([(1, 0.0), (2, 10.0), (3, 5.0), (4, 10.1)], "node long, x double")
    assert graph.induced(edges, places, F.col("x").between(0, 10)).count() == 3


def test_components_against_union_find(spark):
    import random

    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)] + [(7000, 7000)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root}


def test_component_lengths(spark):
    edges = spark.createDataFrame([(1, 2, 0.0, 0.0, 3.0, 4.0), (2, 3, 3.0, 4.0, 3.0, 9.0), (8, 9, 0.0, 0.0, 0.0, 10.0)], "a long, b long, ax double, ay double, bx double, by double")
    got = {r.root: (r.length, r.share) for r in graph.component_lengths(edges, graph.components(edges)).collect()}
    assert got == {1: (10.0, 0.5), 8: (10.0, 0.5)}


def test_connectors_by_place(spark):
    rows = spark.sql("SELECT 's' AS id, array(named_struct('connector_id','c','at',1.0D), named_struct('connector_id','a','at',0.0D), named_struct('connector_id','b','at',0.5D)) AS connectors UNION ALL SELECT 't', array(named_struct('connector_id','a','at',0.0D))")
    assert [tuple(r) for r in graph.connector_edges(rows).collect()] == [("s", "a", "b"), ("s", "b", "c")]


def test_coarse_gate_at_the_limit(spark):
    rows = spark.createDataFrame([("a", 0.25), ("a", 0.26), ("a", None), ("b", 0.3), ("b", 0.9)], "c string, r double")
    assert {r.c: (r.triggered, r.too_coarse) for r in experiment.coarse_gate(rows, ["c"], "c", "r").collect()} == {"a": (1, False), "b": (2, True)}


def test_pareto_with_ties_and_gaps(spark):
    rows = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0), ("c", 2.0, 2.0), ("d", 2.0, 1.0), ("e", None, 0.0)], "k string, x double, y double")
    assert {r.k: r.state for r in experiment.pareto(rows, "k", ["x", "y"]).collect()} == {"a": "frontier", "b": "frontier", "c": "dominated", "d": "frontier", "e": "undetermined"}


def test_density_grid_clamps_and_keeps_empty_cells(spark):
    points = spark.createDataFrame([(-5.0, 0.0), (2200.0, 2200.0)], "x double, y double")
    got = {(r.col, r.row): r.n for r in audit.density_grid(points, 2000.0, 500.0).collect()}
    assert len(got) == 16 and sum(got.values()) == 2 and got[0, 0] == 1 and got[3, 3] == 1


def test_covered_lengths(spark):
    line = "way long, seq long, ax double, ay double, bx double, by double"
    a = spark.createDataFrame([(1, 0, 0.0, 0.0, 1000.0, 0.0), (2, 0, 0.0, 500.0, 1000.0, 500.0)], line)
    b = spark.createDataFrame([(9, 0, 0.0, 10.0, 500.0, 10.0)], line)
    got = {r.way: (round(r.length), round(r.covered)) for r in audit.covered_lengths(a, b, 10.0, 15.0).collect()}
    assert got[1][0] == 1000 and 490 <= got[1][1] <= 520 and got[2] == (1000, 0)


def test_validator_counts_what_is_wrong(spark):
    rows = spark.createDataFrame([(1, 0.5, "ok"), (1, None, "ok"), (2, 0.4, "source_unavailable"), (3, 2.0, "ok"), (4, None, "strange")], "u long, v double, s string")
    got = {r.check: r.violations for r in validate.report(rows, validate.violations({"v": "s"}, {"v": 0.0}, {"v": 1.0}), ["u"]).collect()}
    assert got == {"v:status_unknown": 1, "v:bare_null": 1, "v:value_despite_failure": 1, "v:not_finite": 0, "v:below_range": 0, "v:above_range": 1, "key:repeated": 1}
    assert validate.forbidden_columns(["unit_id", "Trip_count", "origin", "scores", "od_flow_in", "a_score"]) == ["Trip_count", "od_flow_in", "a_score"]


def test_required_columns_and_pinned_tables(spark):
    frame = spark.createDataFrame([(1, "a", "v1"), (2, "b", "v1")], "k long, g string, version string")
    with pytest.raises(tables.SchemaError, match="bbox"):
        tables.require(frame, ["k", "bbox"])
    assert tables.check_table(frame, ["k"], 2, {"g": {"a", "b"}}, ["version"]) == []
    assert len(tables.check_table(frame, ["version"], 3, {"g": {"a"}}, ["k"])) == 4


def test_box_scan_reads_nested_extents(spark, tmp_path):
    rows = spark.range(10).select("id", F.struct(F.col("id").cast("double").alias("xmin"), (F.col("id") + 1.0).alias("xmax"), F.lit(0.0).alias("ymin"), F.lit(1.0).alias("ymax")).alias("bbox"))
    rows.write.parquet(str(tmp_path / "t"))
    got = tables.scan_box(spark.read.parquet(str(tmp_path / "t")), (3.0, 0.0, 4.5, 1.0), ["id"])
    assert sorted(r.id for r in got.collect()) == [2, 3, 4]
    assert "PushedFilters: [IsNotNull(bbox.xmax)" in got._jdf.queryExecution().toString() or "bbox.xm" in got._jdf.queryExecution().toString()


def test_manifest_and_checksums(tmp_path):
    run = artifacts.RunManifest(tmp_path, "r1", "atomic")
    with run.stage("write"):
        (run.folder / "t.txt").write_text("x")
    run.add(name="t", rows=1)
    with pytest.raises(RuntimeError), run.stage("broken"):
        raise RuntimeError("no")
    assert json.loads((run.folder / "manifest.json").read_text())["status"] == "failed"
    good = artifacts.RunManifest(tmp_path, "r2", "atomic")
    (good.folder / "t.txt").write_text("x")
    good.finish()
    artifacts.write_checksums(good.folder)
    assert artifacts.latest_run(tmp_path, "atomic") == good.folder
    (good.folder / "t.txt").write_text("y")
    assert artifacts.tampered(good.folder) == ["t.txt"] and artifacts.latest_run(tmp_path, "atomic") is None
    with pytest.raises(FileExistsError):
        artifacts.RunManifest(tmp_path, "r2", "atomic")
    assert artifacts.canonical({"b": float("nan"), "a": 1}) == '{"a":1,"b":null}'


def test_derivations_are_reused_until_anything_changes(tmp_path):
    made = []
    make = lambda p: (made.append(1), p.write_text("v"))
    check = lambda p: None
    assert artifacts.derive_or_reuse(tmp_path / "o", "h1", {"k": 1}, make, check)
    assert not artifacts.derive_or_reuse(tmp_path / "o", "h1", {"k": 1}, make, check)
    assert artifacts.derive_or_reuse(tmp_path / "o", "h1", {"k": 2}, make, check)
    (tmp_path / "o").write_text("changed")
    assert artifacts.derive_or_reuse(tmp_path / "o", "h1", {"k": 2}, make, check)
    assert len(made) == 3


def test_stream_and_batch_agree(spark, small):
    from terrace.streaming import windows

    schema = spark.read.parquet(f"{small}/events.parquet").schema
    events = windows.event_stream(spark, small, schema, "events.parquet")
    query = windows.tumbling(events, "1 day").writeStream.outputMode("complete").format("memory").queryName("tumbled").start()
    query.processAllAvailable()
    query.stop()
    batch = windows.tumbling(spark.read.parquet(f"{small}/events.parquet"), "1 day")
    key = lambda r: (str(r.start), r.event_type, r.n)
    assert sorted(map(key, spark.table("tumbled").collect())) == sorted(map(key, batch.collect()))
