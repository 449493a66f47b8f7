"""Rules and contracts from files, the order of the features' table, maps to entities, exact lengths beside lines."""

import copy
import json
import math

import pytest
from pyspark.sql import functions as F

from terrace.operators import atomic, audit, experiment, extraction, grids, spatial_join
from terrace.operators.entities import Rule, category
from terrace.sources import config, mapfile

GOOD = {
    "input": {"feature_set_version": "0.3.0"},
    "feature_groups": {"counts": ["school_count_1km", "clinic_count_1km"]},
    "transforms": {
        "log1p": {"output_name": "log1p_{feature}", "candidates": ["counts", "population_density"], "publish_rule": {"minimum_raw_skewness": 1.0},
                  "rules": {"zero_maps_to_zero": True, "null_stays_null": True, "negative_input": "fail", "impute": False, "clip_or_winsorize": False}},
        "percentile": {
            "candidates": ["counts"], "tie_method": "midrank", "tie_sensitivity_methods": ["min", "max"], "minimum_cohort_size": 30, "constant_cohort_policy": "null_with_status", "range": [0, 1],
            "cohorts": {"mvp_pooled_percentile": {"output_name": "pooled_{feature}", "disposition": "diagnostic"}, "within_aoi_percentile": {"output_name": "within_{feature}", "disposition": "diagnostic"},
                        "peer_percentile": {"output_name": "peer_{feature}", "minimum_aois_per_peer_group": 3}},
        },
        "local_ratio": {"output_name": "ratio_k{k}_{feature}", "candidates": ["counts"], "denominator_zero_policy": "null_with_status", "publish_rule": {"minimum_finite_share_of_eligible": 0.5},
                        "neighborhood": {"method": "h3_grid_disk", "k": 1, "exclude_centre": True, "reference_statistic": "median", "require_all_neighbors_present": True, "minimum_valid_neighbors": 3}},
        "source_defined_ghs_smod_class": {"enabled": False, "substitute_with_custom_threshold": False},
    },
    "status_vocabulary": {"atomic_passthrough": [*config.ATOMIC], "gate4": {"a": "cohort_too_small"}},
}
CONTRACT = {"feature_set_version": "0.3.0", "mvp_features": atomic.FEATURES}


def test_a_sound_config_has_no_problems():
    assert config.config_problems(GOOD, CONTRACT) == []
    config.check_config(GOOD, CONTRACT)


@pytest.mark.parametrize(("path", "value"), [
    ("input.feature_set_version", "0.2.0"), ("transforms.log1p.rules.impute", True), ("transforms.log1p.candidates", ["built_up_ratio"]), ("transforms.percentile.candidates", ["distance_nearest_park_m"]),
    ("transforms.percentile.tie_method", "dense"), ("transforms.percentile.minimum_cohort_size", 1), ("transforms.percentile.cohorts.peer_percentile.output_name", "national_percentile_{feature}"),
    ("transforms.local_ratio.neighborhood.k", 0), ("transforms.local_ratio.neighborhood", {}), ("feature_groups.counts", ["no_such_feature"]), ("status_vocabulary.atomic_passthrough", ["ok"]),
    ("transforms.source_defined_ghs_smod_class.enabled", True), ("transforms.percentile.range", [0, 100]), ("transforms.local_ratio.publish_rule.minimum_finite_share_of_eligible", 0),
])
def test_a_wrong_entry_is_named(path, value):
    bad = copy.deepcopy(GOOD)
    at = bad
    *way, last = path.split(".")
    for part in way:
        at = at[part]
    at[last] = value
    assert any(path in p for p in config.config_problems(bad, CONTRACT))
    with pytest.raises(config.ConfigError):
        config.check_config(bad, CONTRACT)


def test_names_and_groups():
    assert config.members({"g": ["a", "b"]}, ["c", "g", "a"]) == ["c", "a", "b"]
    assert config.output_names(GOOD, "x") == {"log1p": "log1p_x", "local_ratio": "ratio_k1_x", "mvp_pooled_percentile": "pooled_x", "within_aoi_percentile": "within_x", "peer_percentile": "peer_x"}


def test_files_and_rules(spark, tmp_path):
    own = {
        "entity_policy": {"category_precedence": ["hub", "shop", "gone"]},
        "canonical_categories": {
            "shop": {"group": "retail", "match_any": [{"key": "shop", "values": ["*"]}], "exclude_if_matches": ["hub"]},
            "hub": {"group": "transport", "match_any": [{"all": [{"key": "public", "values": ["station"]}, {"key": "bus", "values": ["yes"]}]}]},
        },
        "area_categories": {"park": {"match_any": [{"key": "leisure", "values": ["park"]}]}},
    }
    (tmp_path / "rules.json").write_text(json.dumps(own))
    rules = config.category_rules(config.read(str(tmp_path / "rules.json")))
    assert [r.category for r in rules] == ["hub", "shop"] and config.area_rules(own)[0].any_of == [{"leisure": ["park"]}]
    rows = spark.createDataFrame([({"public": "station", "bus": "yes", "shop": "kiosk"},), ({"shop": "kiosk"},), ({"public": "station"},)], "tags map<string,string>")
    assert [r[0] for r in rows.select(category(F.col("tags"), rules)).collect()] == ["hub", "shop", None]
    pytest.importorskip("yaml")
    (tmp_path / "map.yaml").write_text("mapping:\n  food: [cafe, bar]\n  shop: [kiosk]\n")
    assert sorted(map(tuple, config.crosswalk(spark, config.read(str(tmp_path / "map.yaml"))).collect())) == [("bar", "food"), ("cafe", "food"), ("kiosk", "shop")]


def test_areas_by_name(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "area string")
    assert config.choose_areas(rows, ["a", "b"]).count() == 2 and config.choose_areas(rows, ["a", "b"], ["b"]).count() == 1
    with pytest.raises(config.ConfigError, match="unknown areas: z"):
        config.choose_areas(rows, ["a", "b"], ["b", "z"])


def test_columns_of_the_contract():
    columns = atomic.contract_columns()
    assert len(atomic.FEATURES) == 35 and len(columns) == len(set(columns)) and columns[4:39] == atomic.FEATURES
    assert {s.name: s.radius for s in atomic.count_specs()}["mall_count_3km"] == 3000.0
    with pytest.raises(ValueError, match="no radius"):
        atomic.radius_of("mall_count")


def test_reference_grid_and_order(spark):
    assert grids.reference_grid(120.0, -30.0, 990.0, 410.0, 100.0, 50.0) == {"x0": 0.0, "y0": -100.0, "nx": 11, "ny": 6, "cell": 100.0}
    rows = spark.createDataFrame([(n,) for n in ("h3_r10", "h3_r9", "square", "h3_r8")], "n string")
    assert [r[0] for r in rows.orderBy(*experiment.by_resolution(F.col("n"))).collect()] == ["square", "h3_r8", "h3_r9", "h3_r10"]


def test_windows_in_unions(spark):
    windows = spark.createDataFrame([(1, 0.0, 0.0, 4.0, 2.0), (2, 0.0, 0.0, 4.0, 3.0), (3, 50.0, 50.0, 51.0, 51.0), (4, -0.01, 0.0, 2.0, 2.0)], "w int, x0 double, y0 double, x1 double, y1 double")
    extents = spark.createDataFrame([(0.0, 0.0, 2.5, 2.0), (2.0, -1.0, 5.0, 2.5)], "x0 double, y0 double, x1 double, y1 double")
    assert dict(map(tuple, experiment.windows_inside(windows, extents, "w", 3.0).collect())) == {1: True, 2: False, 3: False, 4: False}
    assert dict(map(tuple, experiment.windows_inside(windows, extents, "w", 3.0, 0.02).collect()))[4]
    assert not any(r.inside for r in experiment.windows_inside(windows, extents.limit(0), "w", 3.0).collect())


def test_lengths_beside_lines_against_samples(spark):
    import random

    rng = random.Random(7)
    segment = lambda: [rng.uniform(0, 400) for _ in range(4)]
    a, b = [(k // 3, k % 3, *segment()) for k in range(24)], [tuple(segment()) for _ in range(12)] + [(100.0, 100.0, 100.0, 100.0), (0.0, 50.0, 400.0, 50.0)]
    a += [(90, 0, 0.0, 60.0, 400.0, 60.0), (91, 0, 5.0, 5.0, 5.0, 5.0), (92, 0, 0.0, 900.0, 10.0, 900.0)]

    def away(x, y, s):
        ax, ay, bx, by = s
        far = (bx - ax) ** 2 + (by - ay) ** 2
        t = max(0.0, min(1.0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / far)) if far else 0.0
        return math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay))

    want, n = {}, 4000
    for way, _, ax, ay, bx, by in a:
        hits = sum(any(away(ax + (k + 0.5) / n * (bx - ax), ay + (k + 0.5) / n * (by - ay), s) <= 20 for s in b) for k in range(n)) / n
        want[way] = want.get(way, 0) + hits * math.hypot(bx - ax, by - ay)
    lines, others = spark.createDataFrame(a, "way int, seq int, ax double, ay double, bx double, by double"), spark.createDataFrame(b, "ax double, ay double, bx double, by double")
    got = {r.way: r for r in audit.buffered_lengths(lines, others, 20.0, 75.0).collect()}
    assert set(want) - set(got) == {91}  # a line without length
    assert {w: (got[w].covered, want[w]) for w in got if abs(got[w].covered - want[w]) >= 1.5} == {}
    assert got[90].covered == pytest.approx(400.0) and got[92].covered == 0
    top = audit.unmatched(spark.createDataFrame([(1, 10.0, 4.0), (2, 10.0, 5.0), (3, 30.0, 1.0)], "way int, length double, covered double"), "way", 5)
    assert [r.way for r in top.collect()] == [3, 1]


def test_nearest_shapes_against_all_pairs(spark):
    import random

    rng = random.Random(3)
    points = [(k, g, rng.uniform(0, 9000), rng.uniform(0, 9000), rng.choice([500.0, 4000.0, 9000.0])) for k in range(60) for g in ("line", "box")]
    shapes = []
    for g in ("line", "box"):
        for _ in range(12):
            x, y = rng.uniform(0, 9000), rng.uniform(0, 9000)
            shapes.append((g, g == "line", x, y, x + rng.uniform(0, 700), y + rng.uniform(0, 700)))
    p, s = spark.createDataFrame(points, "k int, g string, x double, y double, radius double"), spark.createDataFrame(shapes, "g string, line boolean, ax double, ay double, bx double, by double")
    every = {(r.k, r.g): r.d for r in p.join(s, "g").groupBy("k", "g").agg(F.min(spatial_join.shape_distance(F.col("x"), F.col("y"))).alias("d")).collect()}
    got = {(r.k, r.g): r.distance for r in spatial_join.nearest_shapes(p, s, ["k", "g"], "g", first=300.0).collect()}
    assert all(every[k] == pytest.approx(d) for k, d in got.items())
    assert {(k, g) for k, g, _, _, radius in points if every[k, g] <= radius} <= set(got)


def test_maps_with_odd_relations(spark):
    rules, areas = [Rule("site", "x", [{"tourism": ["attraction"]}])], [Rule("wood", "area", [{"natural": ["wood"]}])]
    node = lambda i, x, y, **t: ("node", i, t, x, y, None, None)
    way = lambda i, refs, **t: ("way", i, t, None, None, refs, None)
    relation = lambda i, members, **t: ("relation", i, t, None, None, None, members)
    rows = [node(k, float(k % 2) * 4, float(k // 2 % 2) * 4) for k in range(4)] + [node(9, None, None, tourism="attraction"), node(8, 1.0, 1.0, tourism="attraction")]
    rows += [way(1, [0, 1, 3]), way(2, [0, 2, 3]), way(3, [0, 1, 77]), way(4, [77], tourism="attraction"), way(5, [0, 1, 0, 1, 0], natural="wood")]
    rows += [
        relation(1, [("way", 1, "outer"), ("way", 2, "")], type="boundary", natural="wood"), relation(2, [("way", 1, "outer")], type="multipolygon", natural="wood"),
        relation(3, [("relation", 1, "")], type="site", tourism="attraction"), relation(4, [], type="site", tourism="attraction"), relation(5, [("node", 8, ""), ("way", 3, "")], type="site", tourism="attraction", natural="wood"),
        relation(6, [("way", 99, "outer")], type="multipolygon", natural="wood"), relation(7, [("node", 9, "")], tourism="attraction"),
    ]
    got = extraction.extract(spark.createDataFrame(rows, mapfile.SCHEMA), rules, areas)
    assert {(r.kind, r.id, r.size) for r in got.areas.collect()} == {("relation", 1, 16.0)}
    assert {(r.kind, r.id, r["shape"]) for r in got.entities.collect()} == {("relation", 5, "group")}
    assert {(r.kind, r.id) for r in got.dropped.collect()} == {("node", 8)}
    assert {(r.kind, r.id, r.category): r.reason for r in got.failures.collect()} == {
        ("way", 4, "site"): "open_way_without_locations", ("way", 5, "wood"): "assembler_empty_or_invalid", ("relation", 2, "wood"): "assembler_no_area", ("relation", 3, "site"): "nested_relation_member",
        ("relation", 4, "site"): "no_members", ("relation", 5, "wood"): "area_category_on_grouping_relation", ("relation", 6, "wood"): "members_missing_from_extract", ("relation", 7, "site"): "members_missing_from_extract",
    }
    empty = extraction.extract(spark.createDataFrame([], mapfile.SCHEMA), rules, areas)
    assert empty.entities.count() == empty.areas.count() == empty.failures.count() == 0
