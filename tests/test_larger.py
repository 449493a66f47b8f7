"""Queries over keys and numbers of rows that the small tables do not hold, against their SQL."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from terrace.operators import audit
from terrace.queries import ORACLE_SQL, QUERIES
from tests.oracle import connect, rows


def suppliers(folder, keys):
    pq.write_table(pa.table({"s_suppkey": pa.array(keys, pa.int64())}), f"{folder}/supplier.parquet")


def test_triangles_without_area_and_rows_that_repeat(spark, tmp_path):
    suppliers(tmp_path, [1573, 1574, 2379, 1, 1, 9504, 17])  # the corners of 1573, 1574, 2379 and 9504 lie on a line
    got = rows(QUERIES["polygon_cells"](spark, str(tmp_path)).toPandas())
    assert got == rows(connect(tmp_path).sql(ORACLE_SQL["polygon_cells"]).df()) and len(got[1]) == 7


def rows_made(frame, *nodes):
    """Rows that the joins of a plan, as it ran, have put out."""
    frame.collect()
    made, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name, metrics = node.nodeName(), node.metrics()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        if any(n in name for n in nodes) and metrics.contains("numOutputRows"):
            made += metrics.apply("numOutputRows").value()
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return made


def test_points_at_one_place_are_tested_once(spark, tmp_path):
    suppliers(tmp_path, list(range(1, 60)))
    keys = [k + 20_000 * c for k in range(1, 400) for c in range(25)]  # keys 20 000 apart lie at one place
    text = pa.array([None] * len(keys), pa.string())
    pq.write_table(pa.table({"c_custkey": pa.array(keys, pa.int64()), "c_mktsegment": text, "c_name": text, "c_acctbal": pa.array([0.0] * len(keys)), "c_nationkey": pa.array([0] * len(keys), pa.int32())}), f"{tmp_path}/customer.parquet")
    frame = QUERIES["polygon_points"](spark, str(tmp_path))
    want = rows(connect(tmp_path).sql(ORACLE_SQL["polygon_points"]).df())
    assert rows(frame.toPandas()) == want and max(int(r[1]) for r in want[1]) >= 25
    assert rows_made(frame, "Join") < sum(int(r[1]) for r in want[1])


def test_segments_that_repeat_are_measured_once(spark):
    ways = spark.range(300).selectExpr("id AS way", "0L AS seq", "0.0D AS ax", "cast(id % 3 * 10 AS double) AS ay", "400.0D AS bx", "cast(id % 3 * 10 AS double) AS by")
    others = spark.range(200).selectExpr("cast(id AS double) AS ax", "-5.0D AS ay", "cast(id + 1 AS double) AS bx", "-5.0D AS by")
    out = audit.buffered_lengths(ways, others, 10.0, 150.0)
    got = {r.way: r for r in out.collect()}
    assert len(got) == 300 and {round(r.covered, 6) for w, r in got.items() if w % 3 == 0} == {round(200 + 75**0.5, 6)}
    assert {r.covered for w, r in got.items() if w % 3 == 2} == {0.0}
    assert rows_made(out, "Join", "FlatMapCoGroups") <= 2000
    united = audit.unite(np.array([0, 1, 0, 0, 1]), np.array([0.2, 0.0, 0.1, 0.9, 0.5]), np.array([0.4, 0.1, 0.8, 1.0, 0.6]))
    assert [v.tolist() for v in united] == [[0, 0, 1, 1], [0.1, 0.9, 0.0, 0.5], [0.8, 1.0, 0.1, 0.6]]


def test_ways_at_one_place_are_measured_once(spark, tmp_path):
    keys = [(o + 19_000 * c, n) for o in range(1, 41) for c in range(20) for n in range(1, 5)]  # keys 19 000 apart lie at one place
    flags = [("R" if (o % 19_000 + n) % 2 else "A") for o, n in keys]
    lines = {"l_orderkey": pa.array([o for o, _ in keys], pa.int64()), "l_linenumber": pa.array([n for _, n in keys], pa.int32()), "l_partkey": pa.array(range(len(keys)), pa.int64()), "l_returnflag": flags, "l_linestatus": ["O"] * len(keys)}
    pq.write_table(pa.table(lines), f"{tmp_path}/lineitem.parquet")
    duck = connect(tmp_path)
    for name in ("line_match", "unmatched_top"):
        assert rows(QUERIES[name](spark, str(tmp_path)).toPandas()) == rows(duck.sql(ORACLE_SQL[name]).df())
    top = QUERIES["unmatched_top"](spark, str(tmp_path))
    made = rows_made(top, "Join", "FlatMapCoGroups")
    assert top.count() == 20 and made <= len(keys) // 2


def test_what_single_segments_cover_whole_needs_no_pairs(monkeypatch):
    rng, compared, plain = np.random.default_rng(5), [], audit.intervals
    deal = lambda n, low, high: dict(zip(("ax", "ay", "bx", "by"), rng.integers(low, high, (4, n)).astype(float)))
    a, b = deal(600, 0, 500), deal(700, -30, 530)
    a["bx"][:20], a["by"][20:40] = a["ax"][:20], a["ay"][20:40]  # along one axis
    b["bx"][:5], b["by"][:5] = b["ax"][:5], b["ay"][:5]  # points
    a = {c: v[(a["ax"] != a["bx"]) | (a["ay"] != a["by"])] for c, v in a.items()}
    monkeypatch.setattr(audit, "intervals", lambda p, q, r: compared.append(len(p["ax"]) * len(q["ax"])) or plain(p, q, r))
    lines = 500 * np.arange(26) / 25
    for n, most in ((700, len(a["ax"]) * 70), (12, None), (1, None)):
        other = {c: v[:n] for c, v in b.items()}
        compared.clear()
        got = audit.shares(a, other, lines, lines, 30.7)
        which, t0, t1 = audit.unite(*plain(a | {"s0": np.zeros(len(a["ax"])), "s1": np.ones(len(a["ax"]))}, other, 30.7))
        assert np.abs(got - np.bincount(which, t1 - t0, len(a["ax"]))).max() < 1e-9
        assert most is None or sum(compared) <= most
