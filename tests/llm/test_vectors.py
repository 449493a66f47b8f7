import numpy as np
from pyspark.sql import functions as F

from terrace.llm import ann, kdtree, vectors
from terrace.llm._store import Scratch
from tests.oracle import connect, rows

SMALL = "/root/testdata/sf0.01"


def table(spark, vecs, schema="vec_id long, embedding array<double>"):
    return spark.createDataFrame([(i, v) for i, v in vecs], schema)


ODD = [(1000, None), (1050, [0.0] * 4), (1100, [1.0, None, 0.0, 0.0]), (1150, [float("nan"), 0.0, 0.0, 0.0]), (1200, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (1250, []), (1300, [1.0, 2.0])]


def brute(vecs, score, ok, k=5):
    good = sorted({(i, tuple(v)) for i, v in vecs if i is not None and v and ok(v)})
    out = []
    for q, v in good:
        if q % 50 == 0:
            near = sorted((-score(v, w), i) for i, w in good if i != q and len(w) == len(v))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(near, 1)]
    return sorted(out)


def finite(v):
    return all(x is not None and np.isfinite(x) for x in v)


def data(n=300, dim=4, seed=0):
    rng = np.random.default_rng(seed)
    vecs = [(i, rng.normal(0, 1, dim).tolist()) for i in range(n)]
    return vecs + [(n + i, vecs[3][1]) for i in range(40)] + [vecs[50], (50, vecs[60][1]), (1350, [3.0, 1.0])]


def test_exact_search_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 100)
    vecs = data() + ODD
    want = brute(vecs, lambda a, b: sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b)), finite)
    frame = table(spark, vecs)
    got = kdtree.top_k(frame, frame.where("vec_id % 50 = 0"), "vec_id", "embedding", 5)
    assert sorted(map(tuple, got.collect())) == sorted((q, n, i, s) for q, n, i, s in want)


def test_scores_beyond_doubles_stay_exact(spark):
    vecs = [(i, [float(2**17 * (i + 1)), float(3 * i), 1.0]) for i in range(0, 120, 3)]
    want = brute(vecs, lambda a, b: sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b)), finite)
    frame = table(spark, vecs)
    assert max(s for *_, s in want) > 2**53
    assert sorted(map(tuple, kdtree.top_k(frame, frame.where("vec_id % 50 = 0"), "vec_id", "embedding", 5).collect())) == want


def test_trees_prune_nothing_that_counts():
    rng = np.random.default_rng(5)
    points = np.floor(rng.normal(0, 50, (3000, 6)))
    tree = kdtree.Tree(points)
    queries = points[:40]
    for (where, scores), q, i in zip(tree.search(queries, [slice(k, k + 1) for k in range(40)], np.full(40, -np.inf, object), 5), queries, range(40)):
        all_scores = points @ q
        all_scores[i] = -np.inf
        want = np.lexsort([np.arange(len(points)), -all_scores])[:5]
        assert where.tolist() == want.tolist() and scores.tolist() == all_scores[want].tolist()


def test_whole_query_against_sql(spark):
    from terrace.llm.queries import ORACLE_SQL, QUERIES

    assert rows(QUERIES["op8_exact_topk"](spark, SMALL).toPandas()) == rows(connect(SMALL).sql(ORACLE_SQL["op8_exact_topk"]).df())


def test_small_shards_are_searched_exactly(spark):
    vecs = data(200) + ODD
    cosine = lambda a, b: float((np.array(a) * np.array(b)).sum() / (np.sqrt((np.array(a) ** 2).sum()) * np.sqrt((np.array(b) ** 2).sum())))
    frame = table(spark, vecs)
    index, books, shards = ann.build_index(frame, Scratch(spark, "t"), "vec_id", "embedding")
    got = sorted(map(tuple, ann.nearest(index, books, shards, frame.where("vec_id % 50 = 0"), "vec_id", "embedding", 5).collect()))
    want = brute(vecs, cosine, lambda v: finite(v) and any(v))
    near = lambda rows: sorted((q, n, round(s, 9)) for q, n, _, s in rows)
    assert near(got) == near(want)
    assert [(q, n, i) for q, n, i, _ in got if i >= 200] == [(q, n, i) for q, n, i, _ in want if i >= 200]  # equal vectors by id


def test_recall_on_whole_tables(spark):
    from terrace.llm.queries import QUERIES

    for folder in (SMALL, "/root/testdata/sf0.1"):
        frame = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
        v = np.stack(frame.embedding.to_numpy()).astype(float)
        unit, ids = v / np.sqrt((v * v).sum(axis=1))[:, None], frame.vec_id.to_numpy()
        got = {}
        for r in QUERIES["op5_ann"](spark, folder).collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        hits = []
        for k in np.flatnonzero(ids % 50 == 0):
            s = unit @ unit[k]
            s[k] = -np.inf
            hits.append(len(set(ids[np.argsort(-s)[:5]]) & set(got[ids[k]])) / 5)
        assert np.mean(hits) >= 0.95


def test_anisotropic_codes_lower_the_weighed_loss():
    rng = np.random.default_rng(0)
    sample = rng.normal(0, 1, (2000, 64))
    book = ann.fit(sample)
    unit = ann._unit(sample)

    def loss(codes):
        residual = unit - book.centres[np.arange(32), codes].reshape(len(unit), -1)
        return ((residual**2).sum(axis=1) + (book.eta - 1) * (residual * unit).sum(axis=1) ** 2).mean()

    plain = ((ann._pairs(unit)[:, :, None] - book.centres[None]) ** 2).sum(axis=3).argmin(axis=2)
    assert loss(book.encode(unit)) < loss(plain)
    codes, q = book.encode(unit), unit[:3]
    tables, packed = book.tables(q), ann.pack(codes)
    scores = sum(tables[:, j].take(packed[j], axis=1) for j in range(tables.shape[1]))
    assert np.allclose(scores, q @ book.centres[np.arange(32), codes].reshape(len(unit), -1).T, atol=1e-5)


def test_empty_tables(spark):
    frame = table(spark, [])
    assert kdtree.top_k(frame, frame, "vec_id", "embedding", 5).count() == 0
    index, books, shards = ann.build_index(frame, Scratch(spark, "t"), "vec_id", "embedding")
    assert ann.nearest(index, books, shards, frame, "vec_id", "embedding", 5).count() == 0
    assert frame.select(F.lit(1)).count() == 0


def test_blocks_are_never_broadcast(spark):
    frame = table(spark, data(2000))
    rows = vectors.usable(frame, "vec_id", "embedding")
    met = vectors.meetings(vectors.packed(rows, 100, "shard", 2000), vectors.packed(rows.where("id % 50 = 0"), 100, "block", 40), 20)
    assert met.collect()
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan.split("Initial Plan")[0]


def test_walk_visits_best_boxes_first_and_prunes():
    points = np.array([[x, y] for x in range(100) for y in range(100)], float)
    seen = []

    class Rows(np.ndarray):
        def __getitem__(self, at):
            seen.append(np.size(at))
            return np.asarray(super().__getitem__(at))

    tree = kdtree.Tree(points)
    tree.points = points.view(Rows)
    (where, scores), (none, _) = tree.search(np.array([[1.0, 1.0], [1.0, 1.0]]), [slice(9999, 10000), slice(0, 0)], np.array([-np.inf, 1e9], object), 3)
    assert scores.tolist() == [197, 197, 196] and where.tolist() == [9899, 9998, 9799] and not len(none)
    assert sum(seen) <= 2 * kdtree.LEAF
