import itertools
import random

from pyspark.sql import functions as F

from terrace.llm import mixing


def test_targets_are_shared_again_until_none_is_above():
    sizes = [("a", 100), ("b", 10_000), ("c", 50), (None, 400)]
    got = mixing.capped_targets(sizes, [3, 1, 2], 1.5, 2.0)
    left, open_, want = 1.5 * 10_550, dict(zip([s for s, _ in sizes], [3, 1, 2, 3])), {}
    while True:  # the rule as it is told
        level = left / sum(open_.values())
        above = [s for s, w in open_.items() if level * w > 2.0 * dict(sizes)[s]]
        if not above:
            want |= {s: level * w for s, w in open_.items()}
            break
        for s in above:
            want[s] = 2.0 * dict(sizes)[s]
            left -= want[s]
            del open_[s]
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
    assert mixing.capped_targets([("a", 0)], [3], 1.5, 2.0) == {"a": 0.0}


def test_flow_is_of_least_cost():
    rng = random.Random(4)
    for _ in range(60):
        names = ["a", "b", "c"][: rng.randint(2, 3)]
        patterns = {p: rng.randint(1, 4) for n in (1, 2) for p in itertools.combinations(names, n) if rng.random() < 0.8} or {("a",): 2}
        quotas = {s: rng.randint(0, 5) for s in names}
        flow = mixing.min_cost_flow(patterns, quotas, 2)
        given = {s: sum(f.get(s, 0) for f in flow.values()) for s in names}
        assert all(given[s] <= quotas[s] for s in names) and all(sum(f.values()) <= 2 * patterns[p] for p, f in flow.items())
        price = lambda amounts: (sum(amounts.values()), -sum(min(n, patterns[p]) + 4 * max(0, n - patterns[p]) for p, n in amounts.items()))
        best = None
        for amounts in itertools.product(*[range(2 * n + 1) for n in patterns.values()]):
            amounts = dict(zip(patterns, amounts))
            if all(sum(n for p, n in amounts.items() if set(p) <= set(some)) <= sum(quotas[s] for s in some) for k in range(1, len(names) + 1) for some in itertools.combinations(names, k)):
                best = max(best or price(amounts), price(amounts))
        assert price({p: sum(f.values()) for p, f in flow.items()}) == best


def test_overlapping_members_meet_their_quotas(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 7 + 1).alias("size"), F.when(F.col("id") % 4 == 0, F.array(F.lit("x"), F.lit("y"))).when(F.col("id") % 4 == 1, F.array(F.lit("y"))).when(F.col("id") % 4 == 2, F.array(F.lit("x"))).otherwise(F.lit(None)).alias("members"))
    quotas = {"x": 500, "y": 700, None: 50}
    got = mixing.mix(docs, quotas, "members", "size", "doc_id").collect()
    assert all(r.copies <= 2 and r.taken == r.copies * r.size and len(r.given) == r.copies and set(r.given) <= set(r.members or [None]) for r in got)
    for s, q in quotas.items():
        assert abs(sum(r.size * r.given.count(s) for r in got) - q) <= 14
    again = mixing.mix(docs.repartition(7), quotas, "members", "size", "doc_id").collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_nulls_ties_clashing_names_and_empty_tables(spark):
    schema = "doc_id long, text string, source string, size string, target int, words int"
    rows = [(1, None, "s", "x", 1, 1), (2, "", None, "x", 1, 1), (2, "a b", None, "x", 1, 1), (2, "a b", None, "x", 1, 1), (None, "a b c", "s", None, None, None)]
    got = mixing.mix_by_source(spark.createDataFrame(rows, schema).drop("size", "target")).collect()
    assert len(got) == 5 and {r.taken % max(1, r.size) for r in got} == {0} and sum(r.taken for r in got if r.size == 0) == 0
    assert mixing.mix_by_source(spark.createDataFrame([], schema).drop("size", "target")).count() == 0
