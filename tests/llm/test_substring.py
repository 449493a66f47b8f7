import random

import numpy as np
from pyspark.sql import functions as F

from terrace.llm import substring


def brute(rows):
    """(kept words, removed) by row: a place is covered if its window starts at an earlier place of the input."""
    first, out = {}, []
    key = lambda i: substring.NO_ID if i is None else i
    split = [(key(i), (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - 19):
            w = tuple(words[k : k + 20])
            first[w] = min(first.get(w, (i, k)), (i, k))
    for i, words in split:
        gone = set()
        for k in range(len(words) - 19):
            if first[tuple(words[k : k + 20])] < (i, k):
                gone.update(range(k, k + 20))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, b" ".join(kept).decode(), len(words), len(words) - len(kept)))
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("ids", "bucket", "row", "c0", "id", "n_words", "removed_spans"):
        frame = frame.withColumn(name, F.lit("own"))
    got = substring.remove_repeats(frame.repartition(3), **options).collect()
    return sorted((substring.NO_ID if r.doc_id is None else r.doc_id, r.text or "", r.n_words, r.n_removed) for r in got)


def texts(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz")
    passages = [[word() for _ in range(rng.randint(15, 40))] for _ in range(5)]
    rows = []
    for i in range(40):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 30))]
        rows.append((i * 3 - 20, rng.choice([" ", "\n", "\t "]).join(words)))
    return rows


def test_against_brute_force(spark):
    rows = [*texts(1), (500, None), (501, ""), (502, "a " * 400), (None, "lone words"), (503, "ä ß " * 30)]
    assert run(spark, rows) == brute(rows)


def test_heavy_prefixes_are_split_alike(spark, monkeypatch):
    rows = [*texts(2), *((1000 + i, "q " * 60 + f"t{i % 3}") for i in range(30))]
    want = brute(rows)
    counts = np.zeros(substring.SHORT_TABLE + substring.MIDDLE_TABLE, np.int64)
    counts[5], counts[substring.SHORT_TABLE + 9] = 10**9, 10**9
    groups = substring.Groups(counts)
    assert groups.short[5] == -1 and groups.split[9] > 1 and groups.count > groups.split[9]
    monkeypatch.setattr(substring, "MIN_GROUPS", 400)  # a group then holds a few suffixes: all prefix lengths occur
    assert run(spark, rows) == want


def test_repeated_rows_do_not_remove_each_other(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long), (1, long), (2, long)]
    assert [x[3] for x in run(spark, rows)] == [0, 0, 50]


def test_rows_of_one_id_are_judged_each_on_its_own_text(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(1, a), (2, a), (2, b), (None, b), (None, a + " x"), (None, "y " + a), (None, None), (3, f"{b} {a}"), (3, f"z {b}")]
    assert run(spark, rows) == brute(rows)
    assert [x[3] for x in run(spark, rows[:3])] == [0, 30, 0] or sorted(x[3] for x in run(spark, rows[:3])) == [0, 0, 30]


def test_one_window_in_all_documents(spark, monkeypatch):
    monkeypatch.setattr(substring, "BATCH_WORDS", 100)  # known repeats then come from many batches
    line = " ".join(f"w{i}" for i in range(20))
    rows = [(i, f"a{i} {line} b{i}") for i in range(200)]
    assert run(spark, rows) == brute(rows)


def test_texts_that_lose_nothing_can_stay_as_they_are(spark):
    frame = spark.createDataFrame([(1, "a\n\nb  c"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in substring.remove_repeats(frame, joined=False).collect()) == [(1, "a\n\nb  c"), (2, None)]


def test_spans_and_empty_tables(spark):
    long = " ".join(f"w{i}" for i in range(30))
    frame = spark.createDataFrame([(1, long), (2, "x y " + long + " z")], "doc_id long, text string")
    assert {r.doc_id: list(r.removed_spans) for r in substring.remove_repeats(frame).collect()} == {1: [], 2: [2, 32]}
    assert substring.remove_repeats(frame.limit(0)).count() == 0
