import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from terrace.llm import langid, quality

SMALL = "/root/testdata/sf0.01"


def docs_of(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_code_lengths_are_those_of_the_trees():
    words = {"x": [b"abab"] * 5 + [b"ab"] * 7, "y": [b"zz"] * 3}
    trees = langid.ContextTrees([(lang, g, n) for lang, own in words.items() for g, n in zip(*langid.grams_of(own))])
    bits, sizes = langid.Scorer(trees).lengths([b"abab  ab\nzq", b""])
    want = np.zeros(2)
    for word in (b"abab", b"ab", b"zq"):
        s = b" " + word + b" "
        for i in range(1, len(s)):
            for k, (own, leave) in enumerate(zip(trees.bits, trees.leave)):
                context, cost = s[max(0, i - langid.ORDER) : i], 0.0
                while context + s[i : i + 1] not in own:
                    cost += leave.get(context, 0.0)
                    if not context:
                        cost += 8.0
                        break
                    context = context[1:]
                else:
                    cost += own[context + s[i : i + 1]]
                want[k] += cost
    assert np.allclose(bits[0], want) and (bits[1] == 0).all() and sizes.tolist() == [11, 0]
    for bits_of, leave in zip(trees.bits, trees.leave):  # in each context the symbols and the escape share all probability
        for context in leave:
            total = sum(2**-b for g, b in bits_of.items() if g[:-1] == context) + 2 ** -leave[context]
            assert math.isclose(total, 1.0)


def test_grams_stay_within_words():
    rng, want = random.Random(2), Counter()
    words = ["".join(rng.choice("ab9=") for _ in range(rng.randint(1, 9))).encode() for _ in range(200)] + ["é中".encode()]
    for word in words:
        s = b" " + word + b" "
        want.update(s[i - k : i + 1] for i in range(1, len(s)) for k in range(min(langid.ORDER, i) + 1))
    assert dict(zip(*langid.grams_of(words))) == want
    assert dict(zip(*langid.grams_of([b"a"]))) == Counter([b"a", b" a", b" ", b"a ", b" a "])


def test_held_out_languages(spark):
    from terrace.llm.queries import QUERIES

    got = QUERIES["op4_language_id"](spark, SMALL).collect()
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SMALL}/documents.parquet'").fetchall())
    assert len(got) == len(langs) and all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)


def test_texts_without_letters_and_without_models(spark):
    docs = docs_of(spark).limit(60)
    trees = langid.learn(docs)
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "中文"), (5, "a"), (6, "der die das " * 60_000)], "id long, text string").withColumn("score2", F.lit(0))
    got = {r.id: r for r in langid.identify(rows, trees).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0.0 and got[2].lang_bits is None
    assert got[4].lang_pred != "und" and got[6].lang_bits < 4
    rows = spark.createDataFrame([("x9", 1), ("a=b c=d", 2), ("mail@example.org 1948", 3)], "text string, score long")
    got = langid.identify(rows, trees)
    assert got.columns == ["text", "lang_pred", "score", "lang_bits"] and all(r.lang_bits > 0 and r.lang_pred != "und" for r in got.collect())
    none = langid.learn(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.identify(rows, none).collect()} == {"und"}
    assert langid.identify(rows.limit(0), trees).count() == 0


def test_machine_scores_by_sums_of_squares():
    rng = np.random.default_rng(2)
    n = quality.BUCKETS + len(quality.STATISTICS) + quality.LENGTHS
    machine = quality.Machine(0.1, rng.normal(0, 1, n), rng.normal(0, 0.3, (n, quality.RANK)), np.zeros(n - quality.BUCKETS), np.ones(n - quality.BUCKETS))
    at, x, stats = quality.features(b"Some words, some MORE words!!\nand a line", quality.Words())
    dense = machine.dense(stats)
    where, values = np.concatenate([at, np.arange(quality.BUCKETS, n)]), np.concatenate([x, dense])
    z = 0.1 + machine.weights[where] @ values
    z += sum(machine.vectors[where[i]] @ machine.vectors[where[j]] * values[i] * values[j] for i in range(len(where)) for j in range(i))
    assert math.isclose(machine.score(at, x, dense), 1 / (1 + math.exp(-z)), rel_tol=1e-6)


def test_held_out_quality(spark):
    from terrace.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op9_quality"](spark, SMALL).collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) >= 0.95 * len(held)


def test_quality_of_odd_rows(spark):
    docs = docs_of(spark)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    machine = quality.learn(docs, labels.unionByName(labels.limit(20).withColumn("quality", F.lit(None).cast("int"))))
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "!"), (4, "word " * 200_000), (4, "word " * 200_000)], "id long, text string")
    got = quality.score(rows, machine).collect()
    assert len(got) == 5 and len({r.score for r in got if r.id == 4}) == 1 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.score(rows, quality.learn(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.score(rows.limit(0), machine).count() == 0


def test_letters_beside_digits_are_scored(spark):
    trees = langid.learn(docs_of(spark))
    chinese = "他出生于一个小村庄后来搬到了城里"
    texts = [chinese, chinese[:8] + "1948" + chinese[8:], "中文" * 40 + "=" + "日本" * 40, "the people of the city and the country", "the9people1of2the3city4and=the@country"]
    got = {r.id: r for r in langid.identify(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), trees).collect()}
    assert all(got[i].lang_bits > langid.FOREIGN_BITS for i in (0, 1, 2)) and all(0 < got[i].lang_bits < langid.FOREIGN_BITS for i in (3, 4))
    assert got[4].lang_pred == got[3].lang_pred and got[4].lang_bits > got[3].lang_bits
    assert langid.Scorer(trees).lengths([b"12 3@4 56=", b"the 1948 city"])[1].tolist() == [11, 14]
