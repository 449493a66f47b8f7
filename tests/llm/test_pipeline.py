import base64
import hashlib
import random

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from terrace.llm import mixing, simhash
from tests.llm.test_substring import brute

SMALL = "/root/testdata/sf0.001"


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, stages = docs.columns, [f for _, f in corpus_pipeline.STAGES]
    known = stages[0](spark, docs, SMALL).cache()
    assert known.columns == names and 0.95 * docs.count() <= known.count() <= docs.count()
    unique = stages[1](spark, known, SMALL).cache()
    assert unique.columns == names and unique.count() == simhash.drop_near_copies(known).count() <= known.select("text").distinct().count()
    cut = stages[2](spark, unique, SMALL).cache()
    want = brute([(r.doc_id, r.text) for r in unique.collect()])
    assert cut.columns == names and sorted((r.doc_id, " ".join(r.text.split())) for r in cut.collect()) == [(i, t) for i, t, _, _ in want]
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = stages[3](spark, cut, SMALL).cache()
    taken = {r.doc_id: r.copies for r in mixing.mix_by_source(cut).collect()}
    rows = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == names and all(rows.count(i) == n for i, n in taken.items())
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in mixed.collect()}
    last = stages[4](spark, mixed, SMALL).collect()
    assert len(last) == len(rows)
    for r in random.Random(1).sample(last, 20):
        ids = coder.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = ["score", "lang_pred", "lang_bits", "n_words", "n_removed", "removed_spans", "size", "copies", "target", "taken", "given", "source_size", "id", "h1", "bucket", "row", "c0", "__h1"]
    wide = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SMALL).cache()
        assert out.columns == wide.columns and out.count() > 0
        assert out.where(" OR ".join(f"`{n}` <> concat('{n}', cast(doc_id as string))" for n in names)).count() == 0
