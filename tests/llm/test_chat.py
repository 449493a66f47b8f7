from pyspark.sql import functions as F

from terrace.llm import chat
from tests.oracle import connect, rows

SMALL = "/root/testdata/sf0.01"


def test_whole_query_against_sql(spark):
    from terrace.llm.queries import ORACLE_SQL, QUERIES

    assert rows(QUERIES["op10_chat"](spark, SMALL).toPandas()) == rows(connect(SMALL).sql(ORACLE_SQL["op10_chat"]).df())


def test_every_participant_speaks_as_the_assistant_once(spark):
    said = spark.createDataFrame([(1, 0, "ann", "hi"), (1, 1, "bob", "yo <|im_end|>"), (1, 2, "ann", None), (1, 3, None, "?"), (None, 0, "eve", "x"), (1, 1, "bob", "yo <|im_end|>")], "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(9)).withColumn("m", F.lit(9))
    got = {(r.conv_id, r.perspective): r for r in chat.rotate(said).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "eve")}
    ann = got[1, "ann"]
    assert (ann.n_messages, ann.n_own) == (5, 2)
    assert [ann.rendered[s.start : s.end] for s in ann.mask] == ["hi<|im_end|>\n", "<|im_end|>\n"]
    assert ann.rendered.startswith("<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\nyo < |im_end|><|im_end|>\n")
    assert [got[1, "bob"].rendered[s.start : s.end] for s in got[1, "bob"].mask] == ["yo < |im_end|><|im_end|>\n"] * 2


def test_long_and_crowded_conversations_come_in_parts(spark):
    many = spark.range(1200).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("role"), F.col("id").cast("string").alias("text"))
    crowd = spark.range(5000).select(F.lit(2).alias("conv_id"), F.lit(7).cast("long").alias("turn"), F.lit("a").alias("role"), F.col("id").cast("string").alias("text"))
    got = chat.rotate(many.unionByName(crowd)).collect()
    assert max(r.n_messages for r in got) <= chat.TURNS
    one = sorted((r.part_turn, r.part_range, r.rendered) for r in got if r.conv_id == 1 and r.perspective == "a")
    want = "".join(f"<|im_start|>{'assistant' if i % 2 == 0 else 'user name=b'}\n{i}<|im_end|>\n" for i in range(1200))
    assert "".join(x[2] for x in one) == want
    assert sum(r.n_messages for r in got if r.conv_id == 2) == 5000
    assert chat.rotate(many.limit(0)).count() == 0
