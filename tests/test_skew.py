"""A third of the rows share one key: results stay whole and no group grows with that key."""

import pytest
from pyspark.sql import functions as F

from foliospark.operators import chat, ordering, retrieval, sets
from foliospark.operators.similarity import top_k_similar


@pytest.fixture(scope="module")
def hot_talk(spark):
    """One conversation of 3,000 messages among 1,500 of four."""
    hot = spark.range(3000).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"))
    rest = spark.range(6000).select((F.floor(F.col("id") / 4) + 100).alias("conv_id"), (F.col("id") % 4).alias("turn"))
    rows = hot.unionByName(rest)
    return rows.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant").alias("role"),
                       F.concat(F.lit("m"), F.col("turn").cast("string")).alias("text"))


def test_window_over_a_hot_conversation(hot_talk):
    got = retrieval.chat_window(hot_talk, 2, piece=64)
    assert got.count() == hot_talk.where("role = 'user'").count()
    rows = got.where("conv_id = 7 AND turn IN (0, 2, 64, 66, 2998)").collect()
    assert {r.turn: r.history for r in rows} == {0: [], 2: ["m0", "m1"], 64: ["m62", "m63"], 66: ["m64", "m65"], 2998: ["m2996", "m2997"]}


def test_assembled_rows_are_bounded(hot_talk):
    rows = chat.assemble(hot_talk, segment_turns=100)
    assert rows.agg(F.max(F.size("messages"))).first()[0] == 100
    assert rows.agg(F.sum(F.size("messages"))).first()[0] == hot_talk.count()


def test_search_in_a_hot_conversation(spark, hot_talk):
    names = spark.createDataFrame([(7, "long one")], "conv_id long, name string")
    found = chat.search_conversations(hot_talk, names, "m2047 m2048 m2049", piece=1024).collect()
    assert [r.conv_id for r in found] == [7]


def test_copies_are_cut_before_the_shuffle(spark):
    rows = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("k"))
    first = sets.first_per_key(rows, ["k"], ["id"])
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert first.count() == 6001 and first.where("k = 'copy'").first().id == 0


def test_copies_in_the_corpus_keep_exact_ranks(spark):
    corpus = spark.range(12_000).select("id", F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(
        F.array(F.lit(1.0), F.col("id").cast("double"))).alias("vector"))
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "question_id long, vector array<double>")
    rows = top_k_similar(asked, corpus.repartition(3), 4, doc_id="id").orderBy("rank").collect()
    assert [r.doc_id for r in rows] == [0, 3, 6, 9]


def test_cache_looks_up_copies_once(spark):
    asked = spark.range(900).select(F.col("id").alias("question_id"), F.when(F.col("id") % 3 == 0, "same old question").otherwise(
        F.concat(F.lit("question "), F.col("id").cast("string"))).alias("question"))
    cache = spark.createDataFrame([(1, "same old question")], "cache_id long, question string")
    got = retrieval.question_cache(asked, cache, threshold=0.99, suggestion_threshold=0.98)
    assert got.count() == 900 and got.where("status = 'hit'").count() == 300


def test_carried_settings_of_a_hot_user(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user"), F.col("id").alias("t"),
                                    F.floor(F.col("id") / 500).alias("day"), F.when(F.col("id") == 3, "x").alias("own"))
    got = ordering.carry_forward(rows, ["user"], ["t"], "day", {"setting": "own"}, number="n").where("user = 1")
    assert got.agg(F.max("n")).first()[0] == got.count()
    assert got.where("setting = 'x'").count() == got.where("t >= 3").count()
