"""Stored structures: bucketed tables, posting lists, term statistics, answer cache."""

import math
import re
from pathlib import Path

from pyspark.sql import functions as F

from foliospark.plans.ingest import chunk_documents
from foliospark.sources.datasets import DOCS, DatasetStore
from foliospark.operators import retrieval
from foliospark.operators.search import PostingIndex
from foliospark.operators.terms import TermStore, term_scores
from foliospark.plans.answer import AnswerCache
from foliospark.session import work_folder
from foliospark.sources.buckets import BucketTable


def files_of(root):
    found = Path(root.removeprefix("file://").removeprefix("file:")).rglob("*.parquet")
    return {str(f): f.stat().st_mtime_ns for f in found}


def rows_of(stored):
    return sorted(map(tuple, stored.read().collect()))


def test_changes_rewrite_the_buckets_they_touch(spark):
    root = work_folder(spark, "test-buckets")
    stored = BucketTable(spark, root, "id long, v string", "id", 32)
    assert rows_of(stored) == []
    stored.upsert(spark.range(1000).select("id", F.lit("old").alias("v")))
    before = files_of(root)
    updates = spark.createDataFrame([(i, "new") for i in (3, 500, 2000)], "id long, v string")
    touched = stored.upsert(updates)
    want = sorted([(i, "new" if i in (3, 500) else "old") for i in range(1000)] + [(2000, "new")])
    assert rows_of(stored) == want and 1 <= len(touched) <= 3
    after = files_of(root)
    assert {f for f in before if before[f] == after.get(f)} == {f for f in before if not any(f"_bucket={b}/" in f for b in touched)}
    assert stored.upsert(updates) == touched and rows_of(stored) == want  # run twice
    assert stored.upsert(updates.limit(0)) == [] and stored.delete(updates.select("id").limit(0)) == []
    stored.delete(updates)
    assert rows_of(stored) == [r for r in want if r[0] not in (3, 500, 2000)]
    small = BucketTable(spark, work_folder(spark, "test-buckets"), "id long, v string", "id", 4)
    small.upsert(updates)
    small.delete(updates)  # the buckets are empty, not as they were
    assert rows_of(small) == []


def test_posting_lists_find_what_a_scan_finds(spark):
    texts = [(i, t) for i, t in enumerate(["The quick brown fox", "quick", "QUICKLY brown", "fox the brown", "", None, "a b", "Ünïcode wörds", "ab"])]
    texts += [(100 + i, f"common words number {i}") for i in range(200)] + [(0, "a second text of the first key")]
    rows = spark.createDataFrame(texts, "k long, t string")
    index = PostingIndex(spark, work_folder(spark, "test-search"), 16)
    assert index.search("quick").collect() == []
    half = F.col("k") % 2 == 0
    for part, name in ((rows.where(half), "a"), (rows.where(~half), "b"), (rows.where(~half), "b")):
        index.append(part, "k", "t", name)
    for term in ("quick", "Brown", "brown fox", "the quick", "ÏCO", "common words", "number 17", "absent", "ab", "a", "second text of", "words number 3"):
        want = {k for k, t in texts if t is not None and term.lower() in t.lower()}
        assert {r.key for r in index.search(term).collect()} == want, term
    assert index.candidates("number 17").count() <= 11 and index.candidates("zzz").count() == 0
    assert {r.key for r in index.candidate_texts("number 177").collect()} == {277}
    plan = index.search("number 177")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan)  # folders without candidates are not read


def test_term_scores_by_hand(spark):
    texts = ["a b c", "A a a d", "b d d d d d", None, "", "x"]
    store = TermStore(spark, work_folder(spark, "test-terms"))
    assert store.totals() == (0, 0)
    for batch in ("1", "2", "2"):
        store.append(spark.createDataFrame([(t,) for t in (texts[:2] if batch == "1" else texts[2:])], "chunk string"), "chunk", batch)
    tokens = [(t or "").lower().split() for t in texts]
    n, df = 5, {w: sum(w in t for t in tokens) for w in "abcdx"}
    assert store.totals() == (n, 14) and {r.term: r.df for r in store.frequencies().collect()} == df

    def score(question, words):
        total = 0.0
        for w in sorted(set(question.lower().split())):
            if w in df:
                tf = words.count(w)
                total += math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / (14 / 5)))
        return round(total, 6)

    asked = {1: "A d", 2: "c c unknown", 3: "  "}
    rows = [(q, t, a) for q, a in asked.items() for t in texts]
    got = term_scores(spark.createDataFrame(rows, "question_id long, chunk string, question string"), store).collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.term_score - score(r.question, (r.chunk or "").lower().split())) < 1e-6


def test_fused_ranks_by_hand(spark):
    hits = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.8, 2), (2, 11, 0.7, 1), (2, 12, 0.6, 2), (3, 12, 0.5, 1)],
                                 "text_id long, chunk_id long, score double, rank int")
    rewrites = spark.createDataFrame([(7, 1), (7, 2), (8, 3), (9, 1), (9, 99)], "question_id long, text_id long")
    got = retrieval.fused_hits(hits, rewrites, 2).collect()
    assert sorted((r.question_id, r["rank"], r.chunk_id) for r in got) == [(7, 1, 11), (7, 2, 10), (8, 1, 12), (9, 1, 10), (9, 2, 11)]


def test_answers_are_remembered_once(spark):
    cache = AnswerCache(spark, work_folder(spark, "test-cache"), 4)
    assert cache.entries().count() == 0
    cache.remember(spark.createDataFrame([(2, "why", "b"), (1, "why", "a"), (3, "how", None)], "question_id long, question string, answer string"))
    assert [(r.question, r.answer) for r in cache.entries().collect()] == [("why", "a")]
    cache.remember(spark.createDataFrame([(9, "why", "c"), (3, "how", "d")], "question_id long, question string, answer string"))
    assert sorted((r.question, r.answer) for r in cache.entries().collect()) == [("how", "d"), ("why", "c")]


def test_a_bucket_that_would_not_fit_a_task_is_several_files(spark):
    rows = spark.range(4000).select(F.col("id").alias("k"), F.concat(F.lit("brand "), F.sha2(F.col("id").cast("string"), 256)).alias("t"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        index = PostingIndex(spark, work_folder(spark, "one-bucket"), 1)
        index.append(rows, "k", "t", "all")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(spark.read.parquet(f"{index.root}/postings").inputFiles()) > 1
    assert index.search("BRAND ").count() == 4000


def test_texts_are_not_joined_while_no_key_is_known(spark):
    store = DatasetStore(spark, work_folder(spark, "fresh-store"))
    docs = spark.createDataFrame([("a", "k1", 1, "x y"), ("a", "k2", 2, "z"), (None, "k3", 3, "n"), ("a", None, 4, "n")], DOCS)
    fresh = store.unknown_docs(docs)
    assert "Join" not in fresh._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.dockey for r in fresh.collect()) == ["k1", "k2"]
    store.append(docs.where("doc_id = 1"), lambda batch: chunk_documents(batch))
    assert [r.dockey for r in store.unknown_docs(docs).collect()] == ["k2"]
