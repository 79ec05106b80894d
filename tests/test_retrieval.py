import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from foliospark.functions.embedding import HashingEmbedder, embed
from foliospark.operators import cells as cells_module
from foliospark.operators import retrieval
from foliospark.operators.cells import build_cells, search_cells, skipped_share
from foliospark.operators.similarity import Rules, top_k_by_rule, top_k_similar
from foliospark.plans.answer import AnswerSettings, answer_questions


def by_hand(q, c, k, exclude_self=False, rule=None):
    out = []
    for qid, qv, qg in q:
        scored = []
        for cid, cv, cg in c:
            if (exclude_self and qid == cid) or (rule == "same" and qg != cg) or (rule == "other" and qg == cg):
                continue
            if not any(qv) or not any(cv):
                continue
            a, b = np.array(qv), np.array(cv)
            scored.append((-round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 6), cid))
        out += [(qid, cid, rank + 1) for rank, (_, cid) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def frames(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)], i % 3) for i in range(120)]
    rows += [(200 + i, rows[5][1], 5) for i in range(60)] + [(500, [0.0] * 4, 1)]  # hot copies and a zero vector
    return rows, spark.createDataFrame(rows, "id long, v array<double>, g int").repartition(5)


def test_search_forms_agree_with_brute_force(spark):
    rows, df = frames(spark)
    for options, args in (({}, ()), ({"exclude_self": True}, (True,)), ({"group": "g", "group_rule": "other"}, (False, "other")),
                          ({"group": "g", "group_rule": "same", "exclude_self": True}, (True, "same"))):
        want = by_hand(rows, rows, 3, *args)
        for size in ({}, {"broadcast_values": 40, "block_rows": 50}):
            got = top_k_similar(df, df, 3, question_id="id", doc_id="id", vector="v", **options, **size).collect()
            assert sorted((r.question_id, r.doc_id, r["rank"]) for r in got) == want


def clustered(spark, n, seed, first_id=0):
    rng = np.random.default_rng(seed)
    centres = np.random.default_rng(0).normal(size=(40, 8))
    rows = [(first_id + i, [float(x) for x in centres[rng.integers(40)] + rng.normal(size=8) / 20], int(i % 3)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, vector array<double>, grp long")


def test_cells_skip_what_cannot_win(spark):
    corpus, docs = clustered(spark, 3000, 1)
    asked, questions = clustered(spark, 1500, 2, 10_000)
    cells = build_cells(docs, block_rows=100)
    rules = [Rules(3), Rules(2, False, "other")]
    matches, visits = search_cells(questions, cells, rules)
    found = matches.collect()
    for number, rule in enumerate(rules):
        best = {}
        for r in found:
            if r.rule == number:
                best.setdefault(r.question_id, []).append((-r.score, r.doc_id))
        got = sorted((q, d, i + 1) for q, hits in best.items() for i, (_, d) in enumerate(sorted(hits)[:rule.k]))
        c = np.array([v for _, v, _ in corpus])
        c /= np.sqrt((c * c).sum(axis=1, keepdims=True))
        groups, want = np.array([g for _, _, g in corpus]), []
        for qid, v, g in asked:
            scores = np.round(c @ (np.array(v) / np.sqrt(np.array(v) @ np.array(v))), 6)
            if rule.group:
                scores[groups == g] = -9
            want += [(qid, int(d), i + 1) for i, d in enumerate(np.lexsort((np.arange(len(c)), -scores))[:rule.k])]
        assert got == sorted(want)
    assert skipped_share(visits, cells) > 0.6
    assert len(cells.used) > 30 and cells.parts.max() > 1
    plan = matches._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2  # questions by cell and by part, never the corpus


def test_a_question_travels_to_packs_and_not_to_cells(spark):
    """Where no cell can be skipped a question is sent as often as there are packs, of which there are two a core."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=24)], 0) for i in range(4000)]
    docs = spark.createDataFrame(rows, "id long, vector array<double>, grp long")
    cells = build_cells(docs)
    matches, visits = search_cells(docs.where("id < 100"), cells, [Rules(3, True)])
    packs = len(set(cells.pack[cells.used].tolist()))
    assert len(cells.used) > 50 and packs <= 4 * spark.sparkContext.defaultParallelism + 1
    assert skipped_share(visits, cells) < 0.5
    assert matches.count() <= 100 * 3 * packs
    unit = np.array([v for _, v, _ in rows])
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    found = matches.where("question_id = 7").collect()
    scores = np.round(unit @ unit[7], 6)
    scores[7] = -9
    best = np.lexsort((np.arange(4000), -scores))[:3].tolist()
    assert [r.doc_id for r in sorted(found, key=lambda r: (-r.score, r.doc_id))[:3]] == best


def test_two_rules_in_one_search(spark):
    rows, df = frames(spark)
    for size in ({}, {"broadcast_values": 40, "block_rows": 50}):
        got = top_k_by_rule(df, df, [Rules(2, True, "same"), Rules(4, True, "other")], question_id="id", doc_id="id", vector="v", group="g", **size).collect()
        for number, k, rule in ((0, 2, "same"), (1, 4, "other")):
            assert sorted((r.question_id, r.doc_id, r["rank"]) for r in got if r.rule == number) == by_hand(rows, rows, k, True, rule)


def test_no_questions(spark):
    _, df = frames(spark)
    assert top_k_similar(df, df.limit(0), 3, question_id="id", doc_id="id", vector="v", broadcast_values=4).count() == 0
    assert top_k_similar(df.limit(0), df, 3, question_id="id", doc_id="id", vector="v").count() == 0
    assert top_k_similar(df, df.limit(0), 3, question_id="id", doc_id="id", vector="v").count() == 0


def test_embedding_request_size_does_not_matter(spark):
    df = spark.createDataFrame([(i, "a b " * (i % 4) + f"w{i}") for i in range(25)] + [(99, None), (100, " ")], "id long, t string")
    whole = {r.id: r.v for r in df.select("id", embed(F.col("t")).alias("v")).collect()}
    small = {r.id: r.v for r in df.select("id", embed(F.col("t"), batch_size=10).alias("v")).collect()}
    assert whole == small
    assert whole[100] == [0.0] * 64 == whole[99]
    assert list(HashingEmbedder()(["a b a b w2"])[0]) == whole[2]


def test_cache_statuses(spark):
    cache = spark.createDataFrame([(1, "how to renew a plan"), (2, "how to renew a plan"), (3, "other words entirely here")],
                                  "cache_id long, question string")
    asked = spark.createDataFrame([(10, "how to renew a plan"), (11, "how to renew a plan"), (12, "zebra"), (13, "how to renew my plan")],
                                  "question_id long, question string")
    got = {r.question_id: r for r in retrieval.question_cache(asked, cache, threshold=0.99, suggestion_threshold=0.5).collect()}
    assert got[10].status == got[11].status == "hit" and got[10].cache_id == 1
    assert got[12].status == "miss" and got[12].suggestions == []
    assert got[13].status == "suggest" and got[13].suggestions == [1] and got[13].cache_id is None


def test_answering_skips_cached_questions_and_keeps_unanswered_ones(spark):
    chunks = spark.createDataFrame([(1, "alpha beta gamma", None, "delta"), (2, "delta", "alpha beta gamma", None)],
                                   "chunk_id long, chunk string, prev string, next string").withColumn("name", F.lit("doc"))
    asked = spark.createDataFrame([(1, "alpha beta"), (2, "alpha beta gamma delta"), (3, " ")], "question_id long, question string")
    cache = spark.createDataFrame([(7, "alpha beta")], "cache_id long, question string")
    got = {r.question_id: r for r in answer_questions(asked, chunks, cache, AnswerSettings(max_tokens=4)).collect()}
    assert got[1].status == "hit" and got[1].cache_id == 7 and got[1].prompt is None
    assert got[2].context == "alpha beta gamma delta" and got[2].references == "doc"
    assert got[3].context is None and "Question:  " in got[3].prompt


def test_a_task_is_dealt_one_part_and_one_slice_of_the_questions(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(600)]
    table = spark.createDataFrame(rows, "id long, vector array<double>, grp long").repartition(3)
    held = {}
    dealt = cells_module._dealt

    def watched(*args):
        out = dealt(*args)
        held.setdefault("tasks", []).append(out.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count_distinct("pack", "part").alias("parts"), F.count_if(F.col("side") == 1).alias("asked")).collect())
        return out

    monkeypatch.setattr(cells_module, "_dealt", watched)
    monkeypatch.setattr(cells_module, "SLICE_VALUES", 100 * 8)
    found = search_cells(table, build_cells(table, block_rows=100), [Rules(3, True)])[0]
    best = top_k_by_rule(table, table, [Rules(3, True)], question_id="id", doc_id="id")
    assert len(held["tasks"]) == 2
    assert all(t.parts == 1 and t.asked <= 150 for tasks in held["tasks"] for t in tasks)
    order = Window.partitionBy("question_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where("rank <= 3").select("question_id", "doc_id", "rank")
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, best.select("question_id", "doc_id", "rank").collect()))
