"""Named queries: counts, ground truth, evaluation metrics and run tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants, embedding, keys
from ..operators import chunking, evaluation, joins, retrieval
from ..operators.containment import passages_in_texts
from ..operators.ordering import with_position
from ..session import spread, table
from ..sources import datasets
from .registry import query
from .retrieval_queries import SQL_RETRIEVED, _SQL_VECTORS, question_table, reranked, sql_chunk_id, sql_embed, stored_neighbours
from .scalars_queries import SQL_JUDGED, judge_replies
from .splitting_queries import SQL_HASH, sql_chunks


@query("agg1_object_counts", "SELECT source, lang, count(*) AS n_objects FROM documents GROUP BY 1, 2")
def object_counts(spark, sf):
    return table(spark, sf, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_objects"))


@query("agg2_class_names", """
SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN 'D' || source || 'other' ELSE source END AS dataset,
       CASE doc_id % 3 WHEN 0 THEN 'Documents' WHEN 1 THEN 'Chunks' ELSE 'unknown' END AS class_type FROM documents""")
def class_names(spark, sf):
    suffix = F.when(F.col("doc_id") % 3 == 0, "docs").when(F.col("doc_id") % 3 == 1, "chunks").otherwise("other")
    names = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("D"), "source", suffix).alias("class_name"))
    return datasets.parse_class_name(names).select("doc_id", "dataset", "class_type")


@query("agg4_question_seeds", f"""
WITH {sql_chunks(256, 0)}, ck AS (SELECT {sql_chunk_id('doc_id', 'chunk_no')} AS chunk_id, chunk FROM chunks),
p AS (SELECT * FROM ck ORDER BY {SQL_HASH.format("chunk_id || ':3'")}, chunk_id LIMIT 10)
SELECT chunk_id, CAST(unnest([1, 2]) AS INTEGER) AS question_no, regexp_extract(chunk, '(?s)^(.*?[.!?])', 1) AS lead FROM p""")
def question_seeds(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    chunks = chunking.split_tokens(docs, "text", 256, adjacent=False).select(
        keys.chunk_id(F.col("doc_id"), F.col("chunk_no")).alias("chunk_id"), "chunk")
    return evaluation.question_seeds(chunks, "chunk_id", "chunk", max_chunks=10, per_chunk=2, seed=3)


def query_log(spark, sf):
    """Events as a query log: state from the properties, feedback on purchases and errors."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", F.concat(F.lit("S"), (k % 4).cast("string")).alias("state"),
        F.when(F.col("event_type") == "purchase", "positive").when(F.col("event_type") == "error", "negative").alias("feedback"))


_SQL_LOG = """
log AS (SELECT event_id, ts, user_id, 'S' || (CAST(json_extract(props, '$.k') AS INTEGER) % 4) AS state,
               CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative' END AS feedback FROM events)"""
_DEVELOPERS = [(3,), (7,), (11,)]


def _developers(spark):
    return constants.values_frame(spark, ["user_id"], _DEVELOPERS).select(F.col("user_id").cast("long").alias("user_id"))


@query("agg5_ground_truth_log", f"""
WITH {_SQL_LOG}
SELECT event_id, user_id, state, feedback FROM log
WHERE ts >= '2024-01-05' AND ts < '2024-01-26' AND feedback IS NOT NULL AND user_id NOT IN (3, 7, 11)""")
def ground_truth_log(spark, sf):
    return evaluation.extract_ground_truth(
        query_log(spark, sf), date_start="2024-01-05", date_end="2024-01-25", developers=_developers(spark)
    ).select("event_id", "user_id", "state", "feedback")


@query("agg5_ground_truth_first_rows", f"""
WITH {_SQL_LOG}
SELECT event_id, user_id, state, feedback FROM log
WHERE ts >= '2024-01-05' AND ts < '2024-01-26' AND state = 'S1' ORDER BY ts, event_id LIMIT 5""")
def ground_truth_first_rows(spark, sf):
    return evaluation.extract_ground_truth(
        query_log(spark, sf), date_start="2024-01-05", date_end="2024-01-25", state="S1", extract_all=True, no_of_rows=5
    ).select("event_id", "user_id", "state", "feedback")


@query("jn5_exclude_users", "SELECT event_id, user_id FROM events WHERE user_id NOT IN (3, 7, 11)")
def exclude_users(spark, sf):
    return joins.exclude_users(table(spark, sf, "events").select("event_id", "user_id"), _developers(spark), "user_id")


_SQL_LABEL_RANKS = f"""
WITH {_SQL_VECTORS},
f AS (SELECT question_id, min(CASE WHEN q_label = d_label THEN rank END) AS first_rank FROM ranked WHERE rank <= 3 GROUP BY 1)"""


def _label_ranks(spark, sf):
    """Rank of the first neighbour with the question's own label."""
    labels = table(spark, sf, "embeddings").select("vec_id", "label")
    hits = (stored_neighbours(spark, sf, 3)
            .join(labels.withColumnsRenamed({"vec_id": "question_id", "label": "q_label"}), "question_id")
            .join(labels.withColumnsRenamed({"vec_id": "doc_id", "label": "d_label"}), "doc_id"))
    return hits.groupBy("question_id").agg(F.min(F.when(F.col("q_label") == F.col("d_label"), F.col("rank"))).alias("first_rank"))


@query("evl1_hit_rate", f"""{_SQL_LABEL_RANKS}
SELECT count(*) AS n_questions, round(avg(CASE WHEN first_rank IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS hit_rate FROM f""")
def hit_rate(spark, sf):
    return evaluation.retrieval_metrics(_label_ranks(spark, sf)).select("n_questions", "hit_rate")


@query("evl2_mean_reciprocal_rank", f"""{_SQL_LABEL_RANKS}
SELECT count(*) AS n_questions, round(avg(coalesce(1.0 / first_rank, 0.0)), 6) AS mrr FROM f""")
def mean_reciprocal_rank(spark, sf):
    return evaluation.retrieval_metrics(_label_ranks(spark, sf)).select("n_questions", "mrr")


def truth_table(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return passages_in_texts(question_table(spark, sf), docs, "question_id", "question", "doc_id", "text")


@query("jn10_retrieved_truth", f"""WITH {SQL_RETRIEVED}
SELECT r.question_id, r.doc_id, min(new_rank) AS rank FROM reranked r JOIN documents d ON d.doc_id = r.doc_id
WHERE contains(d.text, r.question) GROUP BY 1, 2""")
def retrieved_truth(spark, sf):
    hits = reranked(spark, sf).groupBy("question_id", "doc_id").agg(F.min("new_rank").alias("rank"))
    return hits.join(truth_table(spark, sf), ["question_id", "doc_id"])


@query("evl1_text_retrieval_metrics", f"""WITH {SQL_RETRIEVED},
truth AS (SELECT b.item_id AS question_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
f AS (SELECT t.question_id, min(r.new_rank) AS first_rank FROM truth t LEFT JOIN reranked r USING (question_id, doc_id) GROUP BY 1)
SELECT count(*) AS n_questions, round(avg(CASE WHEN first_rank IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
       round(avg(coalesce(1.0 / first_rank, 0.0)), 6) AS mrr FROM f""")
def text_retrieval_metrics(spark, sf):
    return evaluation.retrieval_metrics(evaluation.first_relevant(reranked(spark, sf), truth_table(spark, sf), "new_rank"))


def answer_pairs(spark, sf):
    """Assistant replies with the user turn before them as the text to compare with."""
    placed = with_position(table(spark, sf, "conversations"), "conv_id", "turn")
    user = placed.where(F.col("role") == "user").select("conv_id", "turn", "position", F.col("text").alias("reference"))
    reply = placed.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("position") - 1).alias("position"), F.col("text").alias("answer"))
    return reply.join(user, ["conv_id", "position"]).withColumn("run_id", F.col("conv_id") % 4)


_SQL_PAIRS = f"""
WITH n AS (SELECT *, lag(role) OVER w AS before, lag(turn) OVER w AS user_turn, lag(text) OVER w AS reference
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (SELECT conv_id * 1000 + user_turn AS pair_id, conv_id % 4 AS run_id, turn, text AS answer, reference
      FROM n WHERE role = 'assistant' AND before = 'user'),
{sql_embed('a', 'p', 'pair_id', 'answer')}, {sql_embed('r', 'p', 'pair_id', 'reference')},
d AS (SELECT a.id, sum(a.v * r.v) AS dot FROM a JOIN r ON a.id = r.id AND a.slot = r.slot GROUP BY 1),
c AS (SELECT p.run_id, p.turn, round(coalesce(dot, 0) / (an.norm * rn.norm), 6) AS score FROM p LEFT JOIN a_norm an ON an.id = pair_id
      LEFT JOIN r_norm rn ON rn.id = pair_id LEFT JOIN d ON d.id = pair_id)"""


@query("evl3_semantic_similarity", f"""{_SQL_PAIRS}
SELECT run_id, round(avg(score), 6) AS similarity, count(*) AS n_answers FROM c GROUP BY 1""")
def semantic_similarity(spark, sf):
    return evaluation.semantic_similarity(answer_pairs(spark, sf), embedding.embed, ["run_id"])


@query("udx5_both_evaluators", f"""{_SQL_PAIRS}
SELECT run_id, round(avg(score), 6) AS similarity, count(*) AS n_answers,
       round(avg(CASE WHEN turn % 11 >= 1 THEN turn % 11 END), 6) AS correctness, count(*) FILTER (turn % 11 = 0) AS n_unscored
FROM c GROUP BY 1""")
def both_evaluators(spark, sf):
    # answer_pairs keeps the turn of the user message; the reply is the next turn in these conversations.
    judged = answer_pairs(spark, sf).withColumn("judge_output", F.concat(F.lit("Score: "), ((F.col("turn") + 1) % 11).cast("string")))
    return evaluation.evaluate(judged, ["semantic_similarity", "correctness"], ["run_id"])


@query("evl4_correctness", f"""
SELECT source, round(avg(score), 6) AS correctness, count(*) FILTER (score IS NULL) AS n_unscored FROM ({SQL_JUDGED}) GROUP BY 1""")
def correctness(spark, sf):
    return evaluation.evaluate(judge_replies(spark, sf), ["correctness"], ["source"])


@query("evl5_regression_metrics", """
WITH p AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 2500 * (1 - l_discount) AS f FROM lineitem),
m AS (SELECT l_returnflag, avg(y) AS mean FROM p GROUP BY 1)
SELECT l_returnflag, round(sqrt(avg((y - f) * (y - f))), 6) AS rmse, round(avg(abs(y - f)), 6) AS mae,
       round(1 - sum((y - f) * (y - f)) / sum((y - mean) * (y - mean)), 6) AS r2
FROM p JOIN m USING (l_returnflag) GROUP BY 1""")
def regression_metrics(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("y"), (
        F.col("l_quantity") * 2500 * (1 - F.col("l_discount"))).alias("f"))
    return evaluation.regression_metrics(rows, "y", "f", ["l_returnflag"])


_SQL_SCORED = """
s AS (SELECT quality, CASE WHEN n_chars > 900 THEN 1 ELSE 0 END AS pred, n_chars / (n_chars + 1000.0::DOUBLE) AS score
      FROM labels JOIN documents USING (doc_id))"""


def scored_labels(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") > 900, 1).otherwise(0).alias("pred"), (
        F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("score"))
    return table(spark, sf, "labels").select("doc_id", "quality").join(docs, "doc_id")


@query("evl6_class_report", f"""
WITH {_SQL_SCORED}, c AS (SELECT DISTINCT quality AS label FROM s UNION SELECT DISTINCT pred FROM s),
n AS (SELECT label, count(*) FILTER (quality = label AND pred = label) AS hits, count(*) FILTER (quality = label) AS support,
             count(*) FILTER (pred = label) AS claimed FROM s, c GROUP BY 1)
SELECT label, round(CASE WHEN claimed = 0 THEN 0 ELSE hits / claimed END, 6) AS precision,
       round(CASE WHEN support = 0 THEN 0 ELSE hits / support END, 6) AS recall,
       round(CASE WHEN support + claimed = 0 THEN 0 ELSE 2 * hits / (support + claimed) END, 6) AS f1, support FROM n""")
def class_report(spark, sf):
    return evaluation.class_report(scored_labels(spark, sf), "quality", "pred")


@query("evl6_binary_summary", f"""
WITH {_SQL_SCORED}, n AS (SELECT count(*) FILTER (quality = 1 AND pred = 1) AS true_positive, count(*) FILTER (quality <> 1 AND pred <> 1) AS true_negative,
 count(*) FILTER (quality <> 1 AND pred = 1) AS false_positive, count(*) FILTER (quality = 1 AND pred <> 1) AS false_negative, count(*) AS n FROM s)
SELECT true_positive, true_negative, false_positive, false_negative, round((true_positive + true_negative) / n, 6) AS accuracy,
       round(true_positive / (true_positive + false_positive), 6) AS precision FROM n""")
def binary_summary(spark, sf):
    return evaluation.binary_summary(scored_labels(spark, sf), "quality", "pred")


@query("evl7_confusion_matrix", f"""
WITH {_SQL_SCORED}, c AS (SELECT quality AS true_label, pred AS predicted_label, count(*) AS n FROM s GROUP BY 1, 2)
SELECT true_label, predicted_label, n, round(n / sum(n) OVER (PARTITION BY true_label), 6) AS share FROM c""")
def confusion_matrix(spark, sf):
    return evaluation.normalised_confusion(scored_labels(spark, sf), "quality", "pred")


@query("evl8_roc_points", f"""
WITH {_SQL_SCORED}, g AS (SELECT score AS threshold, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality <> 1) AS n FROM s GROUP BY 1)
SELECT threshold, round(sum(n) OVER w / sum(n) OVER (), 6) AS fpr, round(sum(p) OVER w / sum(p) OVER (), 6) AS tpr
FROM g WINDOW w AS (ORDER BY threshold DESC) UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE""")
def roc_points(spark, sf):
    return evaluation.roc_points(scored_labels(spark, sf), "quality", "score")


_SQL_AUC = """
SELECT round(sum(CASE WHEN a.{0} > b.{0} THEN 1.0 WHEN a.{0} = b.{0} THEN 0.5 ELSE 0.0 END) / count(*), 6)::DOUBLE AS auc
FROM s a JOIN s b ON a.quality = 1 AND b.quality <> 1"""


@query("evl8_roc_auc", f"WITH {_SQL_SCORED} {_SQL_AUC.format('score')}")
def roc_auc(spark, sf):
    return evaluation.roc_auc(scored_labels(spark, sf), "quality", "score")


@query("evl8_roc_auc_hard_labels", f"WITH {_SQL_SCORED} {_SQL_AUC.format('pred')}")
def roc_auc_hard_labels(spark, sf):
    return evaluation.roc_auc(scored_labels(spark, sf), "quality", "pred")


@query("evl10_epoch_averages", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS epoch, round(avg(value), 6) AS loss, round(100 * avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM events GROUP BY 1""")
def epoch_averages(spark, sf):
    return evaluation.epoch_averages(table(spark, sf, "events"), F.col("ts").cast("date").cast("string"), "value", F.col("event_type") != "error")


@query("agg6_best_trial", """
SELECT user_id, min(event_id) AS event_id, value FROM events JOIN (SELECT user_id, max(value) AS value FROM events GROUP BY 1) USING (user_id, value)
GROUP BY user_id, value""")
def best_trial(spark, sf):
    return evaluation.best_trial(table(spark, sf, "events"), "value", "event_id", ["user_id"])


@query("agg6_lowest_loss", "SELECT event_id, value FROM events ORDER BY value, event_id LIMIT 1")
def lowest_loss(spark, sf):
    return evaluation.best_trial(table(spark, sf, "events"), "value", "event_id", largest=False)


@query("agg7_child_runs", """
WITH runs AS (SELECT event_id AS run_id, event_id // 10 AS parent_id, event_type AS name, json_extract_string(props, '$.k') AS k FROM events)
SELECT c.run_id, c.parent_id, c.name FROM runs c WHERE c.parent_id IN (SELECT run_id FROM runs WHERE k = '69')""")
def child_runs(spark, sf):
    runs = table(spark, sf, "events").select(
        F.col("event_id").alias("run_id"), F.floor(F.col("event_id") / 10).alias("parent_id"), F.col("event_type").alias("name"),
        F.from_json("props", "map<string,string>").alias("tags"))
    return evaluation.child_runs(evaluation.runs_with_tag(runs, "k", "69"), runs).select("run_id", "parent_id", "name")


@query("agg8_feedback_summary", """
WITH f AS (SELECT event_id, CASE WHEN event_type IN ('purchase', 'click') THEN 'positive' ELSE 'negative' END AS feedback FROM events),
l AS (SELECT feedback, 'comment' AS label FROM f WHERE event_id % 2 = 0
      UNION ALL SELECT feedback, 'This is harmful / unsafe' FROM f WHERE event_id % 3 = 0
      UNION ALL SELECT feedback, 'This isn''t true' FROM f WHERE event_id % 4 = 1
      UNION ALL SELECT feedback, 'This isn''t helpful' FROM f WHERE event_id % 5 = 2)
SELECT label, feedback, count(*) AS n FROM l GROUP BY 1, 2""")
def feedback_summary(spark, sf):
    e = F.col("event_id")
    numbers = F.filter(F.array(F.when(e % 3 == 0, 1), F.when(e % 4 == 1, 2), F.when(e % 5 == 2, 3)), lambda x: x.isNotNull())
    rows = table(spark, sf, "events").select(
        F.when(F.col("event_type").isin("purchase", "click"), "positive").otherwise("negative").alias("feedback"),
        evaluation.feedback_message(F.when(e % 2 == 0, "thanks"), numbers).alias("message"))
    return evaluation.feedback_summary(rows)
