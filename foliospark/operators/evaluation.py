"""Retrieval, answer, regression and classification metrics; run search and feedback summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import FEEDBACK_REASONS
from ..functions.embedding import embed
from ..functions.generate import explode_rows
from ..functions.keys import stable_hash
from ..functions.text import judge_score
from ..functions.vectors import cosine
from .ordering import running_totals


def first_relevant(retrieved: DataFrame, truth: DataFrame, rank: str = "rank") -> DataFrame:
    """Rank of the first relevant document per question of the ground truth, null when none was found."""
    wanted = truth.select("question_id", "doc_id").join(
        retrieved.select("question_id", "doc_id", F.col(rank).alias("_rank")), ["question_id", "doc_id"], "left")
    return wanted.groupBy("question_id").agg(F.min("_rank").alias("first_rank"))


def retrieval_metrics(ranks: DataFrame) -> DataFrame:
    """Hit rate and mean reciprocal rank; a question without a hit counts 0."""
    return ranks.agg(F.count(F.lit(1)).alias("n_questions"),
                     F.round(F.avg(F.when(F.col("first_rank").isNotNull(), 1.0).otherwise(0.0)), 6).alias("hit_rate"),
                     F.round(F.avg(F.coalesce(1 / F.col("first_rank"), F.lit(0.0))), 6).alias("mrr"))


def semantic_similarity(answers: DataFrame, embedder: Callable[[Column], Column], group: list[str]) -> DataFrame:
    """Mean cosine between answer and reference per run."""
    vectors = answers.select(*group, embedder(F.col("answer")).alias("a"), embedder(F.col("reference")).alias("r"))
    return vectors.groupBy(*group).agg(F.round(F.avg(cosine(F.col("a"), F.col("r"))), 6).alias("similarity"),
                                       F.count(F.lit(1)).alias("n_answers"))


def correctness(answers: DataFrame, group: list[str], output: str = "judge_output",
                parse: Callable[[Column], Column] = judge_score) -> DataFrame:
    """Mean judge score per run and the number of replies without a usable score."""
    return answers.withColumn("_s", parse(F.col(output))).groupBy(*group).agg(
        F.round(F.avg("_s"), 6).alias("correctness"), F.count_if(F.col("_s").isNull()).alias("n_unscored"))


# Evaluators by name: (answers, group) -> metric columns per group. Users add their own.
EVALUATORS: dict[str, Callable[[DataFrame, list[str]], DataFrame]] = {
    "correctness": correctness,
    "semantic_similarity": lambda answers, group: semantic_similarity(answers, embed, group),
}


def register_evaluator(name: str, evaluator: Callable[[DataFrame, list[str]], DataFrame]) -> None:
    EVALUATORS[name] = evaluator


def evaluate(answers: DataFrame, names: list[str], group: list[str]) -> DataFrame:
    """Run the named evaluators and join their metrics per group."""
    frames = [EVALUATORS[name](answers, group) for name in names]
    out = frames[0]
    for frame in frames[1:]:
        out = out.join(frame, group, "full")
    return out


def regression_metrics(df: DataFrame, actual: str, predicted: str, group: list[str] = ()) -> DataFrame:
    """RMSE, MAE and R² in one pass; R² is null for a constant target."""
    error = F.col(actual) - F.col(predicted)
    sums = df.groupBy(*group).agg(
        F.avg(error * error).alias("_mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(actual).alias("_var"))
    return sums.select(*group, F.round(F.sqrt("_mse"), 6).alias("rmse"), F.round("mae", 6).alias("mae"),
                       F.round(1 - F.try_divide(F.col("_mse"), F.col("_var")), 6).alias("r2"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts per (true, predicted) label present in the data."""
    return df.groupBy(F.col(truth).alias("true_label"), F.col(predicted).alias("predicted_label")).agg(
        F.count(F.lit(1)).alias("n"))


def normalised_confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Confusion counts with their share of the true label's row (one row per label pair)."""
    row = Window.partitionBy("true_label")
    return confusion(df, truth, predicted).withColumn("share", F.round(F.col("n") / F.sum("n").over(row), 6))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 per class; a zero denominator gives 0."""
    cells = confusion(df, truth, predicted)
    side = F.explode(F.array(F.struct(F.col("true_label").alias("label"), F.lit(True).alias("is_true")),
                             F.struct(F.col("predicted_label").alias("label"), F.lit(False).alias("is_true"))))
    rows = cells.withColumn("s", side).select("s.*", "n", (F.col("true_label") == F.col("predicted_label")).alias("ok"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    sums = rows.groupBy("label").agg(
        F.sum(F.when(F.col("is_true") & F.col("ok"), F.col("n")).otherwise(0)).alias("hits"),
        F.sum(F.when(F.col("is_true"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_true"), F.col("n")).otherwise(0)).alias("claimed"))
    precision = zero(F.try_divide(F.col("hits"), F.col("claimed")))
    recall = zero(F.try_divide(F.col("hits"), F.col("support")))
    f1 = zero(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("claimed")))
    return sums.select("label", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"),
                       F.round(f1, 6).alias("f1"), "support")


def binary_summary(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy, precision and the four cells with class 1 as the positive class."""
    y, p = F.col(truth) == 1, F.col(predicted) == 1
    cells = df.agg(F.count_if(y & p).alias("true_positive"), F.count_if(~y & ~p).alias("true_negative"),
                   F.count_if(~y & p).alias("false_positive"), F.count_if(y & ~p).alias("false_negative"))
    good, claimed = F.col("true_positive") + F.col("true_negative"), F.col("true_positive") + F.col("false_positive")
    total = good + F.col("false_positive") + F.col("false_negative")
    return cells.withColumns({
        "accuracy": F.round(F.try_divide(good, total), 6),
        "precision": F.round(F.coalesce(F.try_divide(F.col("true_positive"), claimed), F.lit(0.0)), 6)})


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives at or above each distinct score; equal scores are one point."""
    counts = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    return running_totals(counts.withColumn("_key", -F.col("threshold")), "_key", {"tp": "_pos", "fp": "_neg"})


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC curve: false and true positive rate at each distinct score, from the highest down.

    The curve starts at (0, 0) with an infinite threshold.
    """
    p, n = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) != 1)).first()
    points = _score_counts(df, label, score).select(
        F.col("threshold").cast("double").alias("threshold"), F.round(F.try_divide(F.col("fp"), F.lit(n)), 6).alias("fpr"),
        F.round(F.try_divide(F.col("tp"), F.lit(p)), 6).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by trapezoids; works for hard labels too. Null when a class is missing."""
    points = _score_counts(df, label, score)
    area = F.sum(F.col("_neg") * (2 * F.col("tp") - F.col("_pos")))
    pairs = F.sum("_neg") * F.sum("_pos") * 2
    return points.agg(F.round(F.try_divide(area, pairs), 6).alias("auc"))


def epoch_averages(df: DataFrame, epoch: Column, loss: str, correct: Column) -> DataFrame:
    return df.groupBy(epoch.alias("epoch")).agg(F.round(F.avg(loss), 6).alias("loss"), F.round(
        100 * F.avg(F.when(correct, 1.0).otherwise(0.0)), 6).alias("accuracy"))


def best_trial(trials: DataFrame, score: str, order: str, group: list[str] = (), *, largest: bool = True) -> DataFrame:
    """Trial with the best score; the earliest wins a tie. Partial results meet, not rows."""
    sign = F.col(score) if largest else -F.col(score)
    return trials.groupBy(*group).agg(F.max(F.struct(sign.alias("s"), (-F.col(order)).alias("o"))).alias("b")).select(
        *group, (-F.col("b.o")).alias(order), (F.col("b.s") if largest else -F.col("b.s")).alias(score))


def runs_with_tag(runs: DataFrame, key: str, value: str, tags: str = "tags") -> DataFrame:
    return runs.where(F.try_element_at(F.col(tags), F.lit(key)) == value)


def child_runs(parents: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs whose parent is one of the given runs."""
    return runs.join(parents.select(F.col("run_id").alias("parent_id")), "parent_id", "left_semi")


def feedback_message(comment: Column, reason_numbers: Column) -> Column:
    """Free text on its own line, then the label of every ticked reason (1-based numbers)."""
    labels = F.filter(F.transform(reason_numbers, lambda i: F.get(F.lit(FEEDBACK_REASONS), i - 1)), lambda x: x.isNotNull())
    return F.concat(F.when(F.coalesce(comment, F.lit("")) != "", F.concat(comment, F.lit("\n"))).otherwise(""),
                    F.array_join(labels, "\n"))


def feedback_summary(feedback: DataFrame) -> DataFrame:
    """How often each reason was given with positive and negative feedback; other lines count as comments."""
    lines = explode_rows(feedback, ["feedback"], F.split("message", "\n"), "line").where(F.col("line") != "")
    label = F.when(F.col("line").isin(FEEDBACK_REASONS), F.col("line")).otherwise("comment")
    return lines.groupBy(label.alias("label"), "feedback").agg(F.count(F.lit(1)).alias("n"))


def question_seeds(chunks: DataFrame, key: str, text: str, *, max_chunks: int = 10, per_chunk: int = 1, seed: int = 0) -> DataFrame:
    """Chunks picked by hash for question writing, one row per question to write, with the leading sentence."""
    picked = chunks.withColumn("_h", stable_hash(seed, F.col(key))).orderBy("_h", key).limit(max_chunks)
    return picked.select(key, F.explode(F.sequence(F.lit(1), F.lit(per_chunk))).alias("question_no"),
                         F.regexp_extract(text, r"(?s)^(.*?[.!?])", 1).alias("lead"))


def extract_ground_truth(log: DataFrame, *, date_start: str, date_end: str, state: str | None = None,
                         filter_user=None, no_of_rows: int | None = None, extract_all: bool = False,
                         developers: DataFrame | None = None) -> DataFrame:
    """Rows of a query log (ts, event_id, user_id, state, feedback, ...) for a ground truth.

    Both dates are inclusive. Filters on ts and user reach the scan. Without ``extract_all`` only
    rows with feedback stay. The limit is a distributed top-n by (ts, event_id).
    """
    rows = log.where((F.col("ts") >= F.lit(date_start).cast("timestamp_ntz")) &
                     (F.col("ts") < F.date_add(F.lit(date_end).cast("date"), 1).cast("timestamp_ntz")))
    if state:
        rows = rows.where(F.col("state") == state)
    if filter_user not in (None, ""):
        rows = rows.where(F.col("user_id") == filter_user)
    if not extract_all:
        rows = rows.where(F.col("feedback").isNotNull())
    if developers is not None:
        rows = rows.join(developers, "user_id", "left_anti")
    return rows if no_of_rows is None else rows.orderBy("ts", "event_id").limit(no_of_rows)
