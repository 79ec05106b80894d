"""The evaluation job: retrieval metrics and every configured evaluator of one run, as one metrics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluation
from ..sources.datasets import append_metrics


def evaluation_run(run_id: int, ranked: DataFrame, truths: Sequence[DataFrame], answers: DataFrame,
                   evaluators: Sequence[str] = ("semantic_similarity", "correctness"), folder: str | None = None) -> DataFrame:
    """(run_id, metric, value): hit rate and reciprocal rank against all ground truths, and each evaluator over the answers.

    ``truths`` are tables (question_id, doc_id), say generated and logged ones; pairs in several of them count once.
    """
    truth = truths[0].select("question_id", "doc_id")
    for more in truths[1:]:
        truth = truth.unionByName(more.select("question_id", "doc_id"))
    retrieval = evaluation.retrieval_metrics(evaluation.first_relevant(ranked, truth.distinct(), "new_rank"))
    judged = evaluation.evaluate(answers.withColumn("run_id", F.lit(run_id)), list(evaluators), ["run_id"])
    return append_metrics(retrieval.withColumn("run_id", F.lit(run_id)), ["run_id"], folder).unionByName(append_metrics(judged, ["run_id"], folder))
