"""Named queries of the numbered operators that fit models or join similar documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from .jaccard_join import jaccard_components
from .kneser_ney import scored_with_threshold
from .pitman_yor import hpy_scores
from .registry import query


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_pitman_yor")
def op1(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    return hpy_scores(docs, held_out).select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens",
                                             "base_score", "score", "perplexity")


@query("op3_jaccard_join")
def op3(spark, folder):
    return jaccard_components(table(spark, folder, "documents"))


@query("op9_kneser_ney")
def op9(spark, folder):
    judged = scored_with_threshold(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(judged.id.alias("doc_id"), "lang", "n_words", "n_events", "log_prob", "perplexity", "threshold", "kept")
