"""Lookups against tables and dictionaries. Broadcast is left to Spark's own size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import CLASS_NAMES
from ..functions.generate import explode_rows, inline_rows

REWRITE = "array<struct<question:string,`group`:string,topic:string,similarity_score:string>>"


def rewritten_questions(replies: DataFrame, reply: str, confidence_threshold: int = 1) -> DataFrame:
    """Questions of JSON replies scored at or above the threshold; ``n/a`` and malformed replies are dropped."""
    rows = inline_rows(replies, ["question_id"], F.from_json(reply, REWRITE), "question")
    score = F.col("similarity_score").try_cast("int")
    return rows.withColumn("similarity_score", score).where(
        (F.col("similarity_score") >= confidence_threshold) & (F.lower("question") != "n/a"))


def rewrite_report(replies: DataFrame, reply: str) -> DataFrame:
    parsed = replies.select(F.from_json(reply, REWRITE).alias("p"), F.col(reply).alias("r"))
    bad = F.col("p").isNull() | (F.get(F.col("p"), 0)["question"].isNull() & (F.size("p") > 0))
    return parsed.agg(F.count(F.lit(1)).alias("n_replies"), F.count_if(bad).alias("n_malformed"),
                      F.count_if(F.size("p") == 0).alias("n_empty"))


def expand_from_table(df: DataFrame, key: str, text: str, dictionary: DataFrame) -> DataFrame:
    """Replace tokens found in a dictionary table (acronym, full_form).

    Only the distinct tokens a text shares with the dictionary are regrouped, as a small map per text;
    ``key`` identifies one text, so a map is never larger than that text. Of several forms of one
    acronym the smallest counts.
    """
    dictionary = dictionary.groupBy("acronym").agg(F.min("full_form").alias("full_form"))
    words = explode_rows(df, [key], F.array_distinct(F.split(text, " ")), "acronym")
    found = words.join(dictionary, "acronym").groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("acronym", "full_form"))).alias("_forms"))
    replaced = F.array_join(F.transform(F.split(text, " "), lambda t: F.coalesce(F.try_element_at("_forms", t), t)), " ")
    return df.join(found, key, "left").withColumn(text, F.coalesce(replaced, F.col(text))).drop("_forms")


def over_length(texts: DataFrame, models: DataFrame, n_chars: str) -> DataFrame:
    """Texts longer than their model allows."""
    return texts.join(models, "model_id").where(F.col(n_chars) > F.col("max_length"))


def class_name(index: Column, names: list[str] = CLASS_NAMES, default: str = "Not found") -> Column:
    lookup = F.lit(list(names))
    return F.coalesce(F.when(index >= 0, F.get(lookup, index)), F.lit(default))


def lookup_by_id(ids: DataFrame, rows: DataFrame, key: str, text: str) -> DataFrame:
    """Rows for the requested ids; a row without text yields an empty string."""
    return ids.join(rows, key).withColumn(text, F.coalesce(text, F.lit("")))


def missing_ids(ids: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Requested ids that do not exist."""
    return ids.select(key).distinct().join(rows.select(key), key, "left_anti")


def chunks_with_documents(chunks: DataFrame, docs: DataFrame) -> DataFrame:
    return chunks.join(docs, chunks["doc"] == docs["dockey"])


def exclude_users(log: DataFrame, users: DataFrame, key: str) -> DataFrame:
    return log.join(users, key, "left_anti")


def known_models(requested: DataFrame, models: DataFrame, key: str) -> DataFrame:
    """Requested models that are in the fixed list, with their display name."""
    return requested.join(models, key)


def attach_feedback(messages: DataFrame, feedback: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest feedback of each message id replaces the message's own; unknown ids change nothing."""
    latest = feedback.groupBy(*keys).agg(F.max_by("feedback", F.struct(*order)).alias("_new"))
    return messages.join(latest, keys, "left").withColumn(
        "feedback", F.coalesce("_new", "feedback")).drop("_new")


def drop_dangling(items: DataFrame, folders: DataFrame, folder_key: str, key: str) -> DataFrame:
    """Set the folder of an item to null when that folder no longer exists."""
    known = folders.select(F.col(key).alias("_known")).distinct()
    return items.join(known, F.col(folder_key) == F.col("_known"), "left").withColumn(
        folder_key, F.col("_known")).drop("_known")


def filed_items(items: DataFrame, folders: DataFrame, folder_key: str, key: str, name: str, order: str) -> DataFrame:
    """Items by folder name, in item order; unfiled items follow, newest first.

    A global sort on (folder, item) splits even one huge folder over many tasks.
    """
    joined = items.join(folders, F.col(folder_key) == F.col(key), "left")
    signed = F.when(F.col(name).isNull(), -F.col(order)).otherwise(F.col(order))
    return joined.withColumn("_order", signed).orderBy(
        F.col(name).isNull(), F.lower(name), name, "_order").drop("_order")
