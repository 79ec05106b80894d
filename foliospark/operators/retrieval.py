"""Retrieval steps around the similarity search: cache, rerank, sources, context, window, training groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.embedding import embed
from ..functions.text import token_count, tokens
from ..session import materialise
from .ordering import all_groups_within, with_halo, with_position
from .sizes import BROADCAST_ROWS, at_most, broadcast_when
from .similarity import Rules, top_k_by_rule, top_k_similar

def retrieve_chunks(questions: DataFrame, chunks: DataFrame, top_k: int = 3, rerank_top_k: int = 5,
                    embedder: Callable[[Column], Column] = embed) -> DataFrame:
    """Candidates of each question (question_id, question) among chunks (chunk_id, chunk).

    The larger of both depths is fetched, so that reranking has something to choose from.
    """
    q = questions.select("question_id", embedder(F.col("question")).alias("vector"))
    c = chunks.select("chunk_id", (F.col("vector") if "vector" in chunks.columns else embedder(F.col("chunk"))).alias("vector"))
    hits = top_k_similar(q, c, max(top_k, rerank_top_k), doc_id="chunk_id")
    return hits.withColumnRenamed("doc_id", "chunk_id")


RANK_CONSTANT = 60


def fused_hits(hits: DataFrame, rewrites: DataFrame, depth: int, constant: int = RANK_CONSTANT) -> DataFrame:
    """Hits of several searches of a question as one list: reciprocal ranks are summed, ties go to the lower id.

    ``hits`` (text_id, chunk_id, score, rank) are the searches' results, ``rewrites`` (question_id, text_id) say
    which searches belong to a question. Returns (question_id, chunk_id, score, rank), ``score`` the fused one.
    """
    found = rewrites.join(hits, "text_id").groupBy("question_id", "chunk_id").agg(
        F.round(F.sum(1.0 / (constant + F.col("rank"))), 9).alias("score"))
    order = Window.partitionBy("question_id").orderBy(F.desc("score"), "chunk_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)


def retrieve_fused(questions: DataFrame, rewrites: DataFrame, chunks: DataFrame, top_k: int = 3, rerank_top_k: int = 5,
                   embedder: Callable[[Column], Column] = embed) -> DataFrame:
    """Candidates of questions (question_id, question) by fan-out over their rewrites (question_id, question).

    A question without a rewrite is searched as it is. Equal texts are searched once, however many
    questions share them.
    """
    plain = questions.select("question_id", "question").join(rewrites.select("question_id").distinct(), "question_id", "left_anti")
    asked = rewrites.select("question_id", "question").unionByName(plain).distinct().withColumn(
        "text_id", F.conv(F.substring(F.md5("question"), 1, 15), 16, 10).cast("long"))
    asked = materialise(asked, "rewrites")
    texts = asked.select(F.col("text_id").alias("question_id"), "question").distinct()
    hits = retrieve_chunks(texts, chunks, top_k, rerank_top_k, embedder).withColumnRenamed("question_id", "text_id")
    return fused_hits(hits, asked.select("question_id", "text_id"), max(top_k, rerank_top_k))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two texts' distinct lower-case tokens, 0 when both are blank."""
    left, right = tokens(F.lower(a)), tokens(F.lower(b))
    return F.round(F.coalesce(F.try_divide(F.size(F.array_intersect(left, right)), F.size(F.array_union(left, right))),
                              F.lit(0.0)), 6)


def rerank(hits: DataFrame, questions: DataFrame, chunks: DataFrame, scorer: Callable[[Column, Column], Column] = jaccard,
           top_n: int | None = None) -> DataFrame:
    """Second scoring pass over the candidates only; ties keep the first pass' order."""
    hits = materialise(hits, "hits")  # searched once, and counted before they may be broadcast
    both = (chunks.join(broadcast_when(hits, at_most(hits, BROADCAST_ROWS)), "chunk_id")
            .join(questions.select("question_id", "question"), "question_id")
            .withColumn("rerank_score", scorer(F.col("question"), F.col("chunk"))))
    order = Window.partitionBy("question_id").orderBy(F.desc("rerank_score"), "rank")
    ranked = both.withColumn("new_rank", F.row_number().over(order))
    return ranked if top_n is None else ranked.where(F.col("new_rank") <= top_n)


def keep_sources(ranked: DataFrame, max_sources: int = 3, rank: str = "new_rank") -> DataFrame:
    return ranked.where(F.col(rank) <= max_sources)


def within_budget(ranked: DataFrame, budget: int | Column, text: str, rank: str = "new_rank") -> DataFrame:
    """Leading sources whose texts together stay within a token budget, one for all or a column such as a model's limit."""
    upto = Window.partitionBy("question_id").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    return (ranked.withColumn("n_tokens", token_count(F.col(text)))
            .withColumn("used_tokens", F.sum("n_tokens").over(upto)).where(F.col("used_tokens") <= budget))


def joined_context(ranked: DataFrame, text: str, separator: str = "\n\n", rank: str = "new_rank") -> DataFrame:
    """Context of each question: its few kept sources joined in rank order."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(text).alias("t"))))
    return ranked.groupBy("question_id").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), separator).alias("context"))


def references(ranked: DataFrame, name: str, rank: str = "new_rank", separator: str = "") -> DataFrame:
    """Names of the kept sources in rank order, each once."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(name).alias("n"))))
    return ranked.groupBy("question_id").agg(
        F.array_join(F.array_distinct(F.transform(ordered, lambda x: x["n"])), separator).alias("references"))


def with_neighbour_text(prev: Column, chunk: Column, following: Column, separator: str = " ") -> Column:
    return F.concat_ws(separator, prev, chunk, following)


def question_cache(incoming: DataFrame, cache: DataFrame, *, threshold: float = 0.90, suggestion_threshold: float = 0.85,
                   suggestions: int = 3, embedder: Callable[[Column], Column] = embed) -> DataFrame:
    """Answer questions (question_id, question) from a cache (cache_id, question).

    At or above ``threshold`` the best entry answers (hit). Other entries at or above
    ``suggestion_threshold`` are follow-up suggestions, the best few of them. Equal texts are looked up
    once on both sides; of equal cache entries the lowest id stays.
    """
    asked = incoming.groupBy("question").agg(F.min("question_id").alias("question_id"))
    entries = cache.groupBy("question").agg(F.min("cache_id").alias("cache_id"))
    near = top_k_similar(asked.select("question_id", embedder(F.col("question")).alias("vector")),
                         entries.select("cache_id", embedder(F.col("question")).alias("vector")),
                         suggestions + 1, doc_id="cache_id")
    hit = (F.col("rank") == 1) & (F.col("score") >= threshold)
    follow = ~hit & (F.col("score") >= suggestion_threshold)
    per_text = near.groupBy("question_id").agg(
        F.max("score").alias("best_score"), F.max(F.when(hit, F.col("doc_id"))).alias("cache_id"),
        F.array_sort(F.collect_list(F.when(follow, F.struct("rank", "doc_id")))).alias("_follow"))
    per_text = per_text.withColumn("_follow", F.transform("_follow", lambda x: x["doc_id"]))
    by_text = asked.withColumnRenamed("question_id", "_rep").join(
        per_text.withColumnRenamed("question_id", "_rep"), "_rep", "left").drop("_rep")
    first = F.slice("_follow", 1, suggestions)
    return incoming.join(by_text, "question", "left").select(
        "question_id", F.when(F.col("cache_id").isNotNull(), "hit").when(F.size(F.coalesce(first, F.array())) > 0, "suggest")
        .otherwise("miss").alias("status"), "cache_id", "best_score",
        F.coalesce(first, F.array().cast("array<bigint>")).alias("suggestions"))


def chat_window(messages: DataFrame, window_size: int = 2, piece: int = 4096) -> DataFrame:
    """Texts of the last ``window_size`` messages before each user message, whatever their turn numbers.

    Conversations of a checked length are one window each. Otherwise they are cut into pieces with copied
    edges, so one long conversation does not end up in one task, and each window still sees all it needs.
    """
    rows = messages.select("conv_id", "turn", "role", "text")
    if all_groups_within(rows, "conv_id", piece):
        last = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-window_size, -1)
        return rows.withColumn("history", F.collect_list("text").over(last)).where(F.col("role") == "user").select("conv_id", "turn", "history", "text")
    placed = with_position(rows, "conv_id", "turn", piece=piece)
    cut = with_halo(placed, "position", piece, before=window_size)
    before = Window.partitionBy("conv_id", "_piece").orderBy("position").rangeBetween(-window_size, -1)
    seen = cut.withColumn("history", F.collect_list("text").over(before))
    return seen.where(~F.col("_halo") & (F.col("role") == "user")).select("conv_id", "turn", "history", "text")


def question_batches(questions: DataFrame, batch_size: int = 16) -> DataFrame:
    """Request batches of a fixed size; the whole table is still one job."""
    from .ordering import global_row_number

    numbered = global_row_number(questions, "question_id")
    return numbered.withColumn("batch_no", F.floor((F.col("row_no") - 1) / batch_size)).drop("row_no")


def training_groups(rows: DataFrame, *, key: str, vector: str, group: str, negatives: int = 1) -> DataFrame:
    """For each row: its best row of the same group (positive) and best rows of other groups (hard negatives).

    The group test happens inside the search, so a negative is found however many rows share the group.
    """
    found = top_k_by_rule(rows, rows, [Rules(1, True, "same"), Rules(negatives, True, "other")], question_id=key, doc_id=key,
                          vector=vector, group=group)
    positive = found.where("rule = 0").select("question_id", F.col("doc_id").alias("positive_id"))
    negative = found.where("rule = 1").select("question_id", F.col("doc_id").alias("negative_id"), "rank")
    return positive.join(negative, "question_id")
