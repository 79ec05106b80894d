"""Question answering up to the model call: post-process, cache, retrieve, rerank, assemble, prompt."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.embedding import embed
from ..functions.text import fill_prompt, redact
from ..operators import retrieval
from ..operators.joins import expand_from_table, rewritten_questions
from ..operators.sets import first_per_key
from ..operators.terms import TermStore, rerank_by_terms
from ..session import materialise
from ..sources.buckets import BucketTable

Step = Callable[[DataFrame], DataFrame]
PROMPT = "Answer the question from the sources.\n\nSources:\n{context}\n\nQuestion: {question}\n"


@dataclass
class AnswerSettings:
    top_k: int = 3
    rerank: bool = True
    rerank_top_k: int = 5
    max_sources: int = 3
    use_adjacent: bool = True
    max_tokens: int = 1024
    separator: str = "\n\n"
    prompt: str = PROMPT
    cache_threshold: float = 0.90
    cache_suggestion_threshold: float = 0.85
    post_processors: Sequence[Step] = field(default_factory=tuple)
    embedder: Callable[[Column], Column] = embed
    scorer: Callable[[Column, Column], Column] = retrieval.jaccard
    terms: TermStore | None = None  # rerank by corpus statistics instead of the scorer
    rewriter: Step | None = None  # questions -> (question_id, reply): JSON rewrites of a model
    confidence_threshold: int = 1  # least score of a rewrite that is searched


def acronym_expander(dictionary: dict[str, str]) -> Step:
    """Expand acronyms of a dictionary of any size, looked up as a table."""
    def expand(questions: DataFrame) -> DataFrame:
        forms = questions.sparkSession.createDataFrame(list(dictionary.items()), "acronym string, full_form string")
        return expand_from_table(questions, "question_id", "question", forms)

    return expand


def personal_data_remover(questions: DataFrame) -> DataFrame:
    return questions.withColumn("question", redact(F.col("question")))


def post_process(questions: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Apply query post-processors in the listed order."""
    return reduce(lambda df, step: df.transform(step), steps, questions)


def select_sources(questions: DataFrame, chunks: DataFrame, settings: AnswerSettings) -> DataFrame:
    """Kept sources of each question with the text that goes into its context.

    Questions may carry the ``token_limit`` of their model, which then bounds the context in place of ``max_tokens``.
    """
    depth = settings.rerank_top_k if settings.rerank else 0
    if settings.rewriter:
        rewrites = rewritten_questions(settings.rewriter(questions), "reply", settings.confidence_threshold)
        hits = retrieval.retrieve_fused(questions, rewrites, chunks, settings.top_k, depth, settings.embedder)
    else:
        hits = retrieval.retrieve_chunks(questions, chunks, settings.top_k, depth, settings.embedder)
    if settings.rerank and settings.terms:
        ranked = rerank_by_terms(hits, questions, chunks, settings.terms)
    elif settings.rerank:
        ranked = retrieval.rerank(hits, questions, chunks, settings.scorer)
    else:
        ranked = chunks.join(hits, "chunk_id").withColumn("new_rank", F.col("rank"))
    body = retrieval.with_neighbour_text(F.col("prev"), F.col("chunk"), F.col("next")) if settings.use_adjacent else F.col("chunk")
    kept = retrieval.keep_sources(ranked, settings.max_sources).withColumn("source_text", body)
    if "token_limit" in questions.columns:
        kept = kept.join(questions.select("question_id", "token_limit"), "question_id")
        return retrieval.within_budget(kept, F.col("token_limit"), "source_text")
    return retrieval.within_budget(kept, settings.max_tokens, "source_text")


def answer_questions(questions: DataFrame, chunks: DataFrame, cache: DataFrame | None = None,
                     settings: AnswerSettings | None = None) -> DataFrame:
    """One row per question: status, cached answer id, context, references and the prompt for the model.

    ``questions`` (question_id, question, and token_limit if models differ), ``chunks`` (chunk_id, chunk, prev, next,
    name), ``cache`` (cache_id, question). Only cache misses are searched for. A single question or an
    interactive one is the one-row case of this job.
    """
    settings = settings or AnswerSettings()
    asked = post_process(questions, settings.post_processors)
    if cache is None:
        status = asked.select("question_id", "question", F.lit("miss").alias("status"), F.lit(None).cast("long").alias("cache_id"))
    else:
        looked_up = retrieval.question_cache(asked, cache, threshold=settings.cache_threshold,
                                             suggestion_threshold=settings.cache_suggestion_threshold, embedder=settings.embedder)
        status = materialise(asked.join(looked_up.select("question_id", "status", "cache_id"), "question_id"), "cache-status")
    open_questions = status.where(F.col("status") != "hit").select("question_id", "question")
    if "token_limit" in asked.columns:
        open_questions = open_questions.join(asked.select("question_id", "token_limit"), "question_id")
    sources = select_sources(open_questions, chunks, settings)
    found = retrieval.joined_context(sources, "source_text", settings.separator).join(
        retrieval.references(sources, "name", separator=", "), "question_id")
    out = status.join(found, "question_id", "left")
    prompt = fill_prompt(settings.prompt, context=F.coalesce("context", F.lit("")), question=F.col("question"))
    return out.select("question_id", "status", "cache_id", "context", "references",
                      F.when(F.col("status") != "hit", prompt).alias("prompt"))


class AnswerCache:
    """Answered questions by the hash of their text, stored in buckets; a question answered again replaces its answer."""

    SCHEMA = "cache_id long, question string, answer string"

    def __init__(self, spark: SparkSession, root: str, n_buckets: int = 64):
        self.table = BucketTable(spark, root, self.SCHEMA, "cache_id", n_buckets)

    def entries(self) -> DataFrame:
        """What ``answer_questions`` reads as its cache."""
        return self.table.read()

    def remember(self, answered: DataFrame) -> None:
        """Write the answers (question_id, question, answer) of cache misses back; of equal questions the lowest id counts."""
        named = answered.where(F.col("answer").isNotNull()).withColumn("cache_id", F.conv(F.substring(F.md5("question"), 1, 15), 16, 10).cast("long"))
        self.table.upsert(first_per_key(named, ["cache_id"], ["question_id"]))
