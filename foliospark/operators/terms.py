"""Term statistics of a corpus, kept on append, and a length-normalised score of candidates with them.

The score of a text for a question sums, over the question's distinct terms, the rarity of the term times
its saturated count in the text: ``ln(1 + (N - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b +
b * length / average length))``. Terms are lower-case tokens.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.generate import explode_rows
from ..functions.text import tokens
from ..session import materialise

K1, B = 1.2, 0.75
FREQUENCIES, TOTALS = "term string, df long", "n_texts long, n_tokens long"


def term_frequencies(texts: DataFrame, text: str) -> DataFrame:
    """(term, df): in how many texts each term occurs. Tasks count first, so a frequent term shuffles once a task."""
    rows = explode_rows(texts, [], F.array_distinct(tokens(F.lower(text))), "term")
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def term_totals(texts: DataFrame, text: str) -> DataFrame:
    return texts.where(F.col(text).isNotNull()).agg(F.count(F.lit(1)).alias("n_texts"), F.coalesce(F.sum(F.size(tokens(F.col(text)))), F.lit(0)).alias("n_tokens"))


class TermStore:
    """Statistics of a growing corpus: every append adds its own counts, reading sums them.

    An append names its batch; the same batch again replaces its counts, so one that died is repeated
    without harm.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, texts: DataFrame, text: str, batch: str) -> None:
        term_frequencies(texts, text).write.mode("overwrite").parquet(f"{self.root}/terms/batch={batch}")
        term_totals(texts, text).write.mode("overwrite").parquet(f"{self.root}/totals/batch={batch}")

    def _read(self, kind: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def frequencies(self) -> DataFrame:
        return self._read("terms", FREQUENCIES).groupBy("term").agg(F.sum("df").alias("df"))

    def totals(self) -> tuple[int, int]:
        """Texts and tokens of all batches."""
        return tuple(self._read("totals", TOTALS).agg(F.coalesce(F.sum("n_texts"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first())


def term_scores(candidates: DataFrame, store: TermStore, *, question: str = "question", text: str = "chunk", out: str = "term_score",
                k1: float = K1, b: float = B) -> DataFrame:
    """Candidates (question_id, question, chunk, ...) with the score of their text; a term no text holds adds nothing.

    The rarities of a question's terms are gathered in a small map per question, which its own length
    bounds; counting happens in the row of each candidate.
    """
    n_texts, n_tokens = store.totals()
    average = n_tokens / n_texts if n_tokens else 1.0
    asked = candidates.select("question_id", question).distinct()
    terms = explode_rows(asked, ["question_id"], F.array_distinct(tokens(F.lower(question))), "term").join(store.frequencies(), "term")
    rarity = F.log(1 + (F.lit(n_texts) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    maps = terms.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("term", rarity.alias("rarity")))).alias("_terms"))
    words = F.when(F.col(text).isNull(), F.array().cast("array<string>")).otherwise(tokens(F.lower(text)))
    rows = candidates.join(maps, "question_id", "left").withColumn("_words", words)
    norm = k1 * (1 - b + b * F.size("_words") / average)

    def gain(entry):
        count = F.size(F.filter("_words", lambda w: w == entry["term"]))
        return entry["rarity"] * count * (k1 + 1) / (count + norm)

    total = F.aggregate(F.coalesce("_terms", F.array().cast("array<struct<term:string,rarity:double>>")), F.lit(0.0), lambda acc, e: acc + gain(e))
    return rows.withColumn(out, F.round(total, 6)).drop("_terms", "_words")


def rerank_by_terms(hits: DataFrame, questions: DataFrame, chunks: DataFrame, store: TermStore, top_n: int | None = None) -> DataFrame:
    """Second pass over the candidates (question_id, chunk_id, rank) by term score; ties keep the first pass' order."""
    both = materialise(hits, "hits").join(chunks, "chunk_id").join(questions.select("question_id", "question"), "question_id")
    scored = term_scores(both, store, out="rerank_score")
    order = Window.partitionBy("question_id").orderBy(F.desc("rerank_score"), "rank")
    ranked = scored.withColumn("new_rank", F.row_number().over(order))
    return ranked if top_n is None else ranked.where(F.col("new_rank") <= top_n)
