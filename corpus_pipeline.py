"""Documents to training sequences: quality rules, quality classifier, near-duplicate removal, packing.

Every stage reads what its predecessor kept, as written to Parquet, and works on all of it. The first
three return rows with the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.jaccard_join import one_per_component
from foliospark.llm.kneser_ney import classified
from foliospark.llm.line_quality import with_line_verdict
from foliospark.llm.packing import pack_documents
from foliospark.llm.queries import SEQUENCE_TOKENS, table, vocabulary
from foliospark.llm.registry import query
from foliospark.session import materialise

ORACLE_SQL = None  # tokenizer ids and packing have no SQL counterpart; tests compare with plain Python


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules keep, without the lines that are frequent on their host."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "source", "text")  # no column of the input can clash
    judged = with_line_verdict(rows).where("kept")
    length = F.when(F.col("removed_lines").isNull(), F.col("_row.n_chars")).otherwise(F.length("cleaned_text").cast("long"))
    changed = {"text": F.col("cleaned_text"), "n_chars": length}
    return judged.select(*[(changed[c] if c in changed else F.col("_row")[c]).alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity stays below the threshold of their language."""
    return classified(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of similar ones."""
    return one_per_component(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack_documents(docs, vocabulary("word_bpe_49k.json"), SEQUENCE_TOKENS)


STAGES = [("quality rules", quality_rules), ("quality classifier", quality_classifier),
          ("n-gram Jaccard join", near_duplicates), ("best-fit packing", packing)]


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
