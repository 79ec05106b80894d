"""Corpus ingestion: skip known documents, clean, split, attach neighbours and vectors, store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..operators.chunking import split_characters, split_sentences, split_tokens
from ..sources.datasets import DatasetStore, valid_name

SPLITTERS = {"token": split_tokens, "sentence": split_sentences, "character": split_characters}


def chunk_documents(docs: DataFrame, splitter: str = "token", adjacent: bool = True,
                    embedder: Callable[[Column], Column] | None = None, **options) -> DataFrame:
    """Chunks of docs (dataset, dockey, doc_id, text), with neighbours and, given an embedder, vectors.

    Splitting, neighbours and vectors all happen in the row: no shuffle.
    """
    cut = SPLITTERS[splitter](docs.select("dataset", F.col("dockey").alias("doc"), "doc_id", "text"), "text",
                              adjacent=adjacent, **options).drop("text")
    if not adjacent:
        cut = cut.withColumns({"prev": F.lit(None).cast("string"), "next": F.lit(None).cast("string")})
    named = cut.withColumn("name", F.concat("doc", F.lit(" chunk "), F.col("chunk_no").cast("string"))).withColumnRenamed("chunk", "text")
    vector = embedder(F.col("text")) if embedder else F.lit(None)
    return named.withColumn("embedding", vector.cast("array<float>"))


def ingest_documents(store: DatasetStore, docs: DataFrame, splitter: str = "token", *, unique_keys: bool = False,
                     **options) -> None:
    """Append documents not stored yet, with their chunks; running it again adds nothing.

    Documents whose data set has no valid name are set aside in ``store.refused()`` with the reason.

    With ``unique_keys`` (keys made from file paths, say) the duplicate check and its shuffle are left
    out. Otherwise that shuffle also serves the comparison with the stored keys.
    """
    named = docs.where(valid_name(F.col("dataset")))
    store.refuse(docs.where(~valid_name(F.col("dataset"))), "data set name must be letters and digits")
    fresh = store.unknown_docs(named if unique_keys else named.dropDuplicates(["dataset", "dockey"]))
    store.append(fresh, lambda stored: chunk_documents(stored, splitter, **options))


def ingest_report(docs: DataFrame, text: str, group: list[str]) -> DataFrame:
    """Documents taken in and skipped: null or blank text counts as a bad document."""
    bad = F.col(text).isNull() | is_blank(F.col(text))
    return docs.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), F.count_if(~bad).alias("ingested"),
                                    F.count_if(bad).alias("skipped"))
