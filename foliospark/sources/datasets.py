"""Named datasets of documents and chunks: create, append, list, and export."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import chunk_id
from ..operators.ordering import global_row_number
from ..operators.sizes import BROADCAST_ROWS, at_most, broadcast_when
from ..session import materialise

DOCS = "dataset string, dockey string, doc_id long, text string"
REFUSED = "dataset string, dockey string, doc_id long, reason string"
CHUNKS = ("dataset string, doc string, doc_id long, chunk_no int, name string, text string, prev string, next string, "
          "embedding array<float>")


def check_name(dataset: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9]+", dataset):
        raise ValueError(f"dataset name must be letters and digits: {dataset!r}")
    return dataset


def valid_name(dataset: Column) -> Column:
    return F.coalesce(dataset.rlike("^[A-Za-z0-9]+$"), F.lit(False))


class DatasetStore:
    """Docs and chunks of all datasets as two tables below one folder, partitioned by dataset.

    Appends go through Spark's own committer and are compared by key with what is stored, chunks first
    and documents last, so an append that died halfway is completed, not doubled, when it runs again. A
    document's chunks lie in one file. One writer at a time per dataset.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, kind: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # nothing was appended yet

    def _append(self, frame: DataFrame, kind: str, schema: str) -> None:
        """Rows of a balanced batch, without another shuffle."""
        rows = frame.select([c.split()[0] for c in schema.split(", ")])
        rows.write.mode("append").option("compression", "zstd").partitionBy("dataset").parquet(f"{self.root}/{kind}")

    def docs(self) -> DataFrame:
        return self._read("docs", DOCS)

    def refused(self) -> DataFrame:
        """Documents that could not be stored, with the reason."""
        return self._read("refused", REFUSED)

    def refuse(self, docs: DataFrame, reason: str) -> None:
        """Set documents aside; one that was set aside before is not repeated."""
        key = [c.split()[0] for c in REFUSED.split(", ")]
        rows = docs.withColumn("reason", F.lit(reason)).select(key).dropDuplicates(["dataset", "dockey"])
        known = self.refused().select(F.col("dataset").alias("_d"), F.col("dockey").alias("_k"))
        fresh = rows.join(known, F.col("dataset").eqNullSafe(F.col("_d")) & F.col("dockey").eqNullSafe(F.col("_k")), "left_anti")
        fresh.write.mode("append").parquet(f"{self.root}/refused")

    def chunks(self) -> DataFrame:
        return self._read("chunks", CHUNKS)

    def search_table(self, dataset: str | None = None) -> DataFrame:
        """Stored chunks as retrieval reads them; naming a dataset prunes the other partitions."""
        chunks = self.chunks() if dataset is None else self.chunks().where(F.col("dataset") == check_name(dataset))
        return chunks.select(chunk_id(F.col("dataset"), F.col("doc"), F.col("chunk_no")).alias("chunk_id"), "dataset", "doc", "chunk_no",
                             "name", F.col("text").alias("chunk"), "prev", "next", F.col("embedding").alias("vector"))

    def unknown_docs(self, docs: DataFrame) -> DataFrame:
        """Documents whose key is not stored yet; only keys are read and compared. Texts are not shuffled while none is known."""
        named = docs.where("dataset IS NOT NULL AND dockey IS NOT NULL")
        return self._without(named, self.docs().select("dataset", "dockey"))

    def _without(self, docs: DataFrame, stored: DataFrame) -> DataFrame:
        """``docs`` but those whose key is among the stored ones, which are first reduced to the keys at hand."""
        if stored.isEmpty():
            return docs
        keys = docs.select("dataset", "dockey")
        keys = broadcast_when(keys, at_most(keys, BROADCAST_ROWS))
        known = materialise(stored.join(keys, ["dataset", "dockey"], "left_semi").distinct(), "known-keys")
        if known.isEmpty():
            return docs
        return docs.join(broadcast_when(known, at_most(known, BROADCAST_ROWS)), ["dataset", "dockey"], "left_anti")

    def append(self, docs: DataFrame, chunker: Callable[[DataFrame], DataFrame]) -> None:
        """Store documents that are new, and their chunks.

        The batch is written to the work folder once, so whatever produced it runs only once. It is balanced by data set and
        size there, before texts are cut and repeated, so an append adds few files per dataset and none for a small one beyond one.
        """
        batch = materialise(docs.hint("rebalance", "dataset"), "ingest-batch", "zstd")
        if batch.isEmpty():
            return
        # An append that died may have left chunks of this batch. Only the batch's keys are looked up, in its data sets' folders.
        self._append(chunker(self._without(batch, self.chunks().select("dataset", F.col("doc").alias("dockey")))), "chunks", CHUNKS)
        self._append(batch, "docs", DOCS)

    def class_counts(self) -> DataFrame:
        """Object count per class name, ``D<dataset>docs`` and ``D<dataset>chunks``."""
        counts = [frame.groupBy("dataset").count().select(
            F.concat(F.lit("D"), "dataset", F.lit(kind)).alias("class_name"), F.col("count").alias("n_objects"))
            for kind, frame in (("docs", self.docs()), ("chunks", self.chunks()))]
        return counts[0].unionByName(counts[1])

    def exists(self, dataset: str) -> bool:
        return bool(self.docs().where(F.col("dataset") == check_name(dataset)).take(1))


def parse_class_name(df: DataFrame, column: str = "class_name") -> DataFrame:
    """Dataset and type of a class name; the true suffix is cut for both types."""
    name = F.col(column)
    kind = F.regexp_extract(name, r"^D.*(docs|chunks)$", 1)
    return df.withColumns({
        "dataset": F.when(kind != "", F.regexp_extract(name, r"^D(.*)(docs|chunks)$", 1)).otherwise(name),
        "class_type": F.when(kind == "docs", "Documents").when(kind == "chunks", "Chunks").otherwise("unknown"),
    })


def write_vectors(df: DataFrame, folder: str, vector: str = "vector") -> None:
    """Append rows with a vector column, stored as 32-bit floats. Request batching belongs to the embedder."""
    df.withColumn(vector, F.col(vector).cast("array<float>")).write.mode("append").parquet(folder)


def with_shards(df: DataFrame, key: str, shard_size: int = 500) -> DataFrame:
    """Consecutive shards of ``shard_size`` rows in key order, named like ``0-000017``."""
    numbered = global_row_number(df, key)
    return numbered.withColumn("shard", shard_name(F.floor((F.col("row_no") - 1) / shard_size)))


def shard_name(index: Column) -> Column:
    """At least six digits; longer numbers keep all of theirs."""
    digits = index.cast("string")
    return F.concat(F.lit("0-"), F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits))


def write_shards(df: DataFrame, folder: str, key: str, text: str, shard_size: int = 500) -> None:
    """JSON shards of fixed size, one directory per shard; a shard's rows sit in one task."""
    sharded = with_shards(df.select(key, text), key, shard_size)
    (sharded.select("shard", key, F.col(text).alias("chunks"))
     .repartition("shard").sortWithinPartitions("shard", key).drop(key)
     .write.partitionBy("shard").json(folder))


def append_metrics(metrics: DataFrame, keys: list[str], folder: str | None = None) -> DataFrame:
    """One metrics row per run as (keys, metric, value) rows, optionally appended to a table."""
    values = [c for c in metrics.columns if c not in keys]
    long = metrics.select(*keys, *[F.col(c).cast("double").alias(c) for c in values]).unpivot(
        keys, values, "metric", "value")
    if folder:
        long.write.mode("append").parquet(folder)
    return long
