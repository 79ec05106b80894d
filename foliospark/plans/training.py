"""Chunk export for training: ids from a file, looked up, cut to shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_by_id, missing_ids
from ..operators.ordering import first_rows
from ..sources.corpora import csv_column
from ..sources.datasets import write_shards


def export_chunks(chunks: DataFrame, id_file: str, folder: str, *, no_of_chunks: int | None = None,
                  shard_size: int = 500) -> DataFrame:
    """Write the texts of the listed chunks as JSON shards; returns the ids that were not found."""
    ids = first_rows(csv_column(chunks.sparkSession, id_file, "chunk_id", "chunk_id long"), "chunk_id", no_of_chunks)
    found = lookup_by_id(ids, chunks.select("chunk_id", "chunk"), "chunk_id", "chunk")
    write_shards(found, folder, "chunk_id", "chunk", shard_size)
    return missing_ids(ids, chunks, "chunk_id")


def read_shards(spark, folder: str) -> DataFrame:
    return spark.read.schema("chunks string, shard string").json(folder).select("shard", F.col("chunks").alias("chunk"))
