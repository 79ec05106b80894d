"""Substring search through stored posting lists of three-character runs.

Texts (key, text) are stored by a hash of the key and their runs as (run, key), both kept on append. A term
is looked up by its rarest runs: keys that hold all of them are candidates, and only their
texts are read and tested. Terms without a run of three letters fall back to the scan. Case is folded.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.generate import explode_rows
from ..session import materialise
from .sizes import BROADCAST_ROWS, at_most, broadcast_when

RUN = 3
BUCKETS = 256  # of an index, unless it is made with another number
LOOKED_UP = 4  # runs of a term that are intersected, the rarest


def runs_of(text: Column) -> Column:
    """Distinct runs of a text in lower case."""
    low = F.lower(text)
    starts = F.when(F.length(low) >= RUN, F.sequence(F.lit(1), F.length(low) - (RUN - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(RUN))))


def term_runs(term: str, across_texts: bool) -> list[str]:
    """Runs of a term, or of each of its words where these may stand in different texts of a key."""
    pieces = term.lower().split(" ") if across_texts else [term.lower()]
    return sorted({piece[i:i + RUN] for piece in pieces for i in range(len(piece) - RUN + 1)})


class PostingIndex:
    """Posting lists, run counts and texts below one folder; a key is a whole number and may have many texts."""

    def __init__(self, spark: SparkSession, root: str, n_buckets: int = BUCKETS):
        self.spark, self.root, self.n_buckets = spark, root.rstrip("/"), n_buckets

    def append(self, rows: DataFrame, key: str, text: str, batch: str) -> None:
        """Add rows; the same batch again replaces what it wrote."""
        own = materialise(rows.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("text IS NOT NULL"), "search-batch")
        postings = explode_rows(own, ["key"], runs_of(F.col("text")), "run").distinct()
        placed = postings.withColumn("bucket", F.pmod(F.xxhash64("run"), F.lit(self.n_buckets)))
        stored = self._write(placed, "postings", batch, "run")
        self._write(stored.groupBy("bucket", "run").agg(F.count(F.lit(1)).alias("n")), "counts", batch)
        self._write(own.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.n_buckets))), "texts", batch)

    def _write(self, rows: DataFrame, kind: str, batch: str, *order: str) -> DataFrame:
        """A file per bucket, or several of bounded size for one that would not fit a task; returns the stored rows."""
        folder = f"{self.root}/{kind}/batch={batch}"
        rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *order).write.mode("overwrite").partitionBy("bucket").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def _read(self, kind: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def texts(self) -> DataFrame:
        return self._read("texts", "key long, text string, bucket int")

    def _of_runs(self, kind: str, schema: str, runs: list[str]) -> DataFrame:
        """Rows of the given runs: their buckets are the only folders read."""
        wanted = self.spark.createDataFrame([(r,) for r in runs], "run string").select(F.pmod(F.xxhash64("run"), F.lit(self.n_buckets)).alias("b"))
        buckets = sorted({r.b for r in wanted.collect()})
        return self._read(kind, schema).where(F.col("bucket").isin(buckets) & F.col("run").isin(runs))

    def candidates(self, term: str, across_texts: bool = False) -> DataFrame | None:
        """Keys that hold the rarest runs of a term; None for a term without runs.

        With ``across_texts`` the texts of a key count as joined by spaces, in some order.
        """
        runs = term_runs(term, across_texts)
        if not runs:
            return None
        counts = self._of_runs("counts", "run string, n long, bucket int", runs).groupBy("run").agg(F.sum("n").alias("n")).collect()
        if len(counts) < len(runs):
            runs = []  # some run occurs nowhere
        rarest = sorted(runs, key=lambda r: ({c.run: c.n for c in counts}[r], r))[:LOOKED_UP]
        found = self._of_runs("postings", "run string, key long, bucket int", rarest or ["none"])
        return found.groupBy("key").agg(F.count_distinct("run").alias("n")).where(F.col("n") == max(1, len(rarest))).select("key")

    def candidate_texts(self, term: str) -> DataFrame:
        """Texts of the candidates; beyond a checked number of them Spark picks the join."""
        keys = self.candidates(term)
        if keys is None:
            return self.texts().select("key", "text")
        keys = materialise(keys.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.n_buckets)).cast("int")), "candidates")
        buckets = sorted(r.bucket for r in keys.select("bucket").distinct().collect())  # at most ``n_buckets``
        texts = self.texts().where(F.col("bucket").isin(buckets))
        return texts.join(broadcast_when(keys, at_most(keys, BROADCAST_ROWS)), ["bucket", "key"]).select("key", "text")

    def search(self, term: str) -> DataFrame:
        """Keys with a text that contains the term in any case."""
        return self.candidate_texts(term).where(F.lower("text").contains(term.lower())).select("key").distinct()
