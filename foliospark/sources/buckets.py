"""A stored table cut into buckets by key: changes rewrite the buckets they touch and no other file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from ..operators.sets import delete_ids, upsert
from ..session import materialise

MARK, BUCKET = "_is_row", "_bucket"


class BucketTable:
    """Rows with one key, stored below a folder per bucket (a hash of the key).

    A change reads the touched buckets, writes the merged rows to the work folder and replaces the buckets
    through Spark's own committer. A change that died may be run again: it yields the same table. One row
    of every touched bucket is a mark, so that a bucket without rows is replaced too. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str, key: str, n_buckets: int = 64):
        empty = spark.createDataFrame([], schema)
        self.spark, self.root, self.key, self.n_buckets, self.schema = spark, root.rstrip("/"), key, n_buckets, empty.schema

    def _stored(self) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField(MARK, BooleanType()), StructField(BUCKET, IntegerType())])
        try:
            return self.spark.read.schema(schema).parquet(self.root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        return self._stored().where(MARK).select(*self.schema.names)

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.n_buckets)).cast("int")

    def _touched(self, keys: DataFrame) -> list[int]:
        return sorted(r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect())  # at most ``n_buckets``

    def _replace(self, touched: list[int], rows: DataFrame) -> None:
        marks = self.spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int").withColumn(MARK, F.lit(False))
        placed = rows.withColumns({MARK: F.lit(True), BUCKET: self._bucket()}).unionByName(marks, allowMissingColumns=True)
        merged = materialise(placed, "merged-buckets")
        merged.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.root)

    def upsert(self, updates: DataFrame) -> list[int]:
        """Replace rows with the same key and add the others; returns the buckets that were rewritten."""
        new = materialise(updates.select(*self.schema.names), "updates")
        touched = self._touched(new)
        if touched:
            base = self._stored().where(F.col(BUCKET).isin(touched) & F.col(MARK)).select(*self.schema.names)
            self._replace(touched, upsert(base, new, self.key))
        return touched

    def delete(self, gone: DataFrame) -> list[int]:
        """Drop the rows of the given keys; returns the buckets that were rewritten."""
        keys = materialise(gone.select(self.key).distinct(), "deleted-keys")
        touched = self._touched(keys)
        if touched:
            base = self._stored().where(F.col(BUCKET).isin(touched) & F.col(MARK)).select(*self.schema.names)
            self._replace(touched, delete_ids(base, keys, self.key))
        return touched
