"""Seeded two-pass external shuffle into shards, in column expressions only.

Pass one scatters the records uniformly to buckets of bounded size by a seeded hash of the whole
record. Pass two gathers one bucket at a time in a fixed order, shuffles it with the Fisher-Yates
shuffle of the engine (one bucket is one partition, whose number seeds it) and writes it. The position
of a record is the rows of earlier buckets plus its place in its own, and shards are equal ranges of
positions: their row counts differ by one at most.

The hash covers all columns, so equal keys, texts or sources do not meet in one bucket. Rows that are equal
in all columns are counted first; where there are more than ``EQUAL_ROWS`` of them they are dealt to the
buckets one by one, and that deal is written before it is used. Nulls and empty texts are ordinary values. Input columns come back inside one struct
column ``record``, so no name can clash. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import materialise, work_folder
from .blocks import parts_for

BUCKET_BYTES = 32 << 20
ROW_BYTES = 16
EQUAL_ROWS = 1_000


def scatter(records: DataFrame, n_buckets: int, seed: int) -> DataFrame:
    """(bucket, row): records with their order inside a bucket, dealt uniformly."""
    names = records.columns
    order = F.xxhash64(*names, F.lit(seed))
    row = F.struct(order.alias("order"), F.struct(*names).alias("record")).alias("row")
    if n_buckets > 1:
        equal = materialise(records.groupBy(order.alias("equal")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > EQUAL_ROWS).select("equal"), "equal-rows")
        if not equal.isEmpty():
            numbered = records.select(row, F.monotonically_increasing_id().alias("number")).join(equal, F.col("row.order") == F.col("equal"), "left")
            salt = F.when(F.col("equal").isNotNull(), F.col("number"))
            single = F.pmod(F.xxhash64("row.order", salt, F.lit(seed + 1)), F.lit(n_buckets)).cast("int")
            return materialise(numbered.select(single.alias("bucket"), "row"), "dealt-rows")
    return records.select(F.pmod(F.xxhash64(order, F.lit(seed + 1)), F.lit(n_buckets)).cast("int").alias("bucket"), row)


def shuffle_to_shards(records: DataFrame, n_shards: int, seed: int = 7, *, text_col: str = "text",
                      bucket_bytes: int = BUCKET_BYTES, folder: str | None = None) -> DataFrame:
    """Write the records in shuffled order to ``n_shards`` folders; returns (shard, slot, record) as written."""
    spark = records.sparkSession
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES
    n_rows, n_bytes = records.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    n_buckets = parts_for(n_bytes, bucket_bytes)
    scattered = scatter(records, n_buckets, seed)

    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = counts.select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))

    gathered = (scattered.repartitionById(n_buckets, F.col("bucket")).groupBy("bucket")
                .agg(F.sort_array(F.collect_list("row")).alias("rows")))
    mixed = gathered.join(F.broadcast(offsets), "bucket").select(
        "offset", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("place", "row"))
    position = (F.col("offset") + F.col("place")).cast("long")
    shard = F.expr(f"cast(position * {n_shards} div {max(n_rows, 1)} as int)")
    first = F.expr(f"(shard * {n_rows}L + {n_shards - 1}) div {n_shards}")
    placed = mixed.select(position.alias("position"), F.col("row.record").alias("record")).withColumn("shard", shard)
    folder = folder or work_folder(spark, "shards")
    placed.select("shard", (F.col("position") - first).cast("long").alias("slot"), "record").write.partitionBy("shard").parquet(folder)
    schema = StructType([StructField("slot", LongType()), StructField("record", placed.schema["record"].dataType),
                         StructField("shard", IntegerType())])
    return spark.read.schema(schema).parquet(folder)
