"""Set operations keyed by id: merge, distinct, delete, upsert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key. Every task keeps its own first row, so many copies of a key cost little."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def merge_first_wins(frames: list[DataFrame], key: str, position: str) -> DataFrame:
    """Union in which the first occurrence of an id wins; earlier frames come first."""
    tagged = [frame.withColumn("_source", F.lit(i)) for i, frame in enumerate(frames)]
    union = reduce(DataFrame.unionByName, tagged)
    return first_per_key(union, [key], ["_source", position]).drop("_source")


def delete_ids(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return df.join(gone.select(key), key, "left_anti")


def clear_type(df: DataFrame, column: str, value: str) -> DataFrame:
    """All rows but those of a type; rows without a type stay."""
    return df.where(~F.col(column).eqNullSafe(value))


def upsert(base: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates replace rows with the same key and are added otherwise."""
    return delete_ids(base, updates, key).unionByName(updates)
