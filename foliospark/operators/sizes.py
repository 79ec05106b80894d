"""Size checks that decide whether a side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000  # questions; their few candidates are ids and scores only


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether a table has no more than ``rows`` rows; stops counting just beyond."""
    return df.limit(rows + 1).count() <= rows


def broadcast_when(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a side whose size was checked; otherwise Spark picks the join."""
    return F.broadcast(df) if small else df
