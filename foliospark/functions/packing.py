"""Greedy packing of an ordered array of sizes, as one column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RUNS = "array<struct<start:int,stop:int>>"


def greedy_runs(sizes: Column, limit: int, overlap: int = 0) -> Column:
    """Consecutive runs (start, stop exclusive) whose sizes add up to at most ``limit``.

    An item larger than the limit forms a run of its own. With an overlap, a run begins at the
    earliest earlier item such that the repeated part stays within ``overlap`` and the next item
    still fits.
    """
    def total(start: Column, stop: Column) -> Column:
        return F.aggregate(F.slice(sizes, start + 1, stop - start), F.lit(0), lambda s, n: s + n.cast("int"))

    def step(acc: Column, item: Column) -> Column:
        size, at = item["size"], item["at"]
        grown = F.struct(acc["done"].alias("done"), acc["start"].alias("start"), (acc["used"] + size).alias("used"))
        if overlap:
            starts = F.filter(F.sequence(acc["start"] + 1, at), lambda s: (s == at) | (
                (total(s, at) <= overlap) & (total(s, at) + size <= limit)))
            start = F.get(starts, 0)
            used = total(start, at) + size
        else:
            start, used = at, size
        closed = F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), at.alias("stop"))))
        fresh = F.struct(closed.alias("done"), start.alias("start"), used.alias("used"))
        return F.when((at == acc["start"]) | (acc["used"] + size <= limit), grown).otherwise(fresh)

    begin = F.struct(F.array().cast(RUNS).alias("done"), F.lit(0).alias("start"), F.lit(0).alias("used"))
    items = F.transform(sizes, lambda n, i: F.struct(n.cast("int").alias("size"), i.alias("at")))
    return F.aggregate(items, begin, step, lambda acc: F.when(F.size(sizes) > 0, F.concat(
        acc["done"], F.array(F.struct(acc["start"].alias("start"), F.size(sizes).alias("stop"))))).otherwise(acc["done"]))
