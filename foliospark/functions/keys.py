"""Stable ids and hashes: the same value in every run, retry and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash(salt: int | str, *parts: Column) -> Column:
    """32-bit number from md5 of the parts and a salt; repeatable, unlike ``rand``."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts], F.lit(str(salt)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def document_key(dataset: Column, path: Column) -> Column:
    """Document id from dataset and path, so a retried write yields the same id."""
    return F.sha2(F.concat(dataset, path), 256)


def chunk_id(*key: Column) -> Column:
    """60-bit number of a chunk from all that names it: data set, document key, chunk number."""
    name = F.md5(F.concat_ws(":", *[k.cast("string") for k in key]))
    return F.conv(F.substring(name, 1, 15), 16, 10).cast("long")


def falsy_default(value: Column, default: Column, empty: Column) -> Column:
    """``value`` unless it is null or the type's empty value (``''``, ``0``)."""
    return F.coalesce(F.nullif(value, empty), default)
