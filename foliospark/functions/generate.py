"""Projections that evaluate an expensive array once.

For a plain ``explode`` Catalyst adds a filter ``size(array) > 0`` and pushes it to the scan, which
computes an expensive array twice. The outer form has no such filter; empty rows are dropped after.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body refers to it.

    Inside a lambda an ordinary expression is evaluated again for every element, and an array that
    comes from a stored row is unpacked again by every ``slice``. A bound value avoids both.
    """
    return F.get(F.transform(F.array(value), body), 0)


def explode_rows(df: DataFrame, keep: list, array: Column | str, name: str) -> DataFrame:
    """One row per non-null element."""
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def non_null(df: DataFrame, keep: list, value: Column, name: str) -> DataFrame:
    """Rows where a costly expression is not null, computed once.

    A plain filter would be pushed down with a copy of the expression, often into the few scan tasks.
    """
    return explode_rows(df, keep, F.array(value), name)


def posexplode_rows(df: DataFrame, keep: list, array: Column | str, position: str, name: str) -> DataFrame:
    """One row per element with its zero-based position."""
    return df.select(*keep, F.posexplode_outer(array).alias(position, name)).where(F.col(position).isNotNull())


def inline_rows(df: DataFrame, keep: list, structs: Column | str, present: str) -> DataFrame:
    """One row per struct; ``present`` names a field that is never null."""
    return df.select(*keep, F.inline_outer(structs)).where(F.col(present).isNotNull())
