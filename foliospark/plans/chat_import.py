"""Import of chat exports: detect the version, upgrade, merge with the stored history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.generate import inline_rows
from ..operators.chat import upgrade_bundles
from ..operators.sets import merge_first_wins


def imported(bundles: DataFrame, raw: str, position: str, kind: str = "history") -> DataFrame:
    """Conversations (``history``), ``folders`` or ``prompts`` of all supported bundles with their place in the import order."""
    up = upgrade_bundles(bundles, raw).where(F.col("version_found").isNotNull())
    placed = F.transform(kind, lambda c, i: F.struct(F.col(position).alias("bundle"), i.alias("item"), c.alias("c")))
    rows = inline_rows(up, [], placed, "item")
    return rows.select("c.*", F.struct("bundle", "item").alias("position"))


def refused_bundles(bundles: DataFrame, raw: str) -> DataFrame:
    """Bundles of no supported version, whole and with the reason."""
    found = upgrade_bundles(bundles, raw).where(F.col("version_found").isNull())
    return found.select(*bundles.columns).withColumn("reason", F.lit("Unsupported data format"))


def import_history(stored: DataFrame, bundles: DataFrame, raw: str, position: str) -> DataFrame:
    """Stored conversations win over imported ones with the same id; importing twice changes nothing.

    ``stored`` has the columns of a conversation and a ``position`` struct (bundle, item).
    """
    return merge_first_wins([stored, imported(bundles, raw, position)], "id", "position")


def import_bundles(stored: dict[str, DataFrame], bundles: DataFrame, raw: str, position: str) -> dict[str, DataFrame]:
    """The same for every kind stored: ``history``, ``folders`` and ``prompts``, each merged on its own with the first one winning."""
    return {kind: merge_first_wins([own, imported(bundles, raw, position, kind)], "id", "position") for kind, own in stored.items()}
