"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of a link; the label is the smallest node its links reach.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so
    stars settle at once and chains halve. Rounds are written to the shared folder; a node with very
    many links only takes part in sums and minima that tasks combine before they shuffle.
    """
    both = materialise(links.select(F.col(a).alias("node"), F.col(b).alias("other")).union(
        links.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct(), "links")
    labels = materialise(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        roots = lower.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = materialise(lower.join(roots, "label").select("node", F.least("label", "root").alias("label"), "old"), "labels")
        if jumped.where("label <> old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
