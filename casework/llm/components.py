"""Connected components of a link table, by labels that shrink along links and jump along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import stage


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, for every end of a link (``a``, ``b``).

    Each round gives a node the smallest label of its neighbours and then the label
    of that label. Tables are staged, so that a join on a node with very many links
    is a plain join of two exchanges, which adaptive execution splits.
    """
    both = stage(
        links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), f"{name}_links"
    )
    labels = stage(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"),
        f"{name}_labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("near"))
            .withColumnRenamed("a", "id")
        )
        met = stage(
            labels.join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("old")),
            f"{name}_met",
        )
        target = met.select(F.col("id").alias("label"), F.col("label").alias("jump"))
        jumped = stage(
            met.join(target, "label", "left").select("id", "old", F.least("label", "jump").alias("label")),
            f"{name}_jumped",
        )
        labels = jumped.select("id", "label")
        if not jumped.where("label != old").limit(1).count():
            return labels.select("id", F.col("label").alias("component"))
