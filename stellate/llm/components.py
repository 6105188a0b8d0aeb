"""Connected components of links between integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id it reaches, for every id in ``links`` (a, b).

    Every round, each id tells its neighbours the smallest id around it, and then looks up where
    that id has gone itself, so distances shrink by more than half. Messages are minimums, which
    Spark combines before it shuffles; a hub with many neighbours is therefore no hot key.
    """
    both = stage(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "component-links",
    )
    labels = stage(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")),
        "component-labels",
    )
    while True:
        told = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("heard"))
        )
        nearer = labels.join(told, "id").select(
            "id", "component", F.least("component", "heard").alias("next")
        )
        ahead = labels.select(F.col("id").alias("next"), F.col("component").alias("beyond"))
        moved = stage(
            nearer.join(ahead, "next").select(
                "id", F.col("component").alias("old"), F.least("next", "beyond").alias("component")
            ),
            "component-labels",
        )
        labels = moved.select("id", "component")
        if moved.filter("old != component").isEmpty():
            return labels
