"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import table


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component. ``links``: (a, b), any order, repeats allowed.

    Labels and links stay DataFrames; each round is written to the shared
    folder, so a lost executor costs one round at most. Minima are partially
    aggregated, and the joins have unique keys on the label side, so a node
    with very many links is split where Spark finds it skewed. Each round
    also replaces a label by that label's own label, which doubles the
    distance that labels travel. NULL nodes are ignored.
    """
    links = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = table(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                 "links")
    labels = table(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy("a").agg(F.min("label").alias("near")).withColumnRenamed("a", "node"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = table(step.join(up, "label").select("node", "old", F.least("label", "up").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.filter(F.col("old") != F.col("label")).isEmpty():
            return labels
