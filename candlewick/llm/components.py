"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import store


def components(links: DataFrame, folder: str) -> DataFrame:
    """node and component (the smallest node reachable) for every node of ``links`` (a, b).

    Each round every node's label becomes the smallest among its neighbours' and, by a jump,
    that label's own label; long chains therefore take a logarithmic number of rounds in practice.
    All steps are aggregates combined map-side and joins that adaptive execution can split.
    """
    edges = store(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{folder}/edges",
    )
    labels = store(
        edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")),
        f"{folder}/labels0",
    )
    number = 0
    while True:
        number += 1
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        # A node's old label may still be above what its neighbours know: tell the label's own node as well.
        told = (
            labels.join(near, "node")
            .select(F.col("component").alias("node"), "near")
            .unionByName(near)
            .groupBy("node")
            .agg(F.min("near").alias("near"))
        )
        better = labels.join(told, "node", "left").select(
            "node", "component", F.least("component", "near").alias("own")
        )
        jump = better.select(F.col("node").alias("own"), F.col("own").alias("next"))
        following = store(
            better.join(jump, "own", "left").select(
                "node", F.least("own", F.coalesce("next", "own")).alias("component"), F.col("component").alias("before")
            ),
            f"{folder}/labels{number}",
        )
        if following.filter("component <> before").isEmpty():
            return following.select("node", "component")
        labels = following.select("node", "component")
