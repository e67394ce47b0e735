"""Connected components of a graph that no task and no driver holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.skew import lookup_join
from quayside.session import durable


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Each round gives a node the smallest label among itself and its neighbours, then the label of
    that label, so labels travel in leaps. Labels are looked up by their nodes, small tables of them
    by broadcast, and the smallest per node is combined before the shuffle, so a node with very many
    links is no hot spot; the rounds end when no label changes. Links to oneself and repeated links
    do no harm; no links give no rows.
    """
    both = durable(
        links.select("a", "b").union(links.select("b", "a")).distinct(), "links"
    )
    labels = durable(
        both.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while True:
        near = lookup_join(both, labels.withColumnRenamed("node", "b"), ["b"], stored=True).groupBy("a").agg(
            F.min("component").alias("_near")
        )
        met = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("_old"), F.least("component", "_near").alias("_met")
        )
        leap = labels.select(F.col("node").alias("_met"), F.col("component").alias("_far"))
        step = durable(lookup_join(met, leap, ["_met"], stored=True).select(
            "node", F.least("_met", "_far").alias("component"), "_old"
        ), "labels")
        labels = step.select("node", "component")
        if step.filter("component <> _old").isEmpty():
            return labels
