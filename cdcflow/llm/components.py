"""Connected components of a graph given as edges, by minimum labels that jump along themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.frames import saved

MOST_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of its component, for every node in ``edges`` (columns a, b).

    Each round takes the least label among a node's neighbours and then that label's own label, so the rounds grow with the
    logarithm of a component's width. Minimums are taken before each shuffle, so a node with very many edges is cheap.
    Every round is a written table. An empty frame gives an empty result; an edge with a null end is ignored.
    """
    edges = saved(edges.where("a is not null and b is not null"), "edges")
    both = edges.union(edges.select("b", "a")).select("a", "b")
    labels = saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    for _ in range(MOST_ROUNDS):
        offered = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("offer"))
        nearest = labels.join(offered, labels.node == offered.a, "left").select(
            "node", F.col("label").alias("old"), F.least("label", "offer").alias("label")
        )
        at = labels.select(F.col("node").alias("at"), F.col("label").alias("next"))
        new = saved(
            nearest.join(at, nearest.label == at["at"], "left").select("node", F.least("label", "next").alias("label"), "old"), "labels"
        )
        labels = new.select("node", "label")
        if new.where("label != old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
