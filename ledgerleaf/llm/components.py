"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.scratch import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the
    smallest node of the component.

    Each round a node takes the smallest label among its neighbours and of that
    the label it had, so that chains shrink fast. Labels are written between
    rounds, so that no lineage grows and both sides of every join are shuffled
    for it: adaptive execution can split a node that has very many edges.
    """
    one = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one = materialize(one, "edges")
    # A node's smaller neighbours are tied to the smallest of them: where many
    # nodes have the same neighbours, few edges are left.
    tied = one.join(one.groupBy("b").agg(F.min("a").alias("least")), "b")
    pairs = tied.select(F.col("least").alias("a"), "b").union(tied.filter("a != least").select(F.col("least").alias("a"), F.col("a").alias("b")))
    one = materialize(pairs.distinct(), "edges")
    both = one.select("a", "b").union(one.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "labels"
    )
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("offered"))
        better = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("root").alias("before"), F.least("root", "offered").alias("root")
        )
        heads = labels.select(F.col("node").alias("head"), F.col("root").alias("further"))
        jumped = better.join(heads, better["root"] == heads["head"])
        now = materialize(jumped.select("node", "before", F.col("further").alias("root")), "labels")
        labels = now.select("node", "root")
        if now.filter("root != before").isEmpty():
            return labels
