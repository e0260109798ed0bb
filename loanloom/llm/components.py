"""Connected components of an edge table, as distributed rounds of labels and jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.storage import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Smallest reachable node per node: edges (a, b) in, (node, label) out, for nodes with an edge.

    Each round passes the smallest label of the neighbours to a node and to the node it points
    at, then jumps to the label's label. Rounds end when no label changes, so the result is
    exact; labels are written to the shared folder after each round.
    """
    both = scratch.store(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = scratch.store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        heard = heard.join(labels, "node")
        offers = heard.select("node", "m").union(heard.select("label", "m")).union(labels.select("node", "label"))
        lower = offers.groupBy("node").agg(F.min("m").alias("label"))
        jumped = lower.join(lower.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left")
        new = scratch.store(jumped.select("node", F.least("label", F.coalesce("next", "label")).alias("label")))
        changed = new.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        scratch.drop(labels)
        labels = new
        if not changed:
            scratch.drop(both)
            return labels


def extend(labels: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Labels after further edges: only the components that these connect are worked out again."""
    left = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    right = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    named = edges.select("a", "b").join(left, "a", "left").join(right, "b", "left")
    named = scratch.store(named.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a <> b").distinct())
    if named.limit(1).count() == 0:
        return labels
    joined = components(named, scratch)
    moved = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("lower")), "label", "left").select(
        "node", F.coalesce("lower", "label").alias("label"))
    return scratch.store(moved.union(joined.join(labels.select("node"), "node", "left_anti").select("node", "label")))
