"""Connected components of a graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawdown.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) of every node in edges (a, b).

    Each round points every node to the least of itself and its neighbours, follows the pointers to their ends (each step
    doubles the way) and puts the ends in the place of the nodes. Edges that then join a node to itself are gone, so a star
    costs one round and later rounds read only what is still open. A hub's edges are combined before the shuffle. Rounds are
    written to the shared folder.
    """
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = materialise(edges.select(*ends).distinct(), "edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends_of = _ends(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")))
        labels = ends_of if labels is None else materialise(_through(labels, ends_of), "labels")
        edges = materialise(_contracted(edges, ends_of), "edges")
        if edges.isEmpty():
            return labels


def extended(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """`components` of the edges behind `labels` and of further ones, from the labels: only edges between components count."""
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    new = nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    joined = components(_contracted(edges, labels))
    return materialise(_through(labels.unionByName(new), joined), "labels")


def _ends(pointers: DataFrame) -> DataFrame:
    """Pointers (node, label), each to a node not above it, followed to the nodes that point to themselves."""
    while True:
        following = pointers.select(F.col("node").alias("label"), F.col("label").alias("next"))
        stepped = pointers.join(following, "label").select(
            "node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")
        )
        stepped = materialise(stepped, "labels")
        pointers = stepped.select("node", "label")
        if stepped.filter("moved").isEmpty():
            return pointers


def _through(labels: DataFrame, of_labels: DataFrame) -> DataFrame:
    """Labels replaced by their own labels, where they have one."""
    return labels.join(of_labels.toDF("label", "next"), "label", "left").select(
        "node", F.coalesce("next", "label").alias("label")
    )


def _contracted(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between the labels of their ends; those inside one label are left out."""
    for end in ("a", "b"):
        edges = edges.join(labels.toDF(end, "label"), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.filter("a != b").select(*ends).distinct()
