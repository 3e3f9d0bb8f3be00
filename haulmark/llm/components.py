"""Connected components of a graph that only ever exists as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.session import pin


def _hooks(edges: DataFrame) -> DataFrame:
    """Every node with a smaller neighbour, and the root it reaches by going to the smallest neighbour again and again."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hooks = pin(
        both.groupBy("a").agg(F.min("b").alias("parent")).filter("parent < a").withColumnRenamed("a", "node"), "hooks"
    )
    while True:
        above = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        hooks = pin(
            hooks.join(above, "parent", "left").select(
                "node", F.coalesce("top", "parent").alias("parent"), F.col("top").isNotNull().alias("moved")),
            "hooks",
        )
        if hooks.filter("moved").isEmpty():
            return hooks.select("node", "parent")
        hooks = hooks.select("node", "parent")


def relabel(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``df`` with each value of ``column`` replaced by its label, if it has one (``labels``: node, label)."""
    named = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return (
        df.join(named, df[column] == named["_node"], "left")
        .withColumn(column, F.coalesce("_label", column)).drop("_node", "_label")
    )


def merge_components(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``labels`` (node, label) after adding ``edges`` (a, b); the label is the smallest node of the component.

    Rounds of hooking and contraction: each at least halves the nodes that still have edges.  Nodes without a row are
    their own label.  Every round is stored in the shared folder.
    """
    if labels is not None:
        edges = relabel(relabel(edges, "a", labels), "b", labels)
    edges = pin(edges.filter("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        hooks = _hooks(edges).withColumnRenamed("parent", "label")
        if labels is None:
            labels = hooks
        else:
            moved = relabel(labels, "label", hooks)
            labels = pin(moved.unionByName(hooks.join(labels, "node", "left_anti")), "labels")
        edges = pin(relabel(relabel(edges, "a", hooks), "b", hooks).filter("a <> b").distinct(), "edges")
    return labels
