"""Connected components of an edge table, by rounds of hooking and pointer
jumping. Every step is a join or an aggregation over the edges that still
connect different components; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabkit.scratch import Scratch


def _flatten(parent: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """Follow parents until every node points at its root."""
    step = 0
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        jumped = scratch.table(parent.join(up, "parent").select(
            "node", F.col("next").alias("parent"), (F.col("next") != F.col("parent")).alias("moved")), f"{tag}-jump{step}")
        if step:
            scratch.drop(f"{tag}-jump{step - 1}")
        parent = jumped.select("node", "parent")
        step += 1
        if jumped.where("moved").isEmpty():
            return parent


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``: the root is the
    smallest node of the component. Self-loops and repeated edges do no
    harm; a node in no edge has no row. Each round joins every component
    to a smaller neighbour where it has one, so the number of components
    that still have an edge at least halves.
    """
    e = scratch.table(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{tag}-edges0")
    labels = None
    turn = 0
    while not e.isEmpty():
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = scratch.table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                               .select("node", F.least("node", "b").alias("parent")), f"{tag}-hook{turn}")
        root = _flatten(hooked, scratch, f"{tag}-{turn}")
        if labels is None:
            labels = root.select("node", F.col("parent").alias("root"))
        else:
            to = root.select(F.col("node").alias("root"), F.col("parent").alias("higher"))
            labels = scratch.table(labels.join(to, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), f"{tag}-labels{turn}")
        ra = root.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        rb = root.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        e = scratch.table(e.join(ra, "a").join(rb, "b").where("ra <> rb")
                          .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{tag}-edges{turn + 1}")
        turn += 1
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
