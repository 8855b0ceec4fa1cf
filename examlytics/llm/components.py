"""Connected components by hooking to the smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from examlytics.llm.store import keep


def flatten_parents(parents: DataFrame) -> DataFrame:
    """(node, root) from a forest (node, parent) with parent < node: pointers double until none moves."""
    cur = keep(parents.select("node", F.col("parent").alias("root")), "parents")
    while True:
        up = cur.select(F.col("node").alias("root"), F.col("root").alias("above"))
        cur = keep(cur.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "parents")
        if cur.filter("moved").isEmpty():
            return cur.select("node", "root")
        cur = cur.select("node", "root")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the smallest of its component; edges are (a, b).

    Each round every node takes its smallest smaller neighbour as parent
    (a pre-aggregated minimum, so a node with many edges is no hot key),
    chains are flattened, and edges are redrawn between roots, until no edge
    joins two roots. The number of rounds grows with the logarithm of the
    longest chain of local minima.
    """
    done = None
    left = keep(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while not left.isEmpty():
        step = flatten_parents(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")))
        if done is None:
            done = step
        else:
            moved = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
            old = done.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            done = keep(old.unionByName(step), "components")
        root = step.select(F.col("node"), "root")
        a = left.join(root.withColumnRenamed("node", "a"), "a", "left").select(F.coalesce("root", "a").alias("a"), "b")
        b = a.join(root.withColumnRenamed("node", "b"), "b", "left").select("a", F.coalesce("root", "b").alias("b"))
        left = keep(b.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return done if done is not None else left.select(F.col("b").alias("node"), F.col("a").alias("root"))
