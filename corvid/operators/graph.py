"""Graphs: ancestor walks, reachability, closure, cycles and antichains, by rounds over frontiers.

Every round joins what the last one found to the edges, keeps what is new and
writes it to the shared folder, so lineage stays short and a lost executor costs
a re-read.  Selected nodes are walked from, not the whole graph.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.scratch import written


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def ancestors(nodes: DataFrame, start: str) -> DataFrame:
    """(id, depth) of (id, parent): every ancestor of ``start`` with its longest distance; a cycle raises ValueError.

    A round holds each node of a depth once, however many paths lead to it.
    """
    edges = nodes.where("parent is not null").select("id", "parent").distinct()
    level = written(nodes.where(F.col("id") == F.lit(start)).select("id").distinct().withColumn("depth", F.lit(0)), "walk")
    levels = [level]
    while not level.isEmpty():
        level = written(level.join(edges, "id").select(F.col("parent").alias("id"), F.lit(len(levels)).alias("depth")).distinct(), "walk")
        levels.append(level)
        # a walk longer than the nodes it met has met one twice on a path; counted now and then, as it costs a job
        if len(levels) & (len(levels) - 1) == 0 and len(levels) > _union(levels).select("id").distinct().count() + 1:
            raise ValueError(f"the ancestors of {start} have a cycle")
    return _union(levels).groupBy("id").agg(F.max("depth").alias("depth"))


def reached(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(a, b): for every start (column x) the nodes that a path of one edge or more of (a, b) leads to."""
    steps = edges.select(F.col("a").alias("_from"), F.col("b").alias("_to")).distinct()
    frontier = starts.select(F.col("x").alias("a"), F.col("x").alias("b")).distinct()
    found: list[DataFrame] = []
    while True:
        new = frontier.join(steps, F.col("b") == F.col("_from")).select("a", F.col("_to").alias("b")).distinct()
        if found:
            new = new.join(_union(found), ["a", "b"], "left_anti")
        frontier = written(new, "reached")
        if found and frontier.isEmpty():
            return _union(found)
        found.append(frontier)


def closure(edges: DataFrame) -> DataFrame:
    """Every pair (a, b) with a path of one edge or more: as many rows as that is, so for small graphs or trimmed ones.

    A round joins the new pairs to all known ones, so paths double and few rounds are needed.
    """
    new = written(edges.select("a", "b").distinct(), "closure")
    found = [new]
    while not new.isEmpty():
        known = _union(found)
        longer = [new.join(known.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b")), known.join(new.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))]
        new = written(_union(longer).distinct().join(known, ["a", "b"], "left_anti"), "closure")
        found.append(new)
    return _union(found)


def on_cycles(edges: DataFrame) -> DataFrame:
    """(node) of every node on a cycle: nodes that nothing leads to, or that lead nowhere, go first, round by round."""
    left = written(edges.select("a", "b").distinct(), "cycles")
    n, before = left.count(), -1
    while n != before:
        left = written(left.join(left.select(F.col("b").alias("a")).distinct(), "a", "left_semi").join(left.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a", "b"), "cycles")
        n, before = left.count(), n
    return closure(left).where("a = b").select(F.col("a").alias("node"))


def double_counted(edges: DataFrame, selected: DataFrame) -> DataFrame:
    """(above, below): selected nodes (column x) of which the first reaches the second."""
    found = reached(edges, selected).select(F.col("a").alias("above"), F.col("b").alias("below"))
    return found.join(selected.select(F.col("x").alias("below")).distinct(), "below", "left_semi").select("above", "below")


def orphans(nodes: DataFrame, key: str = "id", parent: str = "parent") -> DataFrame:
    """Rows whose parent isn't null and is nobody's key."""
    return nodes.where(F.col(parent).isNotNull()).join(nodes.select(F.col(key).alias(parent)).distinct(), parent, "left_anti")
