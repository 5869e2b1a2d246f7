"""Connected components of a graph of links, by repeated contraction over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Scratch, skewed_join


def components(edges: DataFrame, scratch: Scratch | None = None, jumps: int = 2) -> DataFrame:
    """(node, component) for every node of `edges` (a long, b long): the smallest node it is connected with.

    A round lets each node point to the one of smallest hash among itself and its neighbours, follows pointers `jumps`
    times, and replaces the ends of every edge by what they point to. The order of hashes is random with respect to the
    graph, so a round leaves a fraction of the nodes even where ids run along a chain, and rounds grow with the logarithm
    of the largest component. Hubs, to which most nodes may point, are dealt over several tasks.

    Defined cases: an edge from a node to itself and edges with a null end link nothing and name no node; repeated edges
    count once; no edges give no rows."""
    scratch = scratch or Scratch(edges.sparkSession, "components")
    apart = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = scratch.written(apart.distinct(), "edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c).alias("rank"), F.col(c).alias("to"))
        best = both.groupBy("a").agg(F.min(ranked("b")).alias("near"))
        to = best.select(F.col("a").alias("node"), F.least(ranked("a"), "near")["to"].alias("to"))
        for _ in range(jumps):
            next_to = to.select(F.col("node").alias("to"), F.col("to").alias("further"))
            to = skewed_join(to, next_to, ["to"], ["node"]).select("node", F.col("further").alias("to"))
        to = scratch.written(to, "pointers")
        rounds.append(to)
        a, b = to.select(F.col("node").alias("a"), F.col("to").alias("ta")), to.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = skewed_join(skewed_join(left, a, ["a"], ["b"]), b, ["b"], ["a"])
        left = scratch.written(moved.where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = rounds[0].select("node", F.col("to").alias("root"))
    for to in rounds[1:]:
        step = to.select(F.col("node").alias("root"), F.col("to").alias("further"))
        labels = skewed_join(labels, step, ["root"], ["node"], "left").select("node", F.coalesce("further", "root").alias("root"))
    least = labels.groupBy("root").agg(F.min("node").alias("component"))
    return skewed_join(labels, least, ["root"], ["node"]).select("node", "component")
