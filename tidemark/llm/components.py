"""Connected components of a link table by repeated contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node, component` of every linked node (bigint); the component is its smallest node.

    Nodes go by their xxhash64, which is one to one on bigint, so that their order
    is a random one whatever the ids say. In each round every node moves to its
    smallest neighbour (or stays), then on to where that one goes, and links are
    mapped along. At least half of the linked nodes are expected to go in a round,
    on a path too; a path of a million takes about fifteen. Hot nodes are safe: a
    round is a min-aggregation with map-side combine, and its joins are between
    written tables, which adaptive execution may split. Null nodes take no part.
    """
    pairs = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    h = lambda c: F.xxhash64(c)
    nodes = Table(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("h", h("node")), "nodes")
    edges = Table(pairs.select(F.least(h("a"), h("b")).alias("a"), F.greatest(h("a"), h("b")).alias("b")).distinct(), "links")
    moved: Table | None = None
    while not edges.df.isEmpty():
        both = edges.df.union(edges.df.select("b", "a")).toDF("node", "other")
        step = Table(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("to")), "step")
        far = Table(step.df.join(step.df.toDF("to", "far"), "to").select("node", F.col("far").alias("to")), "far")
        step.drop()
        if moved is None:
            now = far
        else:
            now = Table(moved.df.join(far.df.toDF("to", "on"), "to", "left").select("node", F.coalesce("on", "to").alias("to")), "moved")
            moved.drop()
        x, y = far.df.toDF("a", "ta"), far.df.toDF("b", "tb")
        new = Table(edges.df.join(x, "a").join(y, "b").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a <> b").distinct(), "links")
        edges.drop()
        if now is not far:
            far.drop()
        moved, edges = now, new
    if moved is None:
        return nodes.df.select("node", F.col("node").alias("component"))
    whole = Table(nodes.df.join(moved.df.toDF("h", "to"), "h").select("node", "to"), "whole")
    names = Table(whole.df.groupBy("to").agg(F.min("node").alias("component")), "names")
    out = Table(whole.df.join(F.broadcast(names.df) if names.small() else names.df, "to").select("node", "component"), "components")
    for t in (nodes, edges, moved, whole, names):
        t.drop()
    return out.df
