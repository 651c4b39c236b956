"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, saved


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> node, label: the same label for connected nodes. Nodes without edges aren't listed.

    Each round sends every node to the least of its neighbours and itself, in the order of a hash, and keeps the edges
    between the images; the image of a component is connected and smaller by a constant factor on average. The rounds'
    small maps are then composed from the last to the first. Every step is a hash aggregation or an equi-join on nodes,
    so no component is gathered anywhere. Empty input gives an empty table.
    """
    code = lambda c: F.xxhash64(c)
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = saved(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", small=True)
    maps: list[DataFrame] = []
    while not now.isEmpty():
        least = both(now).groupBy("a").agg(F.min(F.struct(code("b").alias("h"), F.col("b").alias("n"))).alias("m"))
        to = saved(least.select(F.col("a").alias("node"), F.when(F.struct(code("a").alias("h"), F.col("a").alias("n")) <= F.col("m"), F.col("a")).otherwise(F.col("m.n")).alias("up")), "up", small=True)
        maps.append(to)
        left, right = to.select(F.col("node").alias("a"), F.col("up").alias("x")), to.select(F.col("node").alias("b"), F.col("up").alias("y"))
        after = now.join(left, "a").join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        before, now = now, saved(after, "edges", small=True)
        dropped(before)
    if not maps:
        return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    whole = maps[-1].select("node", F.col("up").alias("label"))
    for to in reversed(maps[:-1]):
        on = whole.select(F.col("node").alias("up"), "label")
        whole = to.join(on, "up", "left").select("node", F.coalesce("label", "up").alias("label"))
    return whole
