"""Connected components of links between values, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.session import stage


def components(links: DataFrame) -> DataFrame:
    """(value, root) for every value in ``links`` (a, b); values of one component share one root.

    Each round maps every value to the least among itself and its neighbours and carries the links over
    to what they map to, so the graph shrinks until no link is left; the maps are then chained. The order
    is that of a hash, which keeps rounds few also along chains. Every round is written.
    """
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    edges = stage(links.where("a <> b").select("a", "b").distinct(), "links")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(order("b")).alias("m"))
        target = stage(least.select(F.col("a").alias("value"), F.least(order("a"), "m").getField("v").alias("target")), "targets")
        maps.append(target)
        moved = edges.join(target.withColumnsRenamed({"value": "a", "target": "ta"}), "a")
        moved = moved.join(target.withColumnsRenamed({"value": "b", "target": "tb"}), "b")
        edges = stage(moved.where("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct(), "links")
    if not maps:
        return links.select(F.col("a").alias("value"), F.col("a").alias("root")).limit(0)
    roots = maps[-1].select("value", F.col("target").alias("root"))
    for earlier in reversed(maps[:-1]):
        joined = earlier.join(roots.withColumnRenamed("value", "target"), "target", "left")
        roots = stage(joined.select("value", F.coalesce("root", "target").alias("root")), "roots")
    return roots
