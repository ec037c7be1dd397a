"""Connected components by joins, for links of any number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.operators.lookup import attach
from lumagrid.settings import sized, store, stored_scope

_MAX_ROUNDS = 64


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every end of the links ``(a, b)``: ``root`` is the smallest node reachable.

    In a round each node with links points at the smaller of itself and its smallest
    neighbour, pointers are followed to their ends, each time twice as far, and links then
    join these ends. Every step is written to the checkpoint folder, and only the result stays
    there. Links with a null end are left out; an empty table gives an empty result.
    """
    with stored_scope(links.sparkSession):
        links = links.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends, n_ends = store(both.distinct())
        edges = ends.where(F.col("a") != F.col("b"))
        roots = ends.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
        roots, n_roots = store(sized(roots, n_ends))
        left = n_ends
        for _ in range(_MAX_ROUNDS):
            if not left or edges.isEmpty():
                return store(sized(roots, n_roots), outlives=True)[0]
            point, n_point = _pointed(edges, left)
            moved = attach(
                roots.withColumnRenamed("root", "a"), point, ["a"], how="left", n_rows=n_point
            ).select("node", F.coalesce("root", "a").alias("root"))
            roots, _ = store(sized(moved, n_roots))
            moved = attach(edges, point, ["a"], n_rows=n_point).select(F.col("root").alias("x"), F.col("b").alias("a"))
            moved = attach(moved, point, ["a"], n_rows=n_point).select(F.col("x").alias("a"), F.col("root").alias("b"))
            edges, left = store(sized(moved.where(F.col("a") != F.col("b")).distinct(), left))
        raise RuntimeError("the components did not settle")


def _pointed(edges: DataFrame, n_edges: int) -> tuple[DataFrame, int]:
    """``(a, root)`` for every node of ``edges``: where following smallest neighbours ends."""
    least = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
    point, n_point = store(sized(least, n_edges))
    for _ in range(_MAX_ROUNDS):
        further = point.select(F.col("a").alias("root"), F.col("root").alias("top"))
        ahead = attach(point, further, ["root"], n_rows=n_point)
        moved = F.col("top") != F.col("root")
        ahead, _ = store(sized(ahead.select("a", F.col("top").alias("root"), moved.alias("moved")), n_point))
        point = ahead.drop("moved")
        if ahead.where("moved").isEmpty():
            break
    return point, n_point
