"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellcast.llm.common import staged


def _neighbours_and_minimum(both: DataFrame) -> DataFrame:
    """Each (u, v) with m, the smallest id among u and its neighbours. The minimum is folded before it moves."""
    low = both.groupBy("u").agg(F.min("v").alias("lv"))
    return both.join(low, "u").select("u", "v", F.least("u", "lv").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _neighbours_and_minimum(both)
    return near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _neighbours_and_minimum(down)
    own = near.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return own.filter("u <> v").distinct()


def _edges(links: DataFrame, a: str, b: str) -> DataFrame:
    edges = links.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v"))
    return staged(edges.filter("u <> v").distinct(), "links")


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads from a node with no other edge to one that has none of its own."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("least"))
    return nodes.filter("up > 1 OR up > 0 AND least = 0").isEmpty()


def contracted(links: DataFrame, a: str, b: str, rounds: int = 2) -> DataFrame:
    """``(u, v)``, v < u, after some rounds: edges that connect the nodes with a link exactly as the links do, mostly by stars."""
    edges = _edges(links, a, b)
    for _ in range(rounds):
        edges = staged(_small_star(_large_star(edges)), "stars")
    return edges


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node with a link: component is the smallest id that links reach.

    Null ends and self links are ignored, repeated links count once, an empty table gives no rows. Each
    round is written to the shared folder, so lineage stays short and a lost executor costs one round.
    A hub's row count is folded before its shuffle; joins on it are left to skew handling.
    """
    edges = contracted(links, a, b)
    while not _settled(edges):
        edges = staged(_small_star(_large_star(edges)), "stars")
    # Every edge leads straight to the smallest id of its component.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
