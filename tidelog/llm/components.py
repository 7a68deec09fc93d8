"""Connected components of a graph given as pairs, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelog.llm import shared

def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """node, root for every node of links (a, b); root is the least node of its component.

    Large and small stars take turns: each node hands its greater neighbours, then its
    lesser ones, to the least node it knows. Every turn is written to the shared folder, so
    lineage stays short; the number of turns grows with the logarithm of the nodes. An empty
    table gives an empty one; loops and repeated pairs change nothing. rows: how many links there
    are, if that is known; it sets the number of tasks alone.
    """
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    links = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, now = shared.measured(links if rows is None else shared.sized(links, rows), "links", total=total)
    while now["rows"]:
        few = lambda df: shared.sized(df, now["rows"])  # noqa: B023, E731
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = few(both.groupBy("u").agg(F.min("v").alias("m"))).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(shared.side(least, now["rows"] * 2), F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = few(few(large).distinct())
        least = few(large.groupBy("u").agg(F.min("v").alias("m"))).select(F.col("u").alias("_u"), "m")
        small = large.join(shared.side(least, now["rows"] * 2), F.col("u") == F.col("_u")).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        following, then = shared.measured(few(few(small.where("u != v")).distinct()), "links", total=total)
        shared.discard(edges)
        edges, before, now = following, now, then
        if now == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def merged(found: DataFrame, links: DataFrame, rows: int, n_links: int) -> DataFrame:
    """components of found (node, root; so many rows) and further links (a, b) together.

    Only the links between components that differ are looked at, with components as nodes.
    """
    own = lambda x: shared.side(found.select(F.col("node").alias(f"_{x}"), F.col("root").alias(f"_root_{x}")), rows)
    ends = links.join(own("a"), F.col("a") == F.col("_a"), "left").join(own("b"), F.col("b") == F.col("_b"), "left")
    ends = ends.select(F.coalesce("_root_a", "a").alias("a"), F.coalesce("_root_b", "b").alias("b"))
    joined, seen = shared.measured(shared.sized(components(ends, n_links), n_links), "joined")
    new = shared.side(joined.select(F.col("node").alias("_node"), F.col("root").alias("_root")), seen["rows"])
    moved = found.join(new, F.col("root") == F.col("_node"), "left").select("node", F.coalesce("_root", "root").alias("root"))
    return shared.sized(moved.union(joined.join(shared.side(found.select("node"), rows), "node", "left_anti")), rows)
