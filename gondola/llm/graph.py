"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.session import materialise

#: Rows that one task should have before a second one is worth its start
TASK_ROWS = 50_000


def short(df: DataFrame, most_rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """A table known to have at most so many rows, in as few tasks as these are worth."""
    tasks = max(1, -(-most_rows // task_rows))
    return df.coalesce(tasks) if tasks < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def components(edges: DataFrame, n_edges: int | None = None) -> DataFrame:
    """node, component (its smallest node) for every node of the edges (a, b), two columns of longs.

    Each step writes its edges, so lineage stays short; the minimum per node is summed up before the
    shuffle, and joins split the edges of a hot node. Loops (a = b) are left out. Steps end once the edges are stars
    around smallest nodes, which no step changes. A step has at most twice as many edges as the one before, and no more
    tasks than they are worth.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    n_edges = edges.count() if n_edges is None else n_edges
    edges = materialise(short(edges.distinct(), n_edges), "edges")
    while not _stars(edges, n_edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        low = materialise(short(low, 2 * n_edges), "low")  # written, so that the join may split a hot node
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = materialise(short(large, n_edges), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.select("a", F.col("low").alias("b")).unionByName(
            small.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        edges = materialise(short(small.distinct(), 2 * n_edges), "small-star")
        n_edges = edges.count()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def joined_components(parts: DataFrame, links: DataFrame, n_links: int) -> DataFrame:
    """The components (node, component) after ``n_links`` new links (a, b) between their nodes, or others.

    Links are contracted to the components they join, so what is walked again has an edge for each of
    these, not for each link of old.
    """
    of = lambda side: parts.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    named = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    named = named.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    moved = materialise(short(components(named, n_links), 2 * n_links), "contracted").select(F.col("node").alias("component"), F.col("component").alias("root"))
    old = parts.join(moved, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    # nodes that were in no component were contracted to themselves
    new = moved.select(F.col("component").alias("node"), F.col("root").alias("component"))
    return old.unionByName(new.join(parts, "node", "left_anti"))


def _stars(edges: DataFrame, n_edges: int) -> bool:
    """Whether every node a of the distinct edges (a > b) has one b, and no b is an a."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return short(ends, 2 * n_edges).filter("up > 1 OR up = 1 AND down = 1").isEmpty()
