"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import replaced


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named
    after its smallest node.

    Large-star and small-star steps take turns until the edges stay the same, which
    takes a number of rounds that grows with the logarithm of the nodes. A step
    keeps no neighbourhood together: the smallest neighbour is an aggregate that
    is joined back. Every round is written to the shared folder, where it takes the
    place of the one before.
    """
    folder: list[str] = []
    edges = replaced(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
        folder,
    )
    before = fingerprint(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        # Large star: larger neighbours move to the smallest of the neighbourhood.
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.filter("a <> b").distinct()
        # Small star: smaller neighbours and the node itself do.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(small.select("a", F.col("m").alias("b"))).distinct()
        edges = replaced(moved, "edges", folder)
        after = fingerprint(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
    ).first()
    return tuple(row)
