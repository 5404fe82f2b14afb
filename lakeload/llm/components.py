"""Connected components by alternating large-star and small-star steps (joins and aggregates only).

Every step is written to the shared folder, so a lost executor costs one step. The number of steps grows with the
logarithm of the longest path. A star's centre may have any number of neighbours: minima are combined before the
shuffle, and Spark splits the centre's partition in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm._common import stage


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def _least(edges: DataFrame) -> DataFrame:
    """Each edge (a, b) with m, the smallest of a and its neighbours."""
    least = edges.groupBy(F.col("a").alias("k")).agg(F.least(F.min("b"), F.col("k")).alias("m"))
    # written, so that the join's other side, where a star's centre is a hot key, can be split
    return edges.join(stage(least, "least"), F.col("a") == F.col("k"))


def connected(edges: DataFrame) -> DataFrame:
    """edges (a, b) of any order type -> (node, root): root is the smallest node of the component."""
    edges = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges"
    )
    seen = None
    while (now := _fingerprint(edges)) != seen and now[0]:
        seen = now
        both = edges.union(edges.select("b", "a"))
        # large star: every larger neighbour of a node points to the smallest neighbour
        large = _least(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours point to the smallest of them
        small = _least(large)
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        edges = stage(small.filter("a != b").distinct(), "edges")
    to_root = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return to_root.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
