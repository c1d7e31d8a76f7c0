"""Connected components of a link table by alternating star rounds; nothing passes through the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import written


def _hang(pairs: DataFrame) -> DataFrame:
    """Per node (``u``) hang every listed ``v`` under the smallest of ``u`` and its ``v``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
    return pairs.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node with a link; the root is the smallest node reachable. links: columns ``a, b``.

    A large-star round hangs the larger neighbours of each node under its smallest one, a small-star round the smaller
    ones; both shrink the links to stars in a number of rounds that grows with the logarithm of the longest path. Every
    round is a written table. Links to itself, repeated links and null ends are ignored; no links give no rows.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links"
    )
    state = None
    while True:
        print_of = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if tuple(print_of) == state or not print_of["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = tuple(print_of)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both).filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        down = _hang(large)
        small = down.filter("v > _m").select(F.col("v").alias("u"), F.col("_m").alias("v")).unionByName(
            down.select("u", F.col("_m").alias("v"))
        )
        edges = written(small.filter("u > v").distinct(), "stars")
