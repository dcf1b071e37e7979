"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, materialize


def _least(links: DataFrame) -> DataFrame:
    """Smallest neighbour of each node u of symmetric links (u, v), itself included; only where it is another node."""
    return links.groupBy("u").agg(F.min("v").alias("m")).where("m < u")


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Root (smallest node) of every node that has a link to another.

    links: columns a and b of one orderable type, in any direction, repeated or not. Returns node, root,
    one row for each linked node, roots included. Self-links and links with a null are left out.

    Each round points larger neighbours, then smaller ones, at a node's smallest neighbour, writes the
    links to the shared folder and compares their count and checksum with the round before. Nothing but
    these two numbers comes to the driver, and rounds grow with the logarithm of a component's diameter.
    """
    stars = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links"
    )
    before = _state(stars)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        # Large star: every larger neighbour of u points at u's smallest neighbour (u itself, if it is the least).
        least = _least(both)
        large = (
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
            .join(least, "u", "left")
            .select(F.col("v").alias("hi"), F.coalesce("m", "u").alias("lo"))
            .distinct()
        )
        large = materialize(large, "large-star")
        # Small star: u and its smaller neighbours point at the smallest of them.
        least = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = large.select(F.col("hi").alias("u"), F.col("lo").alias("v")).join(least, "u")
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("hi"), F.col("m").alias("lo")).distinct()
        fresh = materialize(small, "small-star")
        drop(large)
        drop(stars)
        stars, after = fresh, _state(fresh)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Each hi has one lo now.
    out = stars.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        stars.select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    )
    return out.distinct()


def _state(stars: DataFrame) -> tuple:
    row = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
