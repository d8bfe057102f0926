"""Connected components of a list of links, by alternating large and small stars.

Each half of a round is written to the shared folder, so that lineage stays short and a lost
executor repeats little.  Minima are combined before the shuffle and written as well: a node with
very many neighbours meets its minimum in a join of two plain tables, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.session import kept


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(near: DataFrame, chosen) -> DataFrame:
    """Hang the chosen neighbours b of every a below the least of a and its neighbours."""
    least = kept(near.groupBy("a").agg(F.min("b").alias("least")), "least")
    return near.join(least, "a").select("a", "b", F.least("a", "least").alias("least")).filter(chosen)


def _round(links: DataFrame) -> DataFrame:
    large = _star(_both_ways(links), F.col("b") > F.col("a")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )
    down = kept(large.filter("a > b").distinct(), "links")
    # below a: every neighbour and a itself go to the least neighbour
    near = _star(down, F.lit(True))
    small = near.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
        near.select("a", F.col("least").alias("b"))
    )
    return small.filter("a > b").distinct()


def _state(links: DataFrame) -> tuple:
    """Of the set of links: how many, and two sums that tell sets apart."""
    mixed = F.xxhash64("a", "b")
    row = links.agg(F.count("*"), F.sum(mixed % 1_000_000_007), F.bit_xor(mixed)).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the least node."""
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = kept(ordered.distinct(), "links")
    before = _state(current)
    while before[0]:
        current = kept(_round(current), "links")
        now = _state(current)
        if now == before:
            break
        before = now
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return stars.union(centres)
