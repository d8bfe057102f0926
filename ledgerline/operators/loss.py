"""Where orders were lost, from digests of sets that are halved down to the ranges that differ.

Two sets of orders that should be equal (the first copies in the log, the rows of the ledger) are
digested per log partition and range of offsets: how many, the sum and the exclusive or of their
hashes, and a theta sketch.  Digests of neighbouring ranges merge, so each level of the tree is made
from the one below it and the rows are read once.  The levels are compared from the top, and only
below ranges that differ is the next one looked at.  The rows of the differing ranges at the bottom,
and no others, are read in full and compared exactly.

A tree can be written with each batch and merged later: it is a hundredth of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.session import kept

LEAF = 64  # offsets in a range at the bottom
FAN = 16  # ranges that make one on the level above

RANGE = ["record_partition", "range"]
_HASH = "xxhash64(order_id, record_offset)"
# A sum of hashes may pass 64 bits; decimals hold it for any number of rows.
_TOTAL = "decimal(38, 0)"


@dataclass(frozen=True)
class Tree:
    """Digests of one set of orders; levels[0] has the ranges of `leaf` offsets."""

    levels: list[DataFrame]
    leaf: int
    fan: int


def _leaves(orders: DataFrame, leaf: int) -> DataFrame:
    return orders.groupBy("record_partition", F.expr(f"record_offset div {leaf}").alias("range")).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"cast(sum(cast({_HASH} as decimal(20, 0))) as {_TOTAL})").alias("total"),
        F.expr(f"bit_xor({_HASH})").alias("mixed"),
        F.theta_sketch_agg("order_id").alias("sketch"),
    )


def _above(level: DataFrame, fan: int) -> DataFrame:
    return level.groupBy("record_partition", F.expr(f"`range` div {fan}").alias("range")).agg(
        F.sum("n").alias("n"),
        F.expr(f"cast(sum(total) as {_TOTAL})").alias("total"),
        F.expr("bit_xor(mixed)").alias("mixed"),
        F.theta_union_agg("sketch").alias("sketch"),
    )


def digest_tree(orders: DataFrame, height: int, leaf: int = LEAF, fan: int = FAN) -> Tree:
    """Written digests of orders (order_id, record_partition, record_offset) on `height` levels."""
    levels = [kept(_leaves(orders, leaf), "digests")]
    while len(levels) < height:
        levels.append(kept(_above(levels[-1], fan), "digests"))
    return Tree(levels, leaf, fan)


def height_for(last_offset: int | None, leaf: int = LEAF, fan: int = FAN) -> int:
    """Levels up to one range a partition."""
    height, ranges = 1, (last_offset or 0) // leaf + 1
    while ranges > 1:
        height, ranges = height + 1, -(-ranges // fan)
    return height


def differing(sent: Tree, held: Tree) -> DataFrame:
    """Ranges at the bottom whose digests differ: counts of both sides and how many orders are missing.

    ``about_missing`` comes from the sketches: exact in ranges of fewer than 4,096 orders.
    """
    found = None
    for a, b in zip(reversed(sent.levels), reversed(held.levels)):
        if found is not None:
            above = found.select(F.col("record_partition").alias("_p"), F.col("range").alias("_r"))
            inside = (F.col("record_partition") == F.col("_p")) & (F.expr(f"`range` div {sent.fan}") == F.col("_r"))
            a, b = (x.join(above, inside, "left_semi") for x in (a, b))
        found = kept(_compared(a, b), "differing")
    return found.select(
        *RANGE,
        (F.col("range") * sent.leaf).alias("first_offset"),
        ((F.col("range") + 1) * sent.leaf).alias("past_offset"),
        "sent", "held", "about_missing",
    )


def _compared(a: DataFrame, b: DataFrame) -> DataFrame:
    theirs = b.select(*RANGE, *[F.col(c).alias(f"_{c}") for c in ("n", "total", "mixed", "sketch")])
    same = F.lit(True)
    for c in ("n", "total", "mixed"):
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    missing = (
        F.when(F.col("sketch").isNull(), F.lit(0).cast("long"))
        .when(F.col("_sketch").isNull(), F.col("n"))
        .otherwise(F.theta_sketch_estimate(F.theta_difference("sketch", "_sketch")))
    )
    zero = F.lit(0).cast("long")
    return a.join(theirs, RANGE, "full").filter(~same).select(
        *RANGE,
        F.coalesce("n", zero).alias("sent"),
        F.coalesce("_n", zero).alias("held"),
        missing.alias("about_missing"),
    )


def _hull(found: DataFrame) -> Column:
    """Offsets between the first and the last differing range of each partition, for the scan."""
    ends = found.groupBy("record_partition").agg(F.min("first_offset"), F.max("past_offset")).collect()  # one row a log partition
    hull = F.lit(False)
    for partition, first, past in ends:
        hull |= (F.col("record_partition") == partition) & (F.col("record_offset") >= first) & (F.col("record_offset") < past)
    return hull


def rows_in(orders: DataFrame, found: DataFrame, leaf: int = LEAF) -> DataFrame:
    """The rows of the differing ranges; a scan gets the partitions and offsets as filters."""
    ranges = found.select(*RANGE)
    near = orders.filter(_hull(found)).withColumn("range", F.expr(f"record_offset div {leaf}"))
    return near.join(ranges, RANGE, "left_semi").drop("range")


COLUMNS = ["order_id", "record_partition", "record_offset"]


def lost_orders(sent: DataFrame, held: DataFrame, found: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Orders of the differing ranges that one side lacks: ``lost`` ones were sent, ``unsent`` ones weren't."""
    rows = [rows_in(side.select(*COLUMNS), found, leaf).withColumn("side", F.lit(i)) for i, side in enumerate((sent, held))]
    both = rows[0].union(rows[1]).groupBy(*COLUMNS).agg(F.min("side").alias("low"), F.max("side").alias("high"))
    verdict = F.when(F.col("low") == 0, "lost").otherwise("unsent")
    return both.filter("low = high").select(*COLUMNS, verdict.alias("verdict"))


def find_loss(sent: DataFrame, held: DataFrame, leaf: int = LEAF, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(differing ranges, lost and unsent orders) of two written sets of orders."""
    last = max(side.agg(F.max("record_offset")).first()[0] or 0 for side in (sent, held))
    height = height_for(last, leaf, fan)
    found = kept(differing(digest_tree(sent, height, leaf, fan), digest_tree(held, height, leaf, fan)), "ranges")
    return found, lost_orders(sent, held, found, leaf)
