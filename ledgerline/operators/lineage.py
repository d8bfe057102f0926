"""What became of each dead letter over all its replays.

A replay sends a dead letter again under a new key.  The record that comes of it is applied, or is
a dead letter once more and may be replayed in its turn: a chain.  Chains are followed one link
at a time, with every chain still open in one join; what a step found is written before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.session import kept

APPLIED, REPEATED, WAITING, IN_FLIGHT, DROPPED = "applied", "repeated", "waiting", "in flight", "dropped"


def replay_links(replay_log: DataFrame, arrived: DataFrame) -> DataFrame:
    """Every replay with the position of the record that came of it, null while none has arrived.

    ``replay_log`` has ``id, replay_key``, ``arrived`` has ``ingest_seq, record_key``; a replay
    that the log repeats is one replay, a key that arrived twice counts with its first position.
    Positions rise along a chain, so an arrival before what was sent is none of it.
    """
    first = arrived.groupBy(F.col("record_key").alias("replay_key")).agg(
        F.min("ingest_seq").alias("next_id")
    )
    later = F.when(F.col("next_id") > F.col("id"), F.col("next_id"))
    sent = replay_log.select("id", "replay_key").distinct().join(first, "replay_key", "left")
    return sent.withColumn("next_id", later)


def lineage(quarantine: DataFrame, links: DataFrame, applied: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per original dead letter: replays, depth of the chain, last position and outcome.

    An original is a dead letter that no replay led to.  ``applied`` has the ``ingest_seq`` of ledger
    rows, ``orders`` that of every record that decodes.  Outcomes: *applied*; *repeated*, a good
    record of an order that the ledger had; *waiting*, a dead letter nobody replayed; *in flight*,
    sent and not arrived; *dropped*, arrived as none of these.  A letter that was replayed
    several times has several ends; the first in this order is its outcome.
    """
    links = kept(links, "links")
    dead = kept(quarantine.select("id").distinct(), "dead")
    roots = dead.join(links.select(F.col("next_id").alias("id")), "id", "left_anti")
    open_ends = kept(roots.select(F.col("id").alias("original"), "id", F.lit(0).alias("depth")), "chain")
    seen = open_ends
    while not open_ends.isEmpty():
        step = open_ends.join(links, "id").select(
            "original", F.col("next_id").alias("id"), (F.col("depth") + 1).alias("depth")
        )
        open_ends = kept(step, "chain")
        seen = seen.unionByName(open_ends)
    went_on = links.select("id", F.lit(True).alias("went_on")).distinct()
    states = (
        seen.join(went_on, "id", "left")
        .join(dead.withColumn("dead", F.lit(True)), "id", "left")
        .join(applied.select(F.col("ingest_seq").alias("id"), F.lit(True).alias("applied")).distinct(), "id", "left")
        .join(orders.select(F.col("ingest_seq").alias("id"), F.lit(True).alias("good")).distinct(), "id", "left")
    )
    rank = (
        F.when(F.col("went_on"), None).when(F.col("applied"), 1).when(F.col("good"), 2)
        .when(F.col("dead"), 3).when(F.col("id").isNull(), 4).otherwise(5)
    )
    names = F.array(*map(F.lit, (APPLIED, REPEATED, WAITING, IN_FLIGHT, DROPPED)))
    return states.groupBy("original").agg(
        F.count_if(F.col("depth") > 0).alias("replays"),
        F.max("depth").alias("depth"),
        F.max("id").alias("last_id"),
        F.element_at(names, F.min(rank)).alias("outcome"),
    )
