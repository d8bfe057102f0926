"""Consumer lag per partition: log end minus committed offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.blocked import running
from ledgerline.schemas import LAG_ALERT_THRESHOLD

PARTITION = ["topic", "record_partition"]


def end_offsets(records: DataFrame, as_of: Column) -> DataFrame:
    """Log-end offset per partition at a time: one past the last, for offsets have gaps."""
    return (
        records.filter(F.col("appended_at") <= as_of)
        .groupBy(*PARTITION)
        .agg((F.max("record_offset") + 1).alias("end_offset"))
    )


def lag_of(end: Column, committed: Column) -> Column:
    """Never below zero; a partition without a commit counts from the start."""
    zero = F.lit(0).cast("long")
    return F.greatest(zero, end - F.coalesce(committed, zero))


def by_partition(ends: DataFrame, commits: DataFrame) -> DataFrame:
    """Lag of every partition that has a log end."""
    return ends.join(commits, PARTITION, "left").select(
        *PARTITION,
        "end_offset",
        "committed_offset",
        lag_of(F.col("end_offset"), F.col("committed_offset")).alias("lag"),
    )


def lag_as_of(ends: DataFrame, commits: DataFrame) -> DataFrame:
    """Lag at the time of every commit, whenever it came.

    Log ends (``moment``, ``end_offset``) and commits (``moment``, ``seq``, ``committed_offset``) are put in one
    order of time, ends first, and the last known offsets are carried along it, block by block of a
    day.  An offset never goes back: of commits that overtake each other the highest counts.
    """
    known = ends.select(*PARTITION, "moment", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("seq"), "end_offset")
    done = commits.select(*PARTITION, "moment", F.lit(1).alias("kind"), "seq", "committed_offset")
    rows = known.unionByName(done, allowMissingColumns=True).withColumns({
        "day": F.expr("datediff(moment, DATE '1970-01-01')"), "place": F.struct("moment", "kind", "seq"),
    })
    offsets = {"last_end": F.col("end_offset"), "last_commit": F.col("committed_offset")}
    return running(rows, PARTITION, "day", "place", maxima=offsets).filter("kind = 1").select(
        *PARTITION,
        "seq",
        "moment",
        F.col("last_end").alias("end_offset"),
        F.col("last_commit").alias("committed_offset"),
        lag_of(F.coalesce("last_end", F.lit(0).cast("long")), F.col("last_commit")).alias("lag"),
    )


def total(lags: DataFrame) -> DataFrame:
    return lags.agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))


def alert_count(lag_samples: DataFrame, threshold: int = LAG_ALERT_THRESHOLD) -> DataFrame:
    """Samples at or over the threshold: one count per partition per sample."""
    return lag_samples.agg(F.count_if(F.col("v") >= threshold).alias("lag_alerts"))
