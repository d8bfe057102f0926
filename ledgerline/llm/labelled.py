"""The bounded sample of labelled rows that the classifiers learn from.

Rows whose crc32 of the doc_id's text is divisible by 5 are held out and never sampled.  Of each
label the rows with the smallest hash of their doc_id are taken, up to `per_label`, with texts of at
most `longest` bytes: what the driver holds is bounded by these two parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, name: str, per_label: int, longest: int
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """[(text, label)] in a fixed order, and how many rows each label has to learn from."""
    usable = labels.select("doc_id", F.col(name).cast("int").alias("label")).filter(
        ~held_out(F.col("doc_id")) & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()
    )
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    chosen = None
    for label in (0, 1):
        rows = usable.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        chosen = rows if chosen is None else chosen.union(rows)
    # at most 2 * per_label narrow rows are broadcast
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen.dropDuplicates(["doc_id"])), "doc_id"
    )
    # rows that repeat a doc_id count once
    sample = texts.filter(F.octet_length("text") <= longest).dropDuplicates(["doc_id"]).collect()
    sample.sort(key=lambda r: r["doc_id"])
    return [(r["text"], r["label"]) for r in sample], sizes
