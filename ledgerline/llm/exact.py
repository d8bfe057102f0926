"""Exact de-duplication by recipes of content-defined chunks (DataFrame functions only).

A text is cut where its own content says so (after the end of a sentence or line, once a
chunk has its least length), so equal texts have equal chunks.  A chunk's identifier is
its SHA-256; the identifiers are verified by bringing each distinct chunk together once
and looking for two contents under one identifier.  A document is then the ordered list
of its identifiers, some 32 bytes a kilobyte, and only these lists are grouped and joined:
no text is moved for the comparison.

A hot group is combined before its shuffle (`max` and `count` have fixed-width buffers).  The
groups are written, so the members are joined to a plain table: both sides of that join are shuffled
for it alone, and Spark splits a skewed one.

Defined cases: a null text is an empty one, and empty texts are equal to each other; a null
doc_id is kept only by a group without any other id; repeated rows each get a row and count
in `group_size`; columns besides doc_id and text are not looked at; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.session import kept

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty.  Pure ASCII takes the faster built-in."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def chunks_of(text: Column, least: int = 256, most: int = 2048) -> Column:
    """Ordered chunks whose concatenation is the text."""
    cut = rf"(?s).{{{least},{most - 1}}}?[.!?\n](?=\s)|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def verify_identifiers(docs: DataFrame) -> None:
    """Compare the contents of all chunks that share an identifier; fail if two differ.

    Each distinct chunk is moved once, repeated ones are combined before the shuffle.
    """
    store = (
        docs.select(F.explode(chunks_of(lower_ascii(F.col("text")))).alias("chunk"))
        .select(identifier(F.col("chunk")).alias("id"), "chunk")
        .distinct()
    )
    clash = store.groupBy("id").count().filter("count > 1").limit(1)
    if clash.count():
        raise ValueError("two different chunks have one SHA-256; the recipes can't be trusted")


def recipes(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, recipe: one narrow row per document."""
    text = lower_ascii(F.col("text"))
    return docs.select(
        "doc_id",
        F.sha2(text, 256).alias("text_sha256"),
        F.transform(chunks_of(text), identifier).alias("recipe"),
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_chunks for every row of docs."""
    narrow = docs.select("doc_id", "text")
    verify_identifiers(narrow)
    listed = kept(recipes(narrow), "recipes")
    groups = kept(
        listed.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "groups",
    )
    return listed.join(groups, "recipe").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        F.size("recipe").alias("n_chunks"),
    )


def keep_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is in `ids`; rows with equal id and text become one.

    The id travels in a struct, in which null equals null, for the join and for what follows it:
    texts are shuffled once.
    """
    chosen = ids.select(F.struct("doc_id").alias("_id")).distinct()
    held = docs.withColumn("_id", F.struct("doc_id")).join(chosen, "_id", "left_semi")
    return held.dropDuplicates(["_id", "text"]).select(*docs.columns)


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts, the one with the largest doc_id."""
    return keep_rows(docs, exact_groups(docs).filter("kept"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("n_chunks")


OP6_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS s FROM documents
), g AS (SELECT s, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY s)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept,
       sha256(t.s) AS text_sha256
FROM t JOIN g USING (s)
"""
