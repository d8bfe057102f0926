"""Bloom filters of sets of keys as rows of 64-bit words, built and probed by plain aggregates and joins.

A key sets five bits in each of two words.  There is half a word or more a key, so a key that isn't in
a set passes its filter about once in 100,000 times; on disk a filter takes some five bytes a key.
Filters of sets of any size lie in one table; their number of words is a power of two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEYS_A_WORD = 2
LEAST_BITS = 4  # log2 of the fewest words of a filter
BITS = 5  # set in each of a key's two words


def _word(which: int) -> Column:
    return F.expr(f"xxhash64(order_id, {which}) & (shiftleft(1L, size_bits) - 1)")


def _mask(which: int) -> Column:
    h = f"xxhash64(order_id, {which + 16})"
    return F.expr(" | ".join(f"shiftleft(1L, int(shiftright({h}, {6 * i}) & 63))" for i in range(BITS)))


def _probes(keys: DataFrame) -> DataFrame:
    """Two rows a key: the word it goes to, and the bits it sets there."""
    pair = F.array(*[F.struct(F.lit(i).alias("which"), _word(i).alias("word"), _mask(i).alias("mask")) for i in (0, 1)])
    return keys.select("*", F.inline(pair))


def filter_words(sets: DataFrame) -> DataFrame:
    """batch_id, size_bits, word, bits: the filters of the sets of order_id told apart by batch_id."""
    size = F.expr(f"greatest({LEAST_BITS}, int(ceil(log2(count(1) / {KEYS_A_WORD}))))")
    sizes = sets.groupBy(F.col("batch_id").alias("of")).agg(size.alias("size_bits"))
    keyed = sets.join(sizes, F.col("batch_id") == F.col("of")).select("batch_id", "order_id", "size_bits")
    return _probes(keyed).groupBy("batch_id", "size_bits", "word").agg(F.expr("bit_or(mask)").alias("bits"))


def possible(keys: DataFrame, filters: DataFrame, sizes: set[int]) -> DataFrame:
    """batch_id, order_id: the sets whose filter a key passes.  Keys are unique, `sizes` are the filters'."""
    every = F.array(*map(F.lit, sorted(sizes)))  # powers of two: 60 at most
    tests = _probes(keys.select("order_id", F.explode(every).alias("size_bits")))
    hits = tests.join(filters, ["size_bits", "word"]).filter("bits & mask = mask")
    return hits.groupBy("batch_id", "order_id").agg(F.count(F.lit(1)).alias("words")).filter("words = 2").drop("words")
