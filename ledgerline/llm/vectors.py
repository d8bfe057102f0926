"""Vector code compression: four codes of one byte a vector, with exact nearest codebook entries.

Components become integers, a vector is cut into four equal parts, and each part is written as the
index of its nearest entry in the codebook of that part.  The search slices and intersects: each
dimension's coordinates of the entries are sorted and carry, for every prefix of that order, a
bitmask of the entries in it.  A radius picks a range of the order in each dimension, which is the
difference of two prefix masks; the masks of all dimensions are intersected, and what is left holds
every entry within the radius.  The first radius is the distance to the best of the entries next to
the part in one coordinate each, so the nearest entry and all its ties are among the candidates, and
their full distances decide.  Everything is in 64-bit integers: no rounding, no order of adding.

A round is one pass: a task adds up its parts per entry and sends one row per entry and position,
which Spark adds up.  The driver holds the codebooks only, 256 vectors.  The integer vectors are
written once; the codes are written before the errors are added up per label.

Defined cases: rows whose vector is null or holds a null, NaN or infinite component are dropped;
shorter vectors are filled up with zeros to the longest one's length, rounded up to a multiple of
four; integers beyond +-2^27 count as +-2^27, so that no distance leaves 64 bits; with fewer than
256 rows the codebooks have as many entries; rows in the first codebook are taken by vec_id (null
last), then by vector, repeated ones too; null labels form one group; other columns are not looked
at; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.session import kept

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
FARTHEST = 1 << 27
BLOCK = 128  # vectors whose candidates are held at once


class Slices:
    """One part's codebook, with its coordinates sorted and masked for exact search."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count, width = entries.shape
        words = (count + 63) // 64
        bit = np.zeros((count, words), np.uint64)
        at = np.arange(count)
        bit[at, at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, 0)
        none = np.zeros((1, words), np.uint64)
        self.prefix = [
            np.concatenate([none, np.bitwise_or.accumulate(bit[self.order[:, d]], axis=0)]) for d in range(width)
        ]
        self.all = bit.sum(axis=0, dtype=np.uint64)

    def _distance(self, vectors: np.ndarray, index: np.ndarray | int) -> np.ndarray:
        apart = vectors - self.entries[index]
        return (apart * apart).sum(axis=1)

    def radius(self, vectors: np.ndarray) -> np.ndarray:
        """No less than the distance to the nearest entry: the best of one neighbour a dimension."""
        best = self._distance(vectors, 0)
        for d in range(vectors.shape[1]):
            at = np.minimum(np.searchsorted(self.sorted[:, d], vectors[:, d]), len(self.entries) - 1)
            best = np.minimum(best, self._distance(vectors, self.order[at, d]))
        return np.sqrt(best.astype(np.float64)).astype(np.int64) + 1

    def candidates(self, vectors: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry) of all entries within the radius in each dimension, ascending."""
        masks = np.repeat(self.all[None, :], len(vectors), axis=0)
        for d, prefix in enumerate(self.prefix):
            low = np.searchsorted(self.sorted[:, d], vectors[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], vectors[:, d] + radius, "right")
            masks &= prefix[high] ^ prefix[low]
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        return np.nonzero(bits)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of the nearest entry, the lowest of equally near ones."""
        entries, distances = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)
        for start in range(0, len(vectors), BLOCK):
            block = vectors[start : start + BLOCK]
            row, entry = self.candidates(block, self.radius(block))
            distance = self._distance(block[row], entry)
            first = np.searchsorted(row, np.arange(len(block)))
            best = np.minimum.reduceat(distance, first)
            hits = np.flatnonzero(distance == best[row])
            _, at = np.unique(row[hits], return_index=True)
            entries[start : start + BLOCK] = entry[hits[at]]
            distances[start : start + BLOCK] = best
        return entries, distances


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, v: whole vectors of integers, the others dropped."""
    whole = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    component = F.expr(
        f"transform(embedding, x -> bigint(floor(greatest(-{FARTHEST}d, least({FARTHEST}d, double(x) * {SCALE})))))"
    )
    return embeddings.filter(F.col("embedding").isNotNull() & whole).select(
        "vec_id", "label", component.alias("v")
    )


def _parts_of(column: pa.ListArray, width: int) -> np.ndarray:
    """rows x 4 x width, filled up with zeros."""
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), PARTS * width), np.int64)
    out[np.arange(PARTS * width) < lengths[:, None]] = column.flatten().to_numpy()
    return out.reshape(len(column), PARTS, width)


def first_codebooks(vectors: DataFrame, width: int) -> np.ndarray:
    """parts x entries x width: the rows with the smallest vec_ids."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    return _parts_of(pa.array([r.v for r in rows], pa.list_(pa.int64())), width).swapaxes(0, 1)


def next_codebooks(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the mean of the parts nearest to it, rounded down."""
    parts, count, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        totals = np.zeros((parts, count, width + 1), np.int64)  # the last column counts
        for batch in batches:
            cut = _parts_of(batch.column(0), width)
            for p in range(parts):
                entry, _ = slices[p].nearest(cut[:, p])
                np.add.at(totals[p, :, :width], entry, cut[:, p])
                totals[p, :, width] += np.bincount(entry, minlength=count)
        used = np.repeat(totals[:, :, width] > 0, width + 1)
        slot = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(totals.ravel()[slot])], ["slot", "total"])

    sums = vectors.select("v").mapInArrow(run, "slot bigint, total bigint").groupBy("slot").agg(F.sum("total").alias("total"))
    totals = np.zeros(parts * count * (width + 1), np.int64)
    for slot, total in sums.collect():  # at most 4 x 256 x (width + 1) numbers
        totals[slot] = total
    totals = totals.reshape(parts, count, width + 1)
    n = totals[:, :, width:]
    return np.where(n > 0, totals[:, :, :width] // np.maximum(n, 1), books)


def coded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every vector under the given codebooks."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        for batch in batches:
            cut = _parts_of(batch.column(2), width)
            found = [s.nearest(cut[:, p]) for p, s in enumerate(slices)]
            codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    return vectors.mapInArrow(run, f"{kinds}, code string, error bigint")


def fitted(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The written integer vectors, and the codebooks after `rounds` rounds."""
    vectors = kept(integer_vectors(embeddings), "vectors")
    longest = vectors.agg(F.max(F.size("v")).alias("n")).first().n or 0
    books = first_codebooks(vectors, -(-longest // PARTS))
    if not books.shape[1]:
        return vectors, books
    return vectors, reduce(lambda b, _: next_codebooks(vectors, b), range(rounds), books)


def compressed(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that is kept."""
    vectors, books = fitted(embeddings)
    numbers = ",".join(map(str, books.ravel().tolist()))
    codes = kept(coded(vectors, books), "codes")
    by_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    steps = [f"""
WITH whole AS MATERIALIZED (
  SELECT vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS rid, * FROM whole
), places AS (
  SELECT *, unnest(range(len(v))) AS place, len(v) // {PARTS} AS width FROM numbered
), cells AS MATERIALIZED (
  SELECT rid, place // width AS part, place % width AS spot, v[place + 1] AS x FROM places
), book0 AS MATERIALIZED (
  SELECT part, rid AS entry, spot, x AS c FROM cells WHERE rid < {ENTRIES}
)"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT rid, part, arg_min(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d
  FROM (SELECT rid, part, entry, sum((x - c) * (x - c)) AS d FROM cells JOIN book{i} USING (part, spot)
        GROUP BY rid, part, entry)
  GROUP BY rid, part
)""")
        if i < ROUNDS:
            steps.append(f"""sums{i} AS (
  SELECT part, entry, spot, sum(x) AS s, count(*) AS n FROM cells JOIN near{i} USING (rid, part) GROUP BY ALL
), book{i + 1} AS MATERIALIZED (
  SELECT part, entry, spot,
         CASE WHEN n IS NULL THEN c ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS c
  FROM book{i} LEFT JOIN sums{i} USING (part, entry, spot)
)""")
    return ", ".join(steps) + f""", codes AS (
  SELECT rid, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY rid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, spot)) FROM book{ROUNDS}) AS codebooks_sha256
FROM codes JOIN numbered USING (rid)"""


OP13_SQL = _sql()
