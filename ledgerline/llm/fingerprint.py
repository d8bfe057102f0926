"""Document fingerprints: digests of content-defined chunks, weighted by length.

Boundaries come from a gear hash: at each byte the hash of the last 16 bytes, every older byte
shifted one bit further.  A chunk ends where the hash's top bits are zero; while it is shorter
than the normal length more bits are asked for, beyond it fewer (normalised chunking), so
lengths keep close to the normal one.  A boundary depends on the bytes before it only, so an
insertion changes the chunks around it and no others.  The hash is computed for all bytes of a
batch at once.

A fingerprint is the list of `digest:length` of its distinct chunks, in order of digest.  The
likeness of two is the length they share over that of the shorter: containment, 1 when one text
holds all chunks of the other.  Two empty texts are alike, an empty and another are not.

The next document is found without a global sort: doc_ids are cut into ranges (the ends come
from a quantile sketch and the least doc_id of each range, one number a partition), every row
goes to its range, and the first row of each range also goes to the range before.  Texts are
compressed before that one shuffle.

Defined cases: a null text is an empty one; rows with equal doc_id follow one another by digest of
their text; null doc_ids come first; a single document is its own next; other columns are not
looked at; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.shingles import groups_of, mix

LEAST, NORMAL, MOST = 16, 48, 192  # bytes of a chunk
HARD, EASY = 7, 4  # top bits that are zero at a boundary, before and after the normal length
WINDOW = 16

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of its last 16 bytes' gear values, the older the further shifted."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        older = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += older
    return h


def cuts(easy: list[int], hard: list[int], n: int) -> list[int]:
    """Ends of the chunks of n bytes, given the places where a boundary may be."""
    out, start, e, h = [], 0, 0, 0
    n_easy, n_hard = len(easy), len(hard)
    while n - start > LEAST:
        least, normal, end = start + LEAST, start + NORMAL, min(start + MOST, n)
        while h < n_hard and hard[h] < least:
            h += 1
        if h < n_hard and hard[h] <= normal and hard[h] < end:
            end = hard[h]
        else:
            while e < n_easy and easy[e] <= normal:
                e += 1
            if e < n_easy and easy[e] < end:
                end = easy[e]
        out.append(end)
        start = end
    if start < n:
        out.append(n)
    return out


def chunk_sets(texts: list[bytes]) -> Iterator[dict[int, int]]:
    """For each text its distinct chunks: digest -> length."""
    digest = xxhash.xxh3_64_intdigest
    for a, b in groups_of(texts):
        data = b"".join(texts[a:b])
        top = gear(np.frombuffer(data, np.uint8)) >> np.uint32(32 - HARD)
        easy_at = np.flatnonzero(top >> np.uint32(HARD - EASY) == 0) + 1
        hard_at = easy_at[top[easy_at - 1] == 0]
        bounds = np.cumsum([0, *(len(t) for t in texts[a:b])])
        easy_in, hard_in = np.searchsorted(easy_at, bounds, "right"), np.searchsorted(hard_at, bounds, "right")
        for i in range(b - a):
            start, n = int(bounds[i]), len(texts[a + i])
            ends = cuts(
                (easy_at[easy_in[i] : easy_in[i + 1]] - start).tolist(),
                (hard_at[hard_in[i] : hard_in[i + 1]] - start).tolist(),
                n,
            )
            text, last, out = texts[a + i], 0, {}
            for end in ends:
                out[digest(text[last:end])] = end - last
                last = end
            yield out


def written(chunks: dict[int, int]) -> str:
    return " ".join(f"{d:016x}:{chunks[d]}" for d in sorted(chunks))


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    if not a or not b:
        return float(not a and not b)
    if len(b) < len(a):
        a, b = b, a
    shared = sum(n for d, n in a.items() if d in b)
    return shared / min(sum(a.values()), sum(b.values()))


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the next."""
    m = len(text) // 4
    return text[: len(text) - m] + following[:m]


def _ranges(docs: DataFrame, count: int) -> tuple[list, bool]:
    """The least doc_id of each of some `count` ranges, ascending; whether a doc_id is null."""
    ids = docs.select("doc_id")
    shares = [i / count for i in range(1, count)] or [0.5]
    row = ids.agg(
        F.percentile_approx("doc_id", shares, 10 * count).alias("ends"),
        F.expr("coalesce(bool_or(doc_id IS NULL), false)").alias("nulls"),
    ).first()
    ends = np.array(sorted(set(row["ends"] or ())), np.int64)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).drop_null().to_numpy()
            places = np.searchsorted(ends, values, "right").astype(np.int32)
            order = np.lexsort((values, places))
            places, at = np.unique(places[order], return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(places), pa.array(values[order][at], pa.int64())], ["place", "first"]
            )

    firsts = ids.mapInArrow(least, "place int, first bigint").groupBy("place").agg(F.min("first").alias("first"))
    return sorted(r["first"] for r in firsts.collect()), row["nulls"]


def _dealt(docs: DataFrame, firsts: list, nulls: bool) -> DataFrame:
    """range, last (a copy of the first row of the next range), doc_id, digest, packed text."""
    starts = np.array(firsts, np.int64)
    wrap = max(1, len(firsts)) - 1  # the last range: the first row of all follows its last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for doc_id, text in zip(ids, batch.column(1).cast(pa.binary()).to_pylist()):
                row = doc_id, hashlib.sha256(text).digest()[:8], zlib.compress(text, 1)
                if doc_id is None:
                    rows += [(0, False, *row), (wrap, True, *row)]
                    continue
                at = int(np.searchsorted(starts, doc_id, "right")) - 1
                rows.append((at, False, *row))
                if starts[at] == doc_id and (at or not nulls):
                    rows.append((at - 1 if at else wrap, True, *row))
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.int32(), pa.bool_(), batch.schema.field(0).type, pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["range", "last", "doc_id", "digest", "packed"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"range int, last boolean, doc_id {kind}, digest binary, packed binary")


RESULT = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(rows: list[tuple], last: str | None) -> Iterator[tuple]:
    """Results for consecutive (doc_id, text); `last` follows the final one."""
    texts = [text for _, text in rows]
    following = [*texts[1:], last]
    changed = [edited(t, f) for t, f in zip(texts, following)]
    sets = list(chunk_sets([t.encode() for t in [*texts, last]]))
    for i, (other, new) in enumerate(zip(chunk_sets([t.encode() for t in changed]), changed)):
        own = sets[i]
        yield (
            rows[i][0], len(texts[i]), hashlib.sha256(new.encode()).hexdigest(),
            written(own), written(other), likeness(own, other), likeness(own, sets[i + 1]),
        )


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id and RESULT for every row of docs."""
    spark = docs.sparkSession
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts, nulls = _ranges(source, ranges or 4 * partitions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by range; within it in order, the copies of the next range's first row last."""
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = ["doc_id", *(f.split()[0] for f in RESULT.split(", "))]
        rows: list[tuple] = []
        size, at, closed = 0, None, False
        doc_type = pa.int64()

        def out(last: str) -> pa.RecordBatch:
            columns = list(zip(*_compared(rows, last)))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [doc_type, *types])], names)

        for batch in batches:
            doc_type = batch.schema.field(2).type
            for place, copy, doc_id, _, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if place != at:
                    at, closed = place, False
                if closed:
                    continue  # more rows with the id that begins the next range
                text = zlib.decompress(packed).decode()
                if rows and (copy or size > 1 << 21):
                    yield out(text)
                    rows, size = [], 0
                if copy:
                    closed = True
                else:
                    rows.append((doc_id, text))
                    size += len(text)

    dealt = _dealt(source, firsts, nulls).repartition(partitions, "range")
    order = F.col("doc_id").asc_nulls_first()
    ordered = dealt.sortWithinPartitions("range", "last", order, "digest")
    return ordered.mapInArrow(run, f"doc_id {kind}, {RESULT}")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
