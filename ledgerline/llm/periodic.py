"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch of words with smallest period q and a length of at least 24 and 3q that can't be
extended on either side.  Words count as equal when their bytes are; a batch numbers its words and
puts a number of its own between texts, so that one array holds many texts and no run crosses two.

Periods below 16 are scanned directly: words are compared with those q places on, and stretches of
equal ones are read off.  Longer periods go by scale.  Scale k takes the periods over 2k/3 and up to
k.  Each place has the hash of the k words from there; within any window of k // 3 + 1 places
the least hash is a minimizer, with all its ties.  Windows a period apart in a run are equal, so
their minimizers are too: a run of three periods holds a window whose copy one period on lies in the
run as well.  k words that are longer than the period recur within the run at its multiples only, so
of equal minimizers neighbours in place are one period apart.  Such pairs are the seeds, and a seed is
extended by comparing words themselves.  A stretch found under several periods has the least of them.

One pass over the rows, no shuffle; a task holds one Arrow batch and the arrays of some 4 MB of
text, or of one longer text.  Time is n log n in the words of a text, whatever it repeats.

Two different stretches of k words with equal 64-bit hashes could hide a seed between them; no
other step depends on hashes.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; a null
doc_id's words are taken as they are; repeated rows each get a row; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.shingles import groups_of, mix

LEAST, TIMES = 24, 3  # words of a run, and periods
DIRECT = 16  # shorter periods are scanned
_P = 0x9E3779B97F4A7C15


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """(least period, k) of each scale for texts of up to `longest` words."""
    least = DIRECT
    while TIMES * least <= longest:
        k = (3 * least - 1) // 2
        yield least, k
        least = k + 1


def sliding(best: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """best over each window of `width`, by doubling."""
    y, step = x, 1
    while 2 * step <= width:
        y = best(y[:-step], y[step:])
        step *= 2
    n = len(x) - width + 1
    return best(y[:n], y[width - step : width - step + n])


class Windows:
    """Hashes of all stretches of k numbers, from prefix sums of a polynomial."""

    def __init__(self, numbers: np.ndarray):
        up = np.full(len(numbers), _P, np.uint64)
        self.down = np.full(len(numbers), pow(_P, -1, 1 << 64), np.uint64)
        up[:1] = self.down[:1] = 1
        np.cumprod(up, out=up)
        np.cumprod(self.down, out=self.down)
        self.sums = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(mix(numbers.astype(np.uint64)) * up, out=self.sums[1:])

    def hashes(self, k: int, end: int) -> np.ndarray:
        """Of the stretches that lie in the first `end` numbers."""
        return mix((self.sums[k : end + 1] - self.sums[: end - k + 1]) * self.down[: end - k + 1])


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash of some window, ties included."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = sliding(np.minimum, hashes, width)
    around = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(hashes == sliding(np.maximum, np.concatenate([around, least, around]), width))


def seeds(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(period, place) of neighbouring equal minimizers that are over 2k/3 and up to k apart, ascending."""
    place = minimizers(hashes, k // 3 + 1)
    value = hashes[place]
    order = np.argsort(value, kind="stable")
    place, value = place[order], value[order]
    apart = np.diff(place)
    good = np.flatnonzero((value[1:] == value[:-1]) & (apart <= k) & (3 * apart > 2 * k))
    period, place = apart[good], place[good]
    order = np.lexsort((place, period))
    return period[order], place[order]


def _equal_behind(numbers: np.ndarray, at: int, period: int) -> int:
    """The first place from `at` whose number differs from that one period on."""
    step, end = 64, len(numbers) - period
    while at < end:
        stop = min(at + step, end)
        differ = numbers[at:stop] != numbers[at + period : stop + period]
        if differ.any():
            return at + int(differ.argmax())
        at, step = stop, 2 * step
    return max(at, end)


def _equal_before(numbers: np.ndarray, at: int, period: int) -> int:
    """The first of the places up to `at` whose numbers all equal those one period on."""
    step = 64
    while at > 0:
        start = max(0, at - step)
        differ = numbers[start:at] != numbers[start + period : at + period]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = start, 2 * step
    return 0


def long_runs(numbers: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of stretches of three periods, periods from DIRECT on.  Text i ends before bounds[i + 1] - 1; texts come longest first."""
    sizes = np.diff(bounds) - 1
    windows = Windows(numbers) if len(sizes) and TIMES * DIRECT <= sizes[0] else None
    for least, k in scales(int(sizes[0]) if len(sizes) else 0):
        end = int(bounds[np.searchsorted(-sizes, -TIMES * least, "right")])
        last, done = 0, 0
        for period, place in zip(*(a.tolist() for a in seeds(windows.hashes(k, end), k))):
            if period == last and place < done:
                continue
            last, done = period, _equal_behind(numbers, place, period)
            start = _equal_before(numbers, place, period)
            if done + period - start >= TIMES * period:
                yield start, done + period, period


def short_runs(numbers: np.ndarray) -> Iterator[np.ndarray]:
    """Columns start, end, period of stretches with a period below DIRECT."""
    for period in range(1, min(DIRECT, len(numbers))):
        equal = np.zeros(len(numbers) - period + 2, np.int8)
        equal[1:-1] = numbers[period:] == numbers[:-period]
        edge = np.diff(equal)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + period
        long = end - start >= max(LEAST, TIMES * period)
        yield np.stack([start[long], end[long], np.full(int(long.sum()), period)], axis=1)


def all_runs(numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs by start, then period."""
    found = [*short_runs(numbers), np.array(list(long_runs(numbers, bounds)), np.int64).reshape(-1, 3)]
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)  # equal stretches: the least period first
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, a number of its own behind each text; the texts' bounds."""
    known: dict[bytes, int] = {}
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    numbers = np.empty(int(bounds[-1]), np.int64)
    for i, words in enumerate(texts):
        numbers[bounds[i] : bounds[i + 1] - 1] = [known.setdefault(w, len(known)) for w in words]
        numbers[bounds[i + 1] - 1] = -1 - i
    return numbers, bounds


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """For each list of words its runs as rows (start, length, period)."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers, bounds = numbered([texts[i] for i in order])
    runs = all_runs(numbers, bounds)
    cut = np.searchsorted(runs[:, 0], bounds)
    out: list = [None] * len(texts)
    for j, i in enumerate(order):
        own = runs[cut[j] : cut[j + 1]]
        out[i] = np.stack([own[:, 0] - bounds[j], own[:, 1] - own[:, 0], own[:, 2]], axis=1)
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without what runs repeat: a run keeps its first period."""
    if len(runs):
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
    return b" ".join(words)


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's text of a document: every tenth's words from one place on repeat."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head, block = words[:a], words[a : a + p]
    return head + (block * -(-(n - a) // p))[: n - a]


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """doc_id, runs (by start, then period), collapsed text of every row.

    `planted` first makes every tenth document repeat itself, as the contract of the query has it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                raw = part.column(1).cast(pa.binary()).to_pylist()
                for a, b in groups_of(raw):
                    ids = part.column(0).slice(a, b - a)
                    texts = [t.split() for t in raw[a:b]]  # bytes split at 0x20 and 0x09-0x0D only
                    if planted:
                        texts = [repeated(w, i) for w, i in zip(texts, ids.to_pylist())]
                    runs = runs_of(texts)
                    values = np.concatenate(runs)
                    listed = pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()),
                        pa.StructArray.from_arrays([pa.array(values[:, j]) for j in range(3)], fields=list(_RUN)),
                    )
                    kept = pa.array([collapsed(w, r) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([ids, listed, kept], ["doc_id", "runs", "collapsed"])

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, runs {RUNS}, collapsed string")


def summary(runs: DataFrame) -> DataFrame:
    """One row per document: count, the run with the greatest exponent, digests."""
    # Quotients of numbers below 2^26 that differ do so as doubles too; equal ones are equal.
    best = F.expr(
        "array_min(transform(runs, r -> struct(-double(r.length) / r.period AS key, r.start AS start,"
        " r.period AS period, r.length AS length)))"
    )
    lines = F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))")
    return runs.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), planted=True))
