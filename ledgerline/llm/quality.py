"""Quality classifier: a byte-level convolutional network in numpy.

Filters of five bytes slide over the whole document.  Chunks of 64 bytes, each overlapping half of
the next, keep the strongest answer of every filter (max-pooling), and one more number that shows
repetition: the share of bytes in the chunk that end four bytes which also stand 2 to 20 bytes
before.  A small layer gives each chunk a value; the largest and the mean of a document's chunks are
combined into one probability.

The network is fitted on the driver, on a bounded sample of labelled rows (`SAMPLE` of each label,
texts up to `LONGEST` bytes); scoring covers every byte of every document in one pass without a
shuffle, with the weights (some 40 kB) in the task's closure.

Defined cases: null and empty texts have one chunk without bytes and get its score; without both
labels to learn from, the score is the share of label 1 (0.5 without labels); repeated rows each get
a row; a null doc_id isn't held out; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.labelled import held_out, labelled_sample
from ledgerline.llm.shingles import groups_of

SAMPLE, LONGEST = 1000, 20_000
THRESHOLD = 0.3
WIDTH, FILTERS, HIDDEN = 5, 8, 8
HALF = 32  # bytes; a chunk is two halves, the next begins at its second
LAGS = range(2, 21)
STEPS, BATCH, RATE = 480, 48, 0.02

Weights = dict[str, np.ndarray]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each padded with zeros to whole halves; the first half of each, and the end.

    The zeros are as many as the farthest lag at least: no text is compared with the one before.
    """
    parts, halves = [], [0]
    for text in texts:
        size = max(2, -(-(len(text) + max(LAGS)) // HALF))
        parts.append(text.replace(b"\0", b" ").ljust(size * HALF, b"\0"))
        halves.append(halves[-1] + size)
    return np.frombuffer(b"".join(parts) + b"\0" * WIDTH, np.uint8), np.array(halves)


def _repetition(data: np.ndarray, n: int) -> np.ndarray:
    """For each half, the share of bytes that end four bytes seen a few bytes before as well."""
    seen = np.zeros(n, bool)
    for lag in LAGS:
        same = np.zeros(n, bool)
        np.equal(data[lag:n], data[: n - lag], out=same[lag:])
        seen[3:] |= same[3:] & same[2:-1] & same[1:-2] & same[:-3]
    seen &= data[:n] != 0
    return seen.reshape(-1, HALF).sum(axis=1, dtype=np.float32) / HALF


def chunk_features(w: Weights, data: np.ndarray, halves: np.ndarray, places: bool = False):
    """Chunk rows (filters' maxima, repetition), first chunk of each text; places: of the maxima."""
    n = len(data) - WIDTH
    z = w["filters"][0][data[:n]]
    for j in range(1, WIDTH):
        z += w["filters"][j][data[j : n + j]]
    # the last windows of a text lie in its zeros, whatever text comes next
    ends = halves[1:] * HALF
    for j in range(1, WIDTH):
        z[ends - j] = w["filters"][:, 0].sum(axis=0)
    z = z.reshape(-1, HALF, FILTERS)
    top = z.max(axis=1) + w["bias"]
    same = _repetition(data, n)
    # chunk c of a text is its halves c and c+1: every half but a text's last begins a chunk
    begins = np.ones(len(top), bool)
    begins[halves[1:] - 1] = False
    begins = np.flatnonzero(begins)
    pooled = np.maximum(np.maximum(top[begins], top[begins + 1]), 0)
    repeated = (same[begins, None] + same[begins + 1, None]) / 2
    rows = np.concatenate([pooled, repeated], axis=1).astype(np.float32)
    first = np.concatenate([[0], np.cumsum(np.diff(halves) - 1)[:-1]])
    if not places:
        return rows, first
    at = z.argmax(axis=1) + np.arange(len(top))[:, None] * HALF
    right = top[begins + 1] > top[begins]
    return rows, first, np.where(right, at[begins + 1], at[begins])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _combined(w: Weights, rows: np.ndarray, first: np.ndarray):
    hidden = np.maximum(rows @ w["layer"] + w["layer_bias"], 0)
    value = hidden @ w["chunk"]
    counts = np.diff(np.append(first, len(rows)))
    most = np.maximum.reduceat(value, first)
    mean = np.add.reduceat(value, first) / counts
    return hidden, value, counts, most, mean, w["out"][0] * most + w["out"][1] * mean + w["out"][2]


def scores(w: Weights, texts: list[bytes]) -> np.ndarray:
    if "share" in w:
        return np.full(len(texts), float(w["share"][0]))
    found = []
    for a, b in groups_of(texts, 1 << 20):
        rows, first = chunk_features(w, *joined(texts[a:b]))
        found.append(_sigmoid(_combined(w, rows, first)[-1].astype(np.float64)))
    return np.concatenate(found) if found else np.zeros(0)


def fit(sample: list[tuple[str, int]], seed: int = 7) -> Weights:
    """Adam on the cross-entropy; batches hold both labels in equal parts."""
    labels = np.array([y for _, y in sample], np.int64)
    if not len(labels) or labels.min() == labels.max():
        return {"share": np.array([labels.mean() if len(labels) else 0.5])}
    random = np.random.default_rng(seed)
    w: Weights = {
        "filters": random.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "layer": random.normal(0, 0.5, (FILTERS + 1, HIDDEN)).astype(np.float32),
        "layer_bias": np.full(HIDDEN, 0.1, np.float32),
        "chunk": random.normal(0, 0.5, HIDDEN).astype(np.float32),
        "out": np.array([0.5, 1.0, 0.0], np.float32),
    }
    texts = [t.encode() for t, _ in sample]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    kinds = [np.flatnonzero(labels == y) for y in (0, 1)]
    for step in range(1, STEPS + 1):
        rate = RATE * (1 - step / (STEPS + 1))
        picked = np.concatenate([random.choice(k, BATCH // 2) for k in kinds])
        batch = [texts[i] for i in picked]
        for i in range(0, BATCH, 4):  # short pieces as well, of low quality only where they show it
            size = int(random.integers(100 if labels[picked[i]] == 0 else 4, 300))
            begin = int(random.integers(0, max(1, len(batch[i]) - size)))
            batch[i] = batch[i][begin : begin + size]
        for name, g in _gradients(w, batch, labels[picked]).items():
            m, v = moments[name]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def _gradients(w: Weights, texts: list[bytes], labels: np.ndarray) -> Weights:
    data, halves = joined(texts)
    rows, first, places = chunk_features(w, data, halves, places=True)
    hidden, value, counts, most, mean, logit = _combined(w, rows, first)
    d = ((_sigmoid(logit) - labels) / len(labels)).astype(np.float32)
    of_text = np.repeat(np.arange(len(first)), counts)
    is_most = value == most[of_text]
    shared = np.add.reduceat(is_most.astype(np.float32), first)
    d_value = d[of_text] * (w["out"][0] * is_most / shared[of_text] + w["out"][1] / counts[of_text])
    d_hidden = np.outer(d_value, w["chunk"]) * (hidden > 0)
    d_rows = (d_hidden @ w["layer"].T)[:, :FILTERS] * (rows[:, :FILTERS] > 0)
    filters = np.zeros(WIDTH * 256 * FILTERS, np.float32)
    lane = np.arange(FILTERS)
    for j in range(WIDTH):
        at = (j * 256 + data[places + j].astype(np.int64)) * FILTERS + lane
        filters += np.bincount(at.ravel(), d_rows.ravel(), len(filters)).astype(np.float32)
    return {
        "filters": filters.reshape(WIDTH, 256, FILTERS),
        "bias": d_rows.sum(axis=0),
        "layer": rows.T @ d_hidden,
        "layer_bias": d_hidden.sum(axis=0),
        "chunk": hidden.T @ d_value,
        "out": np.array([(d * most).sum(), (d * mean).sum(), d.sum()], np.float32),
    }


def scored(docs: DataFrame, w: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(w, batch.column(1).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def classifier(docs: DataFrame, labels: DataFrame) -> Weights:
    return fit(labelled_sample(docs, labels, "quality", SAMPLE, LONGEST)[0])


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that the classifier rejects."""
    w = classifier(docs, labels)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(scores(w, [t.encode() for t in text]))

    return docs.filter(score(F.coalesce("text", F.lit(""))) >= THRESHOLD)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, classifier(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
