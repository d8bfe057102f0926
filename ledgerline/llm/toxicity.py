"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are a bounded sample of labelled rows (`SAMPLE` of each label, texts up to `LONGEST`
bytes).  Terms are the examples' words that are associated with the label (chi-square of `CHI2`
or more over the sample weighted back to the labels' true shares; `TERMS` at most); how many
documents hold each term is counted over all documents.  A vector holds (1 + ln count) * idf of
its terms, at length 1.

The index has a posting list per term, in blocks of 64 examples, each with its largest weight.  A
query takes its blocks of example numbers in order of their upper bound (the sum over its terms of
query weight times block maximum) and stops when the bound falls below the `NEAREST`-th best
cosine: the neighbours are exact.  They vote with their squared cosine, times the number of
labelled rows that each example stands for; `PRIOR` votes go to the overall share, so that a text
far from every example gets that share.  `evidence` lists the nearest examples with their labels.

Defined cases: null, empty and term-free texts have no neighbours and get the overall share;
without both labels to learn from there are no terms; equal cosines go to the lower example number;
repeated rows each get a row; a null doc_id isn't held out; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.labelled import held_out, labelled_sample

SAMPLE, LONGEST = 3000, 20_000
TERMS, CHI2 = 1024, 20.0
NEAREST, PRIOR, BLOCK = 15, 0.5, 64
THRESHOLD = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def choose_terms(sample: list[tuple[str, int]], sizes: dict[int, int]) -> list[str]:
    """The words most associated with the label; ties by the word.  Equal texts count once."""
    sample = sorted(set(sample))
    held = {y: Counter() for y in (0, 1)}
    shown = Counter(y for _, y in sample)
    if min(shown[0], shown[1]) == 0:
        return []
    for text, y in sample:
        held[y].update(set(words(text)))
    n = {y: float(sizes[y]) for y in (0, 1)}
    total = n[0] + n[1]
    rated = []
    for term in held[0].keys() | held[1].keys():
        if held[0][term] + held[1][term] < 3:
            continue
        a, b = (held[y][term] / shown[y] for y in (1, 0))  # shares of label 1, 0 that hold it
        # of as many rows as the sample has, in the labels' true proportion
        seen = min(total, len(sample))
        n1, n0 = seen * n[1] / total, seen * n[0] / total
        rows = a * n1 + b * n0
        if 0 < rows < seen:
            chi2 = n1 * n0 * (a - b) ** 2 / (rows / seen * (1 - rows / seen)) / seen
            if chi2 >= CHI2:
                rated.append((-chi2, term))
    return [term for _, term in sorted(rated)[:TERMS]]


def document_counts(docs: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many of them hold each term; one number a term and task."""
    place = {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(terms) + 1, np.int64)
        known = place.keys()
        for batch in batches:
            counts[-1] += batch.num_rows
            for text in batch.column(0).to_pylist():
                for term in known & words(text):
                    counts[place[term]] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["term", "n"])

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(terms) + 1, np.int64)
    for r in rows:  # at most one row a term
        out[r["term"]] = r["n"]
    return int(out[-1]), out[:-1]


class Index:
    """The examples' posting lists with block maxima."""

    def __init__(self, sample: list[tuple[str, int]], sizes: dict[int, int], terms: list[str], n: int, held: np.ndarray):
        self.place = {t: i for i, t in enumerate(terms)}
        self.idf = np.log((1 + n) / (1 + held)) + 1
        shown = Counter(y for _, y in sample)
        total = sum(sizes.values())
        self.share = sizes.get(1, 0) / total if total else 0.5
        self.labels, self.stands_for = [], []
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for text, y in sample:
            vector = self.vector(text)
            if vector:
                for term, weight in vector.items():
                    postings[term].append((len(self.labels), weight))
                self.labels.append(y)
                self.stands_for.append(sizes[y] / shown[y])
        largest = max(self.stands_for, default=1.0)
        self.stands_for = [x / largest for x in self.stands_for]
        #: term -> block -> (largest weight, postings)
        self.blocks: dict[int, dict[int, tuple[float, list[tuple[int, float]]]]] = {}
        for term, posting in postings.items():
            parts: dict[int, list] = defaultdict(list)
            for example, weight in posting:
                parts[example // BLOCK].append((example, weight))
            self.blocks[term] = {b: (max(w for _, w in p), p) for b, p in parts.items()}
        self.remembered: dict[tuple, tuple[float, list]] = {}

    def vector(self, text: str) -> dict[int, float]:
        found = words(text)
        here = self.place.keys() & found
        if not here:
            return {}
        counts = Counter(w for w in found if w in here)
        raw = {self.place[t]: (1 + np.log(c)) * self.idf[self.place[t]] for t, c in counts.items()}
        length = sum(x * x for x in raw.values()) ** 0.5
        return {t: float(x / length) for t, x in sorted(raw.items())}

    def nearest(self, vector: dict[int, float]) -> list[tuple[float, int]]:
        """(cosine, example) of the nearest, best first."""
        bounds: dict[int, float] = defaultdict(float)
        for term, weight in vector.items():
            for block, (most, _) in self.blocks.get(term, {}).items():
                bounds[block] += weight * most
        best: list[tuple[float, int]] = []
        for block, bound in sorted(bounds.items(), key=lambda x: (-x[1], x[0])):
            if len(best) == NEAREST and bound < best[-1][0] - 1e-12:
                break
            cosine: dict[int, float] = defaultdict(float)
            for term, weight in vector.items():
                for example, other in self.blocks.get(term, {}).get(block, (0, ()))[1]:
                    cosine[example] += weight * other
            best = sorted(best + [(c, e) for e, c in cosine.items()], key=lambda x: (-x[0], x[1]))[:NEAREST]
        return best

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability of the label, and the evidence (example, its label, cosine)."""
        vector = self.vector(text)
        key = tuple(vector.items())
        if (known := self.remembered.get(key)) is not None:
            return known
        near = self.nearest(vector)
        votes = [(c * c * self.stands_for[e], self.labels[e]) for c, e in near]
        total = sum(v for v, _ in votes)
        # votes count as many as there are neighbours, whatever each stands for
        scale = sum(c * c for c, _ in near) / total if total else 0.0
        ones = sum(v for v, y in votes if y)
        found = (ones * scale + PRIOR * self.share) / (total * scale + PRIOR)
        if len(self.remembered) >= 100_000:
            self.remembered.clear()
        self.remembered[key] = found, [(e, self.labels[e], c) for c, e in near[:3]]
        return self.remembered[key]


def learn(docs: DataFrame, labels: DataFrame) -> Index:
    sample, sizes = labelled_sample(docs, labels, "toxic", SAMPLE, LONGEST)
    terms = choose_terms(sample, sizes)
    return Index(sample, sizes, terms, *document_counts(docs, terms))


def scored(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("example", pa.int64()), ("toxic", pa.int64()), ("cosine", pa.float64())]))
        for batch in batches:
            found = [index.score(t) for t in batch.column(1).to_pylist()]
            evidence = [[{"example": e, "toxic": y, "cosine": c} for e, y, c in near] for _, near in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array(evidence, kind)],
                ["doc_id", "score", "evidence"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {kind}, score double, evidence array<struct<example: bigint, toxic: bigint, cosine: double>>"
    return source.mapInArrow(run, schema).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, index).drop("evidence")
