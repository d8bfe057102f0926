import math
import zlib

import numpy as np
import pytest
from conftest import ODD, SF_DIR
from pyspark.sql import functions as F

from ledgerline.llm import quality, toxicity
from ledgerline.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def weights(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    return quality.classifier(docs, spark.read.parquet(f"{LARGER}/labels.parquet"))


def test_quality_of_held_out_rows(spark, weights):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    rows = quality.scored(docs, weights).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id")
    rows = [r for r in rows.collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_of_odd_rows(odd, nothing, weights):
    got = quality.scored(odd, weights).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    scores = {t or "": s for (_, t), s in zip(ODD, quality.scores(weights, [(t or "").encode() for _, t in ODD]))}
    by_id = {r.doc_id: r.score for r in got}
    assert all(math.isclose(by_id[i], scores[t or ""], rel_tol=1e-5) for i, t in ODD if i is not None)
    assert quality.scored(nothing, weights).count() == 0


def test_the_whole_document_is_looked_at(weights):
    clean = "The rest of it is and the other thing to be in. " * 400
    junk = " ".join(f"ab{i}%%%" for i in range(4000))
    at_the_end = quality.scores(weights, [clean.encode(), (clean[:4000] + junk).encode()])
    assert at_the_end[0] > 0.3 > at_the_end[1]


def test_a_text_scores_the_same_in_any_company(weights):
    texts = [t.encode() for t in ("short", "a longer text. " * 40, "", "###$$$ " * 30)]
    together = quality.scores(weights, texts)
    alone = np.concatenate([quality.scores(weights, [t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-6)


def test_gradients_match_differences():
    random = np.random.default_rng(5)
    w = {
        "filters": random.normal(0, 0.3, (5, 256, quality.FILTERS)), "bias": random.normal(0, 0.1, quality.FILTERS),
        "layer": random.normal(0, 0.5, (quality.FILTERS + 1, quality.HIDDEN)), "layer_bias": random.normal(0.1, 0.1, quality.HIDDEN),
        "chunk": random.normal(0, 0.5, quality.HIDDEN), "out": np.array([0.5, 1.0, 0.1]),
    }
    w = {k: v.astype(np.float64) for k, v in w.items()}
    texts, labels = [random.bytes(200).replace(b"\0", b"x"), b"some words here " * 12], np.array([0, 1])

    def loss():
        rows, first = quality.chunk_features(w, *quality.joined(texts))
        p = quality._sigmoid(quality._combined(w, rows, first)[-1])
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    found = quality._gradients(w, texts, labels)
    for name in ("bias", "layer", "layer_bias", "chunk", "out"):
        for at in list(np.ndindex(w[name].shape))[:6]:
            old, step = w[name][at], 1e-4
            w[name][at] = old + step
            up = loss()
            w[name][at] = old - step
            down = loss()
            w[name][at] = old
            assert abs((up - down) / (2 * step) - found[name][at]) < 1e-2, (name, at)


def test_one_label_only(spark, odd):
    docs = odd.select("doc_id", "text")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5, 13)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality.scored(docs, quality.classifier(docs, labels)).collect()} == {1.0}
    index = toxicity.learn(docs, labels)
    assert {r.score for r in toxicity.scored(docs, index).collect()} == {0.0}
    none = labels.filter("false")
    assert {r.score for r in quality.scored(docs, quality.classifier(docs, none)).collect()} == {0.5}
    assert {r.score for r in toxicity.scored(docs, toxicity.learn(docs, none)).collect()} == {0.5}


def test_toxicity_of_documents(spark):
    rows = QUERIES["op8_toxicity"](spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").collect()
    true = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in true) >= 0.6 * len(true)
    assert all(0 <= r.score <= 1 for r in rows)


def test_neighbours_are_exact():
    random = np.random.default_rng(2)
    terms = [f"t{i}" for i in range(30)]
    texts = [" ".join(random.choice([*[t.replace("t", "a") for t in terms]], random.integers(1, 12))) for _ in range(500)]
    names = [t.replace("t", "a") for t in terms]
    letters = {n: "".join(chr(97 + int(c)) for c in n[1:]) + "x" for n in names}
    texts = [" ".join(letters[w] for w in t.split()) for t in texts]
    sample = [(t, int(i % 3 == 0)) for i, t in enumerate(texts)]
    sizes = {0: sum(y == 0 for _, y in sample), 1: sum(y == 1 for _, y in sample)}
    index = toxicity.Index(sample, sizes, sorted(set(letters.values())), 500, np.arange(1, len(set(letters.values())) + 1))
    vectors = [index.vector(t) for t in texts]
    for query in vectors[:60]:
        cosines = sorted(
            ((sum(w * v.get(t, 0.0) for t, w in query.items()), i) for i, v in enumerate(vectors)), key=lambda x: (-x[0], x[1])
        )
        want = [(round(c, 9), i) for c, i in cosines[: toxicity.NEAREST] if c > 0]
        assert [(round(c, 9), i) for c, i in index.nearest(query)] == want


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    index = toxicity.learn(spark.read.parquet(f"{SF_DIR}/documents.parquet"), labels)
    got = toxicity.scored(odd, index).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert [r.score for r in got if r.doc_id in (1, 2, 3)] == [index.share] * 3
    assert toxicity.scored(nothing, index).count() == 0
    assert toxicity.scored(odd, index).select(F.max(F.size("evidence"))).first()[0] <= 3
