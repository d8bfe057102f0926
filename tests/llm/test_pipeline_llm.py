"""The pipeline against its stages in plain Python, and on odd documents."""

from collections import defaultdict

import corpus_pipeline
from conftest import SF_DIR
from test_near_llm import brute_groups, repeats, words
from test_exact_llm import lower
from test_tokens import check_packing

from ledgerline.llm import quality


def test_stages_one_by_one(spark, documents):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    weights = quality.classifier(documents, labels)
    docs, texts = documents, {r.doc_id: r.text for r in documents.collect()}
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.kept(stage(spark, docs, SF_DIR), "stage")
        done[name] = docs
        if name != "packing":
            assert docs.columns == documents.columns

    def after(name):
        return {r.doc_id: r.text for r in done[name].collect()}

    ids = list(texts)
    passed = [i for i, s in zip(ids, quality.scores(weights, [texts[i].encode() for i in ids])) if s >= 0.3]
    assert after("quality") == {i: texts[i] for i in passed}
    groups = defaultdict(list)
    for i in passed:
        groups[lower(texts[i])].append(i)
    exact = sorted(max(g) for g in groups.values())
    assert sorted(after("exact_dedup")) == exact
    near = [r[0] for r in brute_groups([(i, texts[i]) for i in exact], 80) if r[3]]
    assert sorted(after("near_dedup")) == sorted(near)
    cut = after("substring_dedup")
    assert sorted(cut) == sorted(near)
    repeated = repeats([(i, texts[i]) for i in near])
    for i in near:
        if i not in repeated and cut[i] != texts[i]:
            assert len(words(texts[i])) - len(words(cut[i])) >= 50  # a near passage
    assert not repeats(list(cut.items())) or all(cut[i] != texts[i] for i in repeats(list(cut.items())))
    check_packing(done["packing"].collect(), cut)


def test_odd_documents_pass_every_stage(spark, odd, nothing):
    for start in (odd, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = corpus_pipeline.kept(stage(spark, docs, SF_DIR), "stage")
        assert (docs.count() > 0) == (start is odd)
    assert corpus_pipeline.quality(spark, odd, SF_DIR).columns == odd.columns
    assert corpus_pipeline.quality(spark, nothing, SF_DIR).count() == 0
