import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm import near, passages
from ledgerline.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_groups(rows, similar=85):
    sets = [(i, shingles(t)) for i, t in rows]
    above = list(range(len(sets)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= similar * len(x | y):
                above[top(a)] = top(b)
    members = defaultdict(list)
    for k in range(len(sets)):
        members[top(k)].append(sets[k][0])
    out = []
    for k, (i, s) in enumerate(sets):
        least = min((x for x in members[top(k)] if x is not None), default=None) if s else i
        out.append((i, len(s), least, i == least))
    return sorted(out, key=str)


def test_groups_of_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = sorted((tuple(r) for r in near.near_groups(documents).collect()), key=str)
    assert got == brute_groups(rows)


def test_pairs_between_the_limits(spark):
    """Similarity 0.80 to 0.85: linked at 80 per cent, not at 85; the stage takes 80."""
    rows = []
    for k in range(60):
        base = [f"t{k}x{i}" for i in range(104)]  # 100 shingles
        copy = list(base)
        for j in range(2):
            copy[20 + 40 * j] = f"new{k}x{j}"  # five shingles each: 90 of 110
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for similar in (80, 85):
        got = sorted((tuple(r) for r in near.near_groups(docs, similar).collect()), key=str)
        assert got == brute_groups(rows, similar)
    assert sorted(r.doc_id for r in near.drop_near_copies(docs).collect()) == list(range(0, 120, 2))


def test_groups_of_odd_rows(odd):
    got = sorted((tuple(r) for r in near.near_groups(odd).collect()), key=str)
    assert got == brute_groups(ODD)
    left = near.drop_near_copies(odd)
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.filter("doc_id IS NOT NULL").collect()) == [1, 2, 3, 4, 6, 8, 9, 10, 12, 13]


def test_a_large_group_of_near_copies(spark):
    """Blocks smaller than the group; the copies are linked through the original only."""
    base = [f"t{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        copy = list(base)
        copy[(i * 2) % 120] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(f"u{i}x{j}" for j in range(50))) for i in range(40)]
    old, near.BLOCK = near.BLOCK, 16
    try:
        got = near.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    finally:
        near.BLOCK = old
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(rows)


def test_no_rows(nothing):
    assert near.near_groups(nothing).count() == 0
    assert near.drop_near_copies(nothing).count() == 0
    assert passages.merged(passages.passages(nothing)).count() == 0
    assert passages.cut_passages(nothing).count() == 0


def test_every_pair_within_the_distance_shares_a_key():
    random = np.random.default_rng(1)
    a = random.integers(0, 1 << 16, near.POSITIONS).astype("<u2")
    spread = [c * near.CHUNK + j for j in range(2) for c in range(near.CHUNKS)]
    for t in range(2000):
        b = a.copy()
        # the worst case first: the errors dealt evenly over the chunks
        at = spread[: near.MOST_APART] if t == 0 else random.choice(near.POSITIONS, near.MOST_APART, replace=False)
        b[at] ^= 1
        keys = near.index_keys(np.stack([a, b]))
        assert (keys[0] == keys[1]).any()


@pytest.mark.parametrize("n", [2, 40])
def test_components_of_a_chain(spark, n):
    links = spark.createDataFrame([(i * 7 % n, (i + 1) * 7 % n) for i in range(n - 1)], "a bigint, b bigint")
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(n)}


def repeats(rows):
    """Words of each document that lie in 50 words which a smaller doc_id holds too."""
    first, out = {}, defaultdict(set)
    for i, t in sorted(rows):
        w = words(t)
        for k in range(len(w) - 49):
            x = tuple(w[k : k + 50])
            if first.setdefault(x, i) != i:
                out[i].update(range(k, k + 50))
    return out


def check_passages(found, rows):
    texts = {i: words(t) for i, t in rows}
    have = defaultdict(set)
    for r in found:
        n = r.end_word - r.start_word
        a, b = texts[r.doc_id][r.start_word : r.end_word], texts[r.first_id][r.first_word : r.first_word + n]
        assert n >= 50 and r.first_id < r.doc_id
        assert Counter(x == y for x, y in zip(a, b))[True] >= 0.85 * n
        have[r.doc_id].update(range(r.start_word, r.end_word))
    missed = {i for i, w in repeats(rows).items() if w - have[i]}
    assert not missed


def test_passages_of_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check_passages(passages.merged(passages.passages(documents)).collect(), rows)


def test_passages_of_odd_rows(odd):
    rows = [x for x in ODD if x[0] is not None]
    found = passages.merged(passages.passages(odd)).collect()
    check_passages(found, rows)
    cut = {r.doc_id: r for r in passages.cut_passages(odd).collect()}
    assert cut[8].text == ODD[7][1] and cut[10].text == ODD[9][1]
    assert "SHARED0 " not in cut[9].text and cut[9].text.split()[:20] == ODD[8][1].split()[:20]
    assert cut[9].text.split()[-70:] == ODD[8][1].split()[-70:]
    assert cut[9].n_chars == len(cut[9].text) and cut[1].text is None


def test_an_unconfirmed_first_hides_nothing(spark):
    """The smallest doc_id shares 30 words only; two others share 60 around them."""
    common = [f"c{i}" for i in range(60)]
    rows = [
        (1, " ".join([f"p{i}" for i in range(40)] + common[15:45] + [f"q{i}" for i in range(40)])),
        (2, " ".join([f"r{i}" for i in range(30)] + common + [f"s{i}" for i in range(30)])),
        (3, " ".join([f"t{i}" for i in range(30)] + common + [f"u{i}" for i in range(30)])),
    ]
    found = passages.merged(passages.passages(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()
    check_passages(found, rows)
    assert {(r.doc_id, r.first_id) for r in found} == {(3, 2)}


def test_recall_of_changed_and_inserted_words(spark):
    """Passages of similarity 0.8 and above between a word changed, or words inserted, in the middle."""
    rows, pairs = [], 0

    def filler(tag, n):
        return [f"{tag}x{i}" for i in range(n)]

    for n, at, new in [(50, 25, 0), (50, 47, 0), (55, 27, 0), (60, 30, 0), (90, 45, 1), (90, 45, 10), (130, 65, 3)]:
        for k in range(30):
            p = filler(f"p{pairs}", n)
            q = p[:at] + filler(f"new{pairs}", max(new, 1)) + p[at + (new == 0) :]
            assert len(shingles(" ".join(p)) & shingles(" ".join(q))) >= 0.8 * len(shingles(" ".join(p)) | shingles(" ".join(q)))
            rows.append((2 * pairs, " ".join(filler(f"a{pairs}", 60 + k) + p + filler(f"b{pairs}", 50))))
            rows.append((2 * pairs + 1, " ".join(filler(f"c{pairs}", 40) + q + filler(f"d{pairs}", 70 - k))))
            pairs += 1
    pieces = passages.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).cache()
    columns = ["doc_id", "first_id", "start_word", "end_word"]
    found = passages.merged(pieces).select(columns).union(passages.shifted(pieces).select(columns)).collect()
    lengths = {r.doc_id: r.end_word - r.start_word for r in found if r.first_id == r.doc_id - 1 and r.start_word <= 41}
    assert all(r.first_id == r.doc_id - 1 and r.doc_id % 2 for r in found)
    assert len(lengths) >= 0.97 * pairs and min(lengths.values()) >= 50


def test_a_line_held_earlier_hides_no_passage(spark):
    """The first document holds most of the passage's words by themselves before the passage."""
    rows = []
    for k in range(40):
        p = [f"p{k}w{i}" for i in range(55)]
        rows.append((2 * k, " ".join([f"a{k}w{i}" for i in range(30)] + p[5:50] + [f"b{k}w{i}" for i in range(60)] + p)))
        rows.append((2 * k + 1, " ".join([f"c{k}w{i}" for i in range(70)] + p + [f"d{k}w{i}" for i in range(30)])))
    check_passages(passages.merged(passages.passages(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect(), rows)


@pytest.mark.parametrize("period, shared, behind", [(20, 40, 20), (10, 40, 30), (20, 60, 0)])
def test_repeated_lines_of_unequal_length(spark, period, shared, behind):
    """Two documents repeat a line for different lengths; the end of the repetition and what follows is in both."""
    rows = []
    for k in range(40):
        line = [f"l{k}w{i}" for i in range(period)]
        end = [f"e{k}w{i}" for i in range(behind)]
        run = line * (200 // period)
        rows.append((2 * k, " ".join([f"a{k}w{i}" for i in range(40)] + run[-(shared + 20) :] + end + [f"b{k}w{i}" for i in range(40)])))
        rows.append((2 * k + 1, " ".join([f"c{k}w{i}" for i in range(40)] + run[-(shared + 7 + k) :] + end + [f"d{k}w{i}" for i in range(40)])))
    check_passages(passages.merged(passages.passages(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect(), rows)


def test_compact_windows_are_the_wide_nodes_of_the_cartesian_tree():
    random = np.random.default_rng(3)
    texts = [[f"w{x}" for x in random.integers(0, 4000, n)] for n in (30, 50, 51, 400, 900)]
    hashes, _, _, bounds = passages.words([" ".join(t).encode() for t in texts])
    of, function, key, first, last = passages.compact_windows(hashes, bounds)
    for t in range(len(texts)):
        own = hashes[bounds[t] : bounds[t + 1]]
        shingle = passages._runs(own, np.arange(max(0, len(own) - 4)), 5)
        for f, seed in enumerate(passages.SEEDS):
            value, spans = passages.mix(shingle ^ np.uint64(seed)), []

            def node(left, right):
                if right - left >= passages.SHINGLES:
                    c = left + int(value[left:right].argmin())
                    spans.append((max(left, c - passages.SHINGLES + 1), min(c, right - passages.SHINGLES)))
                    node(left, c)
                    node(c + 1, right)

            node(0, len(value))
            mine = (of == t) & (function == f)
            assert sorted(zip(first[mine].tolist(), last[mine].tolist())) == sorted(spans)
    assert len(np.unique(key)) == len(key)


@pytest.mark.parametrize("n, quoted", [(55, 36), (60, 40), (80, 45)])
def test_recall_behind_smaller_documents_that_quote_the_passage(spark, n, quoted):
    """Three smaller documents hold part of a passage that two others hold with one word changed."""
    random = np.random.default_rng(n)
    rows, pairs = [], 100

    def filler(tag, size):
        return [f"{tag}x{i}" for i in range(size)]

    for k in range(pairs):
        p = filler(f"p{k}", n)
        q = p[: n // 2] + [f"new{k}"] + p[n // 2 + 1 :]
        for j in range(3):
            at = int(random.integers(0, n - quoted + 1))
            part = p[at : at + quoted]
            rows.append((5 * k + j, " ".join(filler(f"a{k}{j}", 40) + part + filler(f"b{k}{j}", 40))))
        rows.append((5 * k + 3, " ".join(filler(f"c{k}", 60) + p + filler(f"d{k}", 60))))
        rows.append((5 * k + 4, " ".join(filler(f"e{k}", 50) + q + filler(f"f{k}", 80))))
    found = passages.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    caught = {r.doc_id for r in found if r.doc_id % 5 == 4 and r.first_id == r.doc_id - 1}
    assert len(caught) >= 0.95 * pairs


def test_lines_repeated_in_both_texts_take_little_memory():
    """A word said thousands of times in two texts has millions of pairs of runs; few are held at a time."""
    def text(tag):
        numbers = [f"{tag}{i}" for i in range(200)]
        return " ".join(numbers[:100] + ["thor"] * 3000 + numbers[100:] + ["thor"] * 500).encode()

    (a, _, _), (b, _, _) = (passages.words([text(t)])[:3] for t in "xy")
    passages.alike(a[:300], b[:300])
    tracemalloc.start()
    found = passages.alike(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    covered = {w for s, e, _, _ in found for w in range(s, e)}
    assert covered >= set(range(100, 3100)) | set(range(3200, 3700))
    assert peak < 120e6


def test_links_are_the_same_in_small_pieces():
    random = np.random.default_rng(5)
    line = [f"l{i}" for i in range(7)]
    texts = [[w for _ in range(40) for w in (*line, *(f"{t}{x}" for x in random.integers(0, 30, int(random.integers(0, 4)))))] for t in "ab"]
    a, b = (passages.words([" ".join(t).encode()])[0] for t in texts)
    want = passages.alike(a, b)
    old, passages.LINKS, passages.PIECES = (passages.LINKS, passages.PIECES), 8, 2
    try:
        assert passages.alike(a, b) == want
    finally:
        passages.LINKS, passages.PIECES = old


def test_passages_of_a_pair_are_joined_as_the_query_joins_them(spark):
    random = np.random.default_rng(6)
    found = [(int(s), int(s + n), int(s + d), None) for s, n, d in zip(random.integers(0, 300, 200), random.integers(50, 60, 200), random.integers(0, 4, 200))]
    found += [(5, 70, 9, 80)]
    rows = [(2, 1, s, e, t, end, s * 3, e * 3, 7) for s, e, t, end in found]
    schema = "doc_id long, first_id long, start_word long, end_word long, first_word long, first_end long, start_byte long, end_byte long, text_hash long"
    names = ["start_word", "end_word", "first_word"]
    want = {tuple(r) for r in passages.merged(spark.createDataFrame(rows, schema)).select(names).collect()}
    got = passages._straightened(found)
    assert {tuple(r[:3]) for r in got.tolist() if r[3] < 0} == want
    assert [r for r in got.tolist() if r[3] >= 0] == [[5, 70, 9, 80]]


def test_no_join_is_broadcast_by_its_size(spark, monkeypatch):
    """Plans that change with the size of a table move more at scale than small runs tell; folders don't add up."""
    plans, folders = [], []

    def kept(df, label, by=None, batch=None):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        folders.append(session.kept(df, label, by, batch))
        return folders[-1]

    monkeypatch.setattr(passages, "kept", kept)
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text), (2, "before " + text)], "doc_id bigint, text string")
    assert passages.merged(passages.passages(docs)).count() == 1
    assert plans and not any("Broadcast" in p for p in plans)
    assert sum(f.kept_folder in session._made for f in folders) < len(folders) / 2


def test_texts_that_meet_many_others_are_hashed_once(monkeypatch):
    """Ten texts against twelve others: what a pair costs is looking numbers up, not hashing both texts again."""
    common = [f"c{i}" for i in range(60)]
    here = [" ".join([f"a{k}w{i}" for i in range(170)] + common + [f"b{k}w{i}" for i in range(170)]) for k in range(10)]
    there = [" ".join([f"d{k}w{i}" for i in range(100)] + common + [f"e{k}w{i}" for i in range(240)]) for k in range(12)]
    pairs = [(100 + a, b, 7, here[a], there[b]) for b in range(12) for a in range(10)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pairs)], ["doc_id", "first_id", "text_hash", "text", "first_text"])
    hashed, runs = [], passages._runs

    def counted(hashes, starts, length):
        hashed.append(len(starts))
        return runs(hashes, starts, length)

    monkeypatch.setattr(passages, "_runs", counted)
    found = [r for out in passages._verified(passages.WINDOWS)(iter([batch])) for r in out.to_pylist() if r["window"] is None]
    assert {(r["doc_id"], r["first_id"], r["start_word"], r["end_word"], r["first_word"]) for r in found} == {
        (a, b, 170, 230, 100) for a, b, *_ in pairs
    }
    assert sum(hashed) < 4 * 22 * 400


def test_the_query_gives_each_joined_passage_once(spark, root):
    """Pairs that are compared under several listings have the same passages each time."""
    random = np.random.default_rng(8)
    lines = [[f"l{k}w{i}" for i in range(int(random.integers(3, 30)))] for k in range(12)]
    rows = [(d, " ".join(w for k in random.integers(0, 12, 40) for w in (*lines[k], *(f"x{x}" for x in random.integers(0, 50, 2))))) for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.write.parquet(f"{root}/documents.parquet")
    pieces = passages.passages(docs).cache()
    columns = ["doc_id", "first_id", "start_word", "end_word", "first_word", "first_end"]
    straight = passages.merged(pieces).withColumn("first_end", F.expr("first_word + end_word - start_word"))
    want = straight.select(*columns).union(passages.shifted(pieces).select(*columns)).collect()
    got = passages.op2_substring_dedup(spark, root).select(*columns).collect()
    assert len(want) > 50 and sorted(got) == sorted(want)
