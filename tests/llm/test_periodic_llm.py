import hashlib
import random
import zlib

import pytest
from conftest import ODD, SF_DIR

from ledgerline.llm import periodic as pr


def plain_runs(words):
    """Runs as (start, length, period) by comparing words at every lag."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and n and h % 10 == 0:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(runs), best[0], best[1], best[2], 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def random_text(rng):
    """Stretches of random words and of repeated blocks, over few or many words."""
    out = []
    for _ in range(rng.randint(1, 6)):
        kinds = rng.choice([1, 2, 3, 50, 5000])
        block = [f"w{rng.randrange(kinds)}" for _ in range(rng.randint(1, rng.choice([3, 20, 90])))]
        out += block * rng.choice([1, 1, 3, 4, 9]) + block[: rng.randrange(len(block) + 1)]
    return [w.encode() for w in out]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    texts = [random_text(rng) for _ in range(60)] + [[], [b"a"], [b"a"] * 23, [b"a"] * 24]
    for words, got in zip(texts, pr.runs_of(texts)):
        assert list(map(tuple, got.tolist())) == plain_runs(words)


def test_nested_and_fibonacci_runs():
    a, b = [b"a"], [b"b"]
    fib = [a, b]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    inner = ([b"x"] * 30 + [b"y"]) * 4
    texts = [fib[-1], inner * 3, [b"a", b"b"] * 500, [b"z"] * 1000]
    for words, got in zip(texts, pr.runs_of(texts)):
        assert list(map(tuple, got.tolist())) == plain_runs(words)


@pytest.mark.parametrize("period", [15, 16, 17, 23, 24, 35, 36, 200, 3000])
def test_three_periods_are_enough(period):
    rng = random.Random(period)
    block = [b"%d" % rng.randrange(10**6) for _ in range(period)]
    edge = [b"%d" % rng.randrange(10**6) for _ in range(40)]
    (got,) = pr.runs_of([edge + block * 3 + edge[::-1]])
    expected = [(40, 3 * period, period)]
    assert list(map(tuple, got.tolist())) == expected
    (got,) = pr.runs_of([edge + (block * 3)[:-1] + edge[::-1]])
    assert not len(got)


def test_every_scale_leaves_a_window():
    reach = pr.DIRECT
    for least, k in pr.scales(100_000):
        assert least == reach and 3 * least > 2 * k
        assert 3 * least - k - least + 1 >= k // 3 + 1
        reach = k + 1
    assert 3 * reach > 100_000


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(odd, nothing):
    got = rows(pr.summary(pr.periodic_runs(odd, planted=True)))
    expected = [plain_row(i, t) for i, t in ODD if i not in (6, 7)]
    assert [r for r in got if r[0] not in (6, 7)] == sorted(expected, key=str)
    assert pr.summary(pr.periodic_runs(nothing)).count() == 0


def test_query_against_plain_rows(spark, documents):
    got = {r[0]: r for r in rows(pr.op11_periodic(spark, SF_DIR))}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert len(got) == len(texts)
    short = [i for i, t in texts.items() if len(t.split()) <= 2500]
    assert len(short) > 0.95 * len(texts)
    assert [got[i] for i in short] == [plain_row(i, texts[i]) for i in short]
    assert sum(r[1] > 0 for r in got.values()) >= 10


def test_long_repetitive_texts_take_linear_memory_and_time():
    words = [b"a", b"b", b"c"] * 100_000
    (got,) = pr.runs_of([words])
    assert got.tolist() == [[0, 300_000, 3]]
