import hashlib
import random

import numpy as np
import pytest
from conftest import ODD

from ledgerline.llm import fingerprint as fp


def brute(rows):
    """Results by a plain loop; rows in order of doc_id (nulls first), then of the texts' digests."""
    rows = sorted(
        ((i, t or "") for i, t in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).digest()[:8]),
    )
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        m = len(t) // 4
        new = t[: len(t) - m] + following[:m]
        own, other, nxt = (next(iter(fp.chunk_sets([x.encode()]))) for x in (t, new, following))
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), fp.written(own), fp.written(other),
                    fp.likeness(own, other), fp.likeness(own, nxt)))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_odd_rows(odd, ranges):
    got = sorted((tuple(r) for r in fp.fingerprints(odd, ranges).collect()), key=str)
    assert got == brute(ODD)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = fp.fingerprints(documents).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    long = [r for r in got if r.n_chars >= 400]
    assert min(r.near_edited for r in long) > 0.5
    assert sum(r.near_next > 0.3 for r in long) <= 0.05 * len(long)


def test_one_row_and_none(spark, nothing):
    one = spark.createDataFrame([(5, "abcd" * 50)], "doc_id bigint, text string")
    assert [tuple(r) for r in fp.fingerprints(one).collect()] == brute([(5, "abcd" * 50)])
    assert fp.fingerprints(nothing).count() == 0
    only_nulls = spark.createDataFrame([(None, "ab"), (None, "cd")], "doc_id bigint, text string")
    assert sorted((tuple(r) for r in fp.fingerprints(only_nulls).collect()), key=str) == brute([(None, "ab"), (None, "cd")])


def test_boundaries_follow_the_definition():
    data = random.Random(3).randbytes(5000)
    plain = []
    for i in range(len(data)):
        window = data[max(0, i - fp.WINDOW + 1) : i + 1]
        h = 0
        for byte in window:
            h = ((h << 1) + int(fp._GEAR[byte])) & 0xFFFFFFFF
        plain.append(h)
    assert fp.gear(np.frombuffer(data, np.uint8)).tolist() == plain
    ends, start = [], 0
    while start < len(data):
        end = min(start + fp.MOST, len(data))
        for stop in range(start + fp.LEAST, end):
            bits = fp.HARD if stop - start <= fp.NORMAL else fp.EASY
            if plain[stop - 1] >> (32 - bits) == 0:
                end = stop
                break
        ends.append(end)
        start = end
    found, at = next(iter(fp.chunk_sets([data]))), 0
    lengths = []
    for end in ends:
        lengths.append(end - at)
        at = end
    assert sorted(found.values()) == sorted(lengths)


def test_an_insertion_changes_few_chunks():
    data = random.Random(4).randbytes(20_000)
    a, b = fp.chunk_sets([data, data[:9_000] + b"inserted" + data[9_000:]])
    assert fp.likeness(a, b) > 0.95 and fp.likeness(a, a) == 1.0
    assert fp.likeness({}, {}) == 1.0 and fp.likeness({}, a) == 0.0
