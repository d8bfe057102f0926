import hashlib
import random

import numpy as np
import pytest
from compare import differences
from conftest import SF_DIR

from ledgerline.llm import vectors as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, slot string"
NAN, INF = float("nan"), float("inf")


def plain(rows):
    """Codes, errors and codebooks by plain loops over Python's integers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and abs(x) < INF for x in r[1])]
    longest = -(-max((len(r[1]) for r in rows), default=0) // 4) * 4
    vectors = []
    for i, v, label in rows:
        v = [max(-vc.FARTHEST, min(vc.FARTHEST, int(np.floor(np.float64(np.float32(x)) * 1024)))) for x in v]
        vectors.append((i, v + [0] * (longest - len(v)), label))
    w = longest // 4
    cut = [[v[p * w : p * w + w] for p in range(4)] for _, v, _ in vectors]
    first = sorted(vectors, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]
    books = [[r[1][p * w : p * w + w] for r in first] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            owners = [[] for _ in books[p]]
            for c in cut:
                owners[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(o) for col in zip(*o)] if o else e for o, e in zip(owners, books[p])]
    found = [[nearest(c[p], books[p]) for p in range(4)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(vectors, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{j:02x}" for _, j in f), e, by_label[label], digest)
         for (i, _, label), f, e in zip(vectors, found, errors)), key=str,
    )


def result(spark, rows):
    df = spark.createDataFrame([(*r, "c", "s") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vc.compressed(df).collect()), key=str)


def clustered(n, seed, width=16):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(9)]
    return [
        (i * 3 % n, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], rng.choice([None, 1, 2])) for i in range(n)
    ]


def test_against_plain_loops(spark):
    rows = clustered(330, 1)
    assert result(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = clustered(20, 2, 8) + [
        (100, None, 1), (101, [0.5, None] * 4, 1), (102, [NAN] * 8, 1), (103, [0.1] * 7 + [-INF], None),
        (104, [], 1), (105, [0.25] * 5, 2), (5, [0.0] * 8, None), (5, [0.0] * 8, None), (None, [-0.3] * 8, 1),
        (106, [3e38] * 8, 7), (107, [-3e38] * 8, 7), (108, [1 / 3] * 9, 3),
    ]
    assert result(spark, rows) == plain(rows)


def test_few_rows_and_none(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None, 1)]) == []
    assert result(spark, [(1, [], 1)]) == plain([(1, [], 1)])
    assert result(spark, [(9, [1.0, 2.0, 3.0, 4.0], None)]) == plain([(9, [1.0, 2.0, 3.0, 4.0], None)])


@pytest.mark.parametrize("count, spread", [(1, 5), (63, 3), (64, 50), (65, 1), (256, 400), (256, 2)])
def test_masks_find_the_nearest_entry(count, spread):
    rng = np.random.default_rng(count + spread)
    book = rng.integers(-spread, spread + 1, (count, 6))
    queries = rng.integers(-2 * spread, 2 * spread + 1, (3000, 6))
    apart = ((queries[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    entries, distances = vc.Slices(book).nearest(queries)
    assert (entries == apart.argmin(axis=1)).all() and (distances == apart.min(axis=1)).all()


def test_masks_hold_the_box_and_nothing_else():
    rng = np.random.default_rng(5)
    book, queries = rng.integers(-20, 21, (200, 3)), rng.integers(-20, 21, (50, 3))
    radius = rng.integers(0, 12, 50)
    row, entry = vc.Slices(book).candidates(queries, radius)
    inside = (abs(queries[:, None, :] - book[None, :, :]) <= radius[:, None, None]).all(axis=2)
    assert (np.stack(np.nonzero(inside)) == np.stack([row, entry])).all()


def test_query_against_sql(spark):
    assert differences(vc.op13_codes(spark, SF_DIR), vc.OP13_SQL, SF_DIR) == ""
