"""Near-duplicate passages across documents, by compact windows of min-hashes.

A document is the sequence of its five-word shingles; a passage of 50 words has 46 of them.  Under
each of six hash functions every stretch of shingles has a least one.  The stretches that share it are
a compact window: the span of a node of the Cartesian tree over the hashes, from the last smaller hash
before it to the first one behind it.  Only spans of 46 shingles and more matter; there are about two
for each 46 shingles of a text, and they are read off the minima of all 46 in a row, without the tree's
smaller nodes.  Two stretches of similarity 0.8 have the same least shingle under two of the six
functions or more with probability 0.998; equal stretches do under all of them.

1. Documents list their compact windows by (function, least shingle).  Those that meet the smallest
   doc_id of two functions' windows are compared with it: the windows that the two texts share are
   joined by their intervals, and where two functions cover a stretch its words are verified.
2. A window is open when its document isn't alike with that first one there: it met another under one
   function only, or verification failed.  Open windows that lie together are listed again by pairs
   of functions, and documents are compared with the first that meets two such pairs: one that quotes
   less of a passage no longer stands before it.
3. Stretches under two functions that are still open then are listed by their least shingles under all six
   functions, one row for all neighbours that have the same six, and compared with the first document that
   lists these.  Equal stretches have all six in common.
4. Of stretches that the first such document shares all six with and still isn't alike, the 50 words are
   listed and joined to the first document that lists the same; that one holds them.

Verification: runs of equal words are chained over changed, left out and inserted words while the
chain's shingles have a similarity of 0.8.  For shingles in common n and others m (of both sides) that
is n >= 4m, so a chain's score is a sum over its runs and gaps.

What is moved: narrow rows for windows, and the two texts of a pair that met twice.  Counting keys is
combined on the map side and the rows of a hot key are joined to a written table, which Spark splits.
Joins are sort-merge joins, or hash joins dealt by key where one side has each key once, so that no size of
table has a plan of its own; what was written for one listing is deleted after it.  Python is sent some hundred
pairs of texts at a time and hashes and numbers each text among them once.

Result: one row per document and repeated passage, with the first document that holds it.

Defined cases: null, empty and short texts (under 50 words) have no passages; passages within one
document only aren't reported; rows with null doc_id take no part; doc_ids are taken as unique, rows
that repeat one with another text are left as they are; other columns are not looked at; no rows
give no rows.  A shorter run of 45 equal words or more is a passage with the words beside it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.shingles import WIDTH, _power_tables, groups_of, mix, word_lists, words
from ledgerline.session import kept, release

LEAST = 50  # words of a passage
SHINGLES = LEAST - WIDTH + 1
SEEDS = tuple(mix(np.arange(1, 7, dtype=np.uint64)).tolist())
ENOUGH = 2  # hash functions that must agree
OTHER = 4  # shingles in common that make up for one that isn't, at a similarity of 0.8
SLICE = 128  # pairs of texts split into words at a time
WINDOWS, SIX, WORDS = "windows", "six", "words"  # what open stretches are listed by
MATCHES = 1 << 18  # equal shingles of a pair of texts held at a time
LINKS, PIECES = 1 << 13, 32  # pairs of runs that are worked out at a time, and how often they are held
ROWS = 2048  # texts that are sent to Python at a time
GROUP_BYTES = 1 << 18  # text whose windows are listed at a time
BLOCK = 1 << 17  # text split into words at a time


def _runs(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of `length` consecutive words from each start; equal runs have equal hashes."""
    up, down = _power_tables(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[starts + length] - sums[starts]) * down[starts] + np.uint64(length))


def _window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """The least value of each run of `size` values, from runs of 1, 2, 4 and so on."""
    known = 1
    while 2 * known <= size:
        values = np.minimum(values[:-known], values[known:])
        known *= 2
    rest = size - known
    return np.minimum(values[: len(values) - rest], values[rest:])


def compact_windows(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, function, key, first, last) of the compact windows of several texts, text i from bounds[i] to bounds[i + 1].

    A window's 50-word stretches begin at the words first to last of its text; all of them have the
    same least shingle under the function.  The key names function and shingle.
    """
    n = len(hashes)
    if n < LEAST:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts = np.flatnonzero(text[: n - LEAST + 1] == text[LEAST - 1 :])
    of = text[starts]
    shingles = _runs(hashes, np.arange(n - WIDTH + 1), WIDTH)
    turn = of[1:] != of[:-1]
    parts = []
    for function, seed in enumerate(SEEDS):
        least = _window_minima(mix(shingles ^ np.uint64(seed)), SHINGLES)[starts]
        new = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | turn)) if len(starts) else starts
        last = np.append(new[1:], len(starts))[: len(new)] - 1
        key = mix(least[new] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(function)).view(np.int64)
        begin = bounds[of[new]]
        parts.append((of[new], np.full(len(new), function), key, starts[new] - begin, starts[last] - begin))
    return tuple(np.concatenate(x) for x in zip(*parts))


WINDOW = "key bigint, doc_id bigint, function tinyint, place int"


def _windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The compact windows of every text."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for a, b in groups_of(texts, GROUP_BYTES):
            hashes, _, _, bounds = words(texts[a:b])
            of, function, key, first, _ = compact_windows(hashes, bounds)
            columns = [pa.array(key), pa.array(ids[a:b][of]), pa.array(function, pa.int8()), pa.array(first, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "function", "place"])


def _first_of(rows: DataFrame, key: str) -> DataFrame:
    """Keys that more than one document has, and the smallest doc_id of each."""
    ends = rows.groupBy(key).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    return ends.filter("first_id < last_id").select(key, "first_id")


def _meetings(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The rows that share a key with a smaller doc_id, and the smallest one that has the key; the shared keys."""
    shared = kept(_first_of(rows, "key"), label, batch=ROWS)
    # each key is there once, so that no task's table outgrows the others'
    return rows.join(shared.hint("shuffle_hash"), "key").filter("doc_id > first_id"), shared


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, doc_id for each two windows of different functions that may share a stretch; rows come by document and place."""
    tail = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if tail is None else [tail, batch])
        key, doc, function, place = (table.column(n).to_numpy() for n in ("key", "doc_id", "function", "place"))
        known, n, shift = 0 if tail is None else tail.num_rows, len(key), 1
        while shift < n:
            near = (doc[shift:] == doc[:-shift]) & (place[shift:] - place[:-shift] < SHINGLES)
            near[: max(0, known - shift)] = False
            if not near[max(0, known - shift) :].any():
                break
            i = np.flatnonzero(near & (function[shift:] != function[:-shift]))
            low = np.where(function[i] < function[i + shift], key[i], key[i + shift]).view(np.uint64)
            high = np.where(function[i] < function[i + shift], key[i + shift], key[i]).view(np.uint64)
            both = mix(low * np.uint64(0xD6E8FEB86659FD93) + high).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both), pa.array(doc[i])], ["key", "doc_id"])
            shift += 1
        open_end = np.flatnonzero((doc == doc[-1]) & (place > place[-1] - SHINGLES)) if n else np.zeros(0, int)
        tail = table.slice(int(open_end[0])).combine_chunks().to_batches()[0] if len(open_end) else None


def _first_equal(hashes: np.ndarray) -> np.ndarray:
    """For each hash the place of the first that equals it; those that meet another in the table are dealt again."""
    out = np.empty(len(hashes), np.int64)
    rest, bits = np.arange(len(hashes))[::-1], 1 + len(hashes).bit_length()
    table, values, turn = np.zeros(1 << bits, np.int32), hashes[::-1], 0
    while len(rest):
        slot = (values >> np.uint64(64 - bits)).view(np.int64)
        table[slot] = rest  # of several the last is kept, which is the first place
        first = table[slot]
        out[rest] = first
        turn += 1
        rest = rest[hashes[first] != hashes[rest]]
        values = mix(hashes[rest] + np.uint64(turn))
    return out


class _Texts:
    """The word hashes of some texts, with equal shingles, 50-word runs and windows numbered alike.

    Each text is hashed and numbered once; a pair looks its numbers up in a table of the other text's places.
    """

    def __init__(self, lists: list[np.ndarray]):
        bounds = np.cumsum([0, *(len(x) for x in lists)])
        hashes = np.concatenate([*lists, np.zeros(0, np.uint64)])
        self.words = lists
        self.numbers, self.places = {}, {}
        for length in (WIDTH, LEAST):
            runs = _runs(hashes, np.arange(max(0, len(hashes) - length + 1)), length)
            self._number(length, runs, bounds[:-1], bounds[1:] - length + 1)
        of, *columns = compact_windows(hashes, bounds)
        order = np.argsort(of, kind="stable")
        columns = [c[order] for c in columns]
        cut = np.searchsorted(of[order], np.arange(len(lists) + 1))
        self.windows = [[c[a:b] for c in columns] for a, b in zip(cut[:-1], cut[1:])]
        self._number(WINDOWS, columns[1], cut[:-1], cut[1:])
        self.sixes: dict[int, np.ndarray] = {}
        self.other: int | None = None

    def _number(self, kind: int | str, values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        numbers = _first_equal(values.view(np.uint64))
        self.numbers[kind] = [numbers[a : max(a, b)] for a, b in zip(begins.tolist(), ends.tolist())]
        self.places[kind] = np.full(len(values), -1)

    def against(self, other: int) -> None:
        """Hold the texts that come against this one."""
        if other == self.other:
            return
        for kind, places in self.places.items():
            if self.other is not None:
                places[self.numbers[kind][self.other]] = -1
            numbers = self.numbers[kind][other]
            places[numbers[::-1]] = np.arange(len(numbers) - 1, -1, -1)
        self.other = other
        first = self.first_places(WIDTH, other)
        self.counts = np.bincount(first, minlength=len(first))
        self.repeats = bool((self.counts == 0).any())
        if self.repeats:
            self.order = np.argsort(first, kind="stable")
            self.starts = np.cumsum(self.counts) - self.counts

    def first_places(self, kind: int | str, text: int) -> np.ndarray:
        """The first place of each of a text's numbers in the other text, or -1."""
        return self.places[kind][self.numbers[kind][text]]

    def six(self, text: int) -> np.ndarray:
        if text not in self.sixes:
            self.sixes[text] = _sixes(self.windows[text], len(self.words[text]))
        return self.sixes[text]

    def equal_runs(self, first: np.ndarray) -> np.ndarray:
        """Rows (first shingle here, in the other, shingles) of the runs of equal shingles, by their places here."""
        own = np.flatnonzero(first >= 0)
        at = first[own]
        counts = self.counts[at]
        if not self.repeats or not (counts > 1).any():
            return _joined(own, at, np.ones_like(own))
        sums = np.cumsum(counts)
        parts, pieces = [], range(int(sums[-1]) // MATCHES + 1)
        for a, b in pairwise(np.searchsorted(sums, [k * MATCHES for k in (*pieces, len(pieces))]).tolist()):
            n = counts[a:b]
            i = np.repeat(own[a:b], n)
            j = self.order[np.arange(len(i)) + np.repeat(self.starts[at[a:b]] - np.cumsum(n) + n, n)]
            by = _by_diagonal(i, j)
            parts.append(_joined(i[by], j[by], np.ones_like(i)))
        runs = parts[0]
        if len(parts) > 1:
            i, j, length = np.concatenate(parts).T
            by = _by_diagonal(i, j)
            runs = _joined(i[by], j[by], length[by])
        return runs[np.argsort(runs[:, 0] * len(self.counts) + runs[:, 1])]


def _by_diagonal(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The order by diagonals; rows of one diagonal stay as they come, which is by i."""
    diagonal = i - j
    if len(i) and max(i.max(), j.max()) < 1 << 15:
        diagonal = diagonal.astype(np.int16)  # which numpy sorts in one pass
    return np.argsort(diagonal, kind="stable")


def _joined(i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Runs that follow each other on a diagonal as one; rows come by diagonal, or have one place each in both texts."""
    ends, there = i + length, j + length
    new = np.flatnonzero(np.append(True, (i[1:] != ends[:-1]) | (j[1:] != there[:-1]))[: len(i)])
    last = np.append(new[1:], len(i))[: len(new)] - 1
    return np.stack([i[new], j[new], ends[last] - i[new]], axis=1)


def _may_begin(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a passage of a text of n words may begin, and the score's sums and best ends that tell it.

    The text's own shingles bound the score: 1 for one that the other has too, -4 for another.
    """
    has = np.full(n + 1, -OTHER)
    has[: len(first)][first >= 0] = 1
    total = np.zeros(n + 2, np.int64)
    np.cumsum(has, out=total[1:])
    ahead = np.maximum.accumulate(total[::-1])[::-1]
    most = LEAST - 2 * WIDTH + 1
    begins = np.zeros(n + 1, bool)
    if n >= most:
        begins[: n - most + 1] = (has[: n - most + 1] > 0) & (ahead[most : n + 1] >= total[: n - most + 1])
    return begins, total, ahead


def _chains(
    runs: np.ndarray, n: int, m: int, may: np.ndarray, total: np.ndarray, ahead: np.ndarray
) -> Iterator[tuple[int, int, int, int | None]]:
    """Chains of runs that are passages of texts of n and m words; the rest is what `_may_begin` gives.

    (start in a, end in a, start in b, end in b), in words; the last is None for chains on one diagonal.
    """
    i, j, length = runs.T
    ends, there = i + length, j + length
    begins = i[may[i]]
    if not len(begins):
        return
    links = _Links(runs)
    done, begins = -1, set(begins.tolist())
    least = (total[ends] - ahead[ends]).tolist()  # a chain with less never makes up for it
    i, j, length, ends, there = (x.tolist() for x in (i, j, length, ends, there))
    for p in range(len(runs)):
        if ends[p] <= done or i[p] not in begins:
            continue
        score, found = {p: (length[p], False)}, None
        todo = [p]
        while todo:
            q = heappop(todo)
            value, bent = score[q]
            if value < least[q]:
                continue
            s, e, t, end = i[p], ends[q] + WIDTH - 1, j[p], there[q] + WIDTH - 1
            short = max(0, LEAST - (e - s), LEAST - (end - t))
            behind = min(short, n - e, m - end)
            before = short - behind
            if value >= 2 * OTHER * short and before <= min(s, t) and (not found or e + behind > found[1]):
                found = s - before, e + behind, t - before, end + behind if bent else None
                last = ends[q]
            for to, gain in links.behind(q):
                if to not in score:
                    heappush(todo, to)
                if to not in score or value + gain > score[to][0]:
                    score[to] = value + gain, bent or i[to] - j[to] != i[q] - j[q]
        if found:
            done = max(done, last)
            yield found


class _Links:
    """For each run the later ones that carry it on, and by how much they raise a chain's score.

    Worked out for some runs at a time when a chain gets there: lines that both texts repeat have as many
    pairs of runs as the product of their repetitions, and a chain meets few of them.
    """

    def __init__(self, runs: np.ndarray):
        self.i, self.j, self.length = i, j, length = np.ascontiguousarray(runs.T)
        self.ends, self.there = i + length, j + length
        # a run that is shorter than the gap before it or behind it doesn't carry a chain on
        last = np.searchsorted(i, i + 2 * length + 2 * WIDTH, "right")
        self.counts = np.maximum(last - np.arange(len(runs)) - 1, 0)
        self.piece = np.cumsum(self.counts) // LINKS
        self.of = self.piece.tolist()
        self.known: dict[int, tuple[int, list[int], list[int], list[int]]] = {}

    def behind(self, run: int) -> Iterator[tuple[int, int]]:
        piece = self.of[run]
        if piece not in self.known:
            if len(self.known) == PIECES:
                del self.known[next(iter(self.known))]
            self.known[piece] = self._of(piece)
        start, bounds, to, gain = self.known[piece]
        part = slice(bounds[run - start], bounds[run - start + 1])
        return zip(to[part], gain[part])

    def _of(self, piece: int) -> tuple[int, list[int], list[int], list[int]]:
        start, stop = np.searchsorted(self.piece, [piece, piece + 1]).tolist()
        own, c = slice(start, stop), self.counts[start:stop]
        q = np.arange(c.sum()) + np.repeat(np.arange(start + 1, stop + 1) - np.cumsum(c) + c, c)
        there = self.there[own]
        near = (self.there[q] > np.repeat(there, c)) & (self.j[q] <= np.repeat(there + self.length[own] + 2 * WIDTH, c))
        near = np.flatnonzero(near & (self.ends[q] > np.repeat(self.ends[own], c)))
        r, q = np.repeat(np.arange(start, stop), c)[near], q[near]
        i, j, ends, there = self.i[q], self.j[q], self.ends[r], self.there[r]
        over = np.maximum(0, np.maximum(ends - i, there - j))
        here_gap, there_gap, rest = i + over - ends, j + over - there, self.length[q] - over
        wide = np.maximum(here_gap, there_gap) - WIDTH + 1
        fits = np.flatnonzero((rest > 0) & (wide <= np.minimum(rest, self.length[r]) + WIDTH - 1))
        gain = rest[fits] - OTHER * (here_gap[fits] + there_gap[fits])
        return start, np.searchsorted(r[fits], np.arange(start, stop + 1)).tolist(), q[fits].tolist(), gain.tolist()


def alike(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int | None]]:
    """Passages of two texts' words, as _chains gives them."""
    texts = _Texts([a, b])
    texts.against(1)
    rows = {(*r[:3], r[3] if r[3] >= 0 else None) for r in _alike(texts, 0).tolist()}
    return sorted(rows, key=lambda x: x[:3])


def _alike(texts: _Texts, one: int) -> np.ndarray:
    """Rows (start, end, start in the other, end there or -1) of the passages that a text shares with the other."""
    n, m = len(texts.words[one]), len(texts.words[texts.other])
    if min(n, m) < LEAST:
        return np.zeros((0, 4), np.int64)
    place = texts.first_places(LEAST, one)
    s = np.flatnonzero(place >= 0)
    t = place[s]
    new = np.flatnonzero(np.append(True, (s[1:] != s[:-1] + 1) | (t[1:] != t[:-1] + 1))[: len(s)])
    last = np.append(new[1:], len(s))[: len(new)] - 1
    found = np.stack([s[new], s[last] + LEAST, t[new], np.full(len(new), -1)], axis=1)
    if len(s) == len(place):
        return found
    first = texts.first_places(WIDTH, one)
    may, *sums = _may_begin(first, n)
    if not may.any():
        return found
    runs = texts.equal_runs(first)
    # a passage of 50 words has 41 shingles in common
    if runs[:, 2].sum() < LEAST - 2 * WIDTH + 1:
        return found
    chains = dict.fromkeys((*c[:3], -1 if c[3] is None else c[3]) for c in _chains(runs, n, m, may, *sums))
    return np.concatenate([found, np.array(list(chains), np.int64).reshape(-1, 4)])


PASSAGE = (
    "doc_id bigint, first_id bigint, start_word bigint, end_word bigint, first_word bigint, first_end bigint, "
    "start_byte bigint, end_byte bigint, text_hash bigint, window bigint"
)
_NAMES = [f.split()[0] for f in PASSAGE.split(", ")]


def _shared_windows(texts: _Texts, one: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of a text the other has too, and where enough functions cover a stretch."""
    _, _, first, last = texts.windows[one]
    met = texts.first_places(WINDOWS, one) >= 0
    n = len(texts.words[one]) + 1
    cover = np.bincount(first[met], minlength=n) - np.bincount(last[met] + 1, minlength=n)
    return met, np.cumsum(cover) >= ENOUGH


def _inside(first: np.ndarray, last: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which stretches of words lie within a passage."""
    if not len(found) or not len(first):
        return np.zeros(len(first), bool)
    begins, ends = found[np.argsort(found[:, 0]), :2].T
    before = np.searchsorted(begins, first, "right")
    return (before > 0) & (np.maximum.accumulate(ends)[before - 1] >= last)


def _straightened(found: list[tuple] | np.ndarray) -> np.ndarray:
    """Rows (start, end, start in the other, end there or -1); passages that overlap on one diagonal are one.

    A fifth column tells pairs of texts apart.
    """
    if isinstance(found, list):
        found = np.array([f if f[3] is not None else (*f[:3], -1) for f in found], np.int64).reshape(-1, 4)
    bent, rows = found[found[:, 3] >= 0], found[found[:, 3] < 0]
    if not len(rows):
        return bent
    pair = rows[:, 4] if rows.shape[1] > 4 else np.zeros(len(rows), np.int64)
    begin, end, there = rows.T[:3]
    order = np.lexsort((begin, begin - there, pair))
    rows, pair = rows[order], pair[order]
    begin, end, there = rows.T[:3]
    turn = np.append(True, (np.diff(begin - there) != 0) | (np.diff(pair) != 0))
    # ends of one diagonal are all above those of the ones before it
    above = np.cumsum(turn) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + above) - above
    new = np.flatnonzero(turn | np.append(True, begin[1:] > reach[:-1]))
    last = np.append(new[1:], len(begin)) - 1
    straight = rows[new]
    straight[:, 1] = reach[last]
    return np.concatenate([straight, bent])


def _sixes(windows: list[np.ndarray], n: int) -> np.ndarray:
    """For each 50-word stretch of a text of n words, a hash of its least shingles under all functions."""
    _, key, first, last = windows
    change = np.zeros(max(n - LEAST, -1) + 2, np.uint64)
    np.add.at(change, first, key.view(np.uint64))
    np.subtract.at(change, last + 1, key.view(np.uint64))
    return mix(np.cumsum(change[:-1], dtype=np.uint64))


def _open_stretches(
    listing: str, texts: _Texts, one: int, met: np.ndarray, enough: np.ndarray, found: np.ndarray
) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """(start, function, key) of what no passage found holds, as the next listing wants it."""
    function, key, low, high = (c[met] for c in texts.windows[one])
    still = ~_inside(low, high + LEAST, found)
    if listing == WINDOWS:
        return low[still], function[still], key[still]
    a = texts.words[one]
    n = max(0, len(a) - LEAST + 1)
    cover = np.bincount(low[still], minlength=n + 1) - np.bincount(high[still] + 1, minlength=n + 1)
    starts = np.flatnonzero((np.cumsum(cover)[:n] > 0) & enough[:n])
    starts = starts[~_inside(starts, starts + LEAST, found)]
    six = texts.six(one)[starts]
    if listing == WORDS:
        starts = starts[np.isin(six, texts.six(texts.other))]
        return starts, None, _runs(a, starts, LEAST).view(np.int64)
    new = np.flatnonzero(np.append(True, six[1:] != six[:-1])[: len(six)])
    return starts[new], None, six[new].view(np.int64)


def _verified(listing: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Passages of (doc_id, first_id, text_hash, text, first_text), and what stays open.

    Rows with a key in `window` are open, listed by `WINDOWS`: the document's windows that the first text
    shares without a passage that holds them (place and function as start_word and first_word); `SIX`: runs of
    50-word stretches in such windows with the same least shingles; or `WORDS`: the stretches that share
    these with the first text, by their words.  Texts and pairs that occur again in a slice are worked out once.
    """

    def compared(texts: _Texts, one: int, other: int) -> tuple[np.ndarray, tuple]:
        texts.against(other)
        met, enough = _shared_windows(texts, one)
        found = _alike(texts, one) if enough.any() else np.zeros((0, 4), np.int64)
        return found, _open_stretches(listing, texts, one, met, enough, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            ids = batch.column(0).to_pylist()
            here, there = (batch.column(i).cast(pa.binary()).to_pylist() for i in (3, 4))
            number = {t: i for i, t in enumerate(dict.fromkeys(here + there))}
            lists, firsts, lasts = zip(*word_lists(list(number), BLOCK))
            texts = _Texts(list(lists))
            done: dict[tuple[int, int], tuple] = {}
            passed: list[np.ndarray] = []
            opened: list[tuple] = []
            for doc_id, pair in zip(ids, ((number[a], number[b]) for a, b in zip(here, there))):
                if pair not in done:
                    done[pair] = compared(texts, *pair)
                found, rest = done[pair]
                passed.append(found)
                opened.append((doc_id, *rest))
            of = np.repeat(np.arange(len(passed)), [len(p) for p in passed])
            rows = _straightened(np.column_stack([np.concatenate(passed), of]))
            if len(rows):
                of = rows[:, 4]
                begins = np.cumsum([0, *(len(x) for x in lists)])[[number[t] for t in here]][of]
                bytes_of = np.concatenate(firsts)[begins + rows[:, 0]], np.concatenate(lasts)[begins + rows[:, 1] - 1]
                doc_id, first_id, mark = (batch.column(i).take(pa.array(of)).cast(pa.int64()) for i in range(3))
                places = [pa.array(c, mask=c < 0) for c in (*rows.T[:4], *bytes_of)]
                yield pa.RecordBatch.from_arrays([doc_id, first_id, *places, mark, pa.nulls(len(rows), pa.int64())], _NAMES)
            counts = [len(o[1]) for o in opened]
            if total := sum(counts):
                none = pa.nulls(total, pa.int64())
                listed = {
                    "doc_id": pa.array(np.repeat(np.array([o[0] for o in opened], np.int64), counts)),
                    "start_word": pa.array(np.concatenate([o[1] for o in opened])),
                    "window": pa.array(np.concatenate([o[3] for o in opened])),
                }
                if listing == WINDOWS:
                    listed["first_word"] = pa.array(np.concatenate([o[2] for o in opened]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([listed.get(name, none) for name in _NAMES], _NAMES)

    return run


def _compared(docs: DataFrame, pairs: DataFrame, listing: str, label: str) -> tuple[DataFrame, DataFrame]:
    """The rows of `_verified` for pairs (doc_id, first_id), and the texts of these."""
    wanted = pairs.select("doc_id").union(pairs.select("first_id")).distinct()
    texts = kept(docs.join(wanted.hint("merge"), "doc_id").dropDuplicates(["doc_id"]), "texts")
    marked = texts.withColumn("text_hash", F.xxhash64("text"))
    others = texts.select(F.col("doc_id").alias("first_id"), F.col("text").alias("first_text"))
    both = pairs.join(marked.hint("merge"), "doc_id").join(others.hint("merge"), "first_id")
    checked = both.select("doc_id", "first_id", "text_hash", "text", "first_text")
    return kept(checked.mapInArrow(_verified(listing), PASSAGE), label, batch=SLICE), texts


def passages(docs: DataFrame) -> DataFrame:
    """doc_id, first_id and places of every repeated passage; places may overlap."""
    docs = docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    pair = ["doc_id", "first_id"]

    rows, shared = _meetings(docs.mapInArrow(_windows_of, WINDOW), "shared")
    met = kept(rows, "met", batch=ROWS)
    release(shared)
    functions = F.bit_count(F.expr("bit_or(shiftleft(1, int(function)))"))
    counted = kept(met.groupBy(*pair).agg((functions >= ENOUGH).alias("often")), "counted")
    often = counted.filter("often").select(*pair)
    first, texts = _compared(docs, often, WINDOWS, "first")
    release(texts)

    once = met.join(counted.filter("NOT often").select(*pair).hint("shuffle_hash"), pair).select("key", "doc_id", "function", "place")
    failed = first.filter("window IS NOT NULL").selectExpr(
        "window AS key", "doc_id", "cast(first_word AS tinyint) AS function", "cast(start_word AS int) AS place"
    )
    waiting = once.union(failed).repartition("doc_id").distinct().sortWithinPartitions("doc_id", "place")
    together = kept(waiting.mapInArrow(_together, "key bigint, doc_id bigint"), "together")
    release(met)
    # three functions make three pairs, two make one
    rows, shared = _meetings(together, "shared")
    several = rows.groupBy(*pair).agg((F.min("key") < F.max("key")).alias("several")).filter("several")
    again = kept(several.select(*pair).join(often.hint("merge"), pair, "left_anti"), "again")
    release(shared, together, counted)
    second, texts = _compared(docs, again, SIX, "second")
    release(again)

    # a pair compared before may meet again: what its stretches have in common isn't known yet
    third, fewer = _compared(texts, _pairs_listed(second, "sixth"), WORDS, "third")
    release(texts)
    fourth, last = _compared(fewer, _pairs_listed(third, "last"), WORDS, "fourth")
    release(fewer, last)
    return first.union(second).union(third).union(fourth).filter("window IS NULL").drop("window")


def _pairs_listed(rows: DataFrame, label: str) -> DataFrame:
    """The pairs (doc_id, first_id) that open stretches make."""
    listed = rows.filter("window IS NOT NULL").select(F.col("window").alias("key"), "doc_id")
    met, shared = _meetings(listed, "shared")
    out = kept(met.select("doc_id", "first_id").distinct(), label)
    release(shared)
    return out


def shifted(found: DataFrame) -> DataFrame:
    """Passages with words inserted or left out on one side: they aren't on one diagonal."""
    return found.filter("first_end IS NOT NULL").distinct()


def merged(found: DataFrame) -> DataFrame:
    """The passages on one diagonal; overlapping places with one first document and diagonal as one row."""
    found = found.filter("first_end IS NULL")
    diagonal = F.col("start_word") - F.col("first_word")
    keys = ["doc_id", "first_id", "diagonal"]
    lists = found.withColumn("diagonal", diagonal).groupBy(*keys, "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("start_word", "end_word", "start_byte", "end_byte"))).alias("places")
    )
    joined = F.expr(
        """aggregate(places, cast(array() as array<struct<start_word: bigint, end_word: bigint, start_byte: bigint, end_byte: bigint>>),
        (done, p) -> if(size(done) > 0 and element_at(done, -1).end_word >= p.start_word,
          concat(slice(done, 1, size(done) - 1), array(named_struct(
            'start_word', element_at(done, -1).start_word,
            'end_word', greatest(element_at(done, -1).end_word, p.end_word),
            'start_byte', element_at(done, -1).start_byte,
            'end_byte', greatest(element_at(done, -1).end_byte, p.end_byte)))),
          concat(done, array(p))))"""
    )
    return lists.select(*keys, "text_hash", F.inline(joined)).withColumn(
        "first_word", F.col("start_word") - F.col("diagonal")
    ).drop("diagonal")


def cut_passages(docs: DataFrame) -> DataFrame:
    """docs with every passage that an earlier document holds cut out; n_chars follows the text."""
    spans = kept(
        passages(docs)
        .groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"))
        .agg(F.sort_array(F.collect_set(F.struct("start_byte", "end_byte"))).alias("_spans")),
        "spans",
    )

    @F.pandas_udf("string")
    def without(text: pd.Series, places: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(text, places):
            if t is None:
                out.append(None)
                continue
            raw, parts, at = t.encode(), [], 0
            for span in spans:
                parts.append(raw[at : max(at, span["start_byte"])])
                at = max(at, span["end_byte"])
            out.append(b"".join([*parts, raw[at:]]).decode())
        return pd.Series(out)

    on = (F.col("doc_id") == F.col("_doc")) & (F.xxhash64("text") == F.col("_hash"))
    joined = docs.join(spans, on, "left")
    changed = F.col("_spans").isNotNull()
    # only texts that change are sent to Python
    cut = joined.withColumn("_cut", without(F.when(changed, F.col("text")), "_spans"))
    out = cut.withColumn("text", F.when(changed, F.col("_cut")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and passage: doc_id, first_id, and where it is in both, in words."""
    # a pair's passages on one diagonal are joined where it is compared; a pair compared again has the same ones
    columns = ["doc_id", "first_id", "start_word", "end_word", "first_word", "first_end"]
    found = passages(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(*columns).distinct()
    return found.withColumn("first_end", F.expr("coalesce(first_end, first_word + end_word - start_word)"))
