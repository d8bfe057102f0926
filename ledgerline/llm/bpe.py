"""Byte-level BPE by a contiguous rank array.

A word is held as two lists, the ids of its parts and the ranks of the merges between
neighbours.  The least rank is found by a scan, its boundary is deleted, and the two ranks
beside it are looked up again.  Words are short, so the scan is cheaper than a heap; a word
over `LONG` bytes (a run of letters without a space) takes a heap, with the same merges in
the same order.

Words repeat, so their encodings are remembered in a dictionary of bounded size; when it is
full it is started anew, which changes no result.

The vocabulary is read from a tokenizers JSON file whose path is a parameter.  Such a file
must lie at the same path on every worker, as an installed package does.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from functools import cache
from struct import pack

import numpy as np

LONG = 256
REMEMBERED = 400_000
NONE = 1 << 30

#: The white space of Unicode.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Letters and numbers that came with Unicode 16.0, for an older `unicodedata`.
NEW_LETTERS = """
1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389
1138b-1138b 1138e-1138e 11390-113b5 113b7-113b7 113d1-113d1 113d3-113d3 11bc0-11be0 13460-143fa
16100-1611d 16d40-16d6c 18cff-18cff 1e5d0-1e5ed 1e5f0-1e5f0
"""
NEW_NUMBERS = """
10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa
"""


def _ranges(first_letter: str, last: int) -> str:
    """A character class of the code points up to `last` whose category starts with the letter."""
    added = NEW_LETTERS if first_letter == "L" else NEW_NUMBERS
    pairs = [tuple(int(x, 16) for x in pair.split("-")) for pair in added.split()]
    out = [f"\\U{a:08x}-\\U{b:08x}" for a, b in pairs if b <= last]
    start = None
    for point in range(last + 2):
        inside = point <= last and unicodedata.category(chr(point))[0] == first_letter
        if inside and start is None:
            start = point
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{point - 1:08x}")
            start = None
    return "".join(out)


@cache
def _pattern(last: int) -> re.Pattern:
    """The words of texts without code points over `last`.

    Contractions, letters, digits, other signs, white space; as byte-level BPE splits.  A
    class that stays within 16 bits is a table look-up for Python's engine.
    """
    letters, digits = _ranges("L", last), _ranges("N", last)
    space = "\\t-\\r " if last < 128 else SPACE
    return re.compile(
        f" ?[{letters}]+|'(?:s|t|re|ve|m|ll|d)| ?[{digits}]+| ?[^{space}{letters}{digits}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def word_pattern(text: str) -> re.Pattern:
    if text.isascii():
        return _pattern(127)
    return _pattern(sys.maxunicode if _ASTRAL.search(text) else 0xFFFF)


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Words(dict):
    """word -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self.encode(word.encode("utf-8"))
        packed = self[word] = pack(f"<{len(ids)}I", *ids)
        return packed


class Codec:
    """Encodes and decodes as the tokenizers library does with the same file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        signs, vocab = byte_signs(), spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.content: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.content[i] = bytes(signs[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.content[i] = token.encode("utf-8")
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.single = [vocab[c] for c, _ in sorted(signs.items(), key=lambda x: x[1])]
        self.ranks: dict[int, int] = {}  # (left id, right id) -> rank
        self.made: list[int] = []  # rank -> id
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left] << 20 | vocab[right]] = rank
            self.made.append(vocab[left + right])
        self.words = _Words(self.merge)

    def merge(self, word: bytes) -> list[int]:
        single, rank, made = self.single, self.ranks.get, self.made
        parts = [single[b] for b in word]
        if len(parts) > LONG:
            return self._merge_long(parts)
        ranks = [rank(a << 20 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != NONE:
            i = ranks.index(least)
            parts[i] = part = made[least]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(part << 20 | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 20 | part, NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, rank, made = len(parts), self.ranks.get, self.made
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := rank(parts[i] << 20 | parts[j], NONE)) != NONE:
                heapq.heappush(heap, (found, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            least, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] == a else n
            if j >= n or parts[j] != b:
                continue  # one of the two is gone
            parts[i], parts[j] = made[least], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> bytes:
        """The ids, packed as little-endian unsigned 32-bit integers."""
        pattern, words = word_pattern(text), self.words.__getitem__
        if not any(token in text for token in self.special):
            return b"".join(map(words, pattern.findall(text)))
        out = []
        for piece in self.split.split(text):
            special = self.special.get(piece)
            if special is None:
                out += map(words, pattern.findall(piece))
            else:
                out.append(special.to_bytes(4, "little"))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.content.__getitem__, ids)).decode("utf-8", "replace")


@cache
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)
