import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from conftest import ODD
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import encode, packing
from ledgerline.llm.bpe import codec

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_same_ids_and_text_as_the_library(text):
    own = codec(PATH).encode(text)
    assert np.frombuffer(own, "<u4").tolist() == ids(text)
    assert codec(PATH).decode(own) == LIBRARY.decode(ids(text), skip_special_tokens=False)


def test_special_token_and_long_words():
    for text in ["<|endoftext|>", "a <|endoftext|> b", "ab" * 3000, "é" * 700, "  a\n\n b  ", "I'll don't"]:
        assert np.frombuffer(codec(PATH).encode(text), "<u4").tolist() == ids(text)
        assert packing.token_ids(packing._encoding(public_tokenizers.path(packing.RANKS)), text).tolist() == ids(text) + [1]


def test_odd_rows_encoded(odd):
    got = sorted((tuple(r) for r in encode.digests(odd, PATH).collect()), key=str)
    want = []
    for i, t in ODD:
        x = ids(t)
        back = LIBRARY.decode(x, skip_special_tokens=False)
        want.append((i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def check_packing(rows, texts):
    """Every id once, windows gapless and within the capacity; the share of padding."""
    tokens = {i: ids(t) + [1] for i, t in texts.items()}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        own = tokens[r.doc_id]
        assert r.doc_tokens == len(own) and r.length > 0
        assert r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == tokens.keys()
    for parts, total in [*((p, len(tokens[i])) for i, p in pieces.items()), *((w, None) for w in windows.values())]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == total if total else at <= packing.CAPACITY
    used = sum(map(len, tokens.values()))
    return 1 - used / (packing.CAPACITY * len(windows))


def test_packing_of_documents(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert check_packing(packing.pack_documents(documents).collect(), texts) < 0.02


def test_packing_of_odd_rows(odd):
    unique = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check_packing(packing.pack_documents(unique).collect(), dict(x for x in ODD if x[0] is not None))
    repeated = packing.pack_documents(odd).filter("doc_id = 13 OR doc_id IS NULL").collect()
    assert sum(r.length for r in repeated) == 2 * (len(ids(ODD[-2][1])) + 1) + len(ids(ODD[-1][1])) + 1


def test_differencing_balances():
    sizes = [8, 7, 6, 5, 4]
    assert sorted(s for s, _ in packing.difference(sizes, 2)) in ([14, 16], [15, 15])
    assert packing.windows([], 10) == []
    for window in packing.windows([9, 9, 9, 2, 2], 10):
        assert sum([9, 9, 9, 2, 2][i] for i in window) <= 10


def test_no_rows(nothing):
    assert encode.digests(nothing, PATH).count() == 0
    assert packing.pack_documents(nothing).count() == 0
