import hashlib
import re
import time

import pytest
from compare import differences
from conftest import ODD, SF_DIR

from ledgerline.llm import personal as ps

TEXT = (
    "Mail: a.b@c-d.example.org, x@y, a@b.c%d@e.f or @g.h; hosts 10.0.0.1 256.1.1.1 1.2.3.4.5 01.002.3.255. "
    "Cards 4111 1111 1111 1111, 4111-1111-1111-1112, 79927398713 and 5500005555555559x. "
    "Phones +1 (017) 555-7713, +49 30 901820, +1 23. IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, "
    "not DE88 3704 0044 0532 0130 00; AT61 1904 3002 3457 3201 THE. Her social security no. 123-45-6789; 000-12-3456. "
    "Order 987-65-4321, code 223-45-6789 far from any word that would make it one of these, so it is left. "
    "Born 3.12.1970, shipped some time later and without any hint whatever on 04/05/2001 é👍 z@é.com q@w.é.com"
)
# The contract's patterns as written, all characters tried.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    def accepted(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1]))
            return 14 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    spans = [
        (m.start(), k, m.end(), kind)
        for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if accepted(kind, m.group())
    ]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans)]


def base(text):
    return [f"{k}:{s}:{e}" for s, e, k, _ in ps.found(text) if k in ps.BASE]


def test_base_spans_are_those_of_the_plain_patterns(documents):
    edges = ["", "@", "a@b.c@d.e", "1.1.1.1.1.1.1.1", "+1+2345678901", "12 34", "a@b..c", "1.2.3", "...@-.-"]
    for text in [TEXT, *edges, *(t for _, t in ODD if t and len(t) < 9000)]:
        assert base(text) == plain_base(text)
    for r in documents.limit(100).collect():
        assert base(r.text) == plain_base(r.text)


def test_added_spans():
    got = {(k, TEXT[s:e]): p for s, e, k, p in ps.found(TEXT) if k not in ps.BASE}
    assert set(got) == {
        ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432"),
        ("iban", "AT61 1904 3002 3457 3201"), ("ssn", "123-45-6789"), ("birth", "3.12.1970"),
    }
    assert got["iban", "DE89 3704 0044 0532 0130 00"] == pytest.approx(1.0)  # the word before it
    cards = {TEXT[s:e]: p for s, e, k, p in ps.found(TEXT) if k == "card"}
    assert cards == {"4111 1111 1111 1111": pytest.approx(1.0), "5500005555555559": pytest.approx(0.8)}


def test_checksums():
    assert ps.luhn("79927398713") and not ps.luhn("79927398710")
    assert ps.mod97("GB82WEST12345698765432") and not ps.mod97("GB83WEST12345698765432")


@pytest.mark.parametrize(
    "text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1 " * 130_000, "A" * 200_000 + "1" * 200_000,
             "+1" + "(" * 400_000, "1-" * 200_000, "a." * 200_000 + "@"],
)
def test_time_is_linear(text):
    begin = time.perf_counter()
    ps.found(text)
    assert time.perf_counter() - begin < 3


def test_odd_rows(spark, odd, nothing):
    got = sorted((tuple(r) for r in ps.report(odd).collect()), key=str)
    expected = []
    for i, t in ODD:
        spans = plain_base(t or "") if len(t or "") < 9000 else []
        n = [sum(s.startswith(k) for s in spans) for k in ps.BASE]
        expected.append((i, *n, hashlib.sha256(",".join(spans).encode()).hexdigest(), ",".join(spans)))
    assert got == sorted(expected, key=str)
    assert ps.report(nothing).count() == 0
    one = spark.createDataFrame([(1, TEXT)], "doc_id bigint, text string")
    row = ps.report(one).first()
    assert row.base_sha256 == hashlib.sha256(",".join(plain_base(TEXT)).encode()).hexdigest()
    assert row.spans.split(",") == [f"{k}:{s}:{e}" for s, e, k, _ in ps.found(TEXT)]


def test_query_against_sql(spark, tmp_path):
    assert differences(ps.op12_pii(spark, SF_DIR), ps.OP12_SQL, SF_DIR) == ""
    texts = [(1, TEXT), (2, None), (3, ""), (4, TEXT.upper()), (4, TEXT), (None, TEXT[100:])]
    spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "t"))
    next((tmp_path / "t").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    assert differences(ps.op12_pii(spark, str(tmp_path)), ps.OP12_SQL, str(tmp_path)) == ""
