r"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Each kind has a pattern, a check and a score.  E-mail addresses, network addresses (parts up to
255), payment cards (14 to 19 digits, Luhn) and international phone numbers (10 to 15 digits) are
the base kinds: what their check accepts stays, context only raises the score.  The method adds

- `iban`: a country's account number, compact or in groups of four, cut to its country's length,
  confirmed by the remainder of 97;
- `ssn`: three, two and four digits with hyphens, no number that is never issued, and
- `birth`: a day, month and year,

the last two only where a word such as "ssn" or "born" stands within 48 characters before or 24
behind.  A span is given when its score reaches 0.5.

Proposals are leftmost and don't overlap within a kind; one that its check refuses is dropped
without a second try.  Every pattern takes whole runs of its characters, so that no text makes a
scan start again inside a run it has read: time is linear in the text.  One pass over the rows, no
shuffle; a task holds one Arrow batch.

Defined cases: a null text is an empty one and has no spans; places are code points, ends exclusive;
spans of different kinds may overlap; repeated rows each get a row; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "birth")
BEFORE, BEHIND = 48, 24  # characters in which a word counts as context
ENOUGH = 0.5

# score without context, and what a word nearby adds
SCORES = {
    "email": (0.9, 0.1), "ip": (0.6, 0.2), "card": (0.8, 0.2), "phone": (0.7, 0.2),
    "iban": (0.9, 0.1), "ssn": (0.3, 0.4), "birth": (0.3, 0.4),
}
WORDS = {
    "email": "e-?mail|mail|contact|kontakt|correo|courriel|write",
    "ip": "ip|address|host|server|adresse",
    "card": "cards?|visa|credit|debit|payment|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social security|taxpayer|social insurance",
    "birth": "born|birth|birthday|dob|geboren|geburtsdatum|nacido|nacida|nacimiento|naissance",
}

# Lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "BR": 29, "CH": 21, "CY": 28, "CZ": 24, "DE": 22,
    "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GI": 23, "GR": 27, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31,
    "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "TR": 26, "UA": 29,
}

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_ANY_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b"
_IBAN = re.compile(IBAN, re.ASCII)
SSN_RUN, SSN = "[0-9]+(?:-[0-9]+)+", "[0-9]{3}-[0-9]{2}-[0-9]{4}"
_SSN_RUN, _SSN = re.compile(r"[0-9]++(?:-[0-9]++)*+"), re.compile(SSN)
BIRTH_RUN = "[0-9]+(?:[./-][0-9]+)+"
BIRTH = "(?:0?[1-9]|[12][0-9]|3[01])[./-](?:0?[1-9]|1[0-2])[./-](?:19|20)[0-9]{2}"
_BIRTH_RUN, _BIRTH = re.compile(r"[0-9]++(?:[./-][0-9]++)*+"), re.compile(BIRTH)
_NEAR = {kind: re.compile(rf"\b(?:{words})\b", re.ASCII | re.IGNORECASE) for kind, words in WORDS.items()}
_NOT_DIGIT = re.compile(r"[^0-9]++")
_DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled (9 taken off beyond 9): the sum ends in 0."""
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(_DOUBLED[v] for v in values[1::2])) % 10 == 0


def mod97(account: str) -> bool:
    """First four characters last, letters as 10 to 35: the number leaves 1 when divided by 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """`[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from its `@`.

    The characters before an `@` reach back to the last other character or match; each is read once.
    """
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = at + 1
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", free)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if m.group(1) and all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split("."))):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


def accounts(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        found, size = m.group(), IBAN_LENGTHS.get(m.group()[:2])
        if size is None:
            continue
        grouped = found[4] == " "
        end = size + (size + 3) // 4 - 1 if grouped else size
        if (len(found) == end or (grouped and found[end : end + 1] == " ")) and mod97(found[:end].replace(" ", "")):
            yield m.start(), m.start() + end


def security_numbers(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN_RUN.finditer(text):
        if _SSN.fullmatch(m.group()):
            area, group, serial = m.group().split("-")
            if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
                yield m.span()


def births(text: str) -> Iterator[tuple[int, int]]:
    for m in _BIRTH_RUN.finditer(text):
        if _BIRTH.fullmatch(m.group()):
            yield m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    alone, more = SCORES[kind]
    near = _NEAR[kind].search(text[max(0, start - BEFORE) : start]) or _NEAR[kind].search(text[end : end + BEHIND])
    return alone + more if near else alone


def found(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) by start, then kind."""
    proposals = []
    if "@" in text:
        proposals += [("email", s) for s in emails(text)]
    if _ANY_DIGIT.search(text):
        proposals += [("ip", s) for s in addresses(text)]
        proposals += [("card", s) for s in cards(text)]
        proposals += [("phone", s) for s in phones(text)]
        proposals += [("iban", s) for s in accounts(text)]
        proposals += [("ssn", s) for s in security_numbers(text)]
        proposals += [("birth", s) for s in births(text)]
    scored = [(start, end, kind, score(text, kind, start, end)) for kind, (start, end) in proposals]
    return sorted((s for s in scored if s[3] >= ENOUGH), key=lambda s: (s[0], KINDS.index(s[2])))


SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, found (kind, start, end, score of each span in order) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = [
                    [{"kind": k, "start": s, "end": e, "score": p} for s, e, k, p in found(t)]
                    for t in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(rows, pa.list_(_SPAN))], ["doc_id", "found"]
                )

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, found {SPANS}")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans as text."""
    listed = ", ".join(f"'{k}'" for k in BASE)
    written = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = f"filter(found, s -> s.kind IN ({listed}))"
    return personal_spans(docs).select(
        "doc_id",
        *[F.expr(f"bigint(size(filter(found, s -> s.kind = '{k}')))").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(F.expr(written.format(base)), ","), 256).alias("base_sha256"),
        F.array_join(F.expr(written.format("found")), ",").alias("spans"),
    )


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    """Matches and the pieces between them give the places; the checks are list expressions."""
    proposals = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": IBAN, "ssn": SSN_RUN, "birth": BIRTH_RUN,
    }
    lengths = ", ".join(f"'{c}': {n}" for c, n in IBAN_LENGTHS.items())
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn_sum = (
        f"list_sum(list_transform(reverse({digits}).split(''), "
        "lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT) ELSE CAST(c AS INT) * 2 - CASE WHEN c >= '5' THEN 9 ELSE 0 END END))"
    )
    size = f"(MAP {{{lengths}}})[m[1:2]]"
    whole = f"CASE WHEN m[5] = ' ' THEN {size} + ({size} + 3) // 4 - 1 ELSE {size} END"
    compact = f"replace(m[1:{whole}], ' ', '')"
    remainder = (
        f"list_reduce(list_transform(({compact}[5:] || {compact}[1:4]).split(''), "
        "lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE CAST(c AS INT) END), "
        "lambda a, b: (CASE WHEN b > 9 THEN a * 100 ELSE a * 10 END + b) % 97, 0)"
    )
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    before = lower.format(f"text[greatest(1, start - {BEFORE} + 1):start]")
    behind = lower.format(f"text[stop + 1:stop + {BEHIND}]")

    def near(kind: str) -> str:
        word = rf"\b(?:{WORDS[kind]})\b"
        return f"(regexp_matches({before}, '{word}') OR regexp_matches({behind}, '{word}'))"

    checks = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda p: len(ltrim(p, '0')) > 3 OR CAST('0' || ltrim(p, '0')[1:3] AS INT) > 255)) = 0",
        "card": f"len({digits}) BETWEEN 14 AND 19 AND {luhn_sum} % 10 = 0",
        "phone": f"len({digits}) BETWEEN 10 AND 15",
        "iban": f"{size} IS NOT NULL AND (len(m) = {whole} OR m[5] = ' ' AND m[{whole} + 1] = ' ') AND {remainder} = 1",
        "ssn": f"regexp_full_match(m, '{SSN}') AND m[1:3] NOT IN ('000', '666') AND m[1] <> '9' AND m[5:6] <> '00'"
               f" AND m[8:] <> '0000' AND {near('ssn')}",
        "birth": f"regexp_full_match(m, '{BIRTH}') AND {near('birth')}",
    }
    per_kind = " UNION ALL ".join(
        f"SELECT row, {i} AS k, '{kind}' AS kind, start, {f'start + {whole}' if kind == 'iban' else 'stop'} AS stop"
        f" FROM placed WHERE kind = '{kind}' AND {checks[kind]}"
        for i, kind in enumerate(KINDS)
    )
    listed = " UNION ALL ".join(
        f"SELECT row, text, '{kind}' AS kind, regexp_extract_all(text, '{p}') AS matches, string_split_regex(text, '{p}') AS pieces FROM docs"
        for kind, p in proposals.items()
    )
    one = "kind || ':' || start || ':' || stop"
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS n_{k}" for k in BASE)
    return f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), listed AS ({listed}
), each AS (
  SELECT row, text, kind, unnest(matches) AS m, unnest(pieces[1:len(matches)]) AS piece, generate_subscripts(matches, 1) AS i
  FROM listed WHERE len(matches) > 0
), ends AS (
  SELECT *, CAST(sum(len(m) + len(piece)) OVER (PARTITION BY row, kind ORDER BY i) AS BIGINT) AS stop FROM each
), placed AS MATERIALIZED (SELECT *, stop - len(m) AS start FROM ends
), spans AS MATERIALIZED ({per_kind}
), joined AS (
  SELECT row, {counts},
         coalesce(string_agg({one}, ',' ORDER BY start, k) FILTER (k < {len(BASE)}), '') AS base,
         string_agg({one}, ',' ORDER BY start, k) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (row)"""


OP12_SQL = _sql()
