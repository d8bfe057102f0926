import hashlib
import re

from compare import differences
from conftest import ODD, SF_DIR

from ledgerline.llm import exact
from ledgerline.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_matches_sql(spark):
    assert differences(QUERIES["op6_exact_dedup"](spark, SF_DIR), ORACLES["op6_exact_dedup"], SF_DIR) == ""


def test_odd_rows(odd):
    groups = {}
    for i, t in ODD:
        groups.setdefault(lower(t), []).append(i)
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_groups(odd).collect()), key=str)
    want = []
    for i, t in ODD:
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_stage_keeps_one_row_of_each_group(odd):
    left = exact.drop_exact_copies(odd)
    assert left.columns == odd.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([2, 3, 5, 7, 8, 9, 10, 11, 12, 13, None], key=str)


def test_no_rows(nothing):
    assert exact.exact_groups(nothing).count() == 0
    assert exact.drop_exact_copies(nothing).count() == 0


def test_chunks_join_to_the_text(odd):
    rows = odd.select("text", F.array_join(exact.chunks_of(exact.lower_ascii(F.col("text"))), "").alias("j")).collect()
    assert all(r.j == lower(r.text) for r in rows)


def test_main_path_has_no_python(documents):
    plan = exact.exact_groups(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
