"""Reader and writer schemas under the compatibility rules."""

import json

import pytest

from ledgerline.operators import schemarules as rules
from ledgerline.schemas import record_schema


def text(**fields):
    """A record schema; a pair gives type and default."""
    rows = []
    for name, kind in fields.items():
        kind, *default = kind if isinstance(kind, tuple) else (kind,)
        rows.append({"name": name, "type": kind} | ({"default": default[0]} if default else {}))
    return json.dumps({"type": "record", "name": "R", "fields": rows})


def judged(spark, reader, writer):
    frame = spark.createDataFrame([("r", reader), ("w", writer)], "id string, text string")
    fields = [rules.schema_fields(frame.filter(f"id = '{i}'"), "id", "text") for i in "rw"]
    found = rules.field_rules(*fields)
    row = rules.verdicts(found).first()
    return row.compatible, row.reasons, {r.name: r.rule for r in found.collect()}


def test_the_second_version_reads_the_first_and_back(spark):
    compatible, reasons, found = judged(spark, record_schema("v2"), record_schema("v1"))
    assert (compatible, reasons) == (True, "")
    assert found.pop("promoCode") == rules.DEFAULT and set(found.values()) == {rules.SAME}
    compatible, _, found = judged(spark, record_schema("v1"), record_schema("v2"))
    assert compatible and found["promoCode"] == rules.SKIPPED


@pytest.mark.parametrize("change, reason", [
    ({"promoCode": ["null", "string"]}, "promoCode: no default"),  # added without a default
    ({"amountCents": "int"}, "amountCents: unreadable type"),  # narrowed
    ({"currency": "long"}, "currency: unreadable type"),  # another type
    ({"region": "string", "channel": "string"}, "channel: no default, region: no default"),  # new and required
])
def test_broken_variants_and_their_reasons(spark, change, reason):
    base = {"orderId": "string", "amountCents": "long", "currency": ("string", "USD")}
    compatible, reasons, _ = judged(spark, text(**(base | change)), text(**base))
    assert (compatible, reasons) == (False, reason)


@pytest.mark.parametrize("reader, writer, rule", [
    ("long", "int", rules.READ_AS), ("double", "float", rules.READ_AS), ("int", "long", rules.UNREADABLE),
    ("float", "double", rules.UNREADABLE), ("bytes", "string", rules.READ_AS), ("string", "bytes", rules.READ_AS),
    (["null", "string"], "string", rules.SAME), ("string", ["null", "string"], rules.UNREADABLE),
    (["null", "string"], ["string", "null"], rules.SAME), (["null", "double"], ["null", "int"], rules.READ_AS),
    (["null", "int"], ["int", "string"], rules.UNREADABLE), ("boolean", "int", rules.UNREADABLE),
    ({"type": "array", "items": "int"}, {"type": "array", "items": "int"}, rules.SAME),
    ({"type": "array", "items": "int"}, {"type": "array", "items": "string"}, rules.UNREADABLE),
])
def test_types(spark, reader, writer, rule):
    compatible, _, found = judged(spark, text(f=reader, k="int"), text(f=writer, k="int"))
    assert found["f"] == rule and compatible == (rule not in rules.BROKEN)


def test_null_is_a_default(spark):
    assert judged(spark, text(f=("string", None), k="int"), text(k="int"))[0]


def test_what_is_no_schema_has_no_fields(spark):
    frame = spark.createDataFrame([("a", None), ("b", ""), ("c", "{}"), ("d", "[1]"), ("e", '{"fields": [{"type": "int"}]}')],
                                  "id string, text string")
    assert rules.schema_fields(frame, "id", "text").count() == 0


def test_shapes_of_objects(spark):
    payloads = ['{"a": 1, "b": "x"}', '{"b": "y", "a": 22}', '{"a": null}', '{"a": 1.5}', '{"a": {"b": true}}', '{}',
                '{"a": 1}{"a": 1}', '{"a": 1} XYZ', "[1]", "", None, '{"a": 1', "12"]
    df = spark.createDataFrame(list(enumerate(payloads)), "n long, p string")
    shapes = rules.written_shapes(df, "n", "p")
    assert sorted((r.n, r.records) for r in shapes.collect()) == [(0, 2), (2, 1), (3, 1), (4, 1), (5, 1)]
    fields = rules.shape_fields(df.join(shapes, "n"), "n", "p").collect()
    got = {(r.schema, r.name): r.types for r in fields if r.name}
    assert got == {
        (0, "a"): ["int"], (0, "b"): ["string"], (2, "a"): ["null"], (3, "a"): ["double"],
        (4, "a"): ["object<b: boolean>"],
    }
    # an object without fields is a writer's schema too
    read = rules.schema_fields(spark.createDataFrame([("r", text(z="int"))], "id string, text string"), "id", "text")
    found = rules.verdicts(rules.field_rules(read, rules.shape_fields(df.join(shapes, "n"), "n", "p")))
    assert {r.writer: r.reasons for r in found.collect()} == dict.fromkeys((0, 2, 3, 4, 5), "z: no default")
