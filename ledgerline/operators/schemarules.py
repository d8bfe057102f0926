"""Can a reader's schema read what a writer's schema wrote?  Record schemas as rows, joined by rules.

A field is ``name, types, has_default``; ``types`` are the branches of its union, or its one type.
A reader's field that the writer lacks needs a default.  Of a field that both have, every branch of
the writer must be a branch of the reader or be promoted to one.  Fields of the writer alone are
skipped.  Nested types count by their text; aliases are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# What each type may be read as besides itself.
PROMOTED = {
    "int": ("long", "float", "double"),
    "long": ("float", "double"),
    "float": ("double",),
    "string": ("bytes",),
    "bytes": ("string",),
}

SAME, READ_AS, DEFAULT, SKIPPED, NO_DEFAULT, UNREADABLE = (
    "same", "read as another type", "default", "skipped", "no default", "unreadable type"
)
BROKEN = (NO_DEFAULT, UNREADABLE)


def schema_fields(schemas: DataFrame, schema_id: str, text: str) -> DataFrame:
    """Rows of (schema, name, types, has_default) of schema texts; a text that is none gives no rows."""
    field = "from_json(field, 'struct<name: string, type: string>')"
    return (
        schemas.select(
            F.col(schema_id).alias("schema"),
            F.explode(F.from_json(text, "struct<fields: array<string>>")["fields"]).alias("field"),
        )
        .selectExpr("schema", f"{field}.name AS name", f"{field}.type AS type", "json_object_keys(field) AS stated")
        .selectExpr(
            "schema",
            "name",
            "if(type LIKE '[%', from_json(type, 'array<string>'), array(type)) AS types",
            "array_contains(stated, 'default') AS has_default",
        )
        .filter("name IS NOT NULL")
    )


def _readable(branch: Column, types: Column) -> Column:
    """Is a writer's branch one of the reader's, or promoted to one?"""
    table = F.create_map(*[x for t, to in PROMOTED.items() for x in (F.lit(t), F.array(*map(F.lit, to)))])
    wider = F.coalesce(F.try_element_at(table, branch), F.array().cast("array<string>"))
    return F.array_contains(types, branch) | F.arrays_overlap(types, wider)


def field_rules(reader: DataFrame, writer: DataFrame) -> DataFrame:
    """Every (reader, writer) pair's fields with the rule that decides them.

    The pairs are those of the two lists of schema names, which are short; every field of either
    side has a row in each pair.
    """
    read = reader.select(F.col("schema").alias("reader"), "name", F.col("types").alias("wanted"), "has_default")
    wrote = writer.select(F.col("schema").alias("writer"), "name", F.col("types").alias("given"))
    writers = wrote.agg(F.collect_set("writer")).scalar()
    readers = read.agg(F.collect_set("reader")).scalar()
    left = read.withColumn("writers", writers).withColumn("writer", F.explode("writers")).drop("writers")
    right = wrote.withColumn("readers", readers).withColumn("reader", F.explode("readers")).drop("readers")
    both = left.join(right, ["reader", "writer", "name"], "full")
    rule = (
        F.when(F.col("wanted").isNull(), SKIPPED)
        .when(F.col("given").isNull(), F.when(F.col("has_default"), DEFAULT).otherwise(NO_DEFAULT))
        .when(~F.forall("given", lambda b: _readable(b, F.col("wanted"))), UNREADABLE)
        .when(F.forall("given", lambda b: F.array_contains("wanted", b)), SAME)
        .otherwise(READ_AS)
    )
    return both.select("reader", "writer", "name", rule.alias("rule"))


def verdicts(rules: DataFrame) -> DataFrame:
    """One row per pair: compatible, and what breaks it (``name: rule``, by name)."""
    broken = F.when(F.col("rule").isin(*BROKEN), F.concat_ws(": ", "name", "rule"))
    return rules.groupBy("reader", "writer").agg(
        (F.count(broken) == 0).alias("compatible"),
        F.array_join(F.array_sort(F.collect_list(broken)), ", ").alias("reasons"),
    )


def written_shapes(payloads: DataFrame, place: str, payload: str) -> DataFrame:
    """The distinct shapes of JSON objects: shape, records and the first place that has it.

    A shape is the names and types of an object's fields; what isn't one JSON object has none.
    """
    shape = F.expr(f"schema_of_variant(try_parse_json({payload}))")
    return (
        # the variant parser stops behind the first value; the array form sees what follows
        payloads.filter(F.expr(f"json_array_length(concat('[', {payload}, ']')) = 1"))
        .select(place, shape.alias("shape"))
        .filter(F.col("shape").startswith("OBJECT<"))
        .groupBy("shape")
        .agg(F.count(F.lit(1)).alias("records"), F.min(place).alias(place))
    )


def shape_fields(examples: DataFrame, schema_id: str, payload: str) -> DataFrame:
    """Fields of the objects as a writer's schema would have them.

    JSON does not tell int from long: whole numbers count as int, which every type of number reads.
    An object without fields has one row without a name, so that it is a writer as well.
    """
    kind = F.expr("schema_of_variant(value)")
    named = (
        F.when(kind == "VOID", "null").when(kind == "BIGINT", "int").when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean").when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "double")
        .otherwise(F.lower(kind))
    )
    fields = F.expr(f"cast(try_parse_json({payload}) AS map<string, variant>)")
    return examples.select(F.col(schema_id).alias("schema"), F.explode_outer(fields).alias("name", "value")).select(
        "schema", "name", F.array(named).alias("types"), F.lit(False).alias("has_default")
    )
