"""Run a job and its reference SQL over the same tables and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def spark_rows(df: DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted(
        (tuple(_plain(v) for v in row) for row in df.select(*names).collect()), key=repr
    )


def sql_rows(sql: str, sf_dir: str) -> tuple[dict[str, str], list[tuple]]:
    with duckdb.connect() as db:
        for file in Path(sf_dir).glob("*.parquet"):
            db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        result = db.execute(sql)
        names = [d[0] for d in result.description]
        types = {d[0]: str(d[1]) for d in result.description}
        order = sorted(range(len(names)), key=names.__getitem__)
        rows = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    return types, sorted(rows, key=repr)


def differences(df: DataFrame, sql: str, sf_dir: str) -> str:
    """Empty when names, types and rows agree."""
    types, expected = sql_rows(sql, sf_dir)
    ours = {c: TYPES.get(t, t) for c, t in df.dtypes}
    if ours != types:
        return f"schema {sorted(ours.items())} != {sorted(types.items())}"
    got = spark_rows(df)
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)} rows"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else ""
