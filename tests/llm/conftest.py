"""Odd documents and pages that every operator has to take."""

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, node string"
PASSAGE = " ".join(f"shared{i} word{i * 7 % 31}" for i in range(40))
LONG = " ".join(f"w{i * i % 9973}" for i in range(60_000))


def numbered(tag: str, n: int) -> str:
    return " ".join(f"{tag}{i}" for i in range(n))


ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "One two three."),
    (5, "ONE two three."),
    (6, LONG),
    (7, LONG.upper()),
    (8, numbered("a", 90) + " " + PASSAGE + " " + numbered("b", 30)),
    (9, numbered("c", 20) + "\n" + PASSAGE.upper() + "\n" + numbered("d", 70)),
    (10, numbered("n", 200)),
    (11, numbered("n", 200).replace("n77 ", "other ")),
    (12, "x" * 5000),
    (13, "É<|endoftext|> ß 👍🏽    end"),
    (13, "É<|endoftext|> ß 👍🏽    end"),
    (None, "a row without an id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, None, "s", None if t is None else len(t), "k", "n") for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
