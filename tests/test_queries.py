"""Every registered query against its reference SQL."""

import pytest
from compare import differences

from __spark_entry__ import entry
from ledgerline.plans import ORACLES as SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), SQL[name], SF_DIR) == ""


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
