"""Every registered query against its independent DuckDB SQL (sf 0.001)."""

import pytest

import __spark_entry__ as entry
from affinity.plans.compare import compare
from affinity.plans.queries import QUERIES

from .conftest import SF_SMALL

KEYS = sorted(set(QUERIES) & set(entry.oracle_sql()))


def test_every_query_has_an_oracle_or_is_rows_only():
    missing = set(QUERIES) - set(entry.oracle_sql())
    assert missing == {"text_similarity"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck_small, key):
    r = compare(spark, duck_small, key, SF_SMALL, entry.queries()[key], entry.oracle_sql()[key])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event", "product_id", "other_id", "llr", "rank"]
    assert df.count() > 0
