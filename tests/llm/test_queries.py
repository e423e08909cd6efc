"""Registered queries against their SQL, and the entry's handling of the subpackage."""

import pytest

import __spark_entry__ as entry
from affinity.llm.oracle import ORACLE
from affinity.llm.queries import QUERIES
from affinity.plans.compare import compare

from ..conftest import SF_SMALL


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_its_sql(spark, duck_small, key):
    r = compare(spark, duck_small, key, SF_SMALL, QUERIES[key], ORACLE[key])
    assert r["cols_match"] and r["spark_rows"] == r["oracle_rows"] > 0 and r["values_match"], r


def test_all_are_registered():
    q = entry.queries()
    assert [k for k in q if k == "pipeline"] == ["pipeline"]
    assert {int(k[2:].split("_")[0]) for k in q if k.startswith("op")} == set(range(1, 14))


def test_nothing_else_imports_the_subpackage():
    import pathlib
    import re
    root = pathlib.Path(entry.__file__).parent / "affinity"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"\bllm\b", f.read_text()), f
