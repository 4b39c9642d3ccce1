"""Driver contract: entry() smoke, registry/oracle key sets, and every
registered query against its DuckDB oracle on the smallest scale factor."""

import os
import re

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"

# Queries without an oracle entry: the training-data operators, which have
# brute-force tests of their own.
NO_ORACLE = re.compile(r"op\d+_\w+|pipeline")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "tier" in df.columns and "winrate_rank" in df.columns


def test_every_query_has_an_oracle():
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert all(NO_ORACLE.fullmatch(name) for name in without)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, SF, name, entry.queries()[name],
                      entry.oracle_sql().get(name))
    assert ok, msg
