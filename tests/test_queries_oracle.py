"""Every registered driver query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()
#: Queries without SQL that give one row a key, and that key.
KEYS = {"grid_search": "params", "refit_predict": "doc_id", "file_checksums": "file_name"}
ROWS_ONLY = set(KEYS)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    if name not in ORACLE:
        n, distinct = df.count(), df.select(KEYS.get(name, df.columns[0])).distinct().count()
        assert n == distinct > 0 if name in ROWS_ONLY else n > 0 and distinct > 0
        return
    r = compare(df, con, ORACLE[name])
    assert r["schema_match"], r
    assert r["count_match"], r
    assert r["value_match"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["suite", "check_name", "level"]
