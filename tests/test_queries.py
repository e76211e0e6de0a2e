"""Every registered query against its DuckDB SQL on the smallest test tables, plus the smoke entry."""

import pytest

import __spark_entry__ as entry
from ferry.plans.queries import QUERIES as PLAIN
from tests.oracle_compare import compare_one, duck

SF = "/root/testdata/sf0.001"
QUERIES = {name: fn for name, fn in entry.queries().items() if name in PLAIN}
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(PLAIN) == set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare_one(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    assert res["status"] == "ok", res


def test_entry_smoke(spark, con):
    df = entry.entry(spark)
    left = con.execute("SELECT count(*) FROM orders WHERE o_orderpriority IS NOT DISTINCT FROM '5-LOW' "
                       "OR NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)").fetchall()[0][0]
    assert df.count() == left > 0
    assert df.columns == ["Id", "OwnerId", "o_orderstatus", "o_totalprice", "o_orderpriority"]
