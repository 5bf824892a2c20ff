"""Every registered query against its SQL in DuckDB, over the whole smallest data set."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from contract.oracle import all_oracles
from contract.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    result = database.execute(ORACLES[name])
    order = [d[0] for d in result.description]
    assert columns == sorted(order)
    want = [tuple(r[order.index(c)] for c in columns) for r in result.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_flagship(spark):
    assert contract.entry(spark).count() == 30
