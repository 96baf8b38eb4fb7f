"""Every query against its SQL twin, and a look at its plan."""

from __future__ import annotations

import duckdb
import pytest

from tests.conftest import SF_DIR
from workload import ORACLES, QUERIES
from workload.check import TABLES, differences


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_twin(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got = df.toArrow()
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not differences(got, con.sql(ORACLES[name]).to_arrow_table())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
