"""Driver contract: entry(), queries() and oracle_sql() agree; a smoke run of
every query at sf0.001 against its DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans import catalog
from tidemark.sources.testdata import TABLES

from .conftest import SF_SMALL

STREAMING = {"stream_incremental", "stream_incremental_restart", "stream_lifecycle",
             "stream_event_order", "stream_answers"}
NO_ORACLE: set[str] = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["opportunities", "validated", "validation_failures"]
    assert rows[0].opportunities > 0


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE_SQL) == set(catalog.QUERIES) - NO_ORACLE
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - STREAMING - NO_ORACLE))
def test_query_matches_oracle_small(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    order = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    idx = [ocols.index(c) for c in order]
    orows = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert srows == orows
    assert srows, "a query that returns nothing cannot fail"


def test_no_python_in_batch_plans(spark):
    for name in ("readiness_board", "fingerprint", "settle_submissions", "drop_processed"):
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan, name


@pytest.mark.parametrize("name", sorted(STREAMING))
def test_streaming_twin_matches_batch_oracle_small(spark, duck, name):
    """The streaming twins (landing files, availableNow micro-batches) give
    the batch oracle's rows."""
    test_query_matches_oracle_small(spark, duck, name)
