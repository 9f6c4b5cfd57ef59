"""Every query with a DuckDB counterpart gives the same rows."""

import glob
import os

import duckdb
import pytest

from cohortwatch import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_rows(spark, db, name):
    got = plans.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = db.execute(plans.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, (tuple(r[k] for k in order) for r in want.fetchall())))


def test_every_query_is_registered_and_lazy(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(plans.queries()) <= names
    assert set(__spark_entry__.oracle_sql()) <= names
    assert __spark_entry__.entry(spark).count() > 0


def test_scores(spark):
    got = plans.queries()["score_threshold"](spark, SF).collect()
    assert len(got) == 15 and all(0 <= r.score <= 1 and r.is_anomaly == (r.score >= 0.8) for r in got)
