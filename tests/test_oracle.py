"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from mapfold.fixtures import BASE_TABLES
from tools.check import digest

SF = "/root/testdata/sf0.001"

QS = E.queries()
ORC = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORC) <= set(QS)


@pytest.mark.parametrize("name", sorted(ORC))
def test_query_matches_oracle(spark, con, name):
    df = QS[name](spark, SF)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(ORC[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert digest(scols, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["iso", "n_features"]
    assert df.count() > 0
