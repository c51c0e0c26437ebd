"""Every query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from nodeloom.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple("~" if pd.isna(v) else round(float(v), 5) if isinstance(v, float) else str(v) for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_equals_sql(spark, sql, name):
    found, expected = QUERIES[name](spark, SF).toPandas(), sql.sql(ORACLE_SQL[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_others_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
