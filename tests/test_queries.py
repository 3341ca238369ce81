import os

import duckdb
import pytest

from quartzlog.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", catalog.queries())
def test_query_equals_sql(spark, duck, name):
    frame = catalog.queries()[name](spark, SF)
    cols = sorted(frame.columns)
    got = sorted(str(tuple(r[c] for c in cols)) for r in frame.collect())
    found = duck.sql(catalog.oracle_sql()[name])
    at = [found.columns.index(c) for c in cols]
    assert got == sorted(str(tuple(r[k] for k in at)) for r in found.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.queries()) <= set(entry.queries()) and set(catalog.oracle_sql()) <= set(entry.oracle_sql())
