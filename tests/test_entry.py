import glob
import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def entry():
    import __spark_entry__

    return __spark_entry__


def test_sql_belongs_to_queries(entry):
    assert set(entry.oracle_sql()) <= set(entry.queries())


def same(a, b):
    import numpy as np

    def plain(v):
        if v is None or (isinstance(v, float) and np.isnan(v)):
            return None
        return round(float(v), 6) if isinstance(v, float | np.floating) else int(v) if isinstance(v, int | np.integer) and not isinstance(v, bool) else v

    rows = [sorted((repr(tuple(plain(v) for v in r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))) for df in (a, b)]
    return rows[0] == rows[1]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
def test_every_core_query_equals_its_sql(spark, entry):
    import duckdb

    from clinweave import queries

    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    wrong = []
    for name in queries.QUERIES:
        got = entry.queries()[name](spark, SMALL).toPandas()
        if name in queries.SQL and not same(got, con.execute(queries.SQL[name]).df()):
            wrong.append(name)
    assert not wrong
    assert entry.entry(spark).count() == 3
