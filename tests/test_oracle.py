"""Every registered query of the library against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from spliceframe.plans import ORACLE_SQL, QUERIES

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    try:
        x = float(v)
    except (TypeError, ValueError):
        return str(v)
    return "nan" if math.isnan(x) else f"{x + 0.0:.5g}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLE_SQL:
        return
    result = con.execute(ORACLE_SQL[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
