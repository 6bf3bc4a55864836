"""Every query with SQL gives the rows that the SQL gives on the same tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from cadastra.plans.registry import ORACLE_SQL, QUERIES

D = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(round(x, 9) + 0.0)
    if isinstance(x, decimal.Decimal):
        return repr(round(float(x), 9) + 0.0)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return repr(x)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, duck, name):
    got = QUERIES[name](spark, D)
    want = duck.sql(ORACLE_SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    mine = sorted(tuple(plain(r[c]) for c in cols) for r in got.collect())
    theirs = sorted(tuple(plain(v) for v in r) for r in want.select(*[f'"{c}"' for c in cols]).fetchall())
    assert len(mine) == len(theirs) and mine
    diff = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    assert not diff, diff[:3]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, D)
    assert df.columns and df.count() > 0
