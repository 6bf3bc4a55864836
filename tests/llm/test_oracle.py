"""Queries with SQL give the rows that the SQL gives on the same tables."""

import duckdb
import pytest

from cadastra.llm.queries import ORACLE_SQL, QUERIES

D = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    got, want = QUERIES[name](spark, D), con.sql(ORACLE_SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    mine = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str)
    theirs = sorted(want.select(*[f'"{c}"' for c in cols]).fetchall(), key=str)
    assert len(mine) == len(theirs) > 0
    diff = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    assert not diff, (len(diff), diff[:3])
