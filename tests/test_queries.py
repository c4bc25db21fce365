"""Every query with SQL against DuckDB on the smallest tables; plans without a Cartesian product."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no tables here")
QUERIES, SQL = entry.core.QUERIES, entry.core.SQL


def plain(v):
    if isinstance(v, float):
        return "" if math.isnan(v) else f"{v:.6f}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    return "(" + ",".join(map(plain, v)) + ")" if isinstance(v, (list, tuple)) else "" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name not in SQL:
        return
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    cur = con.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(row[names.index(c)]) for c in cols) for row in cur.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
