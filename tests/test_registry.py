"""Every query with an oracle, beside DuckDB on the smallest tables."""

import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracle import TABLES, compare, plain  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = [tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    res = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    rows = [tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall()]
    assert compare(got, rows) == "ok"
