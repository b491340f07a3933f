"""Every registered query of the library against its SQL, over the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from refloom.plans import cases, catalogue

SF = Path("/root/testdata/sf0.001")
QUERIES, ORACLE_SQL = catalogue.QUERIES | cases.QUERIES, catalogue.ORACLE_SQL | cases.ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return f"{float(v):.6g}" if hasattr(v, "quantize") else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, str(SF))
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in ORACLE_SQL:
        assert got
        return
    res = duck.execute(ORACLE_SQL[name])
    names = [x[0] for x in res.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(row[names.index(c)]) for c in cols) for row in res.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns[0] == "lang"
