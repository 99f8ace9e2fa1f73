"""Every registered query against its SQL in DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from longtide.plans import archive, catalogue

SF = "/root/testdata/sf0.001"
#: Queries without a row on these tables: all years have a plan.
EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def _plain(df, columns):
    df = df[columns].copy()
    for c in columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
    return sorted(map(tuple, df.astype(str).values.tolist()))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    assert archive
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    assert len(got) or name in EMPTY
    want = duck.execute(catalogue.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert _plain(got, columns) == _plain(want, columns)
