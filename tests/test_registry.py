"""Every registered query with SQL against DuckDB at the smallest scale."""

import os

import duckdb
import pytest

from strandweave.plans import registry

SF = "/root/testdata/sf0.001"


def _rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple("" if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else str(v) for v in (x.item() if hasattr(x, "item") else x for x in row)) for row in df.astype(object).where(df.notna(), None).itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def con():
    own = duckdb.connect()
    for t in os.listdir(SF):
        own.execute(f"create view {t.removesuffix('.parquet')} as select * from read_parquet('{SF}/{t}')")
    return own


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, con, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), con.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)

    def plain(df):
        return df.astype({c: "float64" for c in df if str(df[c].dtype).startswith(("Int", "int", "float"))})

    assert _rows(plain(got)) == _rows(plain(want))
