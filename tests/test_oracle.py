"""Every query with SQL gives DuckDB's rows on the smallest tables."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from loomstream.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    plain = lambda x: None if pd.isna(x) else round(float(x), 9) if isinstance(x, float) else x.item() if hasattr(x, "item") else x
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    if name not in ORACLES:
        assert got.toPandas().equals(QUERIES[name](spark, SF).toPandas())
        return
    want = con.sql(ORACLES[name])
    assert {c: TYPES[t] for c, t in got.dtypes} == dict(zip(want.columns, map(str, want.types), strict=True))
    assert rows(got.toPandas()) == rows(want.df())
