"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest

from strandloom.plans import registry


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    cell = lambda x: None if x is None or x != x else (round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x))
    return sorted((tuple(cell(x) for x in r) for r in df.astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    want = duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["contained_transcript", "superset_transcripts"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
