"""Every catalog query with SQL, held against DuckDB."""

import duckdb
import pandas as pd
import pytest

from loomframe.plans import catalog

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if frame[name].dtype == object or str(frame[name].dtype).startswith(("str", "datetime")):
            frame[name] = [str(v) if pd.notna(v) else "~" for v in frame[name]]
        else:
            frame[name] = pd.to_numeric(frame[name]).astype(float).round(5).fillna(-9e9)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in [*TABLES, "conversations"]:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, duck, name):
    ours, theirs = plain(catalog.QUERIES[name](spark, DATA).toPandas()), plain(duck.sql(catalog.ORACLES[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0
