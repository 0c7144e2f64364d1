"""Every registered query that has one against its DuckDB oracle, at sf0.001."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

KEYS = sorted(k for k in E.oracle_sql() if not k.startswith("op"))
TABLES = "customer supplier part orders lineitem events conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return str(int(v)) if v.is_integer() else repr(round(v, 9))
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted(repr(tuple(_norm(x) for x in r)) for r in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(small_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, small_dir, key):
    got = E.queries()[key](spark, small_dir).toPandas()
    want = duck.execute(E.oracle_sql()[key]).df()
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "product_category_name_english", "top_10_most_sold_product"]
    assert 0 < df.count() <= 10


def test_every_oracle_key_is_a_query():
    """All queries of the order analytics have a SQL twin."""
    assert set(E.oracle_sql()) <= set(E.queries())
    assert {k for k in set(E.queries()) - set(E.oracle_sql()) if not k.startswith("op") and k != "pipeline"} == set()
