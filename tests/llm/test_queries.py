"""Registration, and the SQL twins of the queries that have one."""

import duckdb
import pytest

import __spark_entry__ as entry
from ordermart.llm.queries import ORACLE_SQL, QUERIES


def test_every_operator_is_registered_once():
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_twin(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, folder)
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = con.sql(f"SELECT {', '.join(names)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(rows, key=str)
