"""The operators are registered, and where SQL expresses them they equal it."""

import duckdb
import pytest

import __spark_entry__ as E
from pathwise.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {n.split("_")[0] for n in Q.QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(Q.QUERIES) <= set(E.queries()) and set(Q.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op12_lexical_search"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(Q.ORACLE_SQL[name])
    got = Q.QUERIES[name](spark, SF).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
