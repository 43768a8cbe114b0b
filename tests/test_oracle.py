"""Every registered query equals its independent DuckDB formulation (sf0.001)."""

import pytest

import __spark_entry__ as E
from pathwise.plans.catalog import QUERIES
from sqlcheck.compare import compare, duck
from sqlcheck.oracle import oracle_sql

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], oracle_sql()[name], SF)
    assert r["columns"], r
    assert "type_diff" not in r, r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:6] == ["month", "org_type", "region", "org_name", "org_code",
                              "appointment_type"]


def test_every_line_is_read(spark, con):
    """The fact views keep every line; those without a referral have another pathway id."""
    from pathwise.sources.tables import driver_sources

    s = driver_sources(spark, SF)
    lines = con.sql("SELECT count(*) FROM lineitem").fetchall()[0][0]
    assert {s.digital_log.count(), s.care_contact.count(), s.care_activity.count()} == {lines}
