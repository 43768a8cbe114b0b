"""Snapshot tables: nothing of a write is visible before its commit."""

import datetime as dt

import pytest

from pathwise.sources.snapshots import Conflict, SnapshotTable

JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))


def rows(spark, *values):
    return spark.createDataFrame(values, "month date, n long, who string").select("n", "month", "who")


def content(df):
    return sorted((r["month"], r["n"]) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, f"file://{tmp_path}/t")


def test_full_and_pinned_readers(spark, table):
    with pytest.raises(ValueError, match="nothing is published"):
        table.read()
    table.publish_full(rows(spark, (JAN, 1, "a"), (FEB, 2, "a")))
    pinned = table.read()
    assert pinned.columns == ["n", "month", "who"]
    table.publish_full(rows(spark, (JAN, 7, "b")))
    assert content(pinned) == [(JAN, 1), (FEB, 2)]          # built before the second commit
    assert content(table.read()) == [(JAN, 7)]
    assert content(table.read(table.at(1))) == [(JAN, 1), (FEB, 2)]


def test_months_are_replaced_kept_and_emptied(spark, table):
    table.publish_months(rows(spark, (JAN, 1, "a"), (FEB, 2, "a")), [JAN, FEB])
    table.publish_months(rows(spark, (FEB, 3, "b"), (MAR, 4, "b")), [FEB, MAR])
    assert content(table.read()) == [(JAN, 1), (FEB, 3), (MAR, 4)]
    assert table.read().columns == ["n", "month", "who"]
    table.publish_months(spark.createDataFrame([], table.read().schema), [FEB])
    assert content(table.read()) == [(JAN, 1), (MAR, 4)]
    table.publish_months(rows(spark, (JAN, 1, "a")), [JAN], append=True)
    assert content(table.read()) == [(JAN, 1), (JAN, 1), (MAR, 4)]
    with pytest.raises(ValueError, match="does not cover"):
        table.publish_months(rows(spark, (MAR, 1, "a")), [JAN])
    assert content(table.read()) == [(JAN, 1), (JAN, 1), (MAR, 4)]


@pytest.mark.parametrize("step", ["data", "before rename"])
def test_a_killed_run_leaves_the_old_table(spark, table, step, monkeypatch):
    table.publish_months(rows(spark, (JAN, 1, "a")), [JAN])

    def die(*_):
        raise KeyboardInterrupt

    if step == "data":        # rows are written, no snapshot begun
        monkeypatch.setattr(table, "_commit", die)
    else:                     # the snapshot file is written under its temporary name
        class Context:
            rename = staticmethod(die)
        monkeypatch.setattr(table, "_context", Context)
    with pytest.raises(KeyboardInterrupt):
        table.publish_months(rows(spark, (JAN, 2, "b"), (FEB, 2, "b")), [JAN, FEB])
    again = SnapshotTable(spark, table.path)
    assert content(again.read()) == [(JAN, 1)]
    again.publish_months(rows(spark, (JAN, 2, "b"), (FEB, 2, "b")), [JAN, FEB])
    assert content(again.read()) == [(JAN, 2), (FEB, 2)]


def test_a_second_writer_is_detected(spark, table):
    table.publish_full(rows(spark, (JAN, 1, "a")))
    base = table.current()
    other = SnapshotTable(spark, table.path)
    table.publish_full(rows(spark, (JAN, 2, "first")), base)
    with pytest.raises(Conflict):
        other.publish_full(rows(spark, (JAN, 3, "second")), base)
    assert content(other.read()) == [(JAN, 2)]
    other.publish_full(rows(spark, (JAN, 3, "second")))      # from what is there now
    assert content(table.read()) == [(JAN, 3)]


def test_vacuum_keeps_what_snapshots_name(spark, table):
    table.publish_months(rows(spark, (JAN, 1, "a"), (FEB, 2, "a")), [JAN, FEB])
    table.publish_months(rows(spark, (FEB, 3, "b")), [FEB])
    table.publish_months(rows(spark, (FEB, 4, "c")), [FEB])
    gone = table.vacuum(keep=1)
    assert len(gone) == 2 and table.numbers() == [3]
    assert content(table.read()) == [(JAN, 1), (FEB, 4)]
    assert table.vacuum(keep=1) == []
