"""Partitions of a bounded size; working tables of the staged sources."""

import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pathwise import session
from pathwise.sources import fixtures, tables
from pathwise.sources.publish import SHUFFLE_CLEANUP, materialize, new_run_dir, stored_bytes
from pathwise.sources.tables import FACT_TABLES, Sources

MERGE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
NUMBER = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SCAN = "spark.sql.files.maxPartitionBytes"


def test_partitions_grow_with_the_tables(spark, monkeypatch):
    """A shuffle of much more than a core's share is not merged to one partition a core."""
    monkeypatch.setattr(session, "PARTITION_BYTES", 1 << 20)
    s = spark.newSession()

    def tasks():
        rows = s.range(0, 4_000_000, 1, 8).select(F.xxhash64("id").alias("k"))
        return rows.groupBy("k").count().rdd.getNumPartitions()

    before = tasks()
    session.bounded_shuffles(s, 400 << 20)
    assert before <= s.sparkContext.defaultParallelism < tasks()


def test_own_sizes_stay_and_the_number_is_only_raised(spark):
    s = spark.newSession()
    s.conf.set(MERGE, "5m")
    session.bounded_shuffles(s, 100 << 20)
    assert (s.conf.get(MERGE), s.conf.get(NUMBER), s.conf.get(SCAN)) == ("5m", "50", str(session.SCAN_BYTES))
    session.bounded_shuffles(s, 1 << 20)
    assert s.conf.get(NUMBER) == "50"
    session.bounded_shuffles(s, 300 << 20)
    assert s.conf.get(NUMBER) == "150"


def test_reading_sources_bounds_their_partitions(spark, monkeypatch):
    monkeypatch.setattr(session, "BYTES_PER_INITIAL", 1000)
    s = spark.newSession()
    Sources.from_driver_tables(s, SF_SMALL)
    assert s.conf.get(MERGE) == str(session.PARTITION_BYTES) and int(s.conf.get(NUMBER)) > 100


def test_staged_submissions_lie_in_pieces_and_hold_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "SUBMISSION_PIECE_BYTES", 40_000)
    spark = spark.newSession()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # these pieces are very small
    at = new_run_dir(spark, "test-stage")
    staged, plain = Sources.from_driver_tables(spark, SF_SMALL, at), Sources.from_driver_tables(spark, SF_SMALL)
    files = (spark.read.parquet(f"{at}/digital_log").select("submission_id", F.input_file_name().alias("file"))
             .distinct().groupBy("submission_id").count().agg(F.max("count")).first()[0])
    assert files > 1
    for name in FACT_TABLES:
        a, b = getattr(staged, name), getattr(plain, name)
        assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).isEmpty()


def test_order_lines_are_joined_once(spark):
    """The three facts of the order lines read them from the stage folder."""
    at = new_run_dir(spark, "test-stage")
    Sources.from_driver_tables(spark, SF_SMALL, at)
    assert all("lines" in fixtures.dependencies(n) for n in ("digital_log", "care_contact", "care_activity"))
    assert spark.read.parquet(f"{at}/lines").count() == spark.read.parquet(f"{at}/care_contact").count()


def test_a_job_stages_the_sources_that_it_reads(spark):
    """On demand: the same rows, and no folder of a source that was not asked for."""
    at = new_run_dir(spark, "test-stage")
    src, plain = Sources.from_driver_tables(spark, SF_SMALL, at, on_demand=True), Sources.from_driver_tables(spark, SF_SMALL)
    assert not stored_bytes_or_none(spark, f"{at}/lines")
    con = src.care_contact
    assert src.care_contact is con and con.exceptAll(plain.care_contact).isEmpty()
    assert con.count() == plain.care_contact.count()
    assert stored_bytes_or_none(spark, f"{at}/lines") and stored_bytes_or_none(spark, f"{at}/care_contact")
    assert not any(stored_bytes_or_none(spark, f"{at}/{n}") for n in ("digital_log", "referral", "assessment", "calendar"))
    with pytest.raises(AttributeError):
        src.no_such_table
    # a changed copy has all twelve
    assert replace(src, assessment=plain.assessment).calendar.count() == plain.calendar.count()


def test_facts_are_written_from_dealt_lines_without_a_shuffle(spark):
    at = new_run_dir(spark, "test-stage")
    src = Sources.from_driver_tables(spark, SF_SMALL, at, on_demand=True)
    assert src.care_contact.count()
    lines = spark.read.parquet(f"{at}/lines")
    assert all("ym=" in f for f in lines.inputFiles())
    plan = spark.sql(fixtures.VIEWS["care_activity"], lines=lines)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_working_tables_leave_no_shuffle_files(spark):
    """The files go when the write ends, and the session's own setting comes back."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: sum(1 for f in files.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f)
    before, own = shuffled(), spark.conf.get(SHUFFLE_CLEANUP, None)
    df = spark.range(100_000).groupBy((F.col("id") % 997).alias("k")).count()
    written = materialize(df, f"{new_run_dir(spark, 'test-write')}/t")
    until = time.time() + 20
    while shuffled() > before and time.time() < until:   # dropped by a thread of its own
        time.sleep(0.2)
    assert shuffled() <= before and spark.conf.get(SHUFFLE_CLEANUP, None) == own
    assert written.count() == 997


def stored_bytes_or_none(spark, path):
    try:
        return stored_bytes(spark, path)
    except Exception:
        return None
