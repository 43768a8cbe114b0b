"""Sinks: re-publishing is idempotent; working folders come from the session."""

from pyspark.sql import functions as F

from pathwise.sources import publish as P


def test_shared_dir_is_the_sessions(spark):
    d = P.shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert d == configured.rstrip("/")


def test_month_publish_replaces_only_its_months(spark, refresh):
    df = refresh.questionnaire_dashboard
    path = f"{P.new_run_dir(spark, 'test-publish')}/q"
    P.publish_month(df, path)
    months = [r[0] for r in df.select("month").distinct().collect()]
    first = P.read_published(spark, path, df.columns).count()
    # publish one month again: the table is unchanged (v: re-run safe)
    one = df.filter(F.col("month") == months[0])
    P.publish_month(one, path)
    assert P.read_published(spark, path, df.columns).count() == first
    # the reference's plain append doubles that month (K9)
    P.append_month(one, path)
    assert P.read_published(spark, path, df.columns).count() == first + one.count()


def test_month_publish_removes_a_month_that_became_empty(spark, refresh):
    df = refresh.questionnaire_dashboard
    path = f"{P.new_run_dir(spark, 'test-publish')}/q"
    P.publish_month(df, path)
    gone, *kept = sorted(r[0] for r in df.select("month").distinct().collect())
    run = refresh.questionnaire_months()
    assert {gone, *kept} <= set(run)
    # the re-run of one month finds no rows: its old rows go, other months stay
    P.publish_month(df.filter("month IS NULL"), path, months=[gone])
    back = P.read_published(spark, path, df.columns)
    assert sorted(r[0] for r in back.select("month").distinct().collect()) == kept
    # a run over all months that has rows for some of them
    P.publish_month(df.filter(F.col("month") == gone), path, months=run)
    back = P.read_published(spark, path, df.columns)
    assert {r[0] for r in back.select("month").distinct().collect()} == {gone}


def test_materialize_reads_back_same_rows(spark, refresh):
    df = refresh.digital_summary
    back = P.materialize(df, f"{P.new_run_dir(spark, 'test-mat')}/j01")
    assert back.count() == df.count()
    assert back.columns == df.columns


def test_full_refresh_publishes_seven_tables(spark, refresh):
    out = P.new_run_dir(spark, "test-refresh")
    paths = refresh.publish(f"{out}/dash", f"{out}/work")
    assert sorted(paths) == sorted(["outcome_dashboard", "questionnaire_dashboard",
                                    "time_recorded_dashboard", "wait_dashboard",
                                    "treatment_dashboard", "digital_time_dashboard",
                                    "any_time_dashboard"])
    as_published = refresh._with({})       # averages are decimals
    for name, path in paths.items():
        expected = getattr(as_published, name)
        got = spark.read.parquet(path).select(*expected.columns)
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0, name
