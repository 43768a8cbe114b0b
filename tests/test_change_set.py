"""Refresh by change set against the full refresh, register by register."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pathwise.operators.distinct_state import merged_usage, usage_state
from pathwise.operators.rollup import merge_cells
from pathwise.operators.versions import VERSION_KEYS, latest_register
from pathwise.plans import change_set as C
from pathwise.plans.catalog import FIXTURE_FIRST, earlier_register
from pathwise.plans.refresh import MonthlyRefresh
from pathwise.sources.publish import new_run_dir
from pathwise.sources.tables import Sources, driver_sources


def bag(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def src(spark):
    return driver_sources(spark, SF_SMALL)


def only(src, versions):
    """Sources whose facts hold nothing but ``versions``."""
    keys = versions.select(*VERSION_KEYS)
    return replace(src, **{t: getattr(src, t).join(keys, VERSION_KEYS, "left_semi")
                           for t in ("referral", "digital_log", "care_activity")})


def test_registers_in_turn_equal_the_full_run(spark, src):
    """Forward, back (versions superseded by older ones, months gone) and
    forward again; each step sees only the facts of versions it has not met."""
    full = src.submission_register
    earlier = earlier_register(full)
    state = C.ChangeSetRefresh(spark, new_run_dir(spark, "test-change-set"), first=FIXTURE_FIRST)
    first = state.apply(replace(only(src, latest_register(earlier)), submission_register=earlier))
    added = latest_register(full).join(latest_register(earlier), VERSION_KEYS, "left_anti")
    assert 0 < added.count() < latest_register(full).count()
    second = state.apply(replace(only(src, added), submission_register=full))
    third = state.apply(replace(only(src, added.limit(0)), submission_register=earlier))
    for got, register in ((first, earlier), (second, full), (third, earlier)):
        want = MonthlyRefresh(replace(src, submission_register=register), first=FIXTURE_FIRST)
        for name in ("wait_dashboard", "treatment_dashboard", "outcome_dashboard"):
            assert bag(getattr(got, name)()) == bag(getattr(want, name))


def test_only_changed_submissions_are_scanned(spark, src):
    """The facts' scans are pruned to the folders of the new versions."""
    state = C.ChangeSetRefresh(spark, new_run_dir(spark, "test-change-set"))
    new = state._write(latest_register(src.submission_register).limit(2), "new")
    versions = new.filter(F.col("submission_id") >= F.lit(-2 ** 63))
    plan = src.digital_log.join(versions, VERSION_KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_same_register_again_changes_nothing(spark, src):
    state = C.ChangeSetRefresh(spark, new_run_dir(spark, "test-change-set"), first=FIXTURE_FIRST)
    small = replace(src, submission_register=src.submission_register.filter("period_start >= '1997-10-01'"))
    first = bag(state.apply(small).cells)
    assert first and bag(state.apply(small).cells) == first


def test_cells_taken_away_leave_nulls_and_no_empty_cells(spark):
    ddl = "month string, _bucket int, _s_x bigint, _c_x bigint, _rows bigint"
    a = spark.createDataFrame([("m", 1, 5, 1, 2), ("m", 1, 3, 1, 1), ("m", 0, 0, 0, 1), ("n", None, 4, 2, 2)], ddl)
    b = spark.createDataFrame([("m", 1, 8, 2, 2), ("n", None, 4, 2, 2)], ddl)
    assert sorted(map(tuple, merge_cells(a, b).collect())) == [("m", 0, 0, 0, 1), ("m", 1, 0, 0, 1)]
    assert bag(merge_cells(a.unionByName(b), b)) == bag(merge_cells(a))


def test_distinct_states_of_months_add_up(spark):
    """Ids of any sign and size, nulls, repeats within and across parts."""
    ids = [0, 1, 63, 64, 65, -1, -64, -65, 2 ** 62, -2 ** 63, 2 ** 63 - 1, None]
    rows = [(m, p, i, (m + k) % 3 == 0, k) for m in range(4) for p in (1, None) for k, i in enumerate(ids * 2)]
    df = spark.createDataFrame(rows, "month int, p int, id long, counted boolean, minutes int").repartition(5)
    parts = [usage_state(df.filter(F.col("month") == m), ["p"], id_col="id", counted=F.col("counted"),
                         minutes="minutes") for m in range(4)]
    state = parts[0]
    for part in parts[1:]:
        state = state.unionByName(part)
    want = df.groupBy("p").agg(F.sum("minutes").alias("minutes"),
                               F.count_distinct(F.when(F.col("counted"), F.col("id"))).alias("n_contacts"))
    assert bag(merged_usage(state, ["p"])) == bag(want)
    none = usage_state(df.filter("false"), ["p"], id_col="id", counted=F.lit(True), minutes="minutes")
    assert merged_usage(none, ["p"]).count() == 0


def test_a_change_set_stages_only_the_sources_that_it_reads(spark):
    """Applying registers asks for neither contacts nor answers."""
    at = new_run_dir(spark, "test-stage")
    src = Sources.from_driver_tables(spark, SF_SMALL, at, on_demand=True)
    C.ChangeSetRefresh(spark, new_run_dir(spark, "test-change-set"), first=FIXTURE_FIRST).apply(
        src.replaced(submission_register=src.submission_register.filter("period_start >= '1998-01-01'")))
    staged = {p.getPath().getName() for p in _listed(spark, at)}
    assert "digital_log" in staged and not staged & {"care_contact", "assessment", "terminology"}


def _listed(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)


def test_cells_of_other_months_are_not_merged(spark, src):
    """A later register's step deals out no cells but those of months it changes,
    and these only once."""
    state = C.ChangeSetRefresh(spark, new_run_dir(spark, "test-change-set"), first=FIXTURE_FIRST)
    recent = src.submission_register.filter("period_start >= '1997-06-01'")
    first = state.apply(src.replaced(submission_register=earlier_register(recent)))
    merged = []
    real, C.merge_cells = C.merge_cells, lambda *a: merged.append(real(*a)) or merged[-1]
    try:
        second = state.apply(src.replaced(submission_register=recent))
    finally:
        C.merge_cells = real
    months = {r[0] for r in merged[0].select("month").distinct().collect()}
    others = {r[0] for r in first.cells.select("month").distinct().collect()} - months
    assert months and others
    assert others < {r[0] for r in second.cells.select("month").distinct().collect()}


def test_cells_of_few_dims_are_aggregated_before_they_are_dealt(spark, src):
    state = C.ChangeSetRefresh(spark, new_run_dir(spark, "test-change-set"), first=FIXTURE_FIRST)
    small = src.submission_register.filter("period_start >= '1998-01-01'")
    got = state.apply(src.replaced(submission_register=small))
    for df in (got.wait_dashboard(), got.treatment_dashboard()):
        assert "REPARTITION_BY_COL" not in df._jdf.queryExecution().executedPlan().toString()
