"""Property tests: the rollup equals the per-branch union on random
bases, and neither row order nor partitioning changes any output."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pathwise.functions import rules as R
from pathwise.operators.rollup import Avg, Count, Sum, level_bucket_rollup, unrolled_rollup
from pathwise.operators.versions import reporting_window

SCHEMA = ("month date, iet_count bigint, product string, flag int, wait int, "
          + ", ".join(f"{g} string" for g in R.GEO_COLUMNS))

row = st.tuples(
    st.sampled_from([dt.date(2021, 1, 1), dt.date(2021, 2, 1)]),
    st.sampled_from([None, 0, 1, 2, 5]),
    st.sampled_from([None, "A", "B"]),
    st.sampled_from([0, 1]),
    st.one_of(st.none(), st.integers(-30, 400)),
    *[st.sampled_from([None, "x", "y"]) for _ in R.GEO_COLUMNS],
)
MEASURES = [Sum("iet_count"), Sum("flag"), Avg("avg_wait", "wait"), Count("n_wait", "wait")]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_rollup_equals_union_of_branches(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = level_bucket_rollup(df, "month", ["product"], MEASURES)
    want = unrolled_rollup(df, "month", ["product"], MEASURES).select(*got.columns)
    assert bag(got) == bag(want)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40), st.randoms(use_true_random=False),
       st.integers(1, 9))
def test_order_and_partitioning_do_not_matter(spark, rows, rnd, parts):
    df = spark.createDataFrame(rows, SCHEMA)
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    df2 = spark.createDataFrame(shuffled, SCHEMA).repartition(parts)
    a = level_bucket_rollup(df, "month", ["product"], MEASURES)
    b = level_bucket_rollup(df2, "month", ["product"], MEASURES, fold=True)
    assert bag(a) == bag(b)


def test_reporting_window_clamps_month_end(spark):
    reg = spark.createDataFrame(
        [(1, 1, 1, dt.date(2021, 3, 1), dt.date(2021, 3, 31)),
         (2, 1, 0, dt.date(2021, 2, 1), dt.date(2021, 2, 28))],
        "submission_id long, audit_id int, is_latest int, period_start date, period_end date")
    w = reporting_window(reg, lag=1, first="2020-09-01", offset=-2).frame.first()
    assert w.period_start == dt.date(2021, 2, 1)
    assert w.period_end == dt.date(2021, 2, 28)      # EOMONTH(31 Mar - 1 month)
    assert w.first_date == dt.date(2020, 9, 1)
    assert w.offset_start == dt.date(2020, 12, 1)


def test_window_uses_all_register_rows(spark):
    # the maximum is over every register row, latest or not (K8)
    reg = spark.createDataFrame(
        [(1, 1, 0, dt.date(2021, 5, 1), dt.date(2021, 5, 31)),
         (2, 1, 1, dt.date(2021, 3, 1), dt.date(2021, 3, 31))],
        "submission_id long, audit_id int, is_latest int, period_start date, period_end date")
    w = reporting_window(reg).frame.first()
    assert w.period_start == dt.date(2021, 4, 1)


def test_window_values_stay_in_the_plan(spark):
    reg = spark.createDataFrame([(1, 1, 1, dt.date(2021, 3, 1), dt.date(2021, 3, 31))],
                                "submission_id long, audit_id int, is_latest int, "
                                "period_start date, period_end date")
    w = reporting_window(reg)
    q = reg.filter(F.col("period_start") > w.period_start)
    assert "ScalarSubquery" in q._jdf.queryExecution().optimizedPlan().toString() or \
        "scalar-subquery" in q._jdf.queryExecution().optimizedPlan().toString()
