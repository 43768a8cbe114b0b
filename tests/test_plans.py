"""Physical-plan properties the design relies on."""

from pathwise.plans import averages as V
from pathwise.plans import outcomes as O


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dashboard_of_few_dims_is_one_scan_one_shuffle(base):
    p = plan(O.wait_dashboard(base))
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("FileScan parquet") == 1
    assert "Generate" in p and "partial_sum" in p


def test_dashboard_of_many_dims_shuffles_cells_only(base):
    """Cells are dealt once by all their keys and once by (time, dims); levels
    and buckets are merged from them without an exchange above the Generate."""
    p = plan(O.outcome_dashboard(base))
    assert p.count("Exchange hashpartitioning") == 2 and p.count("FileScan parquet") == 1
    assert "Exchange" not in p[:p.index("Generate")]


def test_bucketed_base_needs_no_exchange_on_the_pathway(spark, refresh):
    """J04 from bucketed J01, J02 and referrals: sort-merge joins and DISTINCT as the files lie."""
    from pathwise.sources.publish import new_run_dir

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = refresh.bucketed_base(new_run_dir(spark, "test-bucketed"), 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(df.select("*"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert p.count("SortMergeJoin") == 2 and "Exchange" not in p
    assert df.count() == refresh.pathway_base.count()


def test_unrolled_baseline_scans_fifteen_times(base):
    from pathwise.operators.rollup import Sum, unrolled_rollup

    p = plan(unrolled_rollup(base, "month", O.OUTCOME_DIMS, [Sum("comp_flag")]))
    assert p.count("FileScan parquet") == 15


def test_reference_tables_are_broadcast(refresh):
    p = plan(refresh.pathway_base)
    assert "SortMergeJoin [coalesce" not in p          # hierarchy joins broadcast
    assert p.count("BroadcastHashJoin") >= 6
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_no_pair_products_anywhere(refresh):
    for name in ("outcome_dashboard", "questionnaire_dashboard", "time_recorded_dashboard",
                 "digital_time_dashboard", "any_time_dashboard", "all_contacts"):
        p = plan(getattr(refresh, name))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_contact_dashboards_do_not_build_the_fanout(base, refresh):
    # contacts are aggregated per pathway (partial aggregates) and joined 1:1 to
    # the base: no window over a pathway, no join of contact rows
    p = plan(V.digital_time_dashboard(base, refresh.digital_contact_rows))
    assert "partial_sum" in p and "partial_count" in p and "partial_max_by" in p
    assert "Window" not in p
    assert p.count("Join [pathway_id") == 1     # base x per-pathway minutes, 1:1


def test_scan_prunes_columns(base):
    p = plan(O.wait_dashboard(base))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "wait_ref_to_assess" in scan and "end_code_desc" not in scan


def test_questionnaire_answers_are_limited_before_their_first_shuffle(spark, refresh):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")   # the terms of the codes only
    try:
        lines = plan(refresh.questionnaire_base.select("*")).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    final = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Final" in line)
    # the partial limit lies below the exchange of the final one
    assert final < partial and any("Exchange hashpartitioning" in line for line in lines[final:partial])
    # and the answers are not joined to the month's pathways below it
    assert "LeftSemi" not in "".join(lines[final:partial + 2])


def test_superseded_activities_are_pruned(refresh):
    """Activities, like contacts, are read from the folders of latest versions only."""
    p = plan(V.contact_activity_pairs(refresh.src).select("*"))
    scans = [line for line in p.splitlines() if "FileScan parquet [pathway_id" in line]
    assert any("minutes" in line for line in scans) and any("contact_date" in line for line in scans)
    assert all("dynamicpruningexpression(submission_id" in line for line in scans)


def filtered_rows(node) -> list[tuple[str, int]]:
    """(scan's columns, rows kept) of every filter by a run-time key filter in an executed plan."""
    found = []
    text = node.simpleString(1000)
    if text.startswith("Filter") and "might_contain" in text:
        found.append((node.child().simpleString(10_000), int(node.metrics().apply("numOutputRows").value())))
    children = node.children()
    for i in range(children.size()):
        found += filtered_rows(children.apply(i))
    return found


def test_a_months_pathways_reach_the_scans(spark, refresh):
    """One-month J07: Bloom filters of the referrals' pathways cut the log and the
    answers at their scans, and lose nothing.  (The month itself is not part of
    them: Spark builds them from the filtered scan, before its joins.)"""
    from pathwise.functions import rules as R
    from pathwise.plans.catalog import FIXTURE_FIRST
    from pathwise.plans.refresh import MonthlyRefresh

    conf = {"spark.sql.autoBroadcastJoinThreshold": "20k", "spark.sql.adaptive.enabled": "false",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        src = refresh.src
        df = MonthlyRefresh(src, first=FIXTURE_FIRST).questionnaire_base.select("*")
        month = {r[0] for r in df.select("pathway_id").collect()}
        df = MonthlyRefresh(src, first=FIXTURE_FIRST).questionnaire_base.select("*")
        df.collect()
        kept = filtered_rows(df._jdf.queryExecution().executedPlan())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    log = src.digital_log.join(src.submission_register.filter("is_latest = 1"), ["submission_id", "audit_id"])
    need = {"product": log.filter(log.pathway_id.isin(*month)).count(),
            "score": src.assessment.filter(src.assessment.pathway_id.isin(*month)
                                           & src.assessment.code.isin(R.QUESTION_CODES)).count()}
    all_rows = {"product": log.count(), "score": src.assessment.count()}
    assert month and len(kept) == 2
    for scan, n in kept:
        side = "score" if "score" in scan else "product"
        assert need[side] <= n < 0.8 * all_rows[side]
