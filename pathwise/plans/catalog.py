"""Registered queries: every job and single operator, over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed over
the whole fixture tables derived from ``sf_dir``.  Parameters are the fixture
run's (FIXTURES.md): history from 1996-01-01, refresh lag one month, and a
questionnaire range of 24 months back (one month in the monthly run).
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathwise.functions import labels as L
from pathwise.functions import rules as R
from pathwise.operators.checks import reference_duplicates
from pathwise.operators.distinct_state import merged_usage, usage_state
from pathwise.operators.orgs import resolve_commissioner, resolve_provider
from pathwise.operators.ranking import rank_newest
from pathwise.operators.rollup import Avg, Count, Sum, buckets_column, level_bucket_rollup
from pathwise.operators.versions import VERSION_KEYS, latest_only
from pathwise.plans import appointments as A
from pathwise.plans import averages as V
from pathwise.plans import outcomes as O
from pathwise.plans import questionnaire as Q
from pathwise.plans.change_set import USAGE_KEYS, Applied, ChangeSetRefresh
from pathwise.plans.refresh import MonthlyRefresh
from pathwise.sources import publish as P
from pathwise.sources.schemas import DASHBOARD_SCHEMAS, TEXT_FLAGS, conform
from pathwise.sources.snapshots import Snapshot, SnapshotTable
from pathwise.sources.tables import Sources, driver_sources

FIXTURE_FIRST = "1996-01-01"
FIXTURE_QUESTIONNAIRE_OFFSET = -24

Query = Callable[[SparkSession, str], DataFrame]


_REFRESHES: dict[tuple[str, str, bool | None], MonthlyRefresh] = {}


def refresh(spark: SparkSession, sf_dir: str, fold: bool | None = None) -> MonthlyRefresh:
    """The fixture refresh for ``sf_dir``.  One per Spark application: its
    DataFrames are immutable, lazy plans, so queries sharing a job (the
    pathway base, say) share the built plan instead of rebuilding it through
    thousands of driver-to-JVM calls.  No data is cached."""
    key = (spark.sparkContext.applicationId, sf_dir, fold)
    if key not in _REFRESHES:
        _REFRESHES[key] = MonthlyRefresh(driver_sources(spark, sf_dir), first=FIXTURE_FIRST,
                                         questionnaire_offset=FIXTURE_QUESTIONNAIRE_OFFSET,
                                         fold=fold)
    return _REFRESHES[key]


def _job(name: str) -> Query:
    return lambda spark, sf_dir: getattr(refresh(spark, sf_dir), name)


def _src(fn: Callable[[Sources], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(driver_sources(spark, sf_dir))


def _refresh(fn: Callable[[MonthlyRefresh], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(refresh(spark, sf_dir))


# ---- single operators ----------------------------------------------------------
def _latest_only(s: Sources) -> DataFrame:
    return latest_only(s.referral, s.submission_register).select(
        "pathway_id", "submission_id", "audit_id", "unique_month_id", "period_start", "period_end")


def _org_succession(s: Sources) -> DataFrame:
    cs = s.commissioner_succession.select(F.col("old_code").alias("_c_old"),
                                          F.col("new_code").alias("_c_new"))
    ps = s.provider_succession.select(F.col("old_code").alias("_p_old"),
                                      F.col("new_code").alias("_p_new"))
    return (s.referral.join(cs, F.col("commissioner_id") == F.col("_c_old"), "left")
            .join(ps, F.col("provider_id") == F.col("_p_old"), "left")
            .select("pathway_id", "commissioner_id", "provider_id",
                    F.coalesce("_c_new", "commissioner_id").alias("commissioner_now"),
                    F.coalesce("_p_new", "provider_id").alias("provider_now")))


def _org_current_hierarchy(s: Sources) -> DataFrame:
    ref = s.referral.select("pathway_id", "unique_month_id", "commissioner_id", "provider_id")
    ref = resolve_commissioner(ref, "commissioner_id", s.commissioner_succession,
                               s.commissioner_hierarchy)
    ref = resolve_provider(ref, "provider_id", s.provider_succession, s.provider_hierarchy)
    return ref.select("pathway_id", "unique_month_id", *R.GEO_COLUMNS)


def _calendar_quarter(s: Sources) -> DataFrame:
    cal = s.calendar.select(F.col("full_date").alias("period_start"), "quarter")
    return (latest_only(s.referral, s.submission_register).join(cal, "period_start")
            .select("pathway_id", "unique_month_id", "period_start", "quarter"))


def _latest_answer_join(r: MonthlyRefresh) -> DataFrame:
    newest = r.newest_answers.select("pathway_id", "code", "score", "term")
    return (r.src.referral.select("pathway_id", "unique_month_id")
            .join(newest, "pathway_id", "left")
            .select("pathway_id", "unique_month_id", "code", "score", "term"))


def _contacts_in_period(r: MonthlyRefresh) -> DataFrame:
    ref = latest_only(r.src.referral, r.src.submission_register)
    return (ref.join(A.digital_contact_rows(r.src), ["pathway_id", "unique_month_id"])
            .filter(F.col("end_date").between(F.col("period_start"), F.col("period_end")))
            .select("pathway_id", "unique_month_id", "start_date", "end_date", "minutes", "product"))


def _base_digital_fanout(r: MonthlyRefresh) -> DataFrame:
    ref = latest_only(r.src.referral, r.src.submission_register)
    j01 = r.digital_summary.select("pathway_id", "product", "integrated",
                                   F.col("n_contacts").alias("iet_count"),
                                   F.col("minutes").alias("iet_minutes"))
    return (ref.join(j01, "pathway_id", "left")
            .select("pathway_id", "unique_month_id", "product", "integrated", "iet_count",
                    "iet_minutes"))


def _product_canonical(s: Sources) -> DataFrame:
    return s.digital_log.select("log_id", "pathway_id", F.col("product").alias("product_raw"),
                                L.canonical_product("product").alias("product"))


def _month_key(s: Sources) -> DataFrame:
    return s.submission_register.select("submission_id", "audit_id", "period_start",
                                        L.month_key("period_start").alias("month"))


def _wait_days(s: Sources) -> DataFrame:
    return s.referral.select(
        "pathway_id", "unique_month_id",
        L.wait_days("received_date", "first_assessment_date").alias("wait_ref_to_assess"),
        L.wait_days("received_date", "first_therapy_date").alias("wait_ref_to_therapy"),
        L.wait_days("first_therapy_date", "second_therapy_date").alias("wait_first_to_second"))


def _end_code_label(s: Sources) -> DataFrame:
    return s.referral.select("pathway_id", "unique_month_id", "end_code",
                             L.end_code_label("end_code").alias("end_code_desc"))


def _outcome_flags(s: Sources) -> DataFrame:
    ref = latest_only(s.referral, s.submission_register)
    return ref.select("pathway_id", "unique_month_id", *O.outcome_flag_columns(ref))


def _problem_label(s: Sources) -> DataFrame:
    cols = ["higher_category", "primary_complaint", "lower_category", "second_complaint"]
    return s.referral.select("pathway_id", "unique_month_id", *cols,
                             L.problem_label(*cols).alias("problem"))


def _severity_bands(s: Sources) -> DataFrame:
    return s.referral.select("pathway_id", "unique_month_id", "anxiety_score", "depression_score",
                             L.gad7_band("anxiety_score").alias("gad7_band"),
                             L.phq9_band("depression_score").alias("phq9_band"))


def _usage_mix(r: MonthlyRefresh) -> DataFrame:
    j01 = r.digital_summary.select("pathway_id", "product", F.col("n_contacts").alias("iet_count"))
    return (r.src.referral.join(j01, "pathway_id", "left")
            .select("pathway_id", "unique_month_id", "product", "iet_count", "contact_count",
                    L.usage_mix("iet_count", "contact_count").alias("mix_class")))


def _question_answer_labels(r: MonthlyRefresh) -> DataFrame:
    return r.latest_answers.select("pathway_id", "code", "score", "latest_rank",
                                   L.question_label("term").alias("question"),
                                   L.answer_label("code", "score").alias("answer"))


def _time_recorded_flag(r: MonthlyRefresh) -> DataFrame:
    return A.digital_contact_rows(r.src).select("pathway_id", "start_date", "end_date", "minutes",
                                     L.time_recorded_flag("minutes").alias("time_recorded"))


def _count_once_flag(r: MonthlyRefresh) -> DataFrame:
    con = r.digital_contacts.select("pathway_id", "start_date", "latest_rank")
    return (r.pathway_base.select("pathway_id", "month", "product", "comp_flag")
            .join(con, "pathway_id", "left")
            .select("pathway_id", "month", "product", "start_date", "latest_rank",
                    L.count_once("latest_rank", "comp_flag").alias("comp_flag")))


def _conditional_distinct(s: Sources) -> DataFrame:
    log = latest_only(s.digital_log, s.submission_register)
    in_period = F.col("end_date").between(F.col("period_start"), F.col("period_end"))
    return log.groupBy("pathway_id").agg(
        F.count_distinct(F.when(in_period, F.col("log_id"))).alias("n_contacts"),
        F.count("log_id").alias("n_rows"))


def _non_null_count(r: MonthlyRefresh) -> DataFrame:
    return A.digital_contact_rows(r.src).groupBy("product").agg(F.count("minutes").alias("n_minutes"),
                                                     F.count(F.lit(1)).alias("n_rows"))


def _exact_average(r: MonthlyRefresh) -> DataFrame:
    measures = [Avg("avg_wait_ref_to_assess", "wait_ref_to_assess"),
                Avg("avg_wait_ref_to_therapy", "wait_ref_to_therapy"),
                Avg("avg_wait_first_to_second", "wait_first_to_second")]
    partials = [(n, e) for m in measures for n, e in m.partials()]
    return (r.pathway_base.select("quarter", *[e.alias(n) for n, e in partials])
            .groupBy("quarter").agg(*[F.sum(n).alias(n) for n, _ in partials])
            .select("quarter", *[m.final() for m in measures]))


def _overlapping_buckets(r: MonthlyRefresh) -> DataFrame:
    return (r.pathway_base
            .select("month", "iet_count",
                    F.explode(buckets_column(F.col("iet_count"))).alias("appointment_type"))
            .groupBy("month", "appointment_type")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("iet_count").alias("iet_count")))


def _org_levels(r: MonthlyRefresh) -> DataFrame:
    return level_bucket_rollup(r.pathway_base, "month", [],
                               [Count("n_pathways", "pathway_id"), Sum("comp_flag")],
                               bucket_col=None)


def _rank_newest(s: Sources) -> DataFrame:
    con = latest_only(s.care_contact, s.submission_register).select(
        "pathway_id", "submission_id", "audit_id", "unique_month_id", "contact_date")
    return rank_newest(con, ["pathway_id"], "contact_date", [
        F.col("submission_id").asc(), F.col("audit_id").asc(), F.col("unique_month_id").asc()])


def _month_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3 twice: the second publish of the same month leaves the table as it was."""
    df = refresh(spark, sf_dir).questionnaire_dashboard
    path = f"{P.new_run_dir(spark, 'month-publish')}/questionnaire_dashboard"
    P.publish_month(df, path)
    P.publish_month(df, path)
    return P.read_published(spark, path, df.columns)


def _month_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3 as it is run each month, at questionnaire offset 0: the month before
    the latest, then the latest, then the latest again."""
    src = driver_sources(spark, sf_dir)
    path = f"{P.new_run_dir(spark, 'month-runs')}/questionnaire_dashboard"
    before, latest = (MonthlyRefresh(src, first=FIXTURE_FIRST, lag=lag).questionnaire_dashboard
                      for lag in (R.REFRESH_LAG_MONTHS + 1, R.REFRESH_LAG_MONTHS))
    for df in (before, latest, latest):
        P.publish_month(df, path)
    return P.read_published(spark, path, latest.columns)


class _Killed(Exception):
    """Stands for the loss of the driver in the middle of a publish."""


class _DiesBeforeCommit(SnapshotTable):
    def _commit(self, snapshot: Snapshot) -> Snapshot:
        raise _Killed


def _atomic_month_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly runs of ``month_runs`` into a snapshot table, with a run of
    the whole month range that is killed when its rows are written but not
    committed: readers never see it."""
    src = driver_sources(spark, sf_dir)
    path = f"{P.new_run_dir(spark, 'atomic-month-runs')}/questionnaire_dashboard"
    table = SnapshotTable(spark, path)
    before, latest = (MonthlyRefresh(src, first=FIXTURE_FIRST, lag=lag)
                      for lag in (R.REFRESH_LAG_MONTHS + 1, R.REFRESH_LAG_MONTHS))
    table.publish_months(before.questionnaire_dashboard, before.questionnaire_months())
    whole = refresh(spark, sf_dir)
    with contextlib.suppress(_Killed):
        _DiesBeforeCommit(spark, path).publish_months(whole.questionnaire_dashboard, whole.questionnaire_months())
    for _ in range(2):
        table.publish_months(latest.questionnaire_dashboard, latest.questionnaire_months())
    return table.read()


def _month_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3 as the reference writes it: a plain insert, so a repeated month
    stands twice (K9)."""
    r = MonthlyRefresh(driver_sources(spark, sf_dir), first=FIXTURE_FIRST)
    path = f"{P.new_run_dir(spark, 'month-append')}/questionnaire_dashboard"
    for _ in range(2):
        P.append_month(r.questionnaire_dashboard, path)
    return P.read_published(spark, path, r.questionnaire_dashboard.columns)


def _full_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1 twice: overwrite leaves one copy."""
    df = refresh(spark, sf_dir).time_recorded_dashboard
    path = f"{P.new_run_dir(spark, 'full-publish')}/time_recorded_dashboard"
    P.publish_full(df, path)
    P.publish_full(df, path)
    return P.read_published(spark, path, df.columns)


def earlier_register(register: DataFrame) -> DataFrame:
    """The fixture register as it was: without its last three months, and with
    every third month's second version still to come."""
    newest = register.agg(F.add_months(F.max("period_start"), -3).alias("m")).select("m").scalar()
    waiting = F.month("period_start") % 3 == 0
    return (register.filter((F.col("period_start") <= newest) & ~(waiting & (F.col("audit_id") == 2)))
            .withColumn("is_latest", F.when(waiting, F.lit(1)).otherwise(F.col("is_latest"))))


_CHANGE_SETS: dict[tuple[str, str], Applied] = {}


def two_registers(spark: SparkSession, sf_dir: str) -> Applied:
    """The earlier register, then the present one by its change set; once per
    Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CHANGE_SETS:
        src = driver_sources(spark, sf_dir)
        state = ChangeSetRefresh(spark, P.new_run_dir(spark, "change-set"), first=FIXTURE_FIRST)
        state.apply(src.replaced(submission_register=earlier_register(src.submission_register)))
        _CHANGE_SETS[key] = state.apply(src)
    return _CHANGE_SETS[key]


def _monthly_digital_summary(s: Sources) -> DataFrame:
    """J01 from mergeable states, one per submission version."""
    log = latest_only(s.digital_log, s.submission_register).withColumn("product", L.canonical_product("product"))
    states = usage_state(log, [*VERSION_KEYS, *USAGE_KEYS], id_col="log_id", minutes="minutes",
                         counted=F.col("end_date").between(F.col("period_start"), F.col("period_end")))
    return merged_usage(states, USAGE_KEYS)


def _with_text_flags(s: Sources) -> Sources:
    """Referral flags as the texts 'True' and 'False' (F02)."""
    flags = sorted(TEXT_FLAGS)
    return replace(s, referral=s.referral.withColumns({c: F.initcap(F.col(c).cast("string")) for c in flags}))


def _text_flag_base(s: Sources) -> DataFrame:
    """J04 over text flags."""
    return MonthlyRefresh(_with_text_flags(s), first=FIXTURE_FIRST).pathway_base


def _collated_digital_summary(s: Sources) -> DataFrame:
    """J01 under the reference's default text comparison (K7): product names in
    any case, with blanks at the end, count as the same."""
    name, known = F.col("product"), [p for _, prefixes in R.PRODUCT_PREFIXES for p in prefixes]
    varied = (F.when(F.col("log_id") % 3 == 0, F.upper(name))
              .when(F.col("log_id") % 3 == 1, F.concat(F.lower(name), F.lit("  "))).otherwise(name))
    is_known = F.lit(False)
    for p in known:
        is_known = is_known | name.startswith(p)
    log = s.digital_log.withColumn("product", F.when(is_known, varied).otherwise(name))
    out = O.digital_summary(replace(s, digital_log=log).with_collation("UTF8_LCASE_RTRIM"))
    return out.select(*[F.col(c).cast("string").alias(c) if c in ("product", "integrated") else F.col(c)
                        for c in out.columns])


def _published_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12 as it is published, averages of the reference's type (in text)."""
    r = refresh(spark, sf_dir)
    path = f"{P.new_run_dir(spark, 'published-averages')}/wait_dashboard"
    table = SnapshotTable(spark, path)
    table.publish_full(conform(O.wait_dashboard(r.pathway_base, averages="decimal"), DASHBOARD_SCHEMAS["wait_dashboard"]))
    out = table.read()
    return out.select(*[F.col(c).cast("string").alias(c) if c.startswith("avg_") else F.col(c) for c in out.columns])


def _bucketed_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J04 from J01, J02 and referrals that lie bucketed by pathway: no shuffle."""
    return refresh(spark, sf_dir).bucketed_base(P.new_run_dir(spark, "bucketed"))


QUERIES: dict[str, Query] = {
    # jobs (J01-J18)
    "digital_summary": _job("digital_summary"),
    "contact_minutes": _job("contact_minutes"),
    "reporting_window": _refresh(lambda r: r.questionnaire_window.frame),
    "pathway_base": _job("pathway_base"),
    "outcome_dashboard": _job("outcome_dashboard"),
    "latest_answers": _job("latest_answers"),
    "questionnaire_base": _job("questionnaire_base"),
    "questionnaire_dashboard": _job("questionnaire_dashboard"),
    "digital_contacts": _job("digital_contacts"),
    "appointment_base": _job("appointment_base"),
    "time_recorded_dashboard": _job("time_recorded_dashboard"),
    "wait_dashboard": _job("wait_dashboard"),
    "treatment_dashboard": _job("treatment_dashboard"),
    "digital_contact_base": _job("digital_contact_base"),
    "digital_time_dashboard": _job("digital_time_dashboard"),
    "all_contacts": _job("all_contacts"),
    "any_contact_base": _job("any_contact_base"),
    "any_time_dashboard": _job("any_time_dashboard"),
    # single operators
    "latest_only": _src(_latest_only),
    "org_succession": _src(_org_succession),
    "org_current_hierarchy": _src(_org_current_hierarchy),
    "calendar_quarter": _src(_calendar_quarter),
    "terminology_lookup": _src(Q.answers_with_terms),
    "latest_answer_join": _refresh(_latest_answer_join),
    "contacts_in_period": _refresh(_contacts_in_period),
    "base_digital_fanout": _refresh(_base_digital_fanout),
    "contact_activity_pairs": _src(V.contact_activity_pairs),
    "product_canonical": _src(_product_canonical),
    "month_key": _src(_month_key),
    "wait_days": _src(_wait_days),
    "end_code_label": _src(_end_code_label),
    "outcome_flags": _src(_outcome_flags),
    "problem_label": _src(_problem_label),
    "severity_bands": _src(_severity_bands),
    "usage_mix": _refresh(_usage_mix),
    "question_answer_labels": _refresh(_question_answer_labels),
    "time_recorded_flag": _refresh(_time_recorded_flag),
    "count_once_flag": _refresh(_count_once_flag),
    "conditional_distinct": _src(_conditional_distinct),
    "non_null_count": _refresh(_non_null_count),
    "exact_average": _refresh(_exact_average),
    "overlapping_buckets": _refresh(_overlapping_buckets),
    "org_levels": _refresh(_org_levels),
    "rank_newest": _src(_rank_newest),
    "distinct_rows": _src(A.digital_contact_rows),
    "reference_duplicates": _src(reference_duplicates),
    "month_publish": _month_publish,
    "month_runs": _month_runs,
    "full_publish": _full_publish,
    "atomic_month_runs": _atomic_month_runs,
    "month_append": _month_append,
    # refresh by change set: two registers in turn
    "change_set_outcomes": lambda spark, sf_dir: two_registers(spark, sf_dir).outcome_dashboard(),
    "change_set_waits": lambda spark, sf_dir: two_registers(spark, sf_dir).wait_dashboard(),
    "change_set_treatments": lambda spark, sf_dir: two_registers(spark, sf_dir).treatment_dashboard(),
    "monthly_digital_summary": _src(_monthly_digital_summary),
    "bucketed_base": _bucketed_base,
    "text_flag_base": _src(_text_flag_base),
    "collated_digital_summary": _src(_collated_digital_summary),
    "published_averages": _published_averages,
}
