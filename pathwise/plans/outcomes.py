"""Pathway base and the outcome / wait / treatment dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwise.functions import labels as L
from pathwise.functions import rules as R
from pathwise.operators.orgs import resolve_commissioner, resolve_provider
from pathwise.operators.rollup import Avg, Sum, level_bucket_rollup
from pathwise.operators.versions import VERSION_KEYS, ReportingWindow, latest_only
from pathwise.sources.tables import Sources


def flag(df: DataFrame, name: str) -> Column:
    """A boolean source flag, accepting 'True' text as the reference does."""
    dtype = df.schema[name].dataType.simpleString()
    return L.truthy(F.col(name), "string" if dtype == "string" else "boolean")


def digital_summary(src: Sources) -> DataFrame:
    """Minutes and distinct in-period contacts per pathway x product x integrated flag.

    Latest versions only; the count uses each log row's own submission period.
    Totals span all months (no month key).
    """
    log = latest_only(src.digital_log, src.submission_register)
    in_period = F.col("end_date").between(F.col("period_start"), F.col("period_end"))
    return (log.select("pathway_id", L.canonical_product("product").alias("product"), "integrated",
                       "minutes", F.when(in_period, F.col("log_id")).alias("_counted"))
            .groupBy("pathway_id", "product", "integrated")
            .agg(F.sum("minutes").alias("minutes"),
                 F.count_distinct("_counted").alias("n_contacts")))


def contact_minutes(src: Sources) -> DataFrame:
    """Clinical minutes per pathway over all care activities (latest versions)."""
    act = latest_only(src.care_activity, src.submission_register)
    return act.groupBy("pathway_id").agg(F.sum("minutes").alias("minutes"))


def latest_referrals(src: Sources) -> DataFrame:
    """Referral rows of the latest submission versions, with their period."""
    return latest_only(src.referral, src.submission_register)


def with_orgs(df: DataFrame, src: Sources) -> DataFrame:
    """Append the nine geography columns (commissioner + provider side)."""
    df = resolve_commissioner(df, "commissioner_id", src.commissioner_succession,
                              src.commissioner_hierarchy)
    return resolve_provider(df, "provider_id", src.provider_succession, src.provider_hierarchy)


def discharged_in_period() -> Column:
    return F.col("discharge_date").between(F.col("period_start"), F.col("period_end"))


def completed_in_period(ref: DataFrame) -> Column:
    """Usable, completed, discharged inside its own submission period."""
    return flag(ref, "usable") & flag(ref, "completed") & discharged_in_period()


def outcome_flag_columns(ref: DataFrame) -> list[Column]:
    """The five 0/1 outcome flags."""
    disc, done = discharged_in_period(), flag(ref, "completed")
    rec, nc, imp = flag(ref, "recovered"), flag(ref, "not_case"), flag(ref, "improved")
    return [
        L.outcome_flag(disc, done, rec).alias("rec_flag"),
        L.outcome_flag(disc, done, nc).alias("not_case_flag"),
        L.outcome_flag(disc, done, imp).alias("rel_imp_flag"),
        L.outcome_flag(disc, done, imp, rec).alias("rel_rec_flag"),
        L.outcome_flag(disc, done).alias("comp_flag"),
    ]


BASE_COLUMNS = [
    "month", "quarter", "period_start", "period_end", "pathway_id", "unique_month_id",
    "received_date", "first_assessment_date", "first_therapy_date", "second_therapy_date",
    "discharge_date", "wait_ref_to_assess", "wait_ref_to_therapy", "wait_first_to_second",
    "old_iet_count", "iet_count", "product", "iet_minutes", "any_minutes", "integrated",
    "end_code", "end_code_desc", "rec_flag", "not_case_flag", "rel_imp_flag", "rel_rec_flag",
    "comp_flag", "problem", "gad7_band", "phq9_band", "mix_class", *R.GEO_COLUMNS,
]


def labelled_referrals(src: Sources, ref: DataFrame) -> DataFrame:
    """What J04 takes from a completed referral row (with its period): waits,
    flags, labels and organisations; nothing of the log, the activities or the
    window."""
    ref = with_orgs(ref.filter(completed_in_period(ref)), src)
    cal = src.calendar.select(F.col("full_date").alias("period_start"), "quarter")
    return ref.join(cal, "period_start", "inner").select(
        *VERSION_KEYS, L.month_key("period_start").alias("month"), "quarter", "period_start", "period_end",
        "pathway_id", "unique_month_id", "received_date", "first_assessment_date",
        "first_therapy_date", "second_therapy_date", "discharge_date",
        L.wait_days("received_date", "first_assessment_date").alias("wait_ref_to_assess"),
        L.wait_days("received_date", "first_therapy_date").alias("wait_ref_to_therapy"),
        L.wait_days("first_therapy_date", "second_therapy_date").alias("wait_first_to_second"),
        "old_iet_count", "contact_count", "end_code", *outcome_flag_columns(ref),
        L.problem_label("higher_category", "primary_complaint", "lower_category",
                        "second_complaint").alias("problem"),
        L.gad7_band("anxiety_score").alias("gad7_band"),
        L.phq9_band("depression_score").alias("phq9_band"), *R.GEO_COLUMNS)


def in_window(first_date, period_start, period_end) -> Column:
    """The window's conditions on a referral."""
    return (F.col("received_date").between(first_date, period_end)
            & F.col("period_start").between(first_date, period_start))


def base_rows(referrals: DataFrame, summary: DataFrame, minutes: DataFrame) -> DataFrame:
    """J04 of labelled referrals: joined to J01 and J02 on the pathway, DISTINCT.

    A pathway with two products keeps two rows (join on pathway only, K1).
    Inputs that lie bucketed by ``pathway_id`` are joined as they lie, and the
    DISTINCT reuses their partitioning.
    """
    j01 = summary.select("pathway_id", "product", "integrated",
                         F.col("minutes").alias("iet_minutes"),
                         F.col("n_contacts").alias("iet_count"))
    j02 = minutes.select("pathway_id", F.col("minutes").alias("any_minutes"))
    rows = (referrals.join(j01, "pathway_id", "left").join(j02, "pathway_id", "left")
            .withColumn("product", L.product_or_default("product"))
            .withColumn("mix_class", L.usage_mix("iet_count", "contact_count")))
    # the end-code description is a function of the end code: DISTINCT over
    # the other columns gives the same rows, without hashing the long text
    at = BASE_COLUMNS.index("end_code_desc")
    return (rows.select(*BASE_COLUMNS[:at], *BASE_COLUMNS[at + 1:]).distinct()
            .select(*BASE_COLUMNS[:at], L.end_code_label("end_code").alias("end_code_desc"),
                    *BASE_COLUMNS[at + 1:]))


def pathway_base(src: Sources, window: ReportingWindow, summary: DataFrame,
                 minutes: DataFrame) -> DataFrame:
    """One row per completed pathway x digital product, all months of the window.

    Plan: the register, calendar and organisation tables are small sides
    (broadcast by Spark's size check); the two per-pathway aggregates join on
    ``pathway_id``, so referral, J01 and J02 meet on one hash partitioning and
    the final DISTINCT reuses it (its keys include ``pathway_id``).
    """
    ref = latest_referrals(src).filter(in_window(window.first_date, window.period_start, window.period_end))
    return base_rows(labelled_referrals(src, ref), summary, minutes)


def base_pathways(src: Sources, window: ReportingWindow) -> DataFrame:
    """Distinct pathways that ``pathway_base`` can have rows of."""
    ref = latest_referrals(src).filter(in_window(window.first_date, window.period_start, window.period_end))
    return ref.filter(completed_in_period(ref)).select("pathway_id").distinct()


OUTCOME_DIMS = ["product", "integrated", "end_code", "end_code_desc", "problem",
                "gad7_band", "phq9_band", "mix_class"]
OUTCOME_FLAGS = ["rec_flag", "not_case_flag", "rel_imp_flag", "rel_rec_flag", "comp_flag"]


def outcome_dashboard(base: DataFrame, *, fold: bool = True) -> DataFrame:
    """Outcome flag sums by month x clinical dims x level x bucket.

    The end-code description is a function of the end code, so the rollup
    groups by the code and labels each output group afterwards (same groups,
    far shorter keys).  With so many dims there are about as many cells as
    base rows, so folding first carries them twice instead of ten times; the
    dashboards with few dims are collapsed in the map tasks as they are.
    """
    keys = [d for d in OUTCOME_DIMS if d != "end_code_desc"]
    out = level_bucket_rollup(base, "month", keys,
                              [Sum("iet_count"), *[Sum(f) for f in OUTCOME_FLAGS]], fold=fold,
                              derived={"end_code_desc": L.end_code_label("end_code")})
    return out.select("month", "org_type", "region", "org_name", "org_code", "appointment_type",
                      "iet_count", *OUTCOME_DIMS, *OUTCOME_FLAGS)


def wait_dashboard(base: DataFrame, *, fold: bool = False,
                   averages: str = "double") -> DataFrame:
    """Average waits (exact decimal average) by quarter x level x bucket."""
    return level_bucket_rollup(base, "quarter", [], [
        Avg("avg_wait_ref_to_assess", "wait_ref_to_assess"),
        Avg("avg_wait_ref_to_therapy", "wait_ref_to_therapy"),
        Avg("avg_wait_first_to_second", "wait_first_to_second"),
        Sum("comp_flag"),
    ], fold=fold, averages=averages)


def treatment_dashboard(base: DataFrame, *, fold: bool = False,
                        averages: str = "double") -> DataFrame:
    """Average digital appointments / digital minutes / any minutes per treatment."""
    return level_bucket_rollup(base, "quarter", ["product"], [
        Avg("avg_iet_count", "iet_count"),
        Avg("avg_iet_minutes", "iet_minutes"),
        Avg("avg_any_minutes", "any_minutes"),
        Sum("comp_flag"),
    ], fold=fold, averages=averages)
