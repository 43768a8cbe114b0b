"""Patient experience questionnaire: latest answers, base, dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwise.functions import labels as L
from pathwise.functions import rules as R
from pathwise.operators.ranking import newest_only, rank_newest
from pathwise.operators.rollup import Sum, level_bucket_rollup
from pathwise.operators.versions import VERSION_KEYS, ReportingWindow, latest_register
from pathwise.plans.outcomes import (
    completed_in_period, discharged_in_period, flag, latest_referrals, with_orgs,
)
from pathwise.sources.tables import Sources


def question_terms(terminology: DataFrame) -> DataFrame:
    """Fully specified, latest, active terms of the questionnaire codes only.

    Restricting to the question codes (which are the only ones that can
    match) bounds this side by the number of codes, whatever the size of
    the terminology, so it is always a broadcast side.
    """
    return (terminology
            .filter((F.col("type_id") == R.TERM_TYPE_FSN) & (F.col("is_latest") == 1)
                    & (F.col("active") == 1))
            .select(F.col("concept_id").cast("string").alias("_concept"), "term")
            .filter(F.col("_concept").isin(R.QUESTION_CODES)))


def answers_with_terms(src: Sources, latest_versions_only: bool = False) -> DataFrame:
    """JN9: questionnaire answers with their question term (NULL if none)."""
    ans = src.assessment.filter(F.col("code").isin(R.QUESTION_CODES))
    if latest_versions_only:
        missing = {"submission_id", "audit_id"} - set(ans.columns)
        if missing:
            raise ValueError(f"assessment has no {sorted(missing)}: cannot keep latest versions")
        ans = ans.join(latest_register(src.submission_register).select(*VERSION_KEYS),
                       VERSION_KEYS, "left_semi")
    terms = question_terms(src.terminology)
    return (ans.join(terms, F.col("code") == F.col("_concept"), "left")
            .select("pathway_id", "code", "term", "score", "effective_from"))


def answer_order() -> tuple[str, list[Column]]:
    """Newest first; ties on the date broken by score, then term (K4)."""
    return "effective_from", [F.col("score").asc_nulls_last(), F.col("term").asc_nulls_last()]


def answer_rows(src: Sources, latest_versions_only: bool = False) -> DataFrame:
    """J06's input: distinct (pathway, code, term, score, date) answer rows.

    As in the reference, answers are not limited to latest submission
    versions (K5).  ``latest_versions_only=True`` limits them, for sources
    whose answers carry ``submission_id`` / ``audit_id``.
    """
    rows = answers_with_terms(src, latest_versions_only)
    return rows.distinct()


def latest_answers(src: Sources) -> DataFrame:
    """Distinct answers ranked newest first per pathway x question code."""
    return rank_newest(answers_with_terms(src), ["pathway_id", "code"], *answer_order(), distinct=True)


def newest_answers(src: Sources) -> DataFrame:
    """J06 restricted to rank 1 (what J07 reads), via a per-group limit that
    Spark applies partially before the shuffle.  The order covers every column
    besides the group, so repeated rows need no DISTINCT first."""
    return newest_only(answers_with_terms(src), ["pathway_id", "code"], *answer_order())


QUESTIONNAIRE_BASE_COLUMNS = ["month", "pathway_id", "product", "iet_count", "question", "answer",
                              "comp_flag", *R.GEO_COLUMNS]


def questionnaire_base(src: Sources, window: ReportingWindow, summary: DataFrame,
                       answers: DataFrame) -> DataFrame:
    """Completed pathways of the questionnaire month(s) with their newest answers.

    Month range: ``offset_start .. period_start`` (one month at offset 0).
    Rows equal in every label merge (K16).  No calendar join here (K10).

    ``summary`` (J01) and ``answers`` (answers with their terms, repeats
    included) cover every pathway ever.  Answers are limited to the newest of
    each pathway and code first: the limit runs partially in every map task, so
    a hot pathway is cut to one row per code and task before anything is
    shuffled.  Both are then cut to the pathways of the month(s), which
    changes nothing in the result.
    """
    ref = latest_referrals(src)
    ref = ref.filter(completed_in_period(ref)
                     & F.col("received_date").between(window.first_date, window.period_end)
                     & F.col("period_start").between(window.offset_start, window.period_start))
    ref = with_orgs(ref, src)
    in_scope = ref.select("pathway_id").distinct()
    j01 = (summary.join(in_scope, "pathway_id", "left_semi")
           .select("pathway_id", "product", F.col("n_contacts").alias("iet_count")))
    newest = (newest_only(answers, ["pathway_id", "code"], *answer_order())
              .join(in_scope, "pathway_id")   # distinct; a semi-join would be pushed below the limit
              .select("pathway_id", "code", "score", "term"))   # ranks 1 of J06
    joined = ref.join(j01, "pathway_id", "left").join(newest, "pathway_id", "left")
    return joined.select(
        L.month_key("period_start").alias("month"), "pathway_id",
        L.product_or_default("product").alias("product"), "iet_count",
        L.question_label("term").alias("question"),
        L.answer_label("code", "score").alias("answer"),
        L.outcome_flag(discharged_in_period(), flag(ref, "completed")).alias("comp_flag"),
        *R.GEO_COLUMNS,
    ).distinct()


def questionnaire_dashboard(base: DataFrame, *, fold: bool = False) -> DataFrame:
    """Completed-treatment counts by month x product x question x answer x level x bucket."""
    dims = ["product", "question", "answer"]
    out = level_bucket_rollup(base, "month", dims, [Sum("iet_count"), Sum("comp_flag")], fold=fold)
    return out.select("month", "org_type", "region", "org_name", "org_code", "appointment_type",
                      "iet_count", *dims, "comp_flag")
