"""Hand-built mini world: one row per behaviour SURVEY §8 says to keep.

Each source table has a few literal rows, so every expectation below is
worked out by hand from the reference's rules, independently of the oracle.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pathwise.plans.refresh import MonthlyRefresh
from pathwise.sources.tables import Sources

D = dt.date
REG = "submission_id long, audit_id int, is_latest int, period_start date, period_end date"
REF = ("pathway_id long, submission_id long, audit_id int, unique_month_id long, "
       "received_date date, first_assessment_date date, first_therapy_date date, "
       "second_therapy_date date, discharge_date date, completed boolean, recovered boolean, "
       "not_case boolean, improved boolean, usable boolean, end_code string, "
       "higher_category string, primary_complaint string, lower_category string, "
       "second_complaint string, anxiety_score int, depression_score int, contact_count int, "
       "old_iet_count int, commissioner_id string, provider_id string")
LOG = ("pathway_id long, log_id long, submission_id long, audit_id int, unique_month_id long, "
       "product string, integrated string, minutes int, start_date date, end_date date")


def referral(pid, sub, *, comm="C1", prov="P1", completed=True, usable=True,
             discharge=D(2021, 3, 15), minutes_flags=(True, False, True)):
    rec, nc, imp = minutes_flags
    return (pid, sub, 2, pid * 1000 + 1, D(2021, 1, 5), D(2021, 1, 10), D(2021, 1, 20),
            D(2021, 2, 1), discharge, completed, rec, nc, imp, usable, "46", "Depression",
            None, None, None, 7, 12, 3, 0, comm, prov)


@pytest.fixture(scope="module")
def world(spark):
    c = spark.createDataFrame
    register = c([
        (202103, 2, 1, D(2021, 3, 1), D(2021, 3, 31)),     # the month reported
        (202103, 1, 0, D(2021, 3, 1), D(2021, 3, 31)),     # superseded version
        (202104, 2, 1, D(2021, 4, 1), D(2021, 4, 30)),     # next month: sets the window
        (202102, 2, 1, D(2021, 2, 1), D(2021, 2, 28)),     # no calendar row (K10)
    ], REG)
    ref = c([
        referral(1, 202103),                                # two products -> two rows (K1)
        referral(2, 202103, comm="C9"),                     # C9 -> C8 -> C7: one hop only (K12)
        referral(3, 202103, prov="P5"),                     # provider row is closed -> Other
        referral(4, 202103, completed=False),               # not completed -> out
        referral(5, 202102),                                # month without a calendar row
        referral(6, 202103, usable=False),                  # not usable -> out
        referral(7, 202103, discharge=D(2021, 4, 2)),       # discharged after the period -> out
    ], REF)
    ref = ref.unionByName(c([(8, 202103, 1, 8001, D(2021, 1, 5), None, None, None,
                              D(2021, 3, 15), True, True, True, True, True, "46", "Depression",
                              None, None, None, 1, 1, 1, 0, "C1", "P1")], REF))  # old version -> out
    log = c([
        (1, 11, 202103, 2, 1001, "SilverCloud X", "Y", 30, D(2021, 3, 2), D(2021, 3, 3)),
        (1, 12, 202103, 2, 1001, "iCT-PTSD", "N", 20, D(2021, 3, 5), D(2021, 3, 6)),
        (1, 13, 202103, 2, 1001, "iCT-PTSD", "N", 25, D(2021, 3, 7), D(2021, 4, 9)),  # ends late
        (2, 21, 202103, 1, 2001, "OCD tool", "Y", 15, D(2021, 3, 2), D(2021, 3, 3)),   # old version
    ], LOG)
    sources = Sources(
        referral=ref, digital_log=log,
        care_contact=c([(1, 202103, 2, 1001, D(2021, 3, 2))],
                       "pathway_id long, submission_id long, audit_id int, unique_month_id long, "
                       "contact_date date"),
        care_activity=c([(1, 202103, 2, 45), (1, 202103, 2, 5)],
                        "pathway_id long, submission_id long, audit_id int, minutes int"),
        assessment=c([], "pathway_id long, code string, score string, effective_from date"),
        terminology=c([], "concept_id long, term string, type_id long, is_latest int, active int"),
        submission_register=register,
        commissioner_succession=c([("C9", "C8"), ("C8", "C7")], "old_code string, new_code string"),
        commissioner_hierarchy=c([
            ("C1", "Sub one", "I1", "ICB one", "R1", "Region one", None),
            ("C8", "Sub eight", "I8", "ICB eight", "R1", "Region one", None),
            ("C7", "Sub seven", "I7", "ICB seven", "R1", "Region one", None),
        ], "org_code string, org_name string, icb_code string, icb_name string, "
           "region_code string, region_name string, effective_to date"),
        provider_succession=c([], "old_code string, new_code string"),
        provider_hierarchy=c([("P1", "Prov one", "Region one", None),
                              ("P5", "Prov five", "Region one", D(2000, 1, 1))],
                             "org_code string, org_name string, region_name string, effective_to date"),
        calendar=c([(D(2021, 3, 1), "Q4 2020"), (D(2021, 4, 1), "Q1 2021")],
                   "full_date date, quarter string"),
    )
    return MonthlyRefresh(sources, first="2020-09-01")


def test_base_rows_and_filters(world):
    rows = world.pathway_base.select("pathway_id", "product").collect()
    got = sorted((r.pathway_id, r.product) for r in rows)
    # 1 fans out to its two products; 2 and 3 have no log -> 'No IET';
    # 4 (not completed), 5 (no calendar row), 6 (not usable), 7 (late discharge),
    # 8 (superseded version) are out
    assert got == [(1, "SilverCloud"), (1, "iCT"), (2, "No IET"), (3, "No IET")]


def test_digital_summary_counts_in_period_contacts_of_latest_versions(world):
    got = {(r.pathway_id, r.product): (r.minutes, r.n_contacts)
           for r in world.digital_summary.collect()}
    # the late-ending iCT contact adds minutes but is not counted; pathway 2's
    # log is a superseded version
    assert got == {(1, "SilverCloud"): (30, 1), (1, "iCT"): (45, 1)}


def test_succession_is_one_hop_and_closed_rows_are_other(world):
    geo = {r.pathway_id: r for r in world.pathway_base.collect()}
    assert geo[2].subicb_code == "C8"              # C9 -> C8, not on to C7
    assert geo[1].subicb_name == "Sub one" and geo[1].region_name_comm == "Region one"
    assert geo[3].provider_code == "Other"         # P5's only row is closed
    assert geo[3].region_name_prov == "Other"


def test_fan_out_counts_a_pathway_once_per_product(world):
    d = world.outcome_dashboard.filter((F.col("org_type") == "National")
                                       & (F.col("appointment_type") == "1+ IET"))
    assert d.agg(F.sum("comp_flag")).first()[0] == 2     # pathway 1, twice
    none = world.outcome_dashboard.filter((F.col("org_type") == "National")
                                          & (F.col("appointment_type") == "No IET"))
    # none bucket: pathways without any log row sum their (NULL) count to NULL (K6)
    assert none.agg(F.sum("comp_flag")).first()[0] == 2
    assert [r.iet_count for r in none.collect()] == [None]


def test_averages_and_contact_dashboards(world):
    w = world.wait_dashboard.filter((F.col("org_type") == "National")
                                    & (F.col("appointment_type") == "1+ IET")).first()
    assert w.avg_wait_ref_to_assess == 5.0 and w.avg_wait_first_to_second == 12.0
    t = {r.product: r for r in world.treatment_dashboard.filter(
        (F.col("org_type") == "National") & (F.col("appointment_type") == "1+ IET")).collect()}
    assert t["iCT"].avg_iet_minutes == 45.0 and t["iCT"].avg_any_minutes == 50.0
    a = {r.product: r for r in world.any_time_dashboard.filter(
        (F.col("org_type") == "National") & (F.col("appointment_type") == "1+ IET")).collect()}
    # pathway 1 has one contact and two activity rows (45, 5): average 25
    assert a["iCT"].avg_any_minutes == 25.0 and a["iCT"].comp_flag == 1


def test_decimal_overflow_fails_like_the_reference(world, spark):
    from pyspark.errors import ArithmeticException

    from pathwise.operators.rollup import Avg, level_bucket_rollup

    big = world.pathway_base.withColumn("iet_minutes", F.lit(100000))
    with pytest.raises(ArithmeticException):
        level_bucket_rollup(big, "quarter", [], [Avg("a", "iet_minutes")]).collect()


def test_answers_latest_versions_option(spark, world):
    from dataclasses import replace

    from pathwise.functions import rules as R
    from pathwise.plans import questionnaire as Q

    code = R.TREATMENT_CODES[0]
    ans = spark.createDataFrame(
        [(1, code, "4", D(2021, 3, 9), 202103, 2),      # latest version
         (1, code, "0", D(2021, 3, 20), 202103, 1)],    # superseded, newer date
        "pathway_id long, code string, score string, effective_from date, "
        "submission_id long, audit_id int")
    src = replace(world.src, assessment=ans)
    # default (as the reference): the superseded, newer answer wins
    top = Q.newest_only(Q.answer_rows(src), ["pathway_id", "code"], *Q.answer_order()).first()
    assert top.score == "0"
    # with the option, only the latest version's answer is left
    top = Q.newest_only(Q.answer_rows(src, True), ["pathway_id", "code"],
                        *Q.answer_order()).first()
    assert top.score == "4"
    with pytest.raises(ValueError):
        Q.answer_rows(world.src, True)      # no version keys on these answers
