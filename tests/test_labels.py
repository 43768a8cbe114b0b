"""One hand-made row per CASE arm of the row-wise derivations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathwise.functions import labels as L
from pathwise.functions import rules as R


def one_col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_canonical_product_every_arm(spark):
    values = ["SilverCloud A", "Slvrcld", "Mnddstrct 1", "Minddistrict X", "iCT-PTSD", "OCD online",
              "ICT upper case", "ocd lower", "Other tool", None, ""]
    assert one_col(spark, values, T.StringType(), L.canonical_product) == [
        "SilverCloud", "SilverCloud", "Minddistrict", "Minddistrict", "iCT", "OCD-NET",
        "ICT upper case", "ocd lower", "Other tool", "No IET", ""]


def test_product_default(spark):
    assert one_col(spark, [None, "x"], T.StringType(), L.product_or_default) == ["No IET", "x"]


def test_end_code_every_code_and_default(spark):
    codes = [c for c, _ in R.END_CODES] + [None, "ZZ", " 50", "50 "]
    got = one_col(spark, codes, T.StringType(), L.end_code_label)
    assert got[:15] == [t for _, t in R.END_CODES]
    # NULL, unknown and padded codes are not matched (exact compare, K7)
    assert got[15:] == [R.END_CODE_DEFAULT] * 4


@pytest.mark.parametrize("score,expected", [
    (None, None), (-1, None), (0, "Minimal Anxiety"), (4, "Minimal Anxiety"), (5, "Mild Anxiety"),
    (9, "Mild Anxiety"), (10, "Moderate Anxiety"), (14, "Moderate Anxiety"), (15, "Severe Anxiety"),
    (99, "Severe Anxiety")])
def test_gad7_band(spark, score, expected):
    assert one_col(spark, [score], T.IntegerType(), L.gad7_band) == [expected]


@pytest.mark.parametrize("score,expected", [
    (None, None), (-1, None), (0, "None-Minimal"), (4, "None-Minimal"), (5, "Mild"), (9, "Mild"),
    (10, "Moderate"), (14, "Moderate"), (15, "Moderate Severe"), (19, "Moderate Severe"),
    (20, "Severe"), (27, "Severe"), (28, None)])
def test_phq9_band(spark, score, expected):
    assert one_col(spark, [score], T.IntegerType(), L.phq9_band) == [expected]


@pytest.mark.parametrize("n,total,expected", [
    (0, 3, "No IET"), (0, 0, None), (2, 2, "Only IET"), (2, 5, "Mixed IET and No IET"),
    (3, 1, None), (None, 4, None), (1, None, None)])
def test_usage_mix(spark, n, total, expected):
    df = spark.createDataFrame([(n, total)], "n bigint, total int")
    assert df.select(L.usage_mix("n", "total")).first()[0] == expected


@pytest.mark.parametrize("minutes,expected", [
    (None, "No Therapist Time Recorded"), (0, "No Therapist Time Recorded"),
    (5, "Therapist Time Recorded"), (-3, None)])
def test_time_recorded(spark, minutes, expected):
    assert one_col(spark, [minutes], T.IntegerType(), L.time_recorded_flag) == [expected]


@pytest.mark.parametrize("rank,expected", [(1, 1), (None, 1), (2, None)])
def test_count_once(spark, rank, expected):
    df = spark.createDataFrame([(rank, 1)], "rank bigint, flag int")
    assert df.select(L.count_once("rank", "flag")).first()[0] == expected


def _problem(spark, hi, pri, lo, sec):
    df = spark.createDataFrame([(hi, pri, lo, sec)], "hi string, pri string, lo string, sec string")
    return df.select(L.problem_label("hi", "pri", "lo", "sec")).first()[0]


def test_problem_top_categories_by_either_source(spark):
    for value, label in R.PROBLEM_TOP:
        assert _problem(spark, value, None, None, None) == label
        assert _problem(spark, None, value, None, None) == label


def test_problem_anxiety_lower_values_in_order(spark):
    anx = R.ANXIETY_TOTAL
    for value, label in R.PROBLEM_ANXIETY:
        assert _problem(spark, anx, None, value, "x") == label
        assert _problem(spark, None, anx, "x", value) == label
    # the first listed lower value wins when both sources name one
    first, last = R.PROBLEM_ANXIETY[0], R.PROBLEM_ANXIETY[-1]
    assert _problem(spark, anx, None, last[0], first[0]) == first[1]


def test_problem_no_code_and_other(spark):
    anx = R.ANXIETY_TOTAL
    assert _problem(spark, anx, None, None, "x") == "No Code"
    assert _problem(spark, anx, None, "x", None) == "No Code"
    assert _problem(spark, anx, None, "x", "y") == "Other"
    assert _problem(spark, None, None, None, None) == "Other"
    # depression beats an anxiety lower value (earlier arm)
    assert _problem(spark, "Depression", anx, R.PROBLEM_ANXIETY[0][0], None) == "F32 or F33 - Depression"


def test_question_labels(spark):
    terms = [t for t, _ in R.QUESTION_TERMS] + [None, "unknown"]
    assert one_col(spark, terms, T.StringType(), L.question_label) == \
        [label for _, label in R.QUESTION_TERMS] + [None, None]


def test_answer_labels_every_family_and_mismatch(spark):
    rows, expected = [], []
    for codes, answers in R.ANSWERS:
        for code in codes:
            for score, label in answers:
                rows.append((code, score))
                expected.append(label)
    rows += [(R.ASSESSMENT_CODES[0], "0"), (R.TREATMENT_CODES[0], "Y"),
             (R.SATISFACTION_CODES[0], "NA"), ("999", "1"), (None, "1"), (R.TREATMENT_CODES[0], None)]
    expected += [None] * 6
    df = spark.createDataFrame(rows, "code string, score string")
    assert [r[0] for r in df.select(L.answer_label("code", "score")).collect()] == expected


def test_wait_days_and_month_key(spark):
    df = spark.createDataFrame([(dt.date(2021, 3, 31), dt.date(2021, 3, 1)),
                                (dt.date(2021, 1, 1), None)], "a date, b date")
    got = df.select(L.wait_days("a", "b").alias("w"), L.month_key("a").alias("m")).collect()
    assert [r.w for r in got] == [-30, None]
    assert [r.m for r in got] == [dt.date(2021, 3, 1), dt.date(2021, 1, 1)]


def test_outcome_flag_null_is_zero(spark):
    df = spark.createDataFrame([(True, True, 1), (True, None, 1), (False, True, 1), (True, True, None)],
                               "disc boolean, done boolean, pathway_id bigint")
    got = [r[0] for r in df.select(L.outcome_flag(F.col("disc"), F.col("done"))).collect()]
    assert got == [1, 0, 0, 0]


def test_truthy_text_flags(spark):
    df = spark.createDataFrame([("True",), ("true ",), ("False",), (None,)], "f string")
    got = [r[0] for r in df.select(L.truthy("f", "string")).collect()]
    assert got == [True, True, False, None]
