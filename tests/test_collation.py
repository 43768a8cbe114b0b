"""Optional SQL-Server-like text comparison."""

from dataclasses import replace

from pyspark.sql import functions as F

from pathwise.functions import labels as L
from pathwise.operators.orgs import resolve_commissioner
from pathwise.plans.refresh import MonthlyRefresh


def test_collated_sources_match_case_and_trailing_blanks(spark, refresh):
    src = refresh.src
    ref = spark.createDataFrame([(1, "c0 ", "ict tool", "50 ")],
                                "pathway_id long, commissioner_id string, product string, end_code string")
    lc = replace(src, referral=ref).with_collation()
    r = lc.referral
    out = resolve_commissioner(r, "commissioner_id", lc.commissioner_succession,
                               lc.commissioner_hierarchy).select(
        "subicb_code", L.canonical_product("product").alias("p"),
        L.end_code_label("end_code").alias("e")).first()
    exact = resolve_commissioner(ref, "commissioner_id", src.commissioner_succession,
                                 src.commissioner_hierarchy).select(
        "subicb_code", L.canonical_product("product").alias("p"),
        L.end_code_label("end_code").alias("e")).first()
    assert exact.subicb_code == "Other" and exact.p == "ict tool" and exact.e == "Missing/invalid"
    assert out.subicb_code != "Other" and out.p == "iCT" and out.e == "Not assessed"


def test_collated_refresh_runs_and_agrees_on_exact_data(spark, refresh):
    # the fixtures' text is already exact, so the dashboards must not change
    r = MonthlyRefresh(refresh.src.with_collation(), first=refresh.first,
                       questionnaire_offset=refresh.questionnaire_offset)
    for name in ("wait_dashboard", "time_recorded_dashboard"):
        a = getattr(refresh, name)
        b = getattr(r, name).select(*[F.col(c).cast("string") if t.startswith("string") else F.col(c)
                                      for c, t in getattr(r, name).dtypes])
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
