"""Frequent pathways counted in the contact rows (J14, J17); other pathways worked out where they lie."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pathwise.functions import rules as R
from pathwise.operators.skew import left_join_split
from pathwise.plans import averages as V


@pytest.mark.parametrize("job", ["any_contact_base", "digital_contact_base"])
def test_frequent_pathways_are_counted_in_the_contact_rows(spark, refresh, job):
    """J14 and J17 build their contact keys once: counting the frequent pathways
    in the contact rows takes fewer exchanges."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows, date, between = ((refresh.all_contact_rows, "contact_date", ()) if job == "any_contact_base"
                               else (refresh.digital_contact_rows, "start_date", V.DIGITAL_BETWEEN))
        base = refresh.pathway_base.select(*V.BASE_PROJECTION)
        twice = V.contact_base(base, V.contact_keys(rows, date, between), date)
        once = getattr(V, job)(base, rows)
        shuffles = [df._jdf.queryExecution().executedPlan().toString().count(" Exchange hashpartitioning")
                    for df in (once, twice)]
        assert shuffles[0] < shuffles[1]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_keys_counted_elsewhere_lose_no_row(spark):
    """Frequent keys by other rows than those joined: repeated, few of many, null."""
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e"), (None, "f")], "k long, l string")
    right = spark.createDataFrame([(k, i, True) for k, n in ((1, 40), (2, 1), (None, 9), (3, 3)) for i in range(n)],
                                  "k long, v int, m boolean")
    counted = right.unionByName(right.filter("k = 2").withColumn("v", F.explode(F.sequence(F.lit(1), F.lit(50)))))
    want = left.join(right, "k", "left")
    got = left_join_split(left, right, "k", spread_by=["v"], matched="m", counted=counted, share=10).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def contact_sources(spark, hot=0, pathways=300):
    """Base, sources and base pathways: repeats, NULLs in every key, superseded
    versions, contacts without activities, pathway 0 with ``hot`` contacts."""
    rnd = random.Random(5)
    day = lambda: rnd.choice([None, *(dt.date(2021, 1, d) for d in range(1, 6))])
    version = lambda: rnd.choice([(1, 1), (2, 2), (3, 1), (None, 1), (2, None)])
    ids = [*range(pathways), None] * 6
    con = [(p, *version(), day(), rnd.choice([None, 7, 8])) for p in ids]
    con += [(0, 2, 2, dt.date(2000, 1, 1) + dt.timedelta(days=i), 7) for i in range(hot)]
    act = [(p, *version(), rnd.choice([None, 0, 15, 30])) for p in ids if p is None or p % 5]
    act += [(0, 2, 2, m) for m in range(3)]
    register = [(1, 1, 1), (2, 2, 1), (3, 1, 0)]
    src = SimpleNamespace(
        care_contact=spark.createDataFrame(con * 2, "pathway_id long, submission_id long, audit_id int, "
                                                    "contact_date date, unique_month_id long"),
        care_activity=spark.createDataFrame(act * 2, "pathway_id long, submission_id long, audit_id int, minutes int"),
        submission_register=spark.createDataFrame(
            [(*r, dt.date(2021, 1, 1), dt.date(2021, 1, 31)) for r in register],
            "submission_id long, audit_id int, is_latest int, period_start date, period_end date"))
    base = spark.createDataFrame(
        [(dt.date(2021, 3, 1), "Q", p, p % 3, product, p % 2, *["g"] * len(R.GEO_COLUMNS))
         for p in range(0, pathways + 20, 2) for product in ("A", "B", "B")],
        "month date, quarter string, pathway_id long, iet_count long, product string, comp_flag int, "
        + ", ".join(f"{c} string" for c in R.GEO_COLUMNS))
    return base, src, base.select("pathway_id").distinct()


@pytest.mark.parametrize("hot", [0, 4000])
def test_contacts_by_pathway_give_the_same_rows(spark, hot):
    base, src, pathways = contact_sources(spark, hot, pathways=300 if hot else 9000)
    got = V.any_contact_base_split(base, src, pathways)
    want = V.any_contact_base(base, V.contact_activity_pairs(src))
    assert got.dtypes == want.dtypes and got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_pairs_of_contacts_and_activities_are_not_shuffled(spark):
    """Nothing is dealt out above the pairs of the pathways that are not frequent."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        plan = V.any_contact_base_split(*contact_sources(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    lines = plan.split("\n")
    depth = [len(x) - len(x.lstrip(" :+-|*")) for x in lines]
    at = [i for i, x in enumerate(lines) if "Generate explode(_minutes" in x]
    assert len(at) == 1
    above, now = [], depth[at[0]]
    for i in range(at[0] - 1, -1, -1):
        if depth[i] < now:
            now = depth[i]
            above.append(lines[i])
    assert any("Window" in x for x in above) and not any("Exchange" in x for x in above)
