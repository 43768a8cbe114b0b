"""A pathway holding most of the contacts: results stay exact, and the
join that meets it is split."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from pathwise.functions import rules as R
from pathwise.operators.skew import heavy_keys, left_join_split
from pathwise.plans.averages import contact_base, contact_minutes_per_pathway

GEO = {g: "g" for g in R.GEO_COLUMNS}


def base_rows(spark):
    rows = [dict(month=dt.date(2021, 3, 1), quarter="Q4 2020", pathway_id=p, iet_count=1,
                 product="A", comp_flag=1, **GEO) for p in range(20)]
    return spark.createDataFrame(rows)


def contact_rows(spark, hot=4000):
    rows = [(0, dt.date(2021, 1, 1) + dt.timedelta(days=i % 300), i % 50, i == 0)
            for i in range(hot)]                                   # pathway 0 is hot
    rows += [(p, dt.date(2021, 2, p), p, True) for p in range(1, 15)]  # 15..19: no contact
    return spark.createDataFrame(rows, "pathway_id long, contact_date date, minutes int, "
                                       "_newest boolean").distinct()


def brute(base, contacts):
    j = base.join(contacts, "pathway_id", "left")
    return j.select("month", "quarter", "pathway_id", "iet_count", "contact_date", "minutes",
                    "product", F.when(F.col("_newest") | F.col("_newest").isNull(),
                                      F.col("comp_flag")).alias("comp_flag"),
                    *R.GEO_COLUMNS).distinct()


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_hot_pathway_contact_base_is_exact(spark):
    b, c = base_rows(spark), contact_rows(spark)
    got = contact_base(b, c, "contact_date")
    assert bag(got) == bag(brute(b, c).select(*got.columns))


def test_hot_pathway_is_split_without_aqe(spark):
    """A pathway with a third of all contacts, AQE off: no join task gets more
    than three times the median's rows."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = [(0, dt.date(2021, 1, 1) + dt.timedelta(days=i % 600), i, False) for i in range(3000)]
        rows += [(p, dt.date(2021, 2, 1), i, False) for p in range(1, 3001) for i in range(2)]
        c = spark.createDataFrame(rows, "pathway_id long, contact_date date, minutes int, _newest boolean")
        b = spark.createDataFrame([dict(month=dt.date(2021, 3, 1), quarter="Q", pathway_id=p, iet_count=1, product="A",
                                        comp_flag=1, **GEO) for p in range(3200)])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = contact_base(b, c, "contact_date")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Join [pathway_id" in plan and "_part" in plan
        per_task = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sum(per_task) == 9000 + 199 and len(per_task) == 16
        assert per_task[-1] <= 3 * per_task[8]
        assert bag(joined) == bag(brute(b, c).select(*joined.columns))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for k, v in old.items():
            spark.conf.set(k, v)


def test_frequent_keys_are_few_and_sized(spark):
    rows = [(k, i) for k, n in ((1, 500), (2, 300), (None, 400), (3, 1)) for i in range(n)] + [(10 + i, 0) for i in range(99)]
    df = spark.createDataFrame(rows, "k long, v int").repartition(4)
    got = {r["k"]: r["_parts"] for r in heavy_keys(df, "k", share=10).collect()}
    assert got == {1: 4, 2: 3}                       # 1,300 rows; over 130 each; parts of about 130
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e"), (None, "f")], "k long, l string")
    right = df.withColumn("m", F.lit(True))
    for share in (10, 4096, 1):
        out = left_join_split(left, right, "k", spread_by=["v"], matched="m", share=share)
        want = left.join(right, "k", "left")
        assert bag(out.select(*want.columns)) == bag(want)
    assert left_join_split(left, right.limit(0), "k", spread_by=["v"], matched="m").count() == 6


def test_hot_pathway_minutes_are_exact(spark):
    c = contact_rows(spark).drop("_newest")
    c = c.withColumn("unique_month_id", F.lit(1).cast("long"))
    got = {r.pathway_id: (r._minutes_sum, r._minutes_n)
           for r in contact_minutes_per_pathway(c, "contact_date").collect()}
    hot = [r for r in c.filter("pathway_id = 0").collect()]
    pairs = {(r.contact_date, r.minutes) for r in hot}
    assert got[0][1] == len(pairs)           # one month id: each pair counts once
