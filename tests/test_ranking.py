"""Ranking by prefix counts equals the window ranking, including a hot group."""

import datetime as dt
import random
from collections import Counter
from functools import partial

from pyspark.sql import functions as F

from pathwise.operators.ranking import newest_only, rank_newest
from pathwise.operators.skew import frequent_buckets, split_frequent
from pathwise.plans import averages as V


def order():
    return "d", [F.col("m").desc_nulls_last(), F.col("k").asc_nulls_last()]


def rows(n_groups=40, hot=600, seed=3):
    rnd = random.Random(seed)
    out = set()
    for g in range(n_groups):
        for _ in range(rnd.randint(1, 8)):
            out.add((g, rnd.choice([None, dt.date(2021, 1, rnd.randint(1, 9))]),
                     rnd.choice([None, 1, 2, 3]), rnd.randint(0, 50)))
    # one group holding most of the rows, plus a NULL group
    for i in range(hot):
        out.add((999, dt.date(2021, 2, 1 + i % 20), i % 7, i))
    out.add((None, None, None, 1))
    out.add((None, dt.date(2021, 1, 1), 2, 2))
    return sorted(out, key=str)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_counted_rank_equals_window_rank(spark):
    df = spark.createDataFrame(rows(), "g long, d date, m int, k long").repartition(7)
    a = rank_newest(df, ["g"], *order(), method="window")
    b = rank_newest(df, ["g"], *order())
    assert bag(a) == bag(b)
    ranks = sorted(r[0] for r in b.filter(F.col("g") == 999).select("latest_rank").collect())
    assert ranks == list(range(1, 601))
    assert rank_newest(df.limit(0), ["g"], *order()).collect() == []


def test_counted_rank_spreads_a_hot_group(spark):
    """No task of the plan gets the hot group: rows meet by (group, date), and a
    group's dates are counted before they meet."""
    df = spark.createDataFrame(rows(hot=3000), "g long, d date, m int, k long")
    ranked = rank_newest(df, ["g"], *order())
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "monotonically_increasing_id" not in plan
    per_date = df.filter("g = 999").groupBy("d").count().agg(F.max("count")).first()[0]
    assert per_date == 150
    window_rows = df.filter("g = 999").select("g", "d").distinct().count()
    assert window_rows == 20
    assert ranked.filter(F.col("g") == 999).agg(F.max("latest_rank")).first()[0] == 3000


def test_building_the_ranking_runs_nothing(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), F.lit(1).alias("m"), F.col("id").alias("k"),
                                F.raise_error(F.lit("ran")).cast("date").alias("d"))
    rank_newest(df, ["g"], *order())


def test_newest_agrees_with_rank(spark):
    df = spark.createDataFrame(rows(), "g long, d date, m int, k long")
    ranked = rank_newest(df, ["g"], *order(), method="window")
    top = newest_only(df, ["g"], *order()).drop("latest_rank")
    assert bag(top) == bag(ranked.filter("latest_rank = 1").drop("latest_rank"))


def test_few_and_many_rows_of_a_group_rank_alike(spark):
    """Repeated rows, null groups and dates, a hot group; groups by the window, by counts and both."""
    some = rows(hot=300)
    df = spark.createDataFrame(some + some[::3] + some[:40], "g long, d date, m int, k long").repartition(5)
    want = bag(rank_newest(df.distinct(), ["g"], *order(), method="window"))
    assert want == bag(rank_newest(df, ["g"], *order(), method="window", distinct=True))
    for share in (1, 10, 100, 4096):
        assert bag(rank_newest(df, ["g"], *order(), distinct=True, share=share)) == want
        assert bag(rank_newest(df.distinct(), ["g"], *order(), share=share)) == want


def test_frequent_groups_are_found_whatever_they_share_a_bucket_with(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, F.lit(None)).when(F.col("id") < 2700, 7)
                                  .otherwise(F.col("id")).cast("long").alias("g"))
    few, many = split_frequent(df, ["g"], frequent_buckets(df, ["g"], 10))
    assert many.filter("g is null").count() == 2000 and many.filter("g = 7").count() == 700
    assert few.count() + many.count() == 3000 and many.count() < 2710
    assert frequent_buckets(df.limit(0), ["g"], 10).count() == 0


def shuffles(df) -> list[str]:
    """Exchanges by hash that ran."""
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in ran.splitlines() if " Exchange hashpartitioning" in line]


def test_all_contacts_are_shuffled_once_after_their_join(spark, refresh, monkeypatch):
    """Without a frequent pathway, what the join gives is dealt once, by pathway: no exchange by
    date but the one that makes the contacts distinct before the join."""
    monkeypatch.setattr(V, "frequent_buckets", partial(frequent_buckets, share=10), raising=False)
    ran = shuffles(V.all_contacts(refresh.src))
    assert [x for x in ran if "contact_date" in x and "audit_id" not in x] == []
    assert len([x for x in ran if "(pathway_id" in x and "," not in x.split("(pathway_id")[1].split(", 8)")[0]]) == 1


def test_all_contacts_are_the_same_with_any_split(spark, refresh, monkeypatch):
    want = bag(rank_newest(V.contact_activity_pairs(refresh.src), ["pathway_id"], *V.any_order(), method="window"))
    for share in (10, 3000, 10 ** 9):
        monkeypatch.setattr(V, "frequent_buckets", partial(frequent_buckets, share=share))
        assert bag(V.all_contacts(refresh.src)) == want
