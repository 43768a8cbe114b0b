"""Per-pathway contact minutes (J15/J18 path) against brute force on hand-made ties."""

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from pathwise.operators.ranking import rank_newest
from pathwise.operators.rollup import AVG_TYPE
from pathwise.plans.averages import contact_minutes_per_pathway

D = [None, dt.date(2021, 1, 1), dt.date(2021, 1, 2)]
M = [None, 0, 5, 7]


def brute(rows, date_col, order):
    """The reference's way: rank, DISTINCT (date, minutes, rank=1), then sum / count."""
    ranked = rank_newest(rows, ["pathway_id"], *order)
    keys = ranked.select("pathway_id", date_col, "minutes",
                         (F.col("latest_rank") == 1).alias("newest")).distinct()
    return keys.groupBy("pathway_id").agg(
        F.sum(F.col("minutes").cast(AVG_TYPE)).alias("_minutes_sum"),
        F.count("minutes").alias("_minutes_n"))


def as_dict(df):
    return {r.pathway_id: (r._minutes_sum, r._minutes_n) for r in df.collect()}


def test_any_contacts_shape(spark):
    rnd = random.Random(7)
    rows = set()
    for p in range(60):
        for _ in range(rnd.randint(1, 6)):
            rows.add((p, rnd.choice(D), rnd.choice(M), rnd.choice([1, 2, 3])))
    df = spark.createDataFrame(sorted(rows, key=str),
                               "pathway_id long, contact_date date, minutes int, unique_month_id long")
    order = ("contact_date", [F.col("minutes").desc_nulls_last(),
             F.col("unique_month_id").asc_nulls_last()])
    assert as_dict(contact_minutes_per_pathway(df, "contact_date")) == as_dict(
        brute(df, "contact_date", order))


def test_digital_contacts_shape(spark):
    rnd = random.Random(11)
    rows = set()
    for p in range(80):
        for _ in range(rnd.randint(1, 7)):
            rows.add((p, rnd.choice(D), rnd.choice(D), rnd.choice(M), rnd.choice([1, 2]),
                      rnd.choice(["A", "B", None])))
    df = spark.createDataFrame(
        sorted(rows, key=str),
        "pathway_id long, start_date date, end_date date, minutes int, unique_month_id long, "
        "product string")
    order = ("start_date", [F.col("end_date").desc_nulls_last(),
             F.col("minutes").desc_nulls_last(), F.col("product").asc_nulls_last(),
             F.col("unique_month_id").asc_nulls_last()])
    got = contact_minutes_per_pathway(df, "start_date", ("end_date",))
    assert as_dict(got) == as_dict(brute(df, "start_date", order))


def test_every_small_case_exhaustively(spark):
    # all pathways of two rows over a small domain, incl. duplicate newest pairs
    values = list(itertools.product(D[:2], M[:3], [1, 2]))
    rows, p = [], 0
    for a, b in itertools.combinations(values, 2):
        rows += [(p, *a), (p, *b)]
        p += 1
    df = spark.createDataFrame(rows, "pathway_id long, contact_date date, minutes int, "
                                     "unique_month_id long")
    order = ("contact_date", [F.col("minutes").desc_nulls_last(),
             F.col("unique_month_id").asc_nulls_last()])
    assert as_dict(contact_minutes_per_pathway(df, "contact_date")) == as_dict(
        brute(df, "contact_date", order))


def test_contact_keys_equal_ranked_keys(spark):
    from pathwise.plans.averages import contact_keys

    def ranked_keys(df, order, date_col):
        return rank_newest(df, ["pathway_id"], *order).select(
            "pathway_id", date_col, "minutes", (F.col("latest_rank") == 1).alias("_newest")).distinct()

    def bag(df):
        from collections import Counter

        return Counter(tuple(r) for r in df.select("pathway_id", df.columns[1], "minutes",
                                                    "_newest").collect())

    rnd = random.Random(5)
    any_rows = set()
    dig_rows = set()
    for p in range(70):
        for _ in range(rnd.randint(1, 6)):
            any_rows.add((p, rnd.choice(D), rnd.choice(M), rnd.choice([1, 2, 3])))
            dig_rows.add((p, rnd.choice(D), rnd.choice(D), rnd.choice(M), rnd.choice([1, 2]),
                          rnd.choice(["A", None])))
    a = spark.createDataFrame(sorted(any_rows, key=str), "pathway_id long, contact_date date, "
                                                         "minutes int, unique_month_id long")
    order = ("contact_date", [F.col("minutes").desc_nulls_last(),
             F.col("unique_month_id").asc_nulls_last()])
    want = ranked_keys(a, order, "contact_date")
    assert bag(contact_keys(a, "contact_date")) == bag(want)

    d = spark.createDataFrame(sorted(dig_rows, key=str),
                              "pathway_id long, start_date date, end_date date, minutes int, "
                              "unique_month_id long, product string")
    order = ("start_date", [F.col("end_date").desc_nulls_last(),
             F.col("minutes").desc_nulls_last(), F.col("product").asc_nulls_last(),
             F.col("unique_month_id").asc_nulls_last()])
    want = ranked_keys(d, order, "start_date")
    assert bag(contact_keys(d, "start_date", ("end_date",))) == bag(want)


def test_packed_order_sorts_like_the_struct_order(spark):
    from pathwise.plans.averages import _newest_order, _packed_order

    dates = [None, dt.date(1, 1, 1), dt.date(1, 1, 2), dt.date(1970, 1, 1), dt.date(9999, 12, 31)]
    mins = [None, -2 ** 31, -1, 0, 1, 2 ** 31 - 1]
    df = spark.createDataFrame(list(itertools.product(dates, mins)),
                               "contact_date date, minutes int")
    packed = [tuple(r) for r in df.orderBy(_packed_order("contact_date").desc()).collect()]
    struct = [tuple(r) for r in df.orderBy(_newest_order("contact_date", ()).desc()).collect()]
    assert packed == struct
