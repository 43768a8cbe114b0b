"""level_bucket_rollup against the reference-shaped union, fold and partitioning."""

import datetime as dt

from pyspark.sql import functions as F

from pathwise.functions import rules as R
from pathwise.operators.rollup import Avg, Count, Sum, level_bucket_rollup, unrolled_rollup
from pathwise.plans import outcomes as O


def _rows(df):
    from collections import Counter

    return Counter(tuple(r) for r in df.collect())


def test_matches_unrolled_union(base):
    measures = [Sum("iet_count"), *[Sum(f) for f in O.OUTCOME_FLAGS]]
    got = level_bucket_rollup(base, "month", O.OUTCOME_DIMS, measures)
    want = unrolled_rollup(base, "month", O.OUTCOME_DIMS, measures)
    assert _rows(got) == _rows(want.select(*got.columns))


def test_fold_is_exact(base):
    measures = [Avg("a1", "wait_ref_to_assess"), Avg("a2", "iet_minutes"), Sum("comp_flag"),
                Count("n", "first_therapy_date")]
    plain = level_bucket_rollup(base, "quarter", ["product"], measures)
    folded = level_bucket_rollup(base, "quarter", ["product"], measures, fold=True)
    assert _rows(plain) == _rows(folded)


def test_no_buckets_matches_unrolled(base):
    measures = [Count("n", "pathway_id")]
    got = level_bucket_rollup(base, "month", ["product"], measures, bucket_col=None)
    want = unrolled_rollup(base, "month", ["product"], measures, bucket_col=None)
    assert _rows(got) == _rows(want.select(*got.columns))


def test_partitioning_does_not_change_results(base):
    measures = [Avg("a", "wait_ref_to_therapy"), Sum("comp_flag")]
    a = level_bucket_rollup(base.repartition(1), "quarter", [], measures)
    b = level_bucket_rollup(base.repartition(13, "pathway_id"), "quarter", [], measures)
    assert _rows(a) == _rows(b)


def test_buckets_overlap_and_null(spark):
    geo = {g: "g" for g in R.GEO_COLUMNS}
    rows = [dict(t=1, n=n, v=1, **geo) for n in (None, 0, 1, 2, 3, -1)]
    df = spark.createDataFrame(rows)
    out = level_bucket_rollup(df, "t", [], [Sum("v")], bucket_col="n").filter(
        F.col("org_type") == "National")
    got = {r.appointment_type: r.v for r in out.collect()}
    # NULL and 0 -> none; 1,2,3 -> 1+; 2,3 -> 2+; a negative count falls in no bucket
    assert got == {R.BUCKET_NONE: 2, R.BUCKET_ONE: 3, R.BUCKET_TWO: 2}


def test_average_is_null_without_values_and_exact(spark):
    geo = {g: "g" for g in R.GEO_COLUMNS}
    df = spark.createDataFrame([dict(t=dt.date(2020, 1, 1), n=1, x=None, **geo),
                                dict(t=dt.date(2020, 1, 1), n=1, x=None, **geo),
                                dict(t=dt.date(2020, 1, 2), n=1, x=1, **geo),
                                dict(t=dt.date(2020, 1, 2), n=1, x=2, **geo),
                                dict(t=dt.date(2020, 1, 2), n=1, x=None, **geo)],
                               "t date, n bigint, x int, " + ", ".join(f"{g} string" for g in geo))
    out = level_bucket_rollup(df, "t", [], [Avg("avg_x", "x")], bucket_col="n").filter(
        (F.col("org_type") == "National") & (F.col("appointment_type") == R.BUCKET_ONE))
    got = {r.t: r.avg_x for r in out.collect()}
    assert got == {dt.date(2020, 1, 1): None, dt.date(2020, 1, 2): 1.5}


def grouping_sets_rollup(df, time, dims, sums):
    """Second implementation: Spark's GROUPING SETS over the five
    levels' keys, the level read back from grouping_id(), buckets folded in by
    a second aggregation over bucket classes."""
    n = F.col("iet_count")
    level_keys = [[], ["region_name_comm", "region_code_comm"],
                  ["region_name_comm", "icb_name", "icb_code"],
                  ["region_name_comm", "subicb_name", "subicb_code"],
                  ["region_name_prov", "provider_name", "provider_code"]]
    geo = ["region_name_comm", "region_code_comm", "icb_name", "icb_code", "subicb_name",
           "subicb_code", "region_name_prov", "provider_name", "provider_code"]
    keys = [time, *dims, "_b"]
    d = df.withColumn("_b", F.when(n >= 2, 2).when(n >= 1, 1).when(n.isNull() | (n == 0), 0))
    sets = [[F.col(c) for c in keys + lk] for lk in level_keys]
    agg = (d.groupingSets(sets, *[F.col(c) for c in keys + geo])
           .agg(F.grouping_id().alias("_gid"), *[F.sum(c).alias(c) for c in sums]))
    # grouping_id bit i (from the right) is set when geo[-1 - i] is not grouped
    def grouped(c):
        return F.shiftright(F.col("_gid"), len(geo) - 1 - geo.index(c)).bitwiseAND(1) == 0
    lvl = (F.when(grouped("provider_code"), "Provider").when(grouped("subicb_code"), "Sub-ICB")
           .when(grouped("icb_code"), "ICB").when(grouped("region_code_comm"), "Region")
           .otherwise("National"))
    pick = {
        "region": {"National": F.lit("All Regions"), "Provider": F.col("region_name_prov")},
        "org_name": {"National": F.lit("England"), "Region": F.col("region_name_comm"),
                     "ICB": F.col("icb_name"), "Sub-ICB": F.col("subicb_name"),
                     "Provider": F.col("provider_name")},
        "org_code": {"National": F.lit("ENG"), "Region": F.col("region_code_comm"),
                     "ICB": F.col("icb_code"), "Sub-ICB": F.col("subicb_code"),
                     "Provider": F.col("provider_code")},
    }

    def col_for(name):
        expr = None
        for level, value in pick[name].items():
            expr = F.when(lvl == level, value) if expr is None else expr.when(lvl == level, value)
        return expr.otherwise(F.col("region_name_comm")) if name == "region" else expr

    out = agg.select(time, *dims, "_b", *sums, lvl.alias("org_type"),
                     *[col_for(c).alias(c) for c in ("region", "org_name", "org_code")])
    b = F.col("_b")
    labels = F.array_compact(F.array(F.when(b >= 1, F.lit(R.BUCKET_ONE)),
                                     F.when(b >= 2, F.lit(R.BUCKET_TWO)),
                                     F.when(b == 0, F.lit(R.BUCKET_NONE))))
    return (out.select("*", F.explode(labels).alias("appointment_type"))
            .groupBy(time, "org_type", "region", "org_name", "org_code", "appointment_type", *dims)
            .agg(*[F.sum(c).alias(c) for c in sums]))


def test_matches_grouping_sets(base):
    sums = ["iet_count", "comp_flag", "rec_flag"]
    got = level_bucket_rollup(base, "month", ["product", "problem"], [Sum(c) for c in sums])
    want = grouping_sets_rollup(base, "month", ["product", "problem"], sums)
    assert _rows(got) == _rows(want.select(*got.columns))
