"""Invariants that follow from the reference's code."""

from pyspark.sql import functions as F

from pathwise.functions import rules as R
from pathwise.plans import averages as V
from pathwise.plans import outcomes as O


def _by(df, keys, measure):
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*keys).agg(F.sum(measure)).collect()}


def test_buckets_partition_and_nest(base):
    d = O.wait_dashboard(base)
    one = _by(d.filter(F.col("appointment_type") == R.BUCKET_ONE), ["quarter", "org_type"], "comp_flag")
    two = _by(d.filter(F.col("appointment_type") == R.BUCKET_TWO), ["quarter", "org_type"], "comp_flag")
    none = _by(d.filter(F.col("appointment_type") == R.BUCKET_NONE), ["quarter", "org_type"], "comp_flag")
    total = {(r[0],): r[1] for r in base.groupBy("quarter").agg(F.sum("comp_flag")).collect()}
    for (quarter, level), v in one.items():
        # (i) 1+ and none partition the base, at every level; 2+ within 1+
        assert v + none.get((quarter, level), 0) == total[(quarter,)]
        assert two.get((quarter, level), 0) <= v


def test_levels_sum_to_national(base):
    # (ii) every level groups the same rows: level sums equal National's
    d = O.outcome_dashboard(base)
    sums = _by(d, ["org_type", "appointment_type"], "rec_flag")
    for (level, bucket), v in sums.items():
        assert v == sums[("National", bucket)], (level, bucket)


def test_comp_flag_counts_every_base_row(base):
    # (iii) the completed flag is 1 on every base row (WHERE repeats its test)
    assert base.filter(F.col("comp_flag") != 1).count() == 0
    d = O.wait_dashboard(base).filter(F.col("org_type") == "National")
    got = d.filter(F.col("appointment_type") != R.BUCKET_TWO).agg(F.sum("comp_flag")).first()[0]
    assert got == base.count()


def test_count_once_flags_each_base_row_once(base, refresh):
    # (iv) J15 / J18: flag sum over 1+ and none = distinct projected base rows
    n = base.select(*V.BASE_PROJECTION).distinct().count()
    for dash in (refresh.digital_time_dashboard, refresh.any_time_dashboard):
        d = dash.filter((F.col("org_type") == "National")
                        & (F.col("appointment_type") != R.BUCKET_TWO))
        assert d.agg(F.sum("comp_flag")).first()[0] == n


def test_contact_base_flag_once_per_projected_row(refresh):
    jb = refresh.digital_contact_base
    flagged = jb.filter(F.col("comp_flag").isNotNull())
    keys = ["month", "quarter", "pathway_id", "iet_count", "product", *R.GEO_COLUMNS]
    assert flagged.count() == flagged.select(*keys).distinct().count()
    assert jb.count() == jb.distinct().count()  # already distinct without a final DISTINCT


def test_reference_duplicates_reports_fanout_keys(spark, refresh):
    from dataclasses import replace

    from pathwise.operators.checks import reference_duplicates

    src = refresh.src
    found = {(r.table_name, r.key, r.n_rows) for r in reference_duplicates(src).collect()}
    assert found == {("commissioner_succession", "C10", 2), ("provider_hierarchy", "P7", 2)}   # the fixtures' own
    doubled = replace(src, provider_succession=src.provider_succession.unionByName(
        src.provider_succession))
    got = {(r.table_name, r.n_rows) for r in reference_duplicates(doubled).collect()}
    assert got == {("provider_succession", 2), ("commissioner_succession", 2), ("provider_hierarchy", 2)}
