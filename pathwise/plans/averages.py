"""Per-contact averages: contact bases and their dashboards.

The reference joins every base row to every contact of its pathway, takes
DISTINCT, and averages over that fan-out.  Both families here start from the
same two partial aggregations of the distinct contact rows: per (pathway,
date, minutes) pair, and per pathway (its newest pair, by ``max_by``), so
no contact is ranked and no task holds a whole pathway.

* The contact bases (J14, J17) expand the pairs into the distinct (date,
  minutes, newest?) keys the reference's DISTINCT keeps, and join them to
  the de-duplicated base projection, very frequent pathways split: the output
  is already distinct.  From the sources (J17), pathways that are not frequent
  are dealt once and worked out where they lie (``any_contact_base_split``).
* The dashboards (J15, J18) never build the fan-out: a base row contributes
  (sum of minutes, count of minutes) over its pathway's keys, aggregated per
  pathway and joined 1:1 to the base.  Sums and counts add exactly, so the
  averages are unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathwise.functions import rules as R
from pathwise.operators.ranking import rank_newest, rank_split
from pathwise.operators.rollup import AVG_TYPE, AvgOfParts, Sum, level_bucket_rollup
from pathwise.operators.skew import frequent_buckets, left_join_split, split_frequent
from pathwise.operators.versions import VERSION_KEYS, latest_only, latest_register
from pathwise.sources.tables import Sources

DIGITAL_BETWEEN = ("end_date",)   # J09 orders by start, end, minutes, ...

BASE_PROJECTION = ["month", "quarter", "pathway_id", "iet_count", "product", "comp_flag",
                   *R.GEO_COLUMNS]


def _base_projection(base: DataFrame) -> DataFrame:
    return base.select(*BASE_PROJECTION).distinct()


def _pairs(rows: DataFrame, date_col: str, between: tuple[str, ...]) -> DataFrame:
    """Per (pathway, date, minutes): number of distinct contact rows, and the
    largest value of each ``between`` order column."""
    return (rows.groupBy("pathway_id", date_col, "minutes")
            .agg(F.count(F.lit(1)).alias("_rows"), *[F.max(c).alias(c) for c in between]))


def _newest_order(date_col: str, between: tuple[str, ...]) -> Column:
    """The ranking order as one struct: NULL sorts lowest, i.e. DESC NULLS LAST."""
    return F.struct(F.col(date_col), *[F.col(c) for c in between], F.col("minutes"))


def _packed_order(date_col: str) -> Column:
    """(date, minutes) DESC NULLS LAST as one exact long: date as days from
    0001-01-01 plus one (0 = NULL, < 2^22) above 33 bits of minutes shifted
    to be non-negative plus one (0 = NULL)."""
    days = F.datediff(F.col(date_col), F.lit("0001-01-01").cast("date")).cast("bigint") + 1
    mins = F.col("minutes").cast("bigint") + F.lit(2 ** 31 + 1)
    return (F.shiftleft(F.coalesce(days, F.lit(0).cast("bigint")), 33)
            + F.coalesce(mins, F.lit(0).cast("bigint")))


def _newest_pair(date_col: str, between: tuple[str, ...]) -> list[Column]:
    """Aggregates giving each pathway's newest pair: ``_top_d``, ``_top_m``
    (its date and minutes) and ``_top_n`` (its number of rows).

    With no ``between`` column the order packs into one long, so three
    scalar ``max_by``s keep Spark's hash aggregate; otherwise one ``max_by``
    over the order struct (exact, but Spark aggregates struct buffers by
    sorting)."""
    if not between:
        order = _packed_order(date_col)
        return [F.max_by(F.col(date_col), order).alias("_top_d"),
                F.max_by(F.col("minutes"), order).alias("_top_m"),
                F.max_by(F.col("_rows"), order).alias("_top_n")]
    top = F.max_by(F.struct(F.col(date_col).alias("d"), F.col("minutes").alias("m"),
                            F.col("_rows").alias("n")), _newest_order(date_col, between))
    return [top.d.alias("_top_d"), top.m.alias("_top_m"), top.n.alias("_top_n")]


def contact_keys(rows: DataFrame, date_col: str, between: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (pathway, date, minutes, newest?) of distinct contact rows, as
    their full ranking gives it (newest: rank 1), without ranking.

    Each (date, minutes) pair appears with ``_newest`` false, except the
    pathway's newest pair (the ``max_by`` of the order), which appears with
    true -- and also with false when another row shares it.  Only pairs are
    shuffled, never contact rows, and every step aggregates partially.  The
    newest pairs are taken out by (pathway, date, minutes), which the pairs
    already lie by, so no task holds a whole pathway's pairs.
    """
    pairs = _pairs(rows, date_col, between)
    top = pairs.groupBy("pathway_id").agg(*_newest_pair(date_col, between))
    alone = top.filter(F.col("_top_n") == 1).select(F.col("pathway_id").alias("_top_p"), "_top_d", "_top_m")
    # a pair that is alone has one row: said again, so that both sides read the same counted pairs
    same = [*[F.col(c).eqNullSafe(F.col(t)) for c, t in (("pathway_id", "_top_p"), (date_col, "_top_d"),
                                                           ("minutes", "_top_m"))], F.col("_rows") == 1]
    others = pairs.join(alone, same, "left_anti").select("pathway_id", date_col, "minutes",
                                                         F.lit(False).alias("_newest"))
    return others.unionByName(top.select("pathway_id", F.col("_top_d").alias(date_col),
                                         F.col("_top_m").alias("minutes"), F.lit(True).alias("_newest")))


def contact_base(base: DataFrame, keys: DataFrame, date_col: str,
                 counted: DataFrame | None = None) -> DataFrame:
    """Base x contacts of the pathway, count-once completion flag.

    The reference's left join, with the keys of ``heavy_keys`` split
    (``operators.skew``), so that no task holds a whole pathway however many
    contacts it has, with or without AQE.

    ``counted``: the contact rows that ``keys`` come from; their frequent
    pathways are counted there.

    ``_newest`` is non-NULL on matched rows and ``comp_flag`` is never NULL,
    so distinct inputs give distinct outputs: no DISTINCT after the join.
    """
    return _flagged(left_join_split(_base_projection(base), keys, "pathway_id", spread_by=[date_col, "minutes"],
                                    matched="_newest", counted=counted), date_col)


def _flagged(joined: DataFrame, date_col: str) -> DataFrame:
    return joined.select(
        "month", "quarter", "pathway_id", "iet_count", date_col, "minutes", "product",
        F.when(F.coalesce("_newest", F.lit(True)), F.col("comp_flag")).alias("comp_flag"), *R.GEO_COLUMNS)


def _with_pathway(rows: DataFrame) -> DataFrame:
    """Contacts that a base row can meet.  The joins would put this filter on
    some of the plans over ``rows`` and not on others, which then share no shuffle."""
    return rows.filter(F.col("pathway_id").isNotNull())


def digital_contact_base(base: DataFrame, contact_rows: DataFrame) -> DataFrame:
    """Base x digital contacts (``contact_rows``: J09's distinct rows)."""
    rows = _with_pathway(contact_rows)
    return contact_base(base, contact_keys(rows, "start_date", DIGITAL_BETWEEN), "start_date", rows)


def any_contact_base(base: DataFrame, contact_rows: DataFrame) -> DataFrame:
    """Base x all contacts (``contact_rows``: J16's distinct rows)."""
    rows = _with_pathway(contact_rows)
    return contact_base(base, contact_keys(rows, "contact_date"), "contact_date", rows)


def any_contact_base_split(base: DataFrame, src: Sources, pathways: DataFrame) -> DataFrame:
    """J17 from the sources.  ``pathways``: distinct ids, among them all of ``base``.

    Frequent pathways are counted in, and split off, the contacts and
    activities, as in ``all_contacts``, and go as in ``any_contact_base``.  Those
    of all others, as nearly all are, are dealt once, by pathway, and cut to
    ``pathways``; contacts meet their activities, lose repeats, are ranked and
    join the base where they lie, so the pairs of contacts and activities, which
    are many more than either, are not shuffled at all.
    """
    key = ["pathway_id"]
    con, act = (_with_pathway(df) for df in _contacts_and_activities(src))
    often = frequent_buckets(con.select(*key).unionByName(act.select(*key)), key)
    (con_few, con_many), (act_few, act_many) = (split_frequent(df, key, often) for df in (con, act))
    base_few, base_many = split_frequent(_base_projection(base), key, often)
    few = base_few.join(_keys_by_pathway(con_few, act_few, pathways), key, "left")
    return _flagged(few, "contact_date").unionByName(
        any_contact_base(base_many, _contact_activity_rows(con_many, act_many).distinct()))


def _keys_by_pathway(con: DataFrame, act: DataFrame, pathways: DataFrame) -> DataFrame:
    """``contact_keys`` of each contact x each activity of the same submission,
    for ``pathways`` with few rows: two shuffles, by pathway, of what is given.

    The distinct minutes of a submission's activities go to its contacts by a
    window (a join by submission would deal both sides anew); a NULL in the
    submission's keys meets nothing."""
    key = ["pathway_id", *VERSION_KEYS]
    con, act = (df.repartition("pathway_id").join(pathways, "pathway_id", "left_semi")
                for df in (con, act.dropna(subset=VERSION_KEYS)))
    sets = act.groupBy(*key).agg(F.collect_set(F.struct("minutes")).alias("_minutes"))
    none = {c: F.lit(None).cast(t) for c, t in (*con.dtypes, *sets.dtypes)}
    columns = [*con.columns, "_minutes"]
    together = (con.select(*con.columns, none["_minutes"].alias("_minutes"), F.lit(True).alias("_contact"))
                .unionByName(sets.select(*[c if c in sets.columns else none[c].alias(c) for c in columns],
                                         F.lit(False).alias("_contact"))))
    met = F.first("_minutes", ignorenulls=True).over(Window.partitionBy(*key))
    rows = (together.withColumn("_minutes", met).filter("_contact")
            .withColumn("_met", F.explode_outer("_minutes"))
            .select("pathway_id", "contact_date", F.col("_met.minutes").alias("minutes"), "unique_month_id").distinct())
    pairs = _pairs(rows, "contact_date", ())
    newest = (Window.partitionBy("pathway_id")
              .orderBy(F.col("contact_date").desc_nulls_last(), F.col("minutes").desc_nulls_last()))
    flags = (F.when(F.col("_rank") > 1, F.array(F.lit(False)))
             .when(F.col("_rows") == 1, F.array(F.lit(True)))
             .otherwise(F.array(F.lit(True), F.lit(False))))
    return (pairs.withColumn("_rank", F.row_number().over(newest))
            .select("pathway_id", "contact_date", "minutes", F.explode(flags).alias("_newest")))


def contact_minutes_per_pathway(rows: DataFrame, date_col: str,
                                between: tuple[str, ...] = ()) -> DataFrame:
    """Per pathway: exact decimal sum and non-null count of minutes over the
    distinct (date, minutes, newest?) contacts of ``rows`` -- what a base row
    contributes to the contact dashboards -- without ranking or joining.

    ``rows`` are distinct contact rows ranked newest-first by ``date_col``,
    then ``between`` (descending), then ``minutes`` (descending), NULLs last,
    then further tie-breakers.  Each (date, minutes) pair counts once, except
    that the newest row's pair counts twice when another row shares it (the
    two differ in the newest flag).  The newest pair is the ``max_by`` of
    (date, max of ``between``, minutes): struct ordering puts NULL lowest,
    which is the order's NULLS LAST.  Two aggregations, both partial before
    their shuffle, so no task sees a whole pathway.
    """
    pairs = _pairs(rows, date_col, between)
    per = pairs.groupBy("pathway_id").agg(
        F.sum(F.col("minutes").cast(AVG_TYPE)).alias("_minutes_sum"),
        F.count("minutes").alias("_minutes_n"),
        *_newest_pair(date_col, between))
    twice = (F.col("_top_n") >= 2) & F.col("_top_m").isNotNull()
    return per.select(
        "pathway_id",
        F.when(twice, F.col("_minutes_sum") + F.col("_top_m").cast(AVG_TYPE))
        .otherwise(F.col("_minutes_sum")).alias("_minutes_sum"),
        (F.col("_minutes_n") + F.when(twice, 1).otherwise(0)).alias("_minutes_n"))


def contact_time_dashboard(base: DataFrame, per_pathway: DataFrame, name: str,
                           *, fold: bool = False, averages: str = "double") -> DataFrame:
    """Average minutes per contact by quarter x product x level x bucket.

    A base row with no contact contributes no minutes (count 0) and its
    flag; every base row carries exactly one flagged row (its newest
    contact, or its only row), so the flag sum is the base's sum.
    """
    rows = (_base_projection(base).join(per_pathway, "pathway_id", "left")
            .withColumn("_minutes_n", F.coalesce(F.col("_minutes_n"), F.lit(0))))
    return level_bucket_rollup(rows, "quarter", ["product"],
                               [AvgOfParts(name, "_minutes_sum", "_minutes_n"), Sum("comp_flag")],
                               fold=fold, averages=averages)


def digital_time_dashboard(base: DataFrame, contact_rows: DataFrame, *,
                           fold: bool = False, averages: str = "double") -> DataFrame:
    """Average digital therapist minutes per contact (``contact_rows``: J09 rows)."""
    per = contact_minutes_per_pathway(contact_rows, "start_date", DIGITAL_BETWEEN)
    return contact_time_dashboard(base, per, "avg_iet_minutes", fold=fold, averages=averages)


def any_time_dashboard(base: DataFrame, contact_rows: DataFrame, *,
                       fold: bool = False, averages: str = "double") -> DataFrame:
    """Average therapist minutes per contact, any contact type (J16 rows)."""
    per = contact_minutes_per_pathway(contact_rows, "contact_date")
    return contact_time_dashboard(base, per, "avg_any_minutes", fold=fold, averages=averages)


def _contacts_and_activities(src: Sources) -> tuple[DataFrame, DataFrame]:
    """Contacts and activities of latest versions.  Activities are cut to them
    like the contacts (the join keys hold the version), so superseded
    submissions are pruned from both scans."""
    con = (latest_only(src.care_contact, src.submission_register)
           .select("pathway_id", "submission_id", "audit_id", "contact_date", "unique_month_id"))
    latest = latest_register(src.submission_register).select(*VERSION_KEYS)
    act = (src.care_activity.join(latest, VERSION_KEYS, "left_semi")
           .select("pathway_id", "submission_id", "audit_id", "minutes"))
    return con, act


def _contact_activity_rows(con: DataFrame, act: DataFrame) -> DataFrame:
    """JN13: each contact x each activity of the same submission.

    Both sides are reduced to their distinct join keys + needed columns first:
    the projection after the join keeps only those columns, so the set is the
    same, and the N:M product is built from de-duplicated rows only.
    """
    return (con.distinct().join(act.distinct(), ["pathway_id", "submission_id", "audit_id"], "left")
            .select("pathway_id", "contact_date", "minutes", "unique_month_id"))


def contact_activity_pairs(src: Sources) -> DataFrame:
    """JN13: each latest-version contact x each activity of the same submission,
    as distinct (pathway, date, minutes, month id)."""
    return _contact_activity_rows(*_contacts_and_activities(src)).distinct()


def any_order() -> tuple[str, list[Column]]:
    """Newest first by contact date; ties: minutes largest first, then month id (K4)."""
    return "contact_date", [F.col("minutes").desc_nulls_last(), F.col("unique_month_id").asc_nulls_last()]


def all_contacts(src: Sources, rows: DataFrame | None = None) -> DataFrame:
    """All contacts with activity minutes, ranked newest first per pathway
    (``rows``: J16's distinct rows, where they exist already).

    Frequent pathways are counted in, and split off, the contacts and
    activities, so the join is worked out once for each pathway."""
    key = ["pathway_id"]
    if rows is not None:
        return rank_newest(rows, key, *any_order())
    con, act = _contacts_and_activities(src)
    often = frequent_buckets(con.select(*key).unionByName(act.select(*key)), key)
    con_few, con_many = split_frequent(con, key, often)
    _, act_many = split_frequent(act, key, often)
    return rank_split(_contact_activity_rows(con_few, act), _contact_activity_rows(con_many, act_many), key,
                      *any_order(), distinct=True)
