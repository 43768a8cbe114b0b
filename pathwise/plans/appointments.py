"""Digital contacts, appointment base and the time-recorded dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwise.functions import labels as L
from pathwise.functions import rules as R
from pathwise.operators.ranking import rank_newest
from pathwise.operators.rollup import Count, level_bucket_rollup
from pathwise.operators.versions import ReportingWindow, latest_only
from pathwise.plans.outcomes import flag, latest_referrals, with_orgs
from pathwise.sources.tables import Sources

CONTACT_COLUMNS = ["pathway_id", "start_date", "end_date", "minutes", "unique_month_id", "product"]


def _latest_log(src: Sources) -> DataFrame:
    log = latest_only(src.digital_log, src.submission_register)
    return log.select("pathway_id", "start_date", "end_date", "minutes", "unique_month_id",
                      L.canonical_product("product").alias("product"))


def digital_contact_rows(src: Sources) -> DataFrame:
    """A08 on the digital log: distinct contact rows of latest versions, canonical product."""
    return _latest_log(src).distinct()


def digital_order() -> tuple[str, list[Column]]:
    """Newest first by start date; the reference stops there, so ties are
    broken by end date, minutes (both newest / largest first), product and
    month id (K4)."""
    return "start_date", [F.col("end_date").desc_nulls_last(), F.col("minutes").desc_nulls_last(),
                          F.col("product").asc_nulls_last(), F.col("unique_month_id").asc_nulls_last()]


def digital_contacts(src: Sources, rows: DataFrame | None = None) -> DataFrame:
    """Distinct digital contacts ranked newest first per pathway."""
    if rows is not None:
        return rank_newest(rows, ["pathway_id"], *digital_order())
    return rank_newest(_latest_log(src), ["pathway_id"], *digital_order(), distinct=True)


APPOINTMENT_COLUMNS = ["month", "pathway_id", "unique_month_id", "product", "minutes",
                       "time_recorded", "start_date", "end_date", *R.GEO_COLUMNS]


def appointment_base(src: Sources, window: ReportingWindow, contacts: DataFrame) -> DataFrame:
    """Digital contacts that ended inside their referral's submission period.

    No completed-treatment or received-date filter and no calendar join.
    The reference writes a left join but filters on the contact's end date,
    so it is an inner join on (pathway, month id).
    """
    ref = latest_referrals(src)
    ref = ref.filter(flag(ref, "usable")
                     & F.col("period_start").between(window.first_date, window.period_start))
    ref = with_orgs(ref, src)
    con = contacts.select(*CONTACT_COLUMNS)
    joined = (ref.join(con, ["pathway_id", "unique_month_id"], "inner")
              .filter(F.col("end_date").between(F.col("period_start"), F.col("period_end"))))
    return joined.select(
        L.month_key("period_start").alias("month"), "pathway_id", "unique_month_id",
        L.product_or_default("product").alias("product"), "minutes",
        L.time_recorded_flag("minutes").alias("time_recorded"),
        "start_date", "end_date", *R.GEO_COLUMNS,
    ).distinct()


def time_recorded_dashboard(appointments: DataFrame, *, fold: bool = False) -> DataFrame:
    """Digital appointments by month x recorded flag x product x level (no buckets)."""
    dims = ["time_recorded", "product"]
    base = appointments.filter(F.col("product") != R.NO_PRODUCT)
    return level_bucket_rollup(base, "month", dims, [Count("n_appointments", "start_date")],
                               bucket_col=None, fold=fold)
