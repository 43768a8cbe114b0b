"""Submission versions and the reporting window (JN1 + F01, J03)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwise.functions import rules as R

VERSION_KEYS = ["submission_id", "audit_id"]


def latest_register(register: DataFrame) -> DataFrame:
    """Register rows of the latest version of each submission, with their period."""
    return (register.filter(F.col("is_latest") == 1)
            .select(*VERSION_KEYS, "period_start", "period_end"))


def latest_only(fact: DataFrame, register: DataFrame) -> DataFrame:
    """Keep fact rows whose (submission, audit) is the latest version (inner join).

    The register holds one row per submission version, so it stays small
    whatever the fact size; Spark's own size check (static estimate, then
    AQE's runtime statistics) turns this into a broadcast hash join and falls
    back to a shuffle join if the register is ever large.
    """
    return fact.join(latest_register(register), VERSION_KEYS, "inner")


@dataclass(frozen=True)
class ReportingWindow:
    """The window of one monthly refresh, as a one-row DataFrame.

    ``period_start`` / ``period_end``: the latest refreshed month (max over
    *all* register rows, shifted back ``lag`` months, end of month for the
    end).  ``first_date``: fixed lower bound of the history.  ``offset_start``:
    ``period_start`` shifted by ``offset`` months (questionnaire month range).
    Columns are read through scalar subqueries, so the values never pass
    through the driver.
    """

    frame: DataFrame

    def __getattr__(self, name: str) -> Column:  # period_start, period_end, ...
        if name.startswith("_") or name == "frame":
            raise AttributeError(name)
        return self.frame.select(name).scalar()


def reporting_window(register: DataFrame, *, lag: int = R.REFRESH_LAG_MONTHS,
                     first: str = R.FIRST_REPORTING_DATE, offset: int = 0) -> ReportingWindow:
    frame = (register
             .agg(F.add_months(F.max("period_start"), -lag).alias("period_start"),
                  F.last_day(F.add_months(F.max("period_end"), -lag)).alias("period_end"))
             .select(F.lit(first).cast("date").alias("first_date"),
                     "period_start", "period_end",
                     F.add_months("period_start", offset).alias("offset_start")))
    return ReportingWindow(frame)
