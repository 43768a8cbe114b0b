"""The monthly refresh: every job of both reference scripts, wired together.

``MonthlyRefresh`` exposes each job as a lazily-built DataFrame.  Nothing
runs until an action; ``publish`` writes the seven dashboards, after
materialising the working tables that several jobs read (the pathway base,
the digital contact rows and the digital summary) so each is computed once
and lineage is cut at shared storage.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame

from pathwise.functions import rules as R
from pathwise.operators.versions import ReportingWindow, reporting_window
from pathwise.plans import appointments as A
from pathwise.plans import averages as V
from pathwise.plans import outcomes as O
from pathwise.plans import questionnaire as Q
from pathwise.sources import publish as P
from pathwise.sources.schemas import DASHBOARD_SCHEMAS, conform
from pathwise.sources.snapshots import SnapshotTable
from pathwise.sources.tables import Sources

DASHBOARDS = [
    "outcome_dashboard", "questionnaire_dashboard", "time_recorded_dashboard",
    "wait_dashboard", "treatment_dashboard", "digital_time_dashboard", "any_time_dashboard",
]


class MonthlyRefresh:
    def __init__(self, src: Sources, *, first: str = R.FIRST_REPORTING_DATE,
                 lag: int = R.REFRESH_LAG_MONTHS, questionnaire_offset: int = 0,
                 fold: bool | None = None, averages: str = "double", answers_latest_versions_only: bool = False,
                 overrides: dict[str, DataFrame] | None = None):
        self.src = src
        self.answers_latest_versions_only = answers_latest_versions_only
        self.first, self.lag, self.questionnaire_offset, self.fold = first, lag, questionnaire_offset, fold
        # None: each dashboard as is best for it
        self._rollup = {} if fold is None else {"fold": fold}
        self.averages = averages
        self._given = overrides or {}
        for name, df in self._given.items():
            self.__dict__[name] = df          # pre-seed cached_property values

    # J03 ---------------------------------------------------------------
    @cached_property
    def window(self) -> ReportingWindow:
        return reporting_window(self.src.submission_register, lag=self.lag, first=self.first)

    @cached_property
    def questionnaire_window(self) -> ReportingWindow:
        return reporting_window(self.src.submission_register, lag=self.lag, first=self.first,
                                offset=self.questionnaire_offset)

    # script 1 ------------------------------------------------------------
    @cached_property
    def digital_summary(self) -> DataFrame:
        return O.digital_summary(self.src)

    @cached_property
    def contact_minutes(self) -> DataFrame:
        return O.contact_minutes(self.src)

    @cached_property
    def pathway_base(self) -> DataFrame:
        return O.pathway_base(self.src, self.window, self.digital_summary, self.contact_minutes)

    def bucketed_base(self, run_dir: str, buckets: int | None = None) -> DataFrame:
        """J04 from working tables bucketed by pathway under ``run_dir``.

        J01, J02 and the labelled referrals have a few rows per pathway
        each, so a bucket of them is no hot spot; their joins and the DISTINCT
        need no exchange.
        """
        n = buckets or int(self.src.referral.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        w = self.window
        ref = O.latest_referrals(self.src).filter(O.in_window(w.first_date, w.period_start, w.period_end))
        tables = {"referral": O.labelled_referrals(self.src, ref), "digital_summary": self.digital_summary,
                  "contact_minutes": self.contact_minutes}
        lying = {name: P.materialize_bucketed(df, f"{run_dir}/{name}", "pathway_id", n)
                 for name, df in tables.items()}
        return O.base_rows(lying["referral"], lying["digital_summary"], lying["contact_minutes"])

    @cached_property
    def outcome_dashboard(self) -> DataFrame:
        return O.outcome_dashboard(self.pathway_base, **self._rollup)

    @cached_property
    def latest_answers(self) -> DataFrame:
        return Q.latest_answers(self.src)

    @cached_property
    def newest_answers(self) -> DataFrame:
        return Q.newest_answers(self.src)

    @cached_property
    def questionnaire_base(self) -> DataFrame:
        return Q.questionnaire_base(self.src, self.questionnaire_window, self.digital_summary,
                                    Q.answers_with_terms(self.src, self.answers_latest_versions_only))

    @cached_property
    def questionnaire_dashboard(self) -> DataFrame:
        return Q.questionnaire_dashboard(self.questionnaire_base, **self._rollup)

    @cached_property
    def digital_contact_rows(self) -> DataFrame:
        return A.digital_contact_rows(self.src)

    @cached_property
    def digital_contacts(self) -> DataFrame:
        return A.digital_contacts(self.src, self._given.get("digital_contact_rows"))

    @cached_property
    def appointment_base(self) -> DataFrame:
        return A.appointment_base(self.src, self.window, self.digital_contact_rows)

    @cached_property
    def time_recorded_dashboard(self) -> DataFrame:
        return A.time_recorded_dashboard(self.appointment_base, **self._rollup)

    # script 2 ------------------------------------------------------------
    @cached_property
    def wait_dashboard(self) -> DataFrame:
        return O.wait_dashboard(self.pathway_base, averages=self.averages, **self._rollup)

    @cached_property
    def treatment_dashboard(self) -> DataFrame:
        return O.treatment_dashboard(self.pathway_base, averages=self.averages, **self._rollup)

    @cached_property
    def digital_contact_base(self) -> DataFrame:
        return V.digital_contact_base(self.pathway_base, self.digital_contact_rows)

    @cached_property
    def digital_time_dashboard(self) -> DataFrame:
        return V.digital_time_dashboard(self.pathway_base, self.digital_contact_rows,
                                        averages=self.averages, **self._rollup)

    @cached_property
    def all_contact_rows(self) -> DataFrame:
        return V.contact_activity_pairs(self.src)

    @cached_property
    def all_contacts(self) -> DataFrame:
        return V.all_contacts(self.src, self._given.get("all_contact_rows"))

    @cached_property
    def any_contact_base(self) -> DataFrame:
        if (rows := self._given.get("all_contact_rows")) is not None:
            return V.any_contact_base(self.pathway_base, rows)
        return V.any_contact_base_split(self.pathway_base, self.src, O.base_pathways(self.src, self.window))

    @cached_property
    def any_time_dashboard(self) -> DataFrame:
        return V.any_time_dashboard(self.pathway_base, self.all_contact_rows, averages=self.averages,
                                    **self._rollup)

    def questionnaire_months(self) -> list[dt.date]:
        """First days of the months the questionnaire run covers."""
        w = self.questionnaire_window.frame.first()
        if w.period_start is None:
            return []
        first, last = (d.year * 12 + d.month - 1 for d in (w.offset_start, w.period_start))
        return [dt.date(m // 12, m % 12 + 1, 1) for m in range(first, last + 1)]

    # running -------------------------------------------------------------
    def _with(self, seeds: dict[str, DataFrame]) -> "MonthlyRefresh":
        """This refresh over working tables, with averages as they are published."""
        return MonthlyRefresh(self.src, first=self.first, lag=self.lag,
                              questionnaire_offset=self.questionnaire_offset, fold=self.fold, averages="decimal",
                              answers_latest_versions_only=self.answers_latest_versions_only,
                              overrides=seeds)

    def publish(self, out_dir: str, run_dir: str, *, month_append: bool = False,
                parallel: bool = True, atomic: bool = False) -> dict[str, str]:
        """Write all seven dashboards, by name with their published schemas
        (``schemas.DASHBOARD_SCHEMAS``); the questionnaire one by month partition.

        Working tables read by several jobs are written once under
        ``run_dir`` and read back (lineage cut at shared storage).  Each job
        starts as soon as the tables it reads exist, so independent jobs run
        side by side: on a large cluster one small dashboard stage cannot
        fill the slots, several concurrent ones can.

        ``atomic``: each dashboard is a ``SnapshotTable``, so a run killed at
        any step leaves every table as one of its snapshots.
        """
        def work(name: str, *needs: str):
            def run(done: dict[str, DataFrame]) -> DataFrame:
                return P.materialize(getattr(self._with({n: done[n] for n in needs}), name),
                                     f"{run_dir}/{name}")
            return needs, run

        def dashboard(name: str, *needs: str):
            def run(done: dict[str, DataFrame]) -> str:
                path = f"{out_dir}/{name}"
                df = conform(getattr(self._with({n: done[n] for n in needs}), name),
                             DASHBOARD_SCHEMAS[name])
                if atomic:
                    table = SnapshotTable(df.sparkSession, path)
                    if name == "questionnaire_dashboard":
                        table.publish_months(df, self.questionnaire_months(), append=month_append)
                    else:
                        table.publish_full(df)
                elif name == "questionnaire_dashboard":
                    if month_append:
                        P.append_month(df, path)
                    else:
                        P.publish_month(df, path, months=self.questionnaire_months())
                else:
                    P.publish_full(df, path)
                return path
            return needs, run

        base = ("pathway_base",)
        done = run_jobs({
            "digital_summary": work("digital_summary"),
            "digital_contact_rows": work("digital_contact_rows"),
            "pathway_base": work("pathway_base", "digital_summary"),
            "outcome_dashboard": dashboard("outcome_dashboard", *base),
            "wait_dashboard": dashboard("wait_dashboard", *base),
            "treatment_dashboard": dashboard("treatment_dashboard", *base),
            "questionnaire_dashboard": dashboard("questionnaire_dashboard", "digital_summary"),
            "time_recorded_dashboard": dashboard("time_recorded_dashboard", "digital_contact_rows"),
            "digital_time_dashboard": dashboard("digital_time_dashboard", *base,
                                                "digital_contact_rows"),
            "any_time_dashboard": dashboard("any_time_dashboard", *base),
        }, parallel)
        return {name: done[name] for name in DASHBOARDS}


def run_jobs(jobs: dict, parallel: bool = True) -> dict:
    """Run Spark actions in dependency order: ``jobs`` maps a name to
    ``(needs, fn)``, and ``fn`` gets the results of ``needs``.

    With ``parallel`` each action is submitted from its own driver thread
    once its inputs exist, and the Spark scheduler interleaves the tasks of
    concurrent jobs.  An error in any job is raised here.
    """
    if not parallel:
        done: dict = {}
        pending = dict(jobs)
        while pending:
            name = next(n for n, (needs, _) in pending.items() if all(d in done for d in needs))
            needs, fn = pending.pop(name)
            done[name] = fn(done)
        return done
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures: dict = {}

        def call(name):
            needs, fn = jobs[name]
            return fn({d: futures[d].result() for d in needs})

        for name in jobs:          # a job only waits on jobs listed before it
            futures[name] = pool.submit(call, name)
        return {name: f.result() for name, f in futures.items()}
