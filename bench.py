"""Benchmark: the monthly refresh and each job at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "monthly_refresh_sec", "value": <end-to-end refresh seconds>, "unit": "sec",
   "queries": {<job or variant>: seconds, ...}, "sf": <scale factor>}

``value`` is the full monthly refresh: working tables materialised once,
all seven dashboards written (what the two reference scripts do per month).
Each job is also timed alone from the source tables, executed in full by a
``noop`` write (nothing collected to the driver).  Every measurement runs
twice and reports the second (warm: JVM and generated code compiled), as
reported too, as ``monthly_refresh_cold``.  Variants: the
reference-shaped 15-branch union vs the single-pass rollup, fold on / off,
and the plain window vs the skew-safe sorted ranking.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pathwise.operators.ranking import rank_newest  # noqa: E402
from pathwise.operators.rollup import Sum, unrolled_rollup  # noqa: E402
from pathwise.plans import appointments as A  # noqa: E402
from pathwise.plans import outcomes as O  # noqa: E402
from pathwise.plans.catalog import (  # noqa: E402
    FIXTURE_FIRST, FIXTURE_QUESTIONNAIRE_OFFSET, QUERIES, refresh,
)
from pathwise.plans.refresh import MonthlyRefresh  # noqa: E402
from pathwise.session import local_session  # noqa: E402
from pathwise.sources import publish as P  # noqa: E402
from pathwise.sources.tables import driver_sources  # noqa: E402

JOBS = [
    "digital_summary", "contact_minutes", "pathway_base", "outcome_dashboard", "latest_answers",
    "questionnaire_base", "questionnaire_dashboard", "digital_contacts", "appointment_base",
    "time_recorded_dashboard", "wait_dashboard", "treatment_dashboard", "digital_contact_base",
    "digital_time_dashboard", "all_contacts", "any_contact_base", "any_time_dashboard",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return round(time.perf_counter() - t, 3)


def warm(fn) -> float:
    """Median of three runs; the first one, which compiles, is the slowest."""
    return statistics.median(timed(fn) for _ in range(3))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="pathwise-bench",
                          extra={"spark.driver.memory": "8g"})
    P.shared_dir(spark)   # the session's checkpoint folder; a local one only if unset

    times: dict[str, float] = {}
    # source staging: derive the twelve source tables from the driver tables
    # and write them once (production reads them as files); timed apart
    times["stage_sources"] = timed(lambda: driver_sources(spark, sf_dir))
    # warm-up (JVM, codegen caches); not timed
    run(QUERIES["latest_only"](spark, sf_dir))

    def fresh() -> MonthlyRefresh:
        # a new refresh per run: nothing built or written by an earlier run is reused
        return MonthlyRefresh(driver_sources(spark, sf_dir), first=FIXTURE_FIRST,
                              questionnaire_offset=FIXTURE_QUESTIONNAIRE_OFFSET)

    for name in JOBS:
        times[name] = warm(lambda: run(getattr(fresh(), name)))

    # variants of the core operator on the outcome dashboard
    base = P.materialize(refresh(spark, sf_dir).pathway_base,
                         f"{P.new_run_dir(spark, 'bench')}/pathway_base")
    measures = [Sum("iet_count"), *[Sum(f) for f in O.OUTCOME_FLAGS]]
    times["j05_rollup_expand_from_base"] = warm(lambda: run(O.outcome_dashboard(base, fold=False)))
    times["j05_rollup_from_base"] = warm(lambda: run(O.outcome_dashboard(base)))
    times["j05_unrolled_15_branch_from_base"] = warm(
        lambda: run(unrolled_rollup(base, "month", O.OUTCOME_DIMS, measures)))

    # ranking J09: plain window vs prefix counts
    rows = P.materialize(A.digital_contact_rows(driver_sources(spark, sf_dir)),
                         f"{P.new_run_dir(spark, 'bench')}/j09_rows")
    times["j09_rank_window"] = warm(
        lambda: run(rank_newest(rows, ["pathway_id"], *A.digital_order(), method="window")))
    times["j09_rank_skew_safe"] = warm(
        lambda: run(rank_newest(rows, ["pathway_id"], *A.digital_order())))

    def publish():
        out_dir = P.new_run_dir(spark, "bench-publish")
        fresh().publish(f"{out_dir}/dashboards", f"{out_dir}/work")

    times["monthly_refresh_cold"] = timed(publish)
    total = timed(publish)
    times["monthly_refresh"] = total

    print(json.dumps({"metric": "monthly_refresh_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
