"""Monthly refresh from the command line.

    python -m pathwise --sources <dir> --out <dir> [--work <dir>]
                       [--first 2020-09-01] [--lag 1] [--questionnaire-offset 0] [--append] [--atomic]
                       [--collation UTF8_LCASE_RTRIM]

``--sources`` holds the twelve source tables as parquet folders named as in
``pathwise.sources.Sources``; ``--driver-tables <sf dir>`` derives them from
the driver's tables instead (fixtures).  Working tables go to ``--work``, by
default a run folder under the session's ``spark.checkpoint.dir``.  Submit
with ``spark-submit -m pathwise`` on a cluster; run with ``python -m`` locally.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from pathwise.functions import rules as R
from pathwise.plans.refresh import MonthlyRefresh
from pathwise.session import TUNING
from pathwise.sources import publish as P
from pathwise.sources.tables import Sources, driver_sources


def main(argv: list[str] | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="pathwise", description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sources", help="folder with the twelve source tables (parquet)")
    src.add_argument("--driver-tables", help="folder with the driver's TPC-H-style tables")
    ap.add_argument("--out", required=True, help="folder for the seven dashboards")
    ap.add_argument("--work", help="folder for working tables (default: under spark.checkpoint.dir)")
    ap.add_argument("--first", default=R.FIRST_REPORTING_DATE)
    ap.add_argument("--lag", type=int, default=R.REFRESH_LAG_MONTHS)
    ap.add_argument("--questionnaire-offset", type=int, default=0)
    ap.add_argument("--collation", help="compare text under this collation, e.g. "
                    "UTF8_LCASE_RTRIM for case-blind, trailing-blank-blind matching")
    ap.add_argument("--append", action="store_true",
                    help="append the questionnaire month instead of replacing it")
    ap.add_argument("--atomic", action="store_true",
                    help="publish snapshot tables: a killed run leaves every table as it was")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("pathwise-monthly-refresh")
    for k, v in TUNING.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    sources = (Sources.from_tables(spark, args.sources) if args.sources
               else driver_sources(spark, args.driver_tables))
    if args.collation:
        sources = sources.with_collation(args.collation)
    refresh = MonthlyRefresh(sources, first=args.first, lag=args.lag,
                             questionnaire_offset=args.questionnaire_offset)
    work = args.work or P.new_run_dir(spark, "monthly-refresh")
    paths = refresh.publish(args.out, work, month_append=args.append, atomic=args.atomic)
    if not args.work:
        P.remove(spark, work)  # the run's own folder: nothing reads it any more
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
