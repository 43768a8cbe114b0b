"""Data checks on the reference tables.

A code listed twice in a succession table, twice among the current rows of
a hierarchy, or a submission version marked latest twice, multiplies every
fact row that joins it; the dashboards keep that behaviour (as the
reference does), so the run reports it instead.  Each check is a grouped
count over a small reference table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.operators.orgs import current_hierarchy
from pathwise.operators.versions import latest_register
from pathwise.sources.tables import Sources


def _repeated(df: DataFrame, table: str, key: F.Column) -> DataFrame:
    return (df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1)
            .select(F.lit(table).alias("table_name"), "key", "n_rows"))


def reference_duplicates(src: Sources) -> DataFrame:
    """(table_name, key, n_rows) for every key that would fan out a join."""
    checks = [
        _repeated(src.commissioner_succession, "commissioner_succession", F.col("old_code")),
        _repeated(src.provider_succession, "provider_succession", F.col("old_code")),
        _repeated(current_hierarchy(src.commissioner_hierarchy), "commissioner_hierarchy",
                  F.col("org_code")),
        _repeated(current_hierarchy(src.provider_hierarchy), "provider_hierarchy",
                  F.col("org_code")),
        _repeated(latest_register(src.submission_register), "submission_register",
                  F.concat_ws("/", F.col("submission_id").cast("string"),
                              F.col("audit_id").cast("string"))),
        _repeated(src.calendar, "calendar", F.col("full_date").cast("string")),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
