"""Organisation resolution: one-hop succession, then the current hierarchy row.

JN3-JN6 + F12 + P12: ``code -> coalesce(successor, code) -> open-ended
hierarchy row``; every output column defaults to 'Other' on its own.
Succession and hierarchy tables are reference data (one row per
organisation), so the joins are left joins against small sides that Spark's
size check broadcasts; the fact side is never shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.functions.labels import org_default

COMMISSIONER_COLUMNS = {
    "subicb_code": "org_code", "subicb_name": "org_name", "icb_code": "icb_code",
    "icb_name": "icb_name", "region_name_comm": "region_name", "region_code_comm": "region_code",
}
PROVIDER_COLUMNS = {
    "provider_code": "org_code", "provider_name": "org_name", "region_name_prov": "region_name",
}


def current_hierarchy(hierarchy: DataFrame) -> DataFrame:
    """only open-ended rows take part (the filter of the ON clause)."""
    return hierarchy.filter(F.col("effective_to").isNull())


def resolve_org(fact: DataFrame, code_col: str, succession: DataFrame, hierarchy: DataFrame,
                columns: dict[str, str], tag: str) -> DataFrame:
    """Append ``columns`` (output name -> hierarchy column) for ``fact[code_col]``."""
    old, new, key = f"_{tag}_old", f"_{tag}_new", f"_{tag}_key"
    succ = succession.select(F.col("old_code").alias(old), F.col("new_code").alias(new))
    cur = current_hierarchy(hierarchy).select(
        F.col("org_code").alias(key),
        *[F.col(src).alias(f"_{tag}_{out}") for out, src in columns.items()])
    joined = (fact.join(succ, F.col(code_col) == F.col(old), "left")
              .join(cur, F.coalesce(F.col(new), F.col(code_col)) == F.col(key), "left"))
    return joined.select(*[F.col(c) for c in fact.columns],
                         *[org_default(f"_{tag}_{out}").alias(out) for out in columns])


def resolve_commissioner(fact: DataFrame, code_col: str, succession: DataFrame,
                         hierarchy: DataFrame) -> DataFrame:
    return resolve_org(fact, code_col, succession, hierarchy, COMMISSIONER_COLUMNS, "cm")


def resolve_provider(fact: DataFrame, code_col: str, succession: DataFrame,
                     hierarchy: DataFrame) -> DataFrame:
    return resolve_org(fact, code_col, succession, hierarchy, PROVIDER_COLUMNS, "pv")
