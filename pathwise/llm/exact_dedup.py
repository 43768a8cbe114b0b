"""Exact dedup by 128-bit content hash, with the bytes compared (native).

One shuffle carries the texts: rows are grouped on (128-bit hash, text).
Equality of the text key is a comparison of bytes, made only inside a hash
group, so two texts that share a hash stay apart.  Partial aggregation leaves
one row per text and map task, so a text that holds a third of all rows does
not meet in one task.  The result of that grouping is joined back to narrow
rows (id and digests); a hot join key is split by AQE's skew join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import LOWER, UPPER, ascii_lower, unused


def _keyed(df: DataFrame, id_col: str, text_col: str,
           content_hash: Callable[[Column], Column]) -> DataFrame:
    text = df.select(F.col(id_col).alias("doc_id"),
                     ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    return text.select("doc_id", content_hash(F.col("norm")).alias("h"),
                       F.sha2("norm", 256).alias("text_sha256"), "norm")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per distinct text: h, text_sha256, keep_id, group_size."""
    return (_keyed(df, id_col, text_col, content_hash)
            .groupBy("h", "text_sha256", "norm")
            .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .drop("norm"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``df``.

    Texts are equal when their bytes are, after lower-casing A-Z only.  Of
    equal texts the row with the largest id stays (ids are stable: the choice
    does not depend on order or partitioning).

    Null text counts as empty; empty texts are equal to each other.  A null id
    sorts below every other, so such a row stays only in a group with no other
    id (``keep_id`` null).  Rows that repeat an id and a text are counted and
    returned each.  Other columns of ``df`` are ignored, whatever their names.
    """
    keyed = _keyed(df, id_col, text_col, content_hash).drop("norm")
    return (keyed.join(exact_groups(df, id_col, text_col, content_hash), ["h", "text_sha256"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with their columns, whatever the names of
    further ones.  Rows that repeat an id and a text are one document: one of
    them stays."""
    own = unused(df, "_own")
    kept = (exact_groups(df, id_col, text_col)
            .select(F.col("keep_id").alias("_keep"), F.col("text_sha256").alias("_sha")))
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = df.withColumn(own, F.sha2(text, 256))
    return (rows.join(kept, rows[id_col].eqNullSafe(kept["_keep"]) & (rows[own] == kept["_sha"]),
                      "left_semi")
            .dropDuplicates([id_col, own]).drop(own).select(*df.columns))


ORACLE = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
WINDOW w AS (PARTITION BY norm)
"""
