"""Newest-first ranking within a group.

The reference orders by one date only, so ties are undetermined there; every
caller here passes tie-breakers over the remaining columns so the ranking is
a function of the data, not of the partitioning (SURVEY K4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathwise.operators.skew import SHARE, frequent_buckets, split_frequent


def rank_newest(df: DataFrame, partition: list[str], newest: str, ties: list[Column],
                name: str = "latest_rank", *, method: str = "counts", distinct: bool = False,
                share: int = SHARE) -> DataFrame:
    """Append ``name`` = row_number over ``partition``, ordered by ``newest``
    descending (NULL last) and then by ``ties`` (bigint).

    ``method="window"`` is the plain window: simple, but every group is
    sorted by one task, so a group holding a large share of the rows becomes
    one huge task.  ``method="counts"`` (default) gives the same numbers with
    no task holding such a group.  Groups that hold at most one in ``share``
    rows, as nearly all do, take the window: their rows are shuffled once, by
    group.  The others (``skew.frequent_buckets``, under ``share`` buckets,
    broadcast) go by counts:

    1. rows per (group, date), with partial aggregation before the shuffle;
    2. prefix sums of these counts over a group's dates, newest first: a group
       has at most as many rows there as there are dates;
    3. a rank among the rows of one (group, date), plus the rows before it.

    ``ties`` must break all ties between distinct rows, as every caller's
    does.  ``distinct``: the distinct rows of ``df`` are ranked; those of a
    group are found where they are ranked, without a shuffle of their own.
    """
    if method == "window":
        return _by_window(df.distinct() if distinct else df, partition, newest, ties, name)
    few, many = split_frequent(df, partition, frequent_buckets(df, partition, share))
    return rank_split(few, many, partition, newest, ties, name, distinct=distinct)


def rank_split(few: DataFrame, many: DataFrame, partition: list[str], newest: str, ties: list[Column],
               name: str = "latest_rank", *, distinct: bool = False) -> DataFrame:
    """``rank_newest`` of rows that are split already: no group is in both, and
    those of ``few`` are small."""
    if distinct:
        few, many = few.repartition(*partition).distinct(), many.distinct()
    return (_by_window(few, partition, newest, ties, name)
            .unionByName(_by_counts(many, partition, newest, ties, name)))


def _by_window(df: DataFrame, partition: list[str], newest: str, ties: list[Column], name: str) -> DataFrame:
    order = [F.col(newest).desc_nulls_last(), *ties]
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)).cast("bigint"))


def _by_counts(df: DataFrame, partition: list[str], newest: str, ties: list[Column], name: str) -> DataFrame:
    keys = [*partition, newest]
    later = (Window.partitionBy(*partition).orderBy(F.col(newest).desc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, -1))
    before = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
              .select(*[F.col(c).alias(f"_k_{c}") for c in keys],
                      F.coalesce(F.sum("_rows").over(later), F.lit(0)).alias("_before")))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    here = F.row_number().over(Window.partitionBy(*keys).orderBy(*ties))
    return (df.withColumn("_here", here).join(before, same)
            .select(*df.columns, (F.col("_before") + F.col("_here")).cast("bigint").alias(name)))


def newest_only(df: DataFrame, partition: list[str], newest: str, ties: list[Column],
                name: str = "latest_rank") -> DataFrame:
    """Rows ranked 1.  Catalyst plans a partial ``WindowGroupLimit`` before the
    shuffle, so a hot group is cut to one row per map task before it moves."""
    return rank_newest(df, partition, newest, ties, name, method="window").filter(F.col(name) == 1)
