"""Splitting the very frequent keys of a join, and only those.

A key that holds a large share of a side's rows puts them all into one task
of a shuffle join.  Here the keys that hold more than one in ``SHARE`` rows
are counted (partial aggregation, so the count itself is never hot); there
are fewer than ``SHARE`` of them whatever the data, so the table of them is
broadcast.  Their rows are dealt over as many parts as their share asks for;
the other side's rows of these keys are repeated once per part.  All other
keys go as they are.  Nothing is dropped or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key is frequent if it holds more than one in SHARE rows: under SHARE keys.
SHARE = 4096


def heavy_keys(df: DataFrame, key: str, share: int = SHARE) -> DataFrame:
    """``key``, _parts for the frequent keys of ``df``: at most ``share`` rows.
    ``_parts`` of a key have about one in ``share`` of all rows each."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total")).select("_total").scalar()
    return (counts.filter((F.col("_n") * share > total) & (F.col("_n") > 1) & F.col(key).isNotNull())
            .select(key, F.ceil(F.col("_n") * share / total).cast("int").alias("_parts")))


#: Groups are counted by so many buckets where only whether they may be frequent matters.
BUCKETS = 65_536


def bucket_of(keys: list[str]) -> Column:
    """The bucket of a group; NULL keys have one too."""
    return F.pmod(F.hash(*keys), F.lit(BUCKETS))


def frequent_buckets(df: DataFrame, keys: list[str], share: int = SHARE) -> DataFrame:
    """``_bucket`` of every group of ``keys`` with more than one in ``share``
    rows of ``df``, and of those that fall together with such a group: under
    ``share`` rows.  Counting buckets, not groups, shuffles at most ``BUCKETS``
    rows a task however many groups there are; so many are summed in one task."""
    counts = df.groupBy(bucket_of(keys).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    n, total = F.col("_n"), F.sum("_n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("_total", total).filter((n * share > F.col("_total")) & (n > 1)).select("_bucket")


def split_frequent(df: DataFrame, keys: list[str], buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` outside and inside ``frequent_buckets``."""
    rows, often = df.withColumn("_bucket", bucket_of(keys)), F.broadcast(buckets)  # fewer than ``share`` rows
    return (rows.join(often, "_bucket", "left_anti").drop("_bucket"),
            rows.join(often, "_bucket", "left_semi").drop("_bucket"))


def left_join_split(left: DataFrame, right: DataFrame, key: str, *, spread_by: list[str], matched: str,
                    counted: DataFrame | None = None, share: int = SHARE) -> DataFrame:
    """``left.join(right, key, "left")``, frequent keys of ``right`` split by
    a hash of ``spread_by``.

    ``counted``: rows to count the keys in, with no key that ``right`` has not
    (default: ``right``).  Where ``right`` is worked out of some rows, counting
    those does not work it out a second and a third time.

    ``matched``: a column of ``right`` that is never NULL there.  A part that
    got no row of ``right`` would give an unmatched row of its own; those are
    left out, as a frequent key has matches.
    """
    heavy = F.broadcast(heavy_keys(right if counted is None else counted, key, share))  # fewer than ``share`` rows
    parts = F.coalesce("_parts", F.lit(1))
    a = (left.join(heavy, key, "left")
         .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))))
    b = (right.join(heavy, key, "left")
         .withColumn("_part", F.pmod(F.xxhash64(*spread_by), parts).cast("int")).drop("_parts"))
    return (a.join(b, [key, "_part"], "left")
            .filter(F.col("_parts").isNull() | F.col(matched).isNotNull()).drop("_part", "_parts"))
