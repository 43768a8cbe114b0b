"""Session settings the plans are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans at run time from real shuffle statistics: coalesces small
# partitions, splits skewed join partitions, and turns a shuffle join into a
# broadcast one when a side turns out small.  ANSI mode makes a decimal
# overflow an error, as in the reference.
#
# Run-time key filters: where a side that can be shuffled (a gigabyte of scan
# or more) is joined to a side cut down by filters, Spark builds a Bloom filter
# of the small side's keys and drops other rows at the large side's scan.  For
# the questionnaire run (J08) the pathways of usable, completed referrals so
# reach the scans of the digital log and of the answers, before anything is
# shuffled.  The small side may be up to 256 MB of scan, a filter up to 64 MB.
KEY_FILTERS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(40_000_000),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(64 * 8 << 20),
}

TUNING = {
    **KEY_FILTERS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}

#: Adaptive execution merges the partitions of a shuffle up to so many (compressed)
#: bytes; left alone it merges up to 64 MB, or one partition a core, and a task's
#: hash tables and sorts then grow with the input.
PARTITION_BYTES = 8 << 20
#: Most bytes of a file that a scan's task reads, for the same reason (Spark's own: 128 MB).
SCAN_BYTES = 16 << 20
#: Bytes of source tables per shuffle partition before merging, and the most partitions.
BYTES_PER_INITIAL, MOST_INITIAL = 2 << 20, 20_000


def partitions_for(source_bytes: int, least: int = 1) -> int:
    return min(max(least, -(-source_bytes // BYTES_PER_INITIAL)), max(least, MOST_INITIAL))


def bounded_shuffles(spark: SparkSession, source_bytes: int) -> None:
    """Scan and shuffle partitions of a bounded size for tables of ``source_bytes``:
    as many as the tables ask for, merged to ``PARTITION_BYTES``.  Sizes that the
    session sets itself stay; the number is only ever raised."""
    for size, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", PARTITION_BYTES),
                       ("spark.sql.files.maxPartitionBytes", SCAN_BYTES)):
        if spark.conf.get(size, None) is None:
            spark.conf.set(size, str(most))
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(number, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if (wanted := partitions_for(source_bytes)) > now:
        spark.conf.set(number, str(wanted))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pathwise",
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**TUNING, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
