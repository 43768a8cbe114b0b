"""The twelve source tables, as lazily-read DataFrames.

Two ways in:

* ``Sources.from_tables(spark, path)`` reads ``<path>/<name>`` parquet tables
  that already have the neutral schema (production layout);
* ``Sources.from_driver_tables(spark, sf_dir, stage_dir)`` derives them
  from the driver's TPC-H-style parquet files through the fixture views and,
  given ``stage_dir``, writes them there once in production layout
  (``driver_sources`` does so under the shared checkpoint folder).

Either way the jobs' plans stay lazy; Catalyst prunes columns and pushes
filters into the parquet scans of whatever a plan actually uses.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathwise.session import bounded_shuffles, partitions_for
from pathwise.sources import fixtures


@dataclass(frozen=True)
class Sources:
    referral: DataFrame
    digital_log: DataFrame
    care_contact: DataFrame
    care_activity: DataFrame
    assessment: DataFrame
    terminology: DataFrame
    submission_register: DataFrame
    commissioner_succession: DataFrame
    commissioner_hierarchy: DataFrame
    provider_succession: DataFrame
    provider_hierarchy: DataFrame
    calendar: DataFrame

    def validate(self) -> "Sources":
        """Check every source against its contract (``schemas.SOURCE_SCHEMAS``);
        raise with the full list of problems, or return ``self``."""
        from pathwise.sources.schemas import problems

        found = [p for f in fields(self) for p in problems(getattr(self, f.name), f.name)]
        if found:
            raise ValueError("source tables do not match their schemas:\n  " + "\n  ".join(found))
        return self

    def replaced(self, **tables: DataFrame) -> "Sources":
        """``dataclasses.replace``, but a source that is staged on demand and
        was not asked for yet is not asked for either."""
        if "_frame" not in self.__dict__:
            return replace(self, **tables)
        out = object.__new__(type(self))
        out.__dict__.update(self.__dict__, **tables)
        return out

    def with_collation(self, collation: str = "UTF8_LCASE_RTRIM") -> "Sources":
        """Every text column compared under ``collation``.

        The reference compares text under its database's default collation,
        which is case-blind and ignores trailing blanks on SQL Server.  By
        default this library compares exactly; giving the source columns a
        collation makes every comparison, join, IN list, prefix test and
        GROUP BY of every plan follow it, with no change to the plans.
        """
        def collated(df: DataFrame) -> DataFrame:
            return df.select(*[
                F.col(f.name).cast(T.StringType(collation)).alias(f.name)
                if isinstance(f.dataType, T.StringType) else F.col(f.name)
                for f in df.schema.fields])
        return Sources(**{f.name: collated(getattr(self, f.name)) for f in fields(self)})

    @classmethod
    def from_tables(cls, spark: SparkSession, path: str) -> "Sources":
        """Read ``<path>/<name>`` parquet tables and check them against their schemas."""
        from pathwise.sources.publish import stored_bytes

        bounded_shuffles(spark, sum(stored_bytes(spark, f"{path}/{f.name}") for f in fields(cls)))
        return cls(**{f.name: spark.read.parquet(f"{path}/{f.name}") for f in fields(cls)}).validate()

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str,
                           stage_dir: str | None = None,
                           partition_facts: bool = True, on_demand: bool = False) -> "Sources":
        """Fixture sources, derived by the fixture views.

        Without ``stage_dir`` every source is a lazy view over the driver
        tables.  With it, each source is written there once and read back,
        in the layout production tables have:

        * reference tables (register, calendar, terminology, organisation
          successions and hierarchies) as small files, whose real size
          Spark's broadcast check sees -- as views they carry the planner's
          product-of-inputs estimate of the joins deriving them and are
          never broadcast;
        * fact tables in several files -- each driver table is one parquet
          row group, which Spark can only read with one task, so a view over
          it runs every downstream join in a single task.  Facts that carry a
          submission id are partitioned by it, as monthly submissions land:
          a job that needs some months (the questionnaire month, the latest
          versions) then reads only their folders, through dynamic
          partition pruning from the filtered register it joins.  A large
          submission lies in several files, written by as many tasks;
        * the joined order lines, which three facts come from, once, dealt by
          month already: the facts are written from them, and referrals from
          orders dealt in the same way, without a shuffle of their own rows.

        ``on_demand``: a source is staged (and checked) when it is first asked
        for, so a job writes only the sources that it reads.
        """
        from pathwise.sources.publish import WORKING_CODEC, materialize, shuffles_dropped, stored_bytes

        size = sum(stored_bytes(spark, f"{sf_dir}/{t}.parquet") for t in fixtures.DRIVER_TABLES)
        bounded_shuffles(spark, size)
        frames: dict[str, DataFrame] = {
            t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in fixtures.DRIVER_TABLES}
        n_files = partitions_for(size, least=max(spark.sparkContext.defaultParallelism, 1))
        pieces = 1 + size // SUBMISSION_PIECE_BYTES
        lock = threading.RLock()   # jobs of one refresh start from several threads

        def frame(name: str) -> DataFrame:
            with lock:
                if name not in frames:
                    inputs = {d: frame(d) for d in fixtures.dependencies(name)}
                    if stage_dir and partition_facts and name in FACT_TABLES and "dated" in inputs:
                        inputs["dated"] = by_month(inputs["dated"], "o_orderkey")
                    df = spark.sql(fixtures.VIEWS[name], **inputs)
                    frames[name] = staged(name, df) if stage_dir else df
                return frames[name]

        def by_month(df: DataFrame, key: str) -> DataFrame:
            """A month's rows in so many pieces; a submission is of one month."""
            return df.repartition("ym", F.pmod(F.xxhash64(key), F.lit(pieces)))

        def staged(name: str, df: DataFrame) -> DataFrame:
            path = f"{stage_dir}/{name}"
            if name in REFERENCE_TABLES or name == "lines" and not partition_facts:
                return materialize(df, path)
            if name not in FACT_TABLES and name != "lines":
                return df
            if name == "lines":
                out = by_month(df, "l_orderkey").write.partitionBy("ym")
            elif partition_facts and "submission_id" in df.columns:
                # one folder per submission, as monthly submissions land
                out = df.write.partitionBy("submission_id")
            else:
                out = df.repartition(n_files).write
            with shuffles_dropped(spark):
                out.mode("overwrite").option("compression", WORKING_CODEC).parquet(path)
            return spark.read.schema(df.schema).parquet(path).select(*df.columns)

        if on_demand:
            out = object.__new__(cls)
            object.__setattr__(out, "_frame", frame)
            return out
        return cls(**{f.name: frame(f.name) for f in fields(cls)}).validate()

    def __getattr__(self, name: str) -> DataFrame:
        """A source that is staged on demand, asked for the first time."""
        if name not in {f.name for f in fields(Sources)} or "_frame" not in self.__dict__:
            raise AttributeError(name)
        from pathwise.sources.schemas import problems

        df = self._frame(name)
        if found := problems(df, name):
            raise ValueError("source tables do not match their schemas:\n  " + "\n  ".join(found))
        object.__setattr__(self, name, df)
        return df


REFERENCE_TABLES = ["submission_register", "calendar", "terminology", "commissioner_succession",
                    "commissioner_hierarchy", "provider_succession", "provider_hierarchy"]
#: Bytes of driver tables for each file that a submission is dealt over.
SUBMISSION_PIECE_BYTES = 256 << 20
FACT_TABLES = ["referral", "digital_log", "care_contact", "care_activity", "assessment"]

_CACHE: dict[tuple[str, str], Sources] = {}


def driver_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """Fixture sources for ``sf_dir``, each staged once per Spark application, when
    it is first asked for, under the session's shared checkpoint folder."""
    from pathwise.sources.publish import new_run_dir

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = Sources.from_driver_tables(spark, sf_dir, new_run_dir(spark, "fixtures"), on_demand=True)
    return _CACHE[key]
