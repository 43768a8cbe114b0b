"""``level_bucket_rollup``: every dashboard's 15 (or 5) GROUP BYs from one scan.

A dashboard groups one base by time + dims at five organisation levels, each
for three *overlapping* usage buckets (``1+``, ``2+`` within it, and
``none``).  Instead of scanning the base once per (level, bucket), two steps:

1. ``finest_cells`` folds the base to its finest cells -- time, dims, the
   geography columns the levels read, and the bucket class -- with Spark's
   partial aggregation before the shuffle, so a hot key is collapsed per task.
2. ``roll_up`` deals the cells out by (time, dims) only.  Every level's keys
   contain these, so all coarser levels and buckets are merged from the cells
   inside the tasks, without another shuffle: a (time, dims) pair has at most
   as many cells as the reference data has organisation pairs, three times.

What is shuffled is the cells, twice, not ten rows per base row.  Exact for
SUM / COUNT / AVG: averages travel as (exact decimal sum, non-null count) and
divide last.  Cells made with ``subtractable=True`` can also be taken away
again (``merge_cells``), which is how a refresh by change set works.

``fold=False`` expands the base rows themselves and aggregates them at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwise.functions import rules as R

AVG_TYPE = "decimal(7,2)"


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str                # sum | count | avg | avg_parts
    col: str
    count_col: str | None = None   # avg_parts: column holding the non-null count

    def partials(self, subtractable: bool = False) -> list[tuple[str, Column]]:
        """(name, per-row expression) of the mergeable partial columns.  A sum
        that is to be taken away again needs its count of values too: NULL
        minus NULL cannot tell whether values are left."""
        c = F.col(self.col)
        if subtractable and self.kind != "count":
            value = c.cast(AVG_TYPE) if self.kind == "avg" else c
            count = F.col(self.count_col) if self.kind == "avg_parts" else F.when(c.isNotNull(), 1).otherwise(0)
            return [(f"_s_{self.name}", F.coalesce(value, F.lit(0).cast(AVG_TYPE) if self.kind == "avg" else F.lit(0))),
                    (f"_c_{self.name}", count)]
        if self.kind == "sum":
            return [(f"_s_{self.name}", c)]
        if self.kind == "count":
            return [(f"_c_{self.name}", F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0)))]
        if self.kind == "avg":
            # The published average is over values cast to decimal(7,2); the
            # cast raises on overflow (ANSI), like the reference.
            return [(f"_s_{self.name}", c.cast(AVG_TYPE)),
                    (f"_c_{self.name}", F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0)))]
        if self.kind == "avg_parts":
            return [(f"_s_{self.name}", c), (f"_c_{self.name}", F.col(self.count_col))]
        raise ValueError(self.kind)

    def final(self, subtractable: bool = False, averages: str = "double") -> Column:
        """The published value.  Averages: one IEEE division of the exact sum
        (``double``), or ``decimal``: decimal(38,6), as the reference types
        them, the exact quotient rounded half up at the sixth place."""
        total, n = F.col(f"_s_{self.name}"), F.col(f"_c_{self.name}")
        if self.kind == "sum":
            return (F.when(n > 0, total) if subtractable else total).alias(self.name)
        if self.kind == "count":
            return n.cast("bigint").alias(self.name)
        n = F.nullif(n.cast("bigint"), F.lit(0).cast("bigint"))  # no non-null value -> NULL
        if averages == "decimal":
            return (total.cast("decimal(38,2)") / n.cast("decimal(19,0)")).cast("decimal(38,6)").alias(self.name)
        return (total.cast("double") / n.cast("double")).alias(self.name)


def Sum(name: str, col: str | None = None) -> Measure:
    return Measure(name, "sum", col or name)


def Count(name: str, col: str) -> Measure:
    return Measure(name, "count", col)


def Avg(name: str, col: str) -> Measure:
    return Measure(name, "avg", col)


def AvgOfParts(name: str, sum_col: str, count_col: str) -> Measure:
    """Average from pre-aggregated (decimal sum, non-null count) columns."""
    return Measure(name, "avg_parts", sum_col, count_col)


def _level_value(v) -> Column:
    return F.col(v[1]) if isinstance(v, tuple) else F.lit(v)


def levels_column(levels=R.ORG_LEVELS, text_type=None) -> Column:
    """array<struct<org_type, region, org_name, org_code>>: one cell per level.

    ``text_type``: the string type of the geography columns; constants are
    cast to it so all cells share one type (and one collation, if any).
    """
    def v(x) -> Column:
        c = _level_value(x)
        return c.cast(text_type) if text_type is not None else c

    return F.array(*[
        F.struct(v(t).alias("org_type"), v(region).alias("region"),
                 v(name).alias("org_name"), v(code).alias("org_code"))
        for t, region, name, code in levels])


def level_source_columns(levels=R.ORG_LEVELS) -> list[str]:
    cols: list[str] = []
    for _, *vals in levels:
        for v in vals:
            if isinstance(v, tuple) and v[1] not in cols:
                cols.append(v[1])
    return cols


def buckets_column(n: Column) -> Column:
    """Usage buckets a row falls in: 2+ also counts in 1+; 0 or NULL is none.
    (A negative count matches no bucket, as in the reference.)

    A CASE over literal arrays, not a filtered array: a higher-order
    function (lambda) cannot be code-generated and would take the expansion
    out of whole-stage codegen."""
    return (F.when(n >= 2, F.array(F.lit(R.BUCKET_ONE), F.lit(R.BUCKET_TWO)))
            .when(n >= 1, F.array(F.lit(R.BUCKET_ONE)))
            .when(n.isNull() | (n == 0), F.array(F.lit(R.BUCKET_NONE)))
            .otherwise(F.array().cast("array<string>")))


def _bucket_class(n: Column) -> Column:
    """Finest bucket grain for the fold: 2 (2+), 1 (exactly 1+ not 2+), 0 (none),
    -1 (a negative count, in no bucket)."""
    return F.when(n >= 2, 2).when(n >= 1, 1).when(n.isNull() | (n == 0), 0).otherwise(-1)


def finest_cells(df: DataFrame, times: list[str], dims: list[str], measures: list[Measure], *,
                 bucket_col: str | None = "iet_count", levels=R.ORG_LEVELS,
                 subtractable: bool = False) -> DataFrame:
    """One row per (times, dims, geography, bucket class ``_bucket``) with the
    measures' partial columns, and the number of rows ``_rows`` where
    ``subtractable``."""
    partials = [p for m in measures for p in m.partials(subtractable)]
    if subtractable:
        partials.append(("_rows", F.lit(1)))
    klass = [_bucket_class(F.col(bucket_col)).alias("_bucket")] if bucket_col else []
    geo = level_source_columns(levels)
    return (df.select(*times, *dims, *geo, *klass, *[e.alias(n) for n, e in partials])
            .groupBy(*times, *dims, *geo, *(["_bucket"] if bucket_col else []))
            .agg(*[F.sum(n).alias(n) for n, _ in partials]))


def merge_cells(add: DataFrame, take: DataFrame | None = None) -> DataFrame:
    """Cells added up key by key; those of ``take`` are taken away.  A cell
    without rows is gone."""
    partials = [c for c in add.columns if c.startswith(("_s_", "_c_")) or c == "_rows"]
    keys = [c for c in add.columns if c not in partials]
    rows = add
    if take is not None:
        rows = add.unionByName(take.select(*keys, *[(-F.col(c)).alias(c) for c in partials]))
    types = dict(add.dtypes)
    return (rows.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in partials])
            .filter(F.col("_rows") != 0).select(*add.columns))


def _expanded(rows: DataFrame, time: str, dims: list[str], partials: list[str], bucketed: bool,
              levels) -> DataFrame:
    """Every row in each (level, bucket) it belongs to: at most 5 x 2 rows."""
    if bucketed:
        rows = rows.select("*", F.explode(buckets_column(F.col("_bucket"))).alias("appointment_type"))
    geo = level_source_columns(levels)
    text_type = rows.schema[geo[0]].dataType if geo else None
    return rows.select(time, *(["appointment_type"] if bucketed else []), *dims, *partials,
                       F.inline(levels_column(levels, text_type)))


def roll_up(cells: DataFrame, time: str, dims: list[str], measures: list[Measure], *,
            bucketed: bool = True, levels=R.ORG_LEVELS, subtractable: bool = False,
            averages: str = "double", derived: dict[str, Column] | None = None, deal: bool = True) -> DataFrame:
    """The dashboard of ``cells`` (``finest_cells``, or any finer ones).

    ``deal=False``: the cells are expanded and aggregated as they lie, before
    the shuffle.  For few dims: few groups, which the map tasks collapse, and
    too few (time, dims) pairs to deal many cells by."""
    names = [n for m in measures for n, _ in m.partials(subtractable)]
    bucket_keys = ["appointment_type"] if bucketed else []
    rows = _expanded(cells.repartition(time, *dims) if deal else cells, time, dims, names, bucketed, levels)
    out = rows.groupBy(time, *R.ORG_COLUMNS, *bucket_keys, *dims).agg(*[F.sum(n).alias(n) for n in names])
    extra = [c.alias(name) for name, c in (derived or {}).items()]
    return out.select(time, *R.ORG_COLUMNS, *bucket_keys, *dims, *extra,
                      *[m.final(subtractable, averages) for m in measures])


def level_bucket_rollup(df: DataFrame, time: str, dims: list[str], measures: list[Measure], *,
                        bucket_col: str | None = "iet_count", levels=R.ORG_LEVELS,
                        fold: bool = True, averages: str = "double",
                        derived: dict[str, Column] | None = None) -> DataFrame:
    """All (level, bucket) branches of a dashboard.

    Output: time, org_type, region, org_name, org_code, [appointment_type],
    dims..., derived..., measures... (sum/count -> bigint, averages -> double,
    or decimal(38,6) with ``averages="decimal"``).

    ``derived``: output columns that are functions of the grouping keys only
    (a label of a code, say).  Grouping by the key alone gives the same
    groups as grouping by key and label, so the label is computed once per
    output group after the aggregation instead of being hashed, compared
    and shuffled with every row -- long text keys dominate this operator's
    cost.
    """
    if fold:
        cells = finest_cells(df, [time], dims, measures, bucket_col=bucket_col, levels=levels)
        return roll_up(cells, time, dims, measures, bucketed=bool(bucket_col), levels=levels,
                       averages=averages, derived=derived)
    partials = [p for m in measures for p in m.partials()]
    names = [n for n, _ in partials]
    bucket_keys = ["appointment_type"] if bucket_col else []
    rows = df.select(time, *dims, *level_source_columns(levels),
                     *([F.col(bucket_col).alias("_bucket")] if bucket_col else []),
                     *[e.alias(n) for n, e in partials])
    out = (_expanded(rows, time, dims, names, bool(bucket_col), levels)
           .groupBy(time, *R.ORG_COLUMNS, *bucket_keys, *dims).agg(*[F.sum(n).alias(n) for n in names]))
    extra = [c.alias(name) for name, c in (derived or {}).items()]
    return out.select(time, *R.ORG_COLUMNS, *bucket_keys, *dims, *extra,
                      *[m.final(averages=averages) for m in measures])


_UNROLLED_BUCKETS = [
    (R.BUCKET_ONE, lambda n: n >= 1),
    (R.BUCKET_NONE, lambda n: (n == 0) | n.isNull()),
    (R.BUCKET_TWO, lambda n: n >= 2),
]


def unrolled_rollup(df: DataFrame, time: str, dims: list[str], measures: list[Measure], *,
                    bucket_col: str | None = "iet_count", levels=R.ORG_LEVELS) -> DataFrame:
    """The reference's shape: one filtered GROUP BY per (level, bucket), unioned.

    Kept as a cross-check of ``level_bucket_rollup`` and as the benchmark
    baseline; it scans ``df`` once per branch (15 times for a bucketed
    dashboard), so it is not used by the jobs.
    """
    partials = [p for m in measures for p in m.partials()]
    branches = []
    for org_type, region, name, code in levels:
        keys = [v[1] for v in (region, name, code) if isinstance(v, tuple)]
        keys = list(dict.fromkeys(keys))
        for label, cond in (_UNROLLED_BUCKETS if bucket_col else [(None, None)]):
            part = df if cond is None else df.filter(cond(F.col(bucket_col)))
            agg = (part.select(time, *keys, *dims, *[e.alias(n) for n, e in partials])
                   .groupBy(time, *keys, *dims)
                   .agg(*[F.sum(n).alias(n) for n, _ in partials]))
            cols = [time, F.lit(org_type).alias("org_type"), _level_value(region).alias("region"),
                    _level_value(name).alias("org_name"), _level_value(code).alias("org_code")]
            if label:
                cols.append(F.lit(label).alias("appointment_type"))
            branches.append(agg.select(*cols, *dims, *[m.final() for m in measures]))
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out
