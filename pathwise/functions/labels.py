"""Column expressions for the row-wise derivations (all JVM-side, no UDFs).

Each builder returns a ``pyspark.sql.Column`` made of ``when`` chains over the
ordered rules in ``rules.py``; first matching rule wins, as in a searched CASE.
Builders that have no default return NULL when nothing matches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathwise.functions import rules as R


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _chain(arms: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    """Fold (condition, value) pairs into one CASE WHEN, first arm first."""
    expr = None
    for cond, value in arms:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    if expr is None:
        return default if default is not None else F.lit(None)
    return expr.otherwise(default) if default is not None else expr


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def truthy(c: str | Column, dtype: str = "boolean") -> Column:
    """A flag that may arrive as boolean or as the text 'True' (P02/F02)."""
    c = _col(c)
    if dtype == "string":
        return F.lower(F.trim(c)) == F.lit("true")
    return c


# P01 + P02 -----------------------------------------------------------------
def canonical_product(c: str | Column) -> Column:
    """Canonical product name by prefix; NULL -> 'No IET'; else unchanged."""
    c = _col(c)
    arms = [(_any([c.startswith(p) for p in prefixes]), F.lit(name))
            for name, prefixes in R.PRODUCT_PREFIXES]
    arms.append((c.isNull(), F.lit(R.NO_PRODUCT)))
    return _chain(arms, c)


def product_or_default(c: str | Column) -> Column:
    """A missing product reads 'No IET'."""
    return F.coalesce(_col(c), F.lit(R.NO_PRODUCT))


# P03 / P05 -------------------------------------------------------------------
def month_key(d: str | Column) -> Column:
    """First day of the month of ``d`` (month name + year cast back to a date)."""
    return F.trunc(_col(d), "month")


def wait_days(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` (may be negative; NULL if either is)."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


# P06 -------------------------------------------------------------------------
def end_code_label(c: str | Column) -> Column:
    c = _col(c)
    return _chain([(c == F.lit(code), F.lit(text)) for code, text in R.END_CODES],
                  F.lit(R.END_CODE_DEFAULT))


# P07 -------------------------------------------------------------------------
def outcome_flag(discharged_in_period: Column, completed: Column, *flags: Column,
                 pathway: str | Column = "pathway_id") -> Column:
    """1 iff discharged in period AND completed AND every flag AND pathway set, else 0."""
    cond = discharged_in_period & completed & _col(pathway).isNotNull()
    for f in flags:
        cond = cond & f
    # NULL in any part makes the condition unknown -> 0, as CASE ... ELSE 0.
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# P08 -------------------------------------------------------------------------
def problem_label(higher: str | Column, primary: str | Column,
                  lower: str | Column, secondary: str | Column) -> Column:
    higher, primary, lower, secondary = map(_col, (higher, primary, lower, secondary))

    def top(value: str) -> Column:
        return (higher == F.lit(value)) | (primary == F.lit(value))

    def low(value: str) -> Column:
        return (lower == F.lit(value)) | (secondary == F.lit(value))

    anxiety = top(R.ANXIETY_TOTAL)
    arms = [(top(value), F.lit(label)) for value, label in R.PROBLEM_TOP]
    arms += [(anxiety & low(value), F.lit(label)) for value, label in R.PROBLEM_ANXIETY]
    arms.append((anxiety & (lower.isNull() | secondary.isNull()), F.lit(R.PROBLEM_NO_CODE)))
    return _chain(arms, F.lit(R.PROBLEM_OTHER))


# P09 / P10 -------------------------------------------------------------------
def band(c: str | Column, bands: list[tuple[int, int | None, str]]) -> Column:
    """Inclusive integer bands; no ELSE, so out-of-range and NULL give NULL."""
    c = _col(c)
    arms = [((c >= lo) if hi is None else c.between(lo, hi), F.lit(label)) for lo, hi, label in bands]
    return _chain(arms)


def gad7_band(c: str | Column) -> Column:
    return band(c, R.GAD7_BANDS)


def phq9_band(c: str | Column) -> Column:
    return band(c, R.PHQ9_BANDS)


# P11 -------------------------------------------------------------------------
def usage_mix(n_digital: str | Column, n_contacts: str | Column) -> Column:
    n, total = _col(n_digital), _col(n_contacts)
    return _chain([
        ((n == 0) & (total > 0), F.lit(R.MIX_NONE)),
        ((n > 0) & (total == n), F.lit(R.MIX_ONLY)),
        ((n > 0) & (total > n), F.lit(R.MIX_MIXED)),
    ])


# P12 -------------------------------------------------------------------------
def org_default(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(R.NO_ORG))


# P13 / P14 -------------------------------------------------------------------
def question_label(term: str | Column) -> Column:
    term = _col(term)
    return _chain([(term == F.lit(t), F.lit(label)) for t, label in R.QUESTION_TERMS])


def answer_label(code: str | Column, score: str | Column) -> Column:
    code, score = _col(code), _col(score)
    arms = []
    for codes, answers in R.ANSWERS:
        in_family = code.isin(codes)
        arms += [(in_family & (score == F.lit(s)), F.lit(label)) for s, label in answers]
    return _chain(arms)


# P15 -------------------------------------------------------------------------
def time_recorded_flag(minutes: str | Column) -> Column:
    m = _col(minutes)
    return _chain([
        (m.isNull() | (m == 0), F.lit(R.TIME_NOT_RECORDED)),
        (m > 0, F.lit(R.TIME_RECORDED)),
    ])


# P16 -------------------------------------------------------------------------
def count_once(rank: str | Column, flag: str | Column) -> Column:
    """Keep ``flag`` on a pathway's newest contact (or its only, contact-less row)."""
    r = _col(rank)
    return F.when((r == 1) | r.isNull(), _col(flag))
