"""Source tables rebuilt as views over the driver's TPC-H-style tables.

The dashboards read twelve care-record tables (referral, digital log, ...).
For tests and benchmarks they are derived from the driver's parquet tables
(see FIXTURES.md).  Each view is one SQL text with ``{name}`` placeholders for
its inputs; the same text runs in Spark (``spark.sql(text, **dataframes)``)
and, as a CTE, in the DuckDB oracle, so both engines see identical inputs.
The text sticks to syntax both engines read the same way.
"""

from __future__ import annotations

import re

from pathwise.functions import rules as R

DRIVER_TABLES = ["orders", "customer", "lineitem", "part", "supplier", "nation", "region", "events"]


def _case_index(expr: str, values: list[str | None], default: str) -> str:
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else _q(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {arms} ELSE {default} END"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_END_CODE_INDEX = [code for code, _ in R.END_CODES] + [None, "ZZ"]            # 0..16, 17 -> '50'
_HIGHER_INDEX = [v for v, _ in R.PROBLEM_TOP] + [R.ANXIETY_TOTAL] * 3          # 0..7, 8 -> NULL
_LOWER_INDEX = [v for v, _ in R.PROBLEM_ANXIETY] + [None]                      # 0..11, 12-13 -> unlisted
_CODE_INDEX = R.QUESTION_CODES                                                 # 0..10, 11 -> unlisted
_SCORE_INDEX = ["0", "1", "2", "3", "4", "NA", "Y"]                             # 7 -> 'N'

# Question code -> term in the fixture terminology: treatment codes name the
# treatment questions 1-6, assessment codes the choice questions 1-4; the
# satisfaction code has no row (its question label stays NULL).
_TERMS = {
    **{code: R.QUESTION_TERMS[5 + i][0] for i, code in enumerate(R.TREATMENT_CODES)},
    **{code: R.QUESTION_TERMS[i][0] for i, code in enumerate(R.ASSESSMENT_CODES)},
}


def _terminology_values() -> str:
    rows = [f"({code}, {_q(term)}, {R.TERM_TYPE_FSN}, 1, 1)" for code, term in _TERMS.items()]
    first, second, third = R.TREATMENT_CODES[:3]
    rows += [
        f"({first}, 'inactive description', {R.TERM_TYPE_FSN}, 1, 0)",
        f"({second}, 'superseded description', {R.TERM_TYPE_FSN}, 0, 1)",
        f"({third}, 'synonym description', 900000000000013009, 1, 1)",
    ]
    return ",\n  ".join(rows)


# name -> SQL text.  Order matters: a view may only use views defined above it.
VIEWS: dict[str, str] = {
    "dated": """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, c.c_nationkey,
       CAST(o.o_orderdate AS DATE) AS d,
       CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS BIGINT) AS ym
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey""",

    "lines": """
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_linestatus,
       p.p_type, x.d, x.ym,
       CASE WHEN l.l_partkey % 10 = 0 THEN 1 ELSE 2 END AS a
FROM {lineitem} l
JOIN {dated} x ON l.l_orderkey = x.o_orderkey
JOIN {part} p ON l.l_partkey = p.p_partkey""",

    "months": """
SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS ym,
       make_date(CAST(year(o_orderdate) AS INT), CAST(month(o_orderdate) AS INT), 1) AS period_start
FROM {orders}""",

    "submission_register": """
SELECT ym * 10 + 1 AS submission_id, 1 AS audit_id, 0 AS is_latest,
       period_start, last_day(period_start) AS period_end
FROM {months}
UNION ALL
SELECT ym * 10 + 2 AS submission_id, 2 AS audit_id, 1 AS is_latest,
       period_start, last_day(period_start) AS period_end
FROM {months}""",

    "calendar": """
SELECT period_start AS full_date,
       'Q' || CAST(CASE WHEN month(period_start) BETWEEN 4 AND 6 THEN 1
                        WHEN month(period_start) BETWEEN 7 AND 9 THEN 2
                        WHEN month(period_start) BETWEEN 10 AND 12 THEN 3 ELSE 4 END AS STRING)
       || ' ' || CAST(CASE WHEN month(period_start) >= 4 THEN year(period_start)
                           ELSE year(period_start) - 1 END AS STRING) AS quarter
FROM {months}""",

    "referral": f"""
SELECT pathway_id,
       ym * 10 + a AS submission_id,
       a AS audit_id,
       pathway_id * 1000000 + ym AS unique_month_id,
       received_date,
       CASE WHEN pathway_id % 17 = 0 THEN NULL
            ELSE received_date + CAST(pathway_id % 30 AS INT) END AS first_assessment_date,
       CASE WHEN pathway_id % 13 = 0 THEN NULL
            ELSE received_date + CAST(pathway_id % 45 AS INT) END AS first_therapy_date,
       CASE WHEN pathway_id % 7 = 0 THEN NULL
            ELSE received_date + CAST(pathway_id % 45 + o_custkey % 28 AS INT) END AS second_therapy_date,
       d + CASE WHEN pathway_id % 19 = 0 THEN 40 ELSE 0 END AS discharge_date,
       o_orderstatus <> 'F' AS completed,
       pathway_id % 2 = 0 AS recovered,
       pathway_id % 5 = 0 AS not_case,
       pathway_id % 3 = 0 AS improved,
       pathway_id % 11 <> 0 AS usable,
       {_case_index('pathway_id % 18', _END_CODE_INDEX, "'50'")} AS end_code,
       {_case_index('pathway_id % 9', _HIGHER_INDEX, 'NULL')} AS higher_category,
       CASE WHEN pathway_id % 9 = 8 AND o_custkey % 2 = 0 THEN {_q(R.ANXIETY_TOTAL)} END AS primary_complaint,
       {_case_index('o_custkey % 14', _LOWER_INDEX, "'unlisted'")} AS lower_category,
       CASE WHEN o_custkey % 14 = 13 THEN {_q(R.PROBLEM_ANXIETY[7][0])}
            WHEN o_custkey % 3 = 0 THEN NULL ELSE 'unlisted' END AS second_complaint,
       CASE WHEN pathway_id % 29 = 0 THEN NULL ELSE CAST(pathway_id % 23 AS INT) END AS anxiety_score,
       CAST(pathway_id % 30 AS INT) AS depression_score,
       CAST(o_custkey % 6 AS INT) AS contact_count,
       CAST(o_custkey % 4 AS INT) AS old_iet_count,
       'C' || CAST(c_nationkey AS STRING) AS commissioner_id,
       'P' || CAST(o_custkey % 120 AS STRING) AS provider_id
FROM (SELECT o_orderkey AS pathway_id, o_custkey, o_orderstatus, c_nationkey, d, ym,
             CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 2 END AS a,
             d - CAST(o_custkey % 120 AS INT) AS received_date
      FROM {{dated}}) r""",

    "digital_log": """
SELECT CASE WHEN l_orderkey % 4 = 0 THEN -l_orderkey ELSE l_orderkey END AS pathway_id,
       l_orderkey * 10 + l_linenumber AS log_id,
       ym * 10 + a AS submission_id,
       a AS audit_id,
       l_orderkey * 1000000 + ym AS unique_month_id,
       CASE WHEN p_type LIKE 'PROMO%' THEN 'SilverCloud A'
            WHEN p_type LIKE 'SMALL%' THEN 'Slvrcld'
            WHEN p_type LIKE 'MEDIUM%' AND l_linenumber % 2 = 0 THEN 'Minddistrict 2'
            WHEN p_type LIKE 'MEDIUM%' THEN 'Mnddstrct 1'
            WHEN p_type LIKE 'STANDARD%' THEN 'iCT-PTSD'
            WHEN p_type LIKE 'LARGE%' THEN 'OCD online'
            WHEN p_type LIKE 'ECONOMY%' AND l_linenumber % 2 = 0 THEN 'Other tool'
            ELSE NULL END AS product,
       l_linestatus AS integrated,
       CASE WHEN l_partkey % 11 = 0 THEN NULL
            WHEN l_partkey % 13 = 0 THEN 0
            WHEN l_partkey % 17 = 0 THEN -CAST(l_quantity AS INT)
            ELSE CAST(l_quantity AS INT) END AS minutes,
       d + CAST(l_partkey % 40 - 20 AS INT) AS start_date,
       d + CAST(l_partkey % 40 - 20 + l_linenumber % 3 AS INT) AS end_date
FROM {lines}""",

    "care_contact": """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN -l_orderkey ELSE l_orderkey END AS pathway_id,
       ym * 10 + a AS submission_id,
       a AS audit_id,
       l_orderkey * 1000000 + ym AS unique_month_id,
       d + CAST(l_partkey % 30 - 15 AS INT) AS contact_date
FROM {lines}""",

    "care_activity": """
SELECT l_orderkey AS pathway_id,
       ym * 10 + a AS submission_id,
       a AS audit_id,
       CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS minutes
FROM {lines}""",

    "assessment": f"""
SELECT CAST((event_id - event_id % 4) / 4 AS BIGINT) AS pathway_id,
       {_case_index('CAST((event_id - event_id % 2) / 2 AS BIGINT) % 12', _CODE_INDEX, "'999999999999999'")} AS code,
       {_case_index('event_id % 8', _SCORE_INDEX, "'N'")} AS score,
       CAST(ts AS DATE) AS effective_from
FROM {{events}}""",

    "terminology": f"""
SELECT concept_id, term, type_id, is_latest, active
FROM (VALUES
  {_terminology_values()}
) AS t(concept_id, term, type_id, is_latest, active)""",

    "commissioner_hierarchy": """
SELECT 'C' || CAST(n.n_nationkey AS STRING) AS org_code,
       n.n_name AS org_name,
       'I' || CAST(r.r_regionkey AS STRING) || '-' || CAST(n.n_nationkey % 2 AS STRING) AS icb_code,
       r.r_name || ' ICB ' || CAST(n.n_nationkey % 2 AS STRING) AS icb_name,
       'R' || CAST(r.r_regionkey AS STRING) AS region_code,
       r.r_name AS region_name,
       CASE WHEN n.n_nationkey % 4 = 3 THEN DATE '2000-01-01' ELSE NULL END AS effective_to
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey""",

    "commissioner_succession": """
SELECT 'C' || CAST(n_nationkey AS STRING) AS old_code,
       'C' || CAST((n_nationkey + 1) % 25 AS STRING) AS new_code
FROM {nation}
WHERE n_nationkey % 5 = 0
UNION ALL
SELECT 'C' || CAST(n_nationkey AS STRING) AS old_code,
       'C' || CAST((n_nationkey + 2) % 25 AS STRING) AS new_code
FROM {nation}
WHERE n_nationkey = 10""",

    "provider_hierarchy": """
SELECT 'P' || CAST(s.s_suppkey AS STRING) AS org_code,
       s.s_name AS org_name,
       r.r_name AS region_name,
       CASE WHEN s.s_suppkey % 10 = 9 THEN DATE '2000-01-01' ELSE NULL END AS effective_to
FROM {supplier} s
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT 'P' || CAST(s_suppkey AS STRING) AS org_code, s_name || ' (second entry)' AS org_name,
       'ELSEWHERE' AS region_name, CAST(NULL AS DATE) AS effective_to
FROM {supplier}
WHERE s_suppkey = 7""",

    "provider_succession": """
SELECT 'P' || CAST(s_suppkey AS STRING) AS old_code,
       'P' || CAST(s_suppkey - 1 AS STRING) AS new_code
FROM {supplier}
WHERE s_suppkey % 6 = 5""",
}

SOURCE_TABLES = [
    "referral", "digital_log", "care_contact", "care_activity", "assessment", "terminology",
    "submission_register", "commissioner_succession", "commissioner_hierarchy",
    "provider_succession", "provider_hierarchy", "calendar",
]

_PLACEHOLDER = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def dependencies(name: str) -> list[str]:
    """Names a view reads (driver tables or earlier views)."""
    return sorted(set(_PLACEHOLDER.findall(VIEWS[name])))


def duckdb_ctes(names: list[str]) -> list[tuple[str, str]]:
    """(name, body) CTEs for the given views and everything they read, in order."""
    needed: set[str] = set()

    def visit(n: str) -> None:
        if n in needed or n not in VIEWS:
            return
        for dep in dependencies(n):
            visit(dep)
        needed.add(n)

    for n in names:
        visit(n)
    return [(n, VIEWS[n].format(**{d: d for d in dependencies(n)}).strip())
            for n in VIEWS if n in needed]
