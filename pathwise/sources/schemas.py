"""Schemas: what the jobs read from each source, and what each dashboard publishes.

The reference has no DDL; its working tables take whatever ``SELECT … INTO``
infers, and later inserts match by position.  Here every source has a
contract checked before a run, and every published table is written by name
with explicit types, so a change upstream fails loudly instead of shifting
columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns the jobs read, per source table (the neutral names of SURVEY §1.3).
SOURCE_SCHEMAS: dict[str, str] = {
    "referral": (
        "pathway_id bigint, submission_id bigint, audit_id int, unique_month_id bigint, "
        "received_date date, first_assessment_date date, first_therapy_date date, "
        "second_therapy_date date, discharge_date date, completed boolean, recovered boolean, "
        "not_case boolean, improved boolean, usable boolean, end_code string, "
        "higher_category string, primary_complaint string, lower_category string, "
        "second_complaint string, anxiety_score int, depression_score int, contact_count int, "
        "old_iet_count int, commissioner_id string, provider_id string"),
    "digital_log": (
        "pathway_id bigint, log_id bigint, submission_id bigint, audit_id int, "
        "unique_month_id bigint, product string, integrated string, minutes int, "
        "start_date date, end_date date"),
    "care_contact": ("pathway_id bigint, submission_id bigint, audit_id int, "
                     "unique_month_id bigint, contact_date date"),
    "care_activity": "pathway_id bigint, submission_id bigint, audit_id int, minutes int",
    "assessment": "pathway_id bigint, code string, score string, effective_from date",
    "terminology": "concept_id bigint, term string, type_id bigint, is_latest int, active int",
    "submission_register": ("submission_id bigint, audit_id int, is_latest int, "
                            "period_start date, period_end date"),
    "commissioner_succession": "old_code string, new_code string",
    "commissioner_hierarchy": ("org_code string, org_name string, icb_code string, "
                               "icb_name string, region_code string, region_name string, "
                               "effective_to date"),
    "provider_succession": "old_code string, new_code string",
    "provider_hierarchy": "org_code string, org_name string, region_name string, effective_to date",
    "calendar": "full_date date, quarter string",
}

_ORG = "org_type string, region string, org_name string, org_code string"

# The seven published tables, in publication column order.  Averages are
# decimal(38,6), rounded half up at the sixth place.
DASHBOARD_SCHEMAS: dict[str, str] = {
    "outcome_dashboard": (
        f"month date, {_ORG}, appointment_type string, iet_count bigint, product string, "
        "integrated string, end_code string, end_code_desc string, problem string, "
        "gad7_band string, phq9_band string, mix_class string, rec_flag bigint, "
        "not_case_flag bigint, rel_imp_flag bigint, rel_rec_flag bigint, comp_flag bigint"),
    "questionnaire_dashboard": (
        f"month date, {_ORG}, appointment_type string, iet_count bigint, product string, "
        "question string, answer string, comp_flag bigint"),
    "time_recorded_dashboard": (
        f"month date, {_ORG}, time_recorded string, product string, n_appointments bigint"),
    "wait_dashboard": (
        f"quarter string, {_ORG}, appointment_type string, avg_wait_ref_to_assess decimal(38,6), "
        "avg_wait_ref_to_therapy decimal(38,6), avg_wait_first_to_second decimal(38,6), comp_flag bigint"),
    "treatment_dashboard": (
        f"quarter string, {_ORG}, appointment_type string, product string, "
        "avg_iet_count decimal(38,6), avg_iet_minutes decimal(38,6), avg_any_minutes decimal(38,6), comp_flag bigint"),
    "digital_time_dashboard": (
        f"quarter string, {_ORG}, appointment_type string, product string, "
        "avg_iet_minutes decimal(38,6), comp_flag bigint"),
    "any_time_dashboard": (
        f"quarter string, {_ORG}, appointment_type string, product string, "
        "avg_any_minutes decimal(38,6), comp_flag bigint"),
}

# Flags the reference compares with 'True': text is accepted for them.
TEXT_FLAGS = {"completed", "recovered", "not_case", "improved", "usable"}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def problems(df: DataFrame, table: str) -> list[str]:
    """What in ``df`` breaks the contract of source ``table`` (empty if nothing)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in struct(SOURCE_SCHEMAS[table]).fields:
        got = have.get(f.name)
        if got is None:
            out.append(f"{table}.{f.name}: missing")
        elif isinstance(f.dataType, T.StringType) and isinstance(got, T.StringType):
            continue                                   # any collation
        elif f.name in TEXT_FLAGS and isinstance(got, T.StringType):
            continue
        elif got != f.dataType:
            out.append(f"{table}.{f.name}: {got.simpleString()}, expected "
                       f"{f.dataType.simpleString()}")
    return out


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select the schema's columns by name, cast to its types (no-op casts vanish)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in struct(ddl).fields])
