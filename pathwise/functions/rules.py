"""Label rules of the care-pathway dashboards.

Everything in this module is data: ordered rule lists that the Column
builders in ``labels.py`` turn into ``CASE WHEN`` chains, and that the DuckDB
oracle turns into SQL.  The texts must equal the published dashboards' texts
character for character, so they are stated once, here.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the published dashboards; do not edit)
# ---------------------------------------------------------------------------

NO_PRODUCT = "No IET"
NO_ORG = "Other"

# Canonical digital-therapy product by name prefix; first matching rule wins,
# NULL becomes NO_PRODUCT, anything else is kept unchanged.
PRODUCT_PREFIXES = [
    ("SilverCloud", ("SilverCloud", "Slvrcld")),
    ("Minddistrict", ("Mnddstrct", "Minddistrict")),
    ("iCT", ("iCT",)),
    ("OCD-NET", ("OCD",)),
]

# Reason for ending treatment; anything else (NULL included) -> END_CODE_DEFAULT.
END_CODES = [
    ("", "Referred but not seen/Seen but not taken on for a course of treatment/Seen and taken on for a course of treatment"),
    ("50", "Not assessed"),
    ("10", "Not suitable for IAPT service - no action taken or directed back to referrer"),
    ("11", "Not suitable for IAPT service - signposted elsewhere with mutual agreement of patient"),
    ("12", "Discharged by mutual agreement following advice and support"),
    ("13", "Referred to another therapy service by mutual agreement"),
    ("14", "Suitable for IAPT service, but patient declined treatment that was offered"),
    ("16", "Incomplete Assessment (Patient dropped out)"),
    ("17", "Deceased (Seen but not taken on for a course of treatment)"),
    ("95", "Not Known (Seen but not taken on for a course of treatment)"),
    ("46", "Mutually agreed completion of treatment"),
    ("47", "Termination of treatment earlier than Care Professional planned"),
    ("48", "Termination of treatment earlier than patient requested"),
    ("49", "Deceased (Seen and taken on for a course of treatment)"),
    ("96", "Not Known (Seen and taken on for a course of treatment)"),
]
END_CODE_DEFAULT = "Missing/invalid"

# Problem descriptor, part 1: higher category (or primary complaint) -> label.
PROBLEM_TOP = [
    ("Depression", "F32 or F33 - Depression"),
    ("Unspecified", "Unspecified"),
    ("Other recorded problems", "Other recorded problems"),
    ("Other Mental Health problems", "Other Mental Health problems"),
    ("Invalid Data supplied", "Invalid Data supplied"),
]
# Part 2: when the higher category (or primary complaint) is ANXIETY_TOTAL,
# the lower category (or secondary complaint) picks the label, in this order.
ANXIETY_TOTAL = "Anxiety and stress related disorders (Total)"
PROBLEM_ANXIETY = [
    ("83482000 Body Dysmorphic Disorder", "83482000 Body Dysmorphic Disorder"),
    ("F400 - Agoraphobia", "F400 - Agoraphobia"),
    ("F401 - Social phobias", "F401 - Social Phobias"),
    ("F402 - Specific (isolated) phobias", "F402 care- Specific Phobias"),
    ("F410 - Panic disorder [episodic paroxysmal anxiety", "F410 - Panic Disorder"),
    ("F411 - Generalised Anxiety Disorder", "F411 - Generalised Anxiety"),
    ("F412 - Mixed anxiety and depressive disorder", "F412 - Mixed Anxiety"),
    ("F42 - Obsessive-compulsive disorder", "F42 - Obsessive Compulsive"),
    ("F431 - Post-traumatic stress disorder", "F431 - Post-traumatic Stress"),
    ("F452 Hypochondriacal Disorders", "F452 - Hypochondrial disorder"),
    ("Other F40-F43 code", "Other F40 to 43 - Other Anxiety"),
]
PROBLEM_NO_CODE = "No Code"
PROBLEM_OTHER = "Other"

# Severity bands, inclusive bounds; None = open upper end.  No match -> NULL.
GAD7_BANDS = [
    (0, 4, "Minimal Anxiety"),
    (5, 9, "Mild Anxiety"),
    (10, 14, "Moderate Anxiety"),
    (15, None, "Severe Anxiety"),
]
PHQ9_BANDS = [
    (0, 4, "None-Minimal"),
    (5, 9, "Mild"),
    (10, 14, "Moderate"),
    (15, 19, "Moderate Severe"),
    (20, 27, "Severe"),
]

# Usage mix of a pathway (digital contacts vs all treatment contacts).
MIX_NONE = "No IET"
MIX_ONLY = "Only IET"
MIX_MIXED = "Mixed IET and No IET"

# Questionnaire question codes, by answer family, and term -> short label.
TREATMENT_CODES = [
    "747901000000107", "747911000000109", "747921000000103",
    "747931000000101", "747941000000105", "747951000000108",
]
ASSESSMENT_CODES = ["747861000000100", "747871000000107", "747881000000109", "904691000000103"]
SATISFACTION_CODES = ["747891000000106"]
QUESTION_CODES = TREATMENT_CODES + ASSESSMENT_CODES + SATISFACTION_CODES

QUESTION_TERMS = [
    ("Improving Access to Psychological Therapies assessment Patient Experience Questionnaire choice question 1 score (observable entity)", "Assessment Question 1"),
    ("Improving Access to Psychological Therapies assessment Patient Experience Questionnaire choice question 2 score (observable entity)", "Assessment Question 2"),
    ("Improving Access to Psychological Therapies assessment Patient Experience Questionnaire choice question 3 score (observable entity)", "Assessment Question 3"),
    ("Improving Access to Psychological Therapies assessment Patient Experience Questionnaire choice question 4 score (observable entity)", "Assessment Question 4"),
    ("Improving Access to Psychological Therapies assessment Patient Experience Questionnaire satisfaction question 1 score (observable entity)", "Satisfaction Assessment Question 1"),
    ("Improving Access to Psychological Therapies treatment Patient Experience Questionnaire question 1 score (observable entity)", "Treatment Question 1"),
    ("Improving Access to Psychological Therapies treatment Patient Experience Questionnaire question 2 score (observable entity)", "Treatment Question 2"),
    ("Improving Access to Psychological Therapies treatment Patient Experience Questionnaire question 3 score (observable entity)", "Treatment Question 3"),
    ("Improving Access to Psychological Therapies treatment Patient Experience Questionnaire question 4 score (observable entity)", "Treatment Question 4"),
    ("Improving Access to Psychological Therapies treatment Patient Experience Questionnaire question 5 score (observable entity)", "Treatment Question 5"),
    ("Improving Access to Psychological Therapies treatment Patient Experience Questionnaire question 6 score (observable entity)", "Treatment Question 6"),
]
# Terminology rows used: fully specified names, latest and active only.
TERM_TYPE_FSN = 900000000000003001

# Answer label by (code family, score); no match -> NULL.
ANSWERS = [
    (TREATMENT_CODES, [("0", "Never"), ("1", "Rarely"), ("2", "Sometimes"), ("3", "Most of the time"),
                       ("4", "All of the time"), ("NA", "Not applicable")]),
    (ASSESSMENT_CODES, [("Y", "Yes"), ("N", "No"), ("NA", "Not applicable")]),
    (SATISFACTION_CODES, [("0", "Not satisfied at all"), ("1", "Not satisfied"),
                          ("2", "Neither satisfied or Dis-satisfied"), ("3", "Mostly satisfied"),
                          ("4", "Completely satisfied")]),
]

TIME_NOT_RECORDED = "No Therapist Time Recorded"
TIME_RECORDED = "Therapist Time Recorded"

# Usage buckets; 2+ is a subset of 1+.
BUCKET_ONE = "1+ IET"
BUCKET_TWO = "2+ IET"
BUCKET_NONE = "No IET"

# Organisation levels: (org_type, region column, name column, code column);
# a plain string is a constant, a tuple ("col", name) a base column.
ORG_LEVELS = [
    ("National", "All Regions", "England", "ENG"),
    ("Region", ("col", "region_name_comm"), ("col", "region_name_comm"), ("col", "region_code_comm")),
    ("ICB", ("col", "region_name_comm"), ("col", "icb_name"), ("col", "icb_code")),
    ("Sub-ICB", ("col", "region_name_comm"), ("col", "subicb_name"), ("col", "subicb_code")),
    ("Provider", ("col", "region_name_prov"), ("col", "provider_name"), ("col", "provider_code")),
]

# Defaults of the reporting window.
FIRST_REPORTING_DATE = "2020-09-01"
REFRESH_LAG_MONTHS = 1

# ---------------------------------------------------------------------------
# Derived names (not fixed values)
# ---------------------------------------------------------------------------

# The nine geography columns every base carries, commissioner side first.
GEO_COLUMNS = [
    "subicb_code", "subicb_name", "icb_code", "icb_name", "region_name_comm",
    "region_code_comm", "provider_code", "provider_name", "region_name_prov",
]
ORG_COLUMNS = ["org_type", "region", "org_name", "org_code"]
