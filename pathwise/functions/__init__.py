"""Row-wise derivations as built-in Column expressions."""

from pathwise.functions import rules  # noqa: F401
from pathwise.functions.labels import (  # noqa: F401
    answer_label, band, canonical_product, count_once, end_code_label, gad7_band, month_key,
    org_default, outcome_flag, phq9_band, problem_label, product_or_default, question_label,
    time_recorded_flag, truthy, usage_mix, wait_days,
)
