"""Reusable relational operators of the dashboards, as DataFrame plans."""

from pathwise.operators.orgs import (  # noqa: F401
    current_hierarchy, resolve_commissioner, resolve_org, resolve_provider,
)
from pathwise.operators.ranking import newest_only, rank_newest  # noqa: F401
from pathwise.operators.rollup import (  # noqa: F401
    Avg, AvgOfParts, Count, Measure, Sum, buckets_column, level_bucket_rollup, levels_column,
)
from pathwise.operators.versions import (  # noqa: F401
    ReportingWindow, latest_only, latest_register, reporting_window,
)
