"""The reference's jobs (J01-J18) as DataFrame plans, and the monthly refresh."""

from pathwise.plans.refresh import DASHBOARDS, MonthlyRefresh  # noqa: F401
