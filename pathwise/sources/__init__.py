"""Source tables (readers and fixture derivations) and sinks."""

from pathwise.sources.tables import Sources, driver_sources  # noqa: F401
