"""pathwise: care-pathway outcome dashboards as Spark DataFrame plans."""

__version__ = "0.1.0"
