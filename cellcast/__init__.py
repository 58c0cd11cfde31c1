"""cellcast: point incidents to daily cell risk, as Spark DataFrame jobs."""

__version__ = "0.1.0"
