"""Legacy data consolidation as native Spark DataFrame jobs."""

__version__ = "0.1.0"
