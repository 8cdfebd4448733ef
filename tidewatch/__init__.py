"""tidewatch: data observability on Spark.

Metrics, monitors, metadata snapshots and their diffs, ETL run checks and
lineage, all expressed as DataFrame / SQL / Structured Streaming plans.
"""

__version__ = "0.1.0"
