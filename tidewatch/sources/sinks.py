"""Sinks: metric results, validation errors and coverage
as partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_observations(df: DataFrame, path: str, date_col: str = "metric_date", time_col: str | None = None,
                       fmt: str = "parquet") -> None:
    """Write results partitioned by ``date_col``, and by ``table_id`` before it
    where there is one, with dynamic partition overwrite: re-running a window
    of a table replaces its partitions only, so a retried job (lost executor,
    re-run) is idempotent and tables share a path."""
    out = df if date_col in df.columns or time_col is None else df.withColumn(date_col, F.to_date(time_col))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*[c for c in ("table_id",) if c in out.columns], date_col).format(fmt).save(path))
