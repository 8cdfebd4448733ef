"""Event sources: pushed metadata, query logs,
ETL assets and runs, paging. Readers take fixed schemas: no inference pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import exprs as E
from tidewatch.schemas import ASSET, RUN, TABLE


def read_pushed_metadata(spark: SparkSession, path: str, schema: T.StructType = TABLE) -> DataFrame:
    """SRC7: metadata pushed by an outside system as JSON lines, read with the
    TABLE schema (same rows as the own inventory)."""
    return spark.read.schema(schema).json(path)


def _bound(v) -> Column:
    if v is None:
        raise ValueError("both window bounds are required")
    return E.as_of(v)


def query_log_scan(logs: DataFrame, start, end, limit: int | None = None, offset: int = 0,
                   time_col: str = "start_time") -> DataFrame:
    """SRC8: queries with start_time in [start, end) (datetime or text bounds),
    ordered by (start_time, query_id) so pages are stable, then paged. The
    range is on the raw column so date-partitioned logs prune."""
    df = logs.where((F.col(time_col) >= _bound(start)) & (F.col(time_col) < _bound(end)))
    df = df.orderBy(time_col, "query_id")
    if offset:
        df = df.offset(offset)
    return df.limit(limit) if limit is not None else df


def read_assets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC9: ETL assets as JSON lines, with the ASSET schema, plus the raw text
    (``raw``) for the type checks of the validators."""
    typed = spark.read.schema(ASSET).json(path)
    raw = spark.read.text(path).select(F.col("value").alias("raw"))
    return typed, raw


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run events as JSON lines with the RUN schema, their times as UTC wall
    time: zones are converted, and a time that is none becomes NULL (its text
    stays in ``<column>_text``), so it ends no job and is in no window."""
    runs = spark.read.schema(RUN).json(path)
    times = ("event_time", "start_time", "end_time")
    return runs.withColumns({f"{c}_text": F.col(c) for c in times} | {c: E.string_to_ts(c) for c in times})


def runs_in_window(runs: DataFrame, start, end, time_col: str = "event_time") -> DataFrame:
    """SRC10: polling mode: runs in the fixed half-open window [start, end).
    Both bounds are required; the same bounds are used for every page, so
    tiled windows never skip or double a run. Times that are text are read as
    ``string_to_ts`` does."""
    lo, hi = _bound(start), _bound(end)
    at = F.col(time_col)
    if isinstance(runs.schema[time_col].dataType, T.StringType):
        at = E.string_to_ts(at)
    return runs.where((at >= lo) & (at < hi))


def runs_by_id(spark: SparkSession, runs: DataFrame, ids: Sequence[str],
               key: str = "run_source_id") -> tuple[DataFrame, DataFrame]:
    """SRC11: webhook mode: (runs whose id was asked, asked ids not found).

    The id list is built on the driver, so its size is known; it is
    broadcast and joined left_semi / left_anti."""
    idf = F.broadcast(spark.createDataFrame([(i,) for i in ids], f"{key} string"))
    found = runs.join(idf, key, "left_semi")
    # only runs that were asked for reach this join, not the whole table
    missing = idf.join(found.select(key).distinct(), key, "left_anti")
    return found, missing


def page(df: DataFrame, order: Sequence[str], limit: int, offset: int = 0) -> DataFrame:
    """SRC12: stable page of an ordered result (order must end in a unique
    key). Deep offsets sort globally: prefer :func:`keyset_page`."""
    out = df.orderBy(*order)
    return (out.offset(offset) if offset else out).limit(limit)


def keyset_page(df: DataFrame, key: str | Sequence[str], after, limit: int) -> DataFrame:
    """Keyset paging: the next ``limit`` rows after the last key seen; a top-n
    per partition instead of a global sort with offset. ``key`` may be several
    columns, of which the last ones make it unique, with ``after`` their
    values; NULLs come first. ``after=None`` starts."""
    keys = [key] if isinstance(key, str) else list(key)
    if after is not None:
        seen = [after] if isinstance(key, str) else list(after)
        later, same = F.lit(False), F.lit(True)
        for k, v in zip(keys, seen, strict=True):
            beyond = F.col(k).isNotNull() if v is None else F.coalesce(F.col(k) > F.lit(v), F.lit(False))
            later, same = later | (same & beyond), same & F.col(k).eqNullSafe(F.lit(v))
        df = df.where(later)
    return df.orderBy(*keys).limit(limit)
