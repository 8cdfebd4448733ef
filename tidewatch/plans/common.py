"""Shared pieces of the registered queries: table access, rounding and the
decorator that pairs a Spark plan with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# fixed as-of instants of the registered queries (results must be repeatable)
AS_OF_EVENTS = "2024-01-20 12:00:00"
AS_OF_ORDERS = "2000-01-01 00:00:00"


def query(name: str, sql: str | None = None):
    """Register a Spark plan under ``name`` with its DuckDB oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            text = sql.strip()
            # oracle text may start with shared CTE definitions
            if not text.upper().startswith(("SELECT", "WITH", "(")):
                text = "WITH " + text
            ORACLE[name] = text
        return fn
    return deco


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def rnd(c: Column | str, n: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), n)


def rounded(df: DataFrame, *cols: str, n: int = 6) -> DataFrame:
    return df.select(*[rnd(c, n).alias(c) if c in cols else F.col(c) for c in df.columns])
