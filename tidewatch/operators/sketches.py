"""Metric state that merges (E34, M5-M19, SRC14, MON1).

A state row holds what a column's metrics of one bucket and segment need, in a
form that adds up: counts, sums, extremes, squared deviations, a HyperLogLog
sketch of the values' hashes and a KLL sketch of the numbers. Day rows are
written once (``sinks.write_observations``); a week, a month, all time or a
coarser segment is a merge of such rows and never reads the table again.

Errors: a KLL sketch of size ``KLL_K`` gives quantiles whose rank is off by
``RANK_ERROR`` at most (99 %, merged or not); the distinct count is off by
about 1.04 / sqrt(2 ** HLL_BITS), 1.6 %, as one standard deviation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import exprs as E
from tidewatch.functions.metrics import NUMERIC, kinds_of

KLL_K, RANK_ERROR = 800, 0.005
HLL_BITS = 12


_STATE = ("rows", "filled", "numbers", "total", "m2", "least", "most", "distinct_state", "quantile_state", "conditions")


def metric_state(df: DataFrame, table_id: str, columns: Sequence[str], time_col: str, grain: str = "day",
                 segments: Sequence[str] = (), conditions: Mapping[str, Column] | None = None,
                 extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per bucket, segment and column: (table_id, segments.., column_name,
    bucket_start, rows, filled, numbers, total, m2, least, most, distinct_state,
    quantile_state, conditions). One scan; a column that is no number has only
    its counts and its distinct sketch. ``conditions``: named row conditions,
    each counted as one element of an array, in the order given. ``extra``:
    further aggregates, which a merge leaves out."""
    asked = list((conditions or {}).items())
    holds = F.array(*[F.coalesce(c, F.lit(False)) for _, c in asked]) if asked else F.array().cast("array<boolean>")
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = [F.struct(F.lit(c).alias("column_name"),
                      (F.col(f"`{c}`") if NUMERIC in kinds_of(types[c]) else F.lit(None)).cast("double").alias("x"),
                      F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`"))).alias("h")) for c in columns]
    long = df.select(*segments, F.col(time_col).alias("at"), E.bucket(time_col, grain).alias("bucket_start"), holds.alias("holds"),
                     F.explode(F.array(*cells)).alias("v")).select(*segments, "at", "bucket_start", "holds", "v.*")
    x = F.col("x")
    counts = [F.count_if(F.get("holds", F.lit(i))) for i in range(len(asked))]
    return long.groupBy(F.lit(table_id).alias("table_id"), *segments, "column_name", "bucket_start").agg(
        F.count("*").alias("rows"), F.count("h").alias("filled"), F.count("x").alias("numbers"), F.sum("x").alias("total"),
        (F.var_pop("x") * F.count("x")).alias("m2"), F.min("x").alias("least"), F.max("x").alias("most"),
        F.hll_sketch_agg("h", F.lit(HLL_BITS)).alias("distinct_state"),
        F.kll_sketch_agg_double(F.when(~F.isnan(x), x), F.lit(KLL_K)).alias("quantile_state"),
        (F.array(*counts) if asked else F.array().cast("array<bigint>")).alias("conditions"),
        *[c.alias(n) for n, c in (extra or {}).items()])


def merge_state(state: DataFrame, grain: str | None = None, segments: Sequence[str] = (), conditions: int = 0) -> DataFrame:
    """State rows of a coarser ``grain`` (None: all time, bucket_start NULL)
    and of the segments that are kept, with the counts of the first
    ``conditions`` conditions."""
    at = E.bucket("bucket_start", grain) if grain else F.lit(None).cast("timestamp_ntz")
    by = ["table_id", *segments, "column_name", "__at"]
    rows, n, t = state.withColumn("__at", at), F.col("numbers"), F.col("total")
    # squared deviations from the common mean, which is found first: sums of
    # squares would lose them where the mean is large
    means = rows.groupBy(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(by)]).agg(
        F.try_divide(F.sum(t), F.sum(n).cast("double")).alias("__mean"))
    rows = rows.join(means, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r{i}")) for i, k in enumerate(by)]))
    away = F.try_divide(t, n.cast("double")) - F.col("__mean")
    return rows.groupBy(*by[:-1], F.col("__at").alias("bucket_start")).agg(
        F.sum("rows").alias("rows"), F.sum("filled").alias("filled"), F.sum(n).alias("numbers"), F.sum(t).alias("total"),
        F.sum(F.col("m2") + n * away * away).alias("m2"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_union_agg("distinct_state").alias("distinct_state"), F.kll_merge_agg_double("quantile_state").alias("quantile_state"),
        (F.array(*[F.sum(F.get("conditions", F.lit(i))) for i in range(conditions)]) if conditions
         else F.array().cast("array<bigint>")).alias("conditions"))


def quantile_of(state: Column | str, p: float) -> Column:
    """A quantile from a merged state; NULL without numbers."""
    c = F.col(state) if isinstance(state, str) else state
    return F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(float(p))))


def state_metrics(state: DataFrame, points: Sequence[float] = (0.2, 0.4, 0.5, 0.6, 0.8), conditions: Sequence[str] = ()) -> DataFrame:
    """The metrics that a state answers, as columns named like the metrics and
    the conditions."""
    keys = [c for c in state.columns if c not in _STATE]
    distinct = F.hll_sketch_estimate("distinct_state")
    names = {p: "numeric_median" if p == 0.5 else f"percentile_{round(100 * p)}" for p in points}
    return state.select(
        *keys, F.col("rows").alias("row_count"), F.try_divide("total", F.col("numbers").cast("double")).alias("numeric_mean"),
        F.sqrt(F.try_divide("m2", F.nullif(F.col("numbers") - 1, F.lit(0)).cast("double"))).alias("numeric_stddev"),
        F.col("total").alias("sum"), distinct.alias("approx_distinct_count"),
        F.try_divide(distinct.cast("double"), F.col("filled").cast("double")).alias("approx_distinctness"),
        *[quantile_of("quantile_state", p).alias(n) for p, n in names.items()],
        *[F.get("conditions", F.lit(i)).alias(n) for i, n in enumerate(conditions)])
