"""Monitors.

Design rules kept throughout:
* all metrics of a table come from one aggregation per batch of about 60
  expressions (wide aggregations fall off a cliff past that);
* aggregation happens before any join, so shuffles move groups, not rows;
* results are DataFrames; the driver gets what a docstring bounds at most;
* broadcast is only used for tables built on the driver from a list whose
  length is known; everything else is left to AQE, which converts joins to
  broadcast from measured sizes.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import exprs as E
from tidewatch.functions.metrics import REGISTRY, Ctx, kind_table, metrics_for
from tidewatch.operators.base_terms import profile_terms
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.session import scratch_path

DEFAULT_BATCH = 60
SPREAD_MIN_EXPRS = 16
# estimated input that is spread over the cores: a few splits of a table
SPREAD_MAX_BYTES = 1 << 30
GRAIN_STEP = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY",
              "month": "INTERVAL 1 MONTH", "year": "INTERVAL 1 YEAR"}


@dataclass(frozen=True)
class MetricSpec:
    metric: str
    column: str | None = None
    alias: str | None = None

    @property
    def name(self) -> str:
        if self.alias:
            return self.alias
        return self.metric if self.column is None else f"{self.column}__{self.metric}"


def _spec(x) -> MetricSpec:
    if isinstance(x, MetricSpec):
        return x
    if isinstance(x, str):
        return MetricSpec(x)
    return MetricSpec(x[1], x[0], x[2] if len(x) > 2 else None)


def _join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join two aggregated frames on their group keys, NULL-safe."""
    if not keys:
        left, right = left.withColumn("__one", F.lit(1)), right.withColumn("__one", F.lit(1))
        return left.join(right, "__one", how).drop("__one")
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"__r_{k}")
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    out = left.join(r, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def spread(df: DataFrame, n_exprs: int, n_batches: int = 1, heavy: bool = False) -> DataFrame:
    """Round-robin the rows over the session's cores when CPU-heavy work
    (many aggregate expressions, or regexes over text) would otherwise run
    in a handful of tasks: an input of a few file splits. Batches run as
    parallel stages, so they count as tasks too. The rule reads Catalyst's size
    estimate of the plan and starts no job; an input of more than
    ``SPREAD_MAX_BYTES``, or of unknown size, is left as it is read."""
    if df.isStreaming or (n_exprs < SPREAD_MIN_EXPRS and not heavy):
        return df             # a stream is partitioned by its source
    target = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(target) if n_batches < target and size <= SPREAD_MAX_BYTES else df


def _chunks(items: list, n: int) -> list[list]:
    return [items[i:i + n] for i in range(0, len(items), n)] or [[]]


def _plan_exprs(df: DataFrame, specs: list[MetricSpec], ctx_base: Ctx, exact: bool):
    """Split specs into aggregate expressions, percentile groups, exact
    distinct passes and post-aggregation expressions."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    aggs: list[tuple[str, Column]] = []
    qgroups: dict[str, list[float]] = {}
    distinct_cols: list[str] = []
    post: list[tuple[str, object]] = []
    for s in specs:
        m = REGISTRY.get(s.metric)
        if m is None:
            raise KeyError(f"unknown metric {s.metric!r}")
        if m.needs_column and s.column is None:
            raise ValueError(f"metric {s.metric!r} needs a column")
        if m.post:
            post.append((s.name, "row_count_change"))
            continue
        x = F.col(s.column) if s.column else F.lit(1)
        ctx = Ctx(as_of=ctx_base.as_of, exact=exact, dtype=dtypes.get(s.column))
        if m.quantile is not None:
            ps = m.quantile if isinstance(m.quantile, tuple) else (m.quantile,)
            qgroups.setdefault(s.column, [])
            for p in ps:
                if p not in qgroups[s.column]:
                    qgroups[s.column].append(p)
            post.append((s.name, ("quantile", s.column, ps, isinstance(m.quantile, tuple))))
            continue
        if m.distinct and exact:
            if s.column not in distinct_cols:
                distinct_cols.append(s.column)
            post.append((s.name, ("distinct", s.column, s.metric)))
            if s.metric == "approx_distinctness":
                aggs.append((f"__nn__{s.column}", F.count(x)))
            continue
        aggs.append((s.name, m.build(x, ctx)))
    for c, ps in qgroups.items():
        qgroups[c] = sorted(ps)
        if not exact:        # exact ones are selected by a pass of their own
            aggs.append((f"__q__{c}", E.percentile(c, qgroups[c])))
    return aggs, qgroups, distinct_cols, post


def metric_monitor(df: DataFrame, metrics: Iterable, time_col: str | None = None,
                   grain: str | None = None, segments: Sequence = (), where: Column | None = None,
                   window: tuple | None = None, as_of=None, exact: bool = False,
                   fill: bool = False, batch_size: int = DEFAULT_BATCH) -> DataFrame:
    """MON1: metrics per time bucket and segment, in one scan per batch.

    ``metrics``: MetricSpec, (column, metric[, alias]) or a row-metric name.
    ``window``: half-open [start, end) range on the raw time column, so the
    parquet scan prunes row groups. ``exact`` swaps sketches for exact twins;
    exact percentiles are selected at once, so they start jobs of their own.
    ``fill`` adds empty buckets between the first and last bucket of each
    segment (counts 0, other metrics NULL) before ``row_count_change``.
    """
    specs = [_spec(m) for m in metrics]
    at = E.as_of(as_of)
    base = df
    if window is not None:
        if time_col is None:
            raise ValueError("window needs time_col")
        lo, hi = window
        base = base.where((F.col(time_col) >= E.lit(lo)) & (F.col(time_col) < E.lit(hi)))
    if where is not None:
        base = base.where(where)
    key_exprs: list[Column] = []
    keys: list[str] = []
    if grain:
        if time_col is None:
            raise ValueError("grain needs time_col")
        key_exprs.append(E.bucket(time_col, grain).alias("bucket_start"))
        keys.append("bucket_start")
    for s in segments:
        # a segment is a column name or a (name, Column) pair
        if isinstance(s, str):
            key_exprs.append(F.col(s))
            keys.append(s)
        else:
            name, c = s
            key_exprs.append(c.alias(name))
            keys.append(name)

    aggs, qgroups, distinct_cols, post = _plan_exprs(base, specs, Ctx(as_of=at), exact)
    text_heavy = any(REGISTRY[sp.metric].kind == "string" for sp in specs)
    base = spread(base, len(aggs), max(1, -(-len(aggs) // batch_size)), heavy=text_heavy)
    need_rows = any(p[1] == "row_count_change" for p in post)
    if need_rows and not any(a == "__rows" for a, _ in aggs):
        aggs.append(("__rows", F.count(F.lit(1))))

    def agg(exprs):
        cols = [c.alias(a) for a, c in exprs]
        if key_exprs:
            return base.groupBy(*key_exprs).agg(*cols) if cols else base.select(*key_exprs).distinct()
        return base.agg(*cols) if cols else base.agg(F.count(F.lit(1)).alias("__rows"))

    # exact distinct: a single one stays in the aggregation (planned without
    # Expand); several get their own two-phase passes joined on the keys.
    single_distinct = len(distinct_cols) == 1 and len(aggs) < batch_size
    if single_distinct:
        c = distinct_cols[0]
        aggs.append((f"__d__{c}", F.count_distinct(F.col(c))))

    batches = _chunks(aggs, batch_size)
    out = agg(batches[0])
    for b in batches[1:]:
        out = _join_on_keys(out, agg(b), keys)

    if distinct_cols and not single_distinct:
        for c in distinct_cols:
            d = (base.where(F.col(c).isNotNull())
                 .select(*key_exprs, F.col(c)).distinct()
                 .groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias(f"__d__{c}")))
            out = _join_on_keys(out, d, keys)
            out = out.withColumn(f"__d__{c}", F.coalesce(F.col(f"__d__{c}"), F.lit(0)))

    if exact and qgroups:
        rows = base.select(*key_exprs, *[F.col(f"`{c}`").cast("double").alias(f"__q__{c}") for c in qgroups])
        out = _join_on_keys(out, exact_quantiles(rows, {f"__q__{c}": ps for c, ps in qgroups.items()}, keys), keys)

    if fill and grain:
        count_cols = {"__rows"} | {c for c in out.columns if c.startswith("__d__")} | {
            sp.name for sp in specs if sp.metric == "row_count" or sp.metric.endswith("_count")}
        out = _fill_buckets(out, keys, grain, [c for c in out.columns if c not in keys], count_cols)

    selected: list[Column] = [F.col(k) for k in keys]
    for s in specs:
        name = s.name
        p = dict(post).get(name)
        if p is None:
            selected.append(F.col(f"`{name}`"))
        elif p == "row_count_change":
            if grain:
                w = Window.partitionBy(*[F.col(k) for k in keys if k != "bucket_start"]) \
                    .orderBy("bucket_start")
                selected.append((F.col("__rows") - F.lag("__rows").over(w)).alias(name))
            else:
                selected.append(F.lit(None).cast("long").alias(name))
        elif p[0] == "quantile":
            _, c, ps, is_array = p
            q = F.col(f"__q__{c}")
            idx = [qgroups[c].index(v) + 1 for v in ps]
            if is_array:
                selected.append(F.array(*[F.element_at(q, i) for i in idx]).alias(name))
            else:
                selected.append(F.element_at(q, idx[0]).alias(name))
        elif p[0] == "distinct":
            _, c, metric = p
            d = F.col(f"__d__{c}").cast("long")
            if metric == "approx_distinct_count":
                selected.append(d.alias(name))
            else:
                selected.append(F.try_divide(d.cast("double"),
                                             F.col(f"__nn__{c}").cast("double")).alias(name))
    return out.select(*selected)


def _fill_buckets(out: DataFrame, keys: list[str], grain: str, agg_names: list[str],
                  counts: set[str]) -> DataFrame:
    """Empty buckets between the first and last bucket of each segment.

    Built per segment from its own range (sequence + explode): no cross join.
    """
    segs = [k for k in keys if k != "bucket_start"]
    step = F.expr(GRAIN_STEP[grain])
    ranges = (out.groupBy(*segs).agg(F.min("bucket_start").alias("__lo"), F.max("bucket_start").alias("__hi"))
              .select(*segs, F.explode(F.sequence("__lo", "__hi", step)).alias("bucket_start")))
    filled = _join_on_keys(ranges, out, keys, "left")
    # counts (row count, *_count metrics, exact distinct counts) are 0 in an
    # empty bucket; every other metric is NULL
    return filled.select(*[F.col(k) for k in keys],
                         *[(F.coalesce(F.col(f"`{n}`"), F.lit(0)) if n in counts else F.col(f"`{n}`")).alias(n)
                           for n in agg_names])


# ------------------------------------------------------------------ MON2, MON3

PROFILE_SKIP = {"approx_quantiles"}   # array valued; the six scalar cut points cover it


def profile_specs(df: DataFrame, columns: Sequence[str] | None = None) -> list[MetricSpec]:
    cols = columns or df.columns
    specs = [MetricSpec("row_count", None, "::row_count")]
    for f in df.schema.fields:
        if f.name not in cols:
            continue
        for m in metrics_for(f.dataType):
            if m in PROFILE_SKIP:
                continue
            specs.append(MetricSpec(m, f.name, f"{f.name}::{m}"))
    return specs


def profile(df: DataFrame, table_id: str = "table", columns: Sequence[str] | None = None,
            as_of=None, exact: bool = False, batch_size: int = DEFAULT_BATCH) -> DataFrame:
    """MON2: every metric that fits each column's type, in long form
    (table_id, column_name, metric, value).

    The metrics come from base terms in two scans of the table, whatever its
    width (see ``base_terms``). Metrics that are registered with an aggregate
    of their own are added in batches of ``batch_size``.
    """
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if columns is None or c in columns])
    kept = spread(kept, SPREAD_MIN_EXPRS)
    out, rest = profile_terms(kept, PROFILE_SKIP, as_of, exact)
    for chunk in _chunks([MetricSpec(m, c, f"{c}::{m}") for c, m in rest], batch_size) if rest else []:
        wide = metric_monitor(kept, chunk, as_of=as_of, exact=exact, batch_size=10 ** 6)
        cells = [F.struct(F.lit(s.column).alias("column_name"), F.lit(s.metric).alias("metric"),
                          F.col(f"`{s.name}`").cast("double").alias("value")) for s in chunk]
        out = out.unionByName(wide.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*"))
    return out.select(F.lit(table_id).alias("table_id"), "column_name", "metric", "value")


def applicable_metrics(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """MON3: (column_name, column_type, metric) for every metric a column
    supports. Metadata only: the column list comes from the schema, the
    (kind, metric) table from the registry; no scan of data."""
    from tidewatch.functions.metrics import kinds_of

    cols = [(f.name, f.dataType.simpleString(), sorted(kinds_of(f.dataType))) for f in schema.fields]
    cdf = spark.createDataFrame(cols, "column_name string, column_type string, kinds array<string>")
    ktab = spark.createDataFrame(kind_table(), "kind string, metric string")
    return (cdf.select("column_name", "column_type", F.explode("kinds").alias("kind"))
            .join(F.broadcast(ktab), "kind").select("column_name", "column_type", "metric"))


# ------------------------------------------------------------------ MON4

def capability_rollup(results: DataFrame, mapping: DataFrame) -> DataFrame:
    """MON4: template flags then metric flags.

    results: (test_no, template, status in passed/failed/skipped)
    mapping: (template, metric)
    Per template: any failure wins, else the status of the first result.
    Per metric: true only if all its templates with a result passed.
    """
    per_template = results.groupBy("template").agg(
        F.bool_or(F.col("status") == "failed").alias("any_failed"),
        F.min_by("status", "test_no").alias("first_status"))
    per_template = per_template.select(
        "template",
        F.when(F.col("any_failed"), F.lit("failed")).otherwise(F.col("first_status")).alias("template_status"))
    return (mapping.join(per_template, "template")
            .groupBy("metric")
            .agg(F.bool_and(F.col("template_status") == "passed").alias("supported")))


# ------------------------------------------------------------------ MON5

def custom_sql_monitor(spark: SparkSession, query: str, limit: int = 100) -> tuple[DataFrame, DataFrame]:
    """MON5: (row count, capped preview) of a user query. The count projects
    no columns, the preview stops after ``limit`` rows; nothing is cached."""
    q = spark.sql(query)
    return q.agg(F.count(F.lit(1)).alias("row_count")), q.limit(limit)


# ------------------------------------------------------------------ MON6

RULE_OPS = ("eq", "gt", "gte", "lt", "lte", "inside", "outside")


def apply_rules(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """MON6: judge metric values against rules.

    metrics: long form with ``metric`` and ``value`` (plus any keys);
    rules: (rule_id, metric, operator, threshold, lower, upper).
    ``breached`` is true/false, NULL when the value is NULL. The join is left
    to AQE, which broadcasts the rules from their measured size.
    """
    v, t, lo, hi = F.col("value"), F.col("threshold"), F.col("lower"), F.col("upper")
    op = F.col("operator")
    ok = (F.when(op == "eq", v == t).when(op == "gt", v > t).when(op == "gte", v >= t)
          .when(op == "lt", v < t).when(op == "lte", v <= t)
          .when(op == "inside", v.between(lo, hi)).when(op == "outside", (v < lo) | (v > hi)))
    return metrics.join(rules, "metric").withColumn("breached", ok)


# ------------------------------------------------------------------ MON7-MON10

def row_count_change(snapshots: DataFrame, key: str = "table_id", time: str = "snapshot_time",
                     value: str = "row_count") -> DataFrame:
    """MON7: difference to the previous snapshot of the same table. The
    window is partitioned by table, never global."""
    w = Window.partitionBy(key).orderBy(time)
    return snapshots.withColumn("row_count_change", F.col(value) - F.lag(value).over(w))


def _trend(before: Column, after: Column) -> Column:
    return (F.when(before.isNull() & after.isNull(), F.lit(None))
            .when(before.isNull(), F.lit("created"))
            .when(after.isNull(), F.lit("dropped"))
            .when(after > before, F.lit("grew"))
            .when(after < before, F.lit("fell"))
            .otherwise(F.lit("same")))


def volume_monitor(before: DataFrame, after: DataFrame, key: str = "table_id") -> DataFrame:
    """MON8: row / byte count trend between two snapshots (full outer join on
    the lower-cased table id)."""
    b = before.select(F.lower(key).alias("__k"), F.col("row_count").alias("rows_before"),
                      F.col("byte_count").alias("bytes_before"))
    a = after.select(F.lower(key).alias("__k"), F.col("row_count").alias("rows_after"),
                     F.col("byte_count").alias("bytes_after"))
    j = b.join(a, "__k", "full_outer")
    return j.select(
        F.col("__k").alias(key), "rows_before", "rows_after",
        (F.col("rows_after") - F.col("rows_before")).alias("row_delta"),
        _trend(F.col("rows_before"), F.col("rows_after")).alias("row_trend"),
        "bytes_before", "bytes_after",
        _trend(F.col("bytes_before"), F.col("bytes_after")).alias("byte_trend"))


def freshness_monitor(snapshots: DataFrame, max_age_seconds: int, as_of=None,
                      key: str = "table_id", time: str = "last_update_time",
                      snapshot: str = "snapshot_time") -> DataFrame:
    """MON9: per table the latest update, its age at as_of, whether it is
    stale, and whether the last snapshot moved it forward."""
    at = E.as_of(as_of)
    w = Window.partitionBy(key).orderBy(snapshot)
    moved = snapshots.withColumn("__prev", F.lag(time).over(w))
    per = moved.groupBy(key).agg(
        F.max(time).alias("last_update_time"),
        F.max_by(F.col(time) > F.col("__prev"), F.col(snapshot)).alias("moved_forward"))
    age = E.epoch(at) - E.epoch(F.col("last_update_time"))
    return per.select(key, "last_update_time", age.alias("age_seconds"),
                      (age > max_age_seconds).alias("stale"), "moved_forward")


def schema_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """MON10: tables created / dropped, columns added / dropped / retyped.

    Inputs are COLUMN rows (full_table_id, column_name, column_type); names
    are compared lower-cased. One full outer join on (table, column).
    """
    def prep(df, sfx):
        return df.select(F.lower("full_table_id").alias("full_table_id"),
                         F.lower("column_name").alias("column_name"),
                         F.col("column_type").alias(f"type_{sfx}"))
    b, a = prep(before, "before"), prep(after, "after")
    j = b.join(a, ["full_table_id", "column_name"], "full_outer")
    t_before = F.max(F.col("type_before").isNotNull().cast("int")).over(Window.partitionBy("full_table_id"))
    t_after = F.max(F.col("type_after").isNotNull().cast("int")).over(Window.partitionBy("full_table_id"))
    j = j.withColumn("__tb", t_before).withColumn("__ta", t_after)
    change = (F.when(F.col("__tb") == 0, F.lit("table_created"))
              .when(F.col("__ta") == 0, F.lit("table_dropped"))
              .when(F.col("type_before").isNull(), F.lit("column_added"))
              .when(F.col("type_after").isNull(), F.lit("column_dropped"))
              .when(F.lower("type_before") != F.lower("type_after"), F.lit("column_retyped")))
    return (j.withColumn("change", change).where(F.col("change").isNotNull())
            .select("full_table_id", "column_name", "type_before", "type_after", "change"))


# ------------------------------------------------------------------ MON11-MON13

def query_captured(logs: DataFrame, statement: str, window: tuple | None = None) -> DataFrame:
    """MON11: logged queries whose lower-cased text contains the trimmed,
    lower-cased statement. The time range (on the raw column) goes first."""
    df = logs
    if window is not None:
        df = df.where((F.col("start_time") >= E.lit(window[0])) & (F.col("start_time") < E.lit(window[1])))
    return df.where(F.lower("query_text").contains(statement.strip().lower()))


def rca_sample(df: DataFrame, cond: Column, key: str, n: int, seed: str | int = 0) -> DataFrame:
    """MON12: repeatable sample of rows that break ``cond``."""
    return E.sample_rows(df.where(cond), key, n, seed)


def rca_summary(df: DataFrame, cond: Column, segments: Sequence[str], time_col: str | None = None) -> DataFrame:
    """MON13: per segment rows, breaching rows, breach rate, absolute distance
    to the overall rate, and latest time.

    The overall rate is a global aggregate of the segment result: exactly one
    row, so broadcasting it is size-bound. Both sides share the segment
    aggregation's exchange, so the table is scanned once; no global window
    funnels the segments into one task.
    """
    aggs = [F.count(F.lit(1)).alias("rows"), E.count_if(cond).alias("breaching_rows")]
    if time_col:
        aggs.append(F.max(time_col).alias("latest_time"))
    seg = df.groupBy(*segments).agg(*aggs)
    total = seg.agg((F.sum("breaching_rows") / F.sum("rows")).alias("__overall"))
    joined = _join_on_keys(seg, F.broadcast(total), [])
    rate = F.col("breaching_rows") / F.col("rows")
    return joined.select(*segments, "rows", "breaching_rows", rate.alias("breach_rate"),
                         F.abs(rate - F.col("__overall")).alias("rate_distance"),
                         *(["latest_time"] if time_col else []))


# ------------------------------------------------------------------ results as tables

ARRAY_METRICS = {"approx_quantiles"}


def observations(df: DataFrame, table_id: str, metrics: Iterable | None = None, time_col: str | None = None,
                 grain: str | None = None, segments: Sequence[str] = (), as_of=None, exact: bool = False,
                 batch_size: int = DEFAULT_BATCH) -> DataFrame:
    """Metric results in the OBSERVATION schema, one row per value:
    (table_id, column_name, metric, segment map, bucket_start, value, as_of).

    ``metrics`` defaults to every metric that fits each column (as
    ``profile``). The work is one ``metric_monitor`` run (one scan per batch);
    the wide result is unpivoted, so the rows are groups x metrics, never
    rows of the table. Feed it to ``sinks.write_observations``.
    """
    base = profile_specs(df) if metrics is None else [_spec(m) for m in metrics]
    specs = [MetricSpec(s.metric, s.column, f"{s.column or ''}::{s.metric}") for s in base
             if s.metric not in ARRAY_METRICS]
    at = E.as_of(as_of)
    wide = metric_monitor(df, specs, time_col=time_col, grain=grain, segments=segments, as_of=at, exact=exact,
                          batch_size=batch_size)
    seg_names = [s if isinstance(s, str) else s[0] for s in segments]
    keys = (["bucket_start"] if grain else []) + seg_names
    names = [s.name for s in specs]
    wide = wide.select(*keys, *[F.col(f"`{n}`").cast("double").alias(n) for n in names])
    long = wide.unpivot(keys, [F.col(f"`{n}`") for n in names], "__name", "value")
    seg = (F.create_map(*[x for k in seg_names for x in (F.lit(k), F.col(k).cast("string"))]) if seg_names
           else F.create_map().cast("map<string,string>"))
    split = F.split(F.col("__name"), "::", 2)
    return long.select(
        F.lit(table_id).alias("table_id"), F.nullif(split.getItem(0), F.lit("")).alias("column_name"),
        split.getItem(1).alias("metric"), seg.alias("segment"),
        (F.col("bucket_start") if grain else F.lit(None).cast("timestamp_ntz")).alias("bucket_start"),
        F.col("value"), at.alias("as_of"))


def rca_search(df: DataFrame, breach: Column, attributes: Sequence[str], min_share: float = 0.01, max_attributes: int = 3) -> DataFrame:
    """MON13, segments found rather than given: (segment, attributes, n,
    breaches, rate, parent_rate, gain) of every combination of values of up to
    ``max_attributes`` attributes that holds at least ``min_share`` of the rows.

    Level by level: a combination is counted only if all its parts were large
    enough at the level before. An attribute has at most 1 / ``min_share`` such
    values, so what a level keeps is small and bounded whatever the table's
    size; each level is one scan and one aggregation. ``parent_rate`` is the
    greatest breach rate among the segments with one attribute less, ``gain``
    the rate beyond it: what the combination adds to the explanation.
    """
    spark = df.sparkSession
    names = list(attributes)
    hit = F.coalesce(breach, F.lit(False)).cast("int").alias("__hit")
    # a value's place in its attribute is its text; NULL is a value of its own
    item = lambda a: F.concat(F.lit(f"{a}="), F.coalesce(F.col(f"`{a}`").cast("string"), F.lit("NULL")))
    rows = df.select(hit, F.array(*[item(a) for a in names]).alias("__items"))
    total = rows.agg(F.count("*").alias("n"), F.sum("__hit").alias("b")).first()
    least, bound = max(1.0, min_share * total["n"]), int(1 / min_share)
    none = spark.createDataFrame([([], total["n"], total["b"] or 0)], "segment array<string>, n long, breaches long")
    found, before = [], none.withColumn("rate", F.try_divide("breaches", F.col("n").cast("double")))
    for level in range(1, min(max_attributes, len(names)) + 1):
        picks = [list(c) for c in combinations(range(len(names)), level)]
        segments = F.array(*[F.array(*[F.get("__items", F.lit(i)) for i in c]) for c in picks])
        if level > 1:
            # the segments kept so far, as one list of known bound
            kept = [r[0] for r in before.select(F.array_join("segment", "\x1f")).limit(bound * len(picks) * level + 1).collect()]
            known = F.array(*[F.lit(k) for k in kept]).cast("array<string>")
            parts = lambda s: F.transform(F.sequence(F.lit(0), F.lit(level - 1)), lambda k: F.array_join(
                F.filter(s, lambda _, i: i != k), "\x1f"))
            segments = F.filter(segments, lambda s: F.forall(parts(s), lambda p: F.array_contains(known, p)))
        counted = (rows.select("__hit", F.explode(segments).alias("segment")).groupBy("segment")
                   .agg(F.count("*").alias("n"), F.sum("__hit").alias("breaches")).where(F.col("n") >= least)
                   .withColumn("rate", F.col("breaches") / F.col("n")))
        path = scratch_path(spark, "rca-level")
        counted.write.parquet(path)
        counted = spark.read.schema(counted.schema).parquet(path)
        up = counted.select("segment", F.explode(F.transform(F.sequence(F.lit(0), F.lit(level - 1)), lambda k: F.filter(
            "segment", lambda _, i: i != k))).alias("parent"))
        parents = before.select(F.col("segment").alias("parent"), F.col("rate").alias("parent_rate"))
        best = up.join(parents, "parent").groupBy("segment").agg(F.max("parent_rate").alias("parent_rate"))
        found.append(counted.join(best, "segment"))
        before = counted
    out = reduce(lambda a, b: a.unionByName(b), found)
    return out.select(F.array_join("segment", ", ").alias("segment"), F.size("segment").alias("attributes"), "n", "breaches", "rate",
                      "parent_rate", (F.col("rate") - F.col("parent_rate")).alias("gain"))
