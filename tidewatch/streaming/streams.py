"""Streams: the batch contracts as Structured
Streaming queries.

Event time: parquet gives TIMESTAMP_NTZ (UTC wall time); watermarks and
windows need TIMESTAMP, so :func:`event_ts` converts through epoch
microseconds, which is independent of the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions import exprs as E
from tidewatch.functions.patterns import ERROR_STATUSES, FINAL_STATUSES
from tidewatch.operators.etl import normalize_status
from tidewatch.operators.monitors import GRAIN_STEP, _plan_exprs, _spec
from tidewatch.operators.sketches import merge_state, metric_state, state_metrics
from tidewatch.functions.metrics import Ctx


def event_ts(c: Column | str) -> Column:
    """TIMESTAMP_NTZ (UTC wall time) -> TIMESTAMP instant."""
    c = E.col(c)
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(E.EPOCH_NTZ).cast("timestamp_ntz"),
                                               c.cast("timestamp_ntz")))


def to_wall(c: Column | str) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ UTC wall time (session-zone free)."""
    c = E.col(c)
    return F.lit(E.EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(c) / 1_000_000).cast("decimal(18,6)"))


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


# ------------------------------------------------------------------ STR1

def stream_runs(runs: DataFrame, mapping: Mapping[str, str] | DataFrame | None, watermark: str = "1 hour",
                time_col: str = "event_time") -> DataFrame:
    """STR1: run events with the status normalised and repeated events
    (same run, status and time) dropped. State is bounded by the watermark.
    A dict map is a literal map expression; a DataFrame map is a
    stream-static join."""
    s = runs.withColumn("event_ts", event_ts(time_col))
    s = normalize_status(s, mapping)
    return (s.withWatermark("event_ts", watermark)
            .dropDuplicatesWithinWatermark(["run_source_id", "status", time_col]))


# ------------------------------------------------------------------ STR2

def stream_metrics(df: DataFrame, metrics: Iterable, time_col: str, window: str = "1 day",
                   watermark: str = "1 hour", segments: Sequence[str] = (), as_of=None) -> DataFrame:
    """STR2: metrics per tumbling window and segment (append mode: a window
    is emitted once the watermark passes its end; later rows are dropped and
    show up as ``numRowsDroppedByWatermark`` in the query progress).
    Exact distinct and exact percentiles are not available on streams; the
    sketches are used."""
    specs = [_spec(m) for m in metrics]
    s = df.withColumn("__ets", event_ts(time_col)).withWatermark("__ets", watermark)
    aggs, qgroups, distinct_cols, post = _plan_exprs(s, specs, Ctx(as_of=E.as_of(as_of)), exact=False)
    if any(p[1] == "row_count_change" for p in post):
        raise ValueError("row_count_change needs the previous window; run it on the written output")
    g = s.groupBy(F.window("__ets", window).alias("w"), *segments).agg(*[c.alias(a) for a, c in aggs])
    sel = [to_wall("w.start").alias("window_start"), to_wall("w.end").alias("window_end"), *segments]
    postd = dict(post)
    for sp in specs:
        p = postd.get(sp.name)
        if p is None:
            sel.append(F.col(f"`{sp.name}`"))
        else:
            _, c, ps, is_array = p
            q = F.col(f"__q__{c}")
            idx = [qgroups[c].index(v) + 1 for v in ps]
            sel.append((F.array(*[F.element_at(q, i) for i in idx]) if is_array
                        else F.element_at(q, idx[0])).alias(sp.name))
    return g.select(*sel)


class WindowMetrics:
    """STR2 with every late row counted: metrics per tumbling window (hour, day,
    week, ..) and segment from mergeable states (see ``sketches``). Use it as
    the ``foreachBatch`` function of a stream.

    Rows behind the watermark are told apart before anything is aggregated: a
    batch becomes one state row per window, segment, column and side (on time
    or late), written under its batch id, so a batch that is run again replaces
    itself and counts stay right over any number of batches. The watermark of
    a batch is the greatest event time of the batches before it less the
    ``delay``; a row is late if its window ended by then. ``closed`` merges the
    states of the windows that the watermark has passed.
    """

    def __init__(self, path: str, columns: Sequence[str], time_col: str, grain: str = "day", delay: str = "1 hour",
                 segments: Sequence[str] = (), conditions: Mapping[str, Column] | None = None, table_id: str = "stream"):
        self.path, self.columns, self.time_col, self.grain, self.delay = path, list(columns), time_col, grain, delay
        self.segments, self.conditions, self.table_id = list(segments), dict(conditions or {}), table_id

    def watermark(self, spark: SparkSession, before: int | None = None):
        """The watermark after the batches before ``before`` (all); None at first."""
        marks = _read_or_empty(spark, f"{self.path}/marks", "newest timestamp_ntz, batch_id long")
        marks = marks if before is None else marks.where(F.col("batch_id") < before)
        return marks.agg((F.max("newest") - F.expr(f"INTERVAL {self.delay}")).cast("timestamp_ntz")).first()[0]

    def _end(self) -> Column:
        return F.col("bucket_start") + F.expr(GRAIN_STEP[self.grain])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, mark = batch.sparkSession, self.watermark(batch.sparkSession, batch_id)
        states = metric_state(batch, self.table_id, self.columns, self.time_col, self.grain, self.segments, self.conditions,
                              {"newest": F.max("at")})
        late = F.lit(False) if mark is None else F.coalesce(self._end() <= F.lit(mark).cast("timestamp_ntz"), F.lit(False))
        at = f"{self.path}/states/batch_id={batch_id}"
        # one pass over the batch: a window is late as a whole, so its state is
        states.withColumn("late", late).write.mode("overwrite").parquet(at)
        # the mark comes last: a batch without one is written again
        (spark.read.parquet(at).agg(F.max("newest").cast("timestamp_ntz").alias("newest"))
         .write.mode("overwrite").parquet(f"{self.path}/marks/batch_id={batch_id}"))

    def _states(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/states")

    def closed(self, spark: SparkSession) -> DataFrame:
        """(segments.., column_name, window_start, window_end, metrics..) of the
        windows that the watermark has passed."""
        mark = self.watermark(spark)
        done = self._end() <= F.lit(mark).cast("timestamp_ntz") if mark is not None else F.lit(False)
        merged = merge_state(self._states(spark).where(~F.col("late")).where(done), self.grain, self.segments, len(self.conditions))
        out = state_metrics(merged, conditions=list(self.conditions))
        rest = [c for c in out.columns if c not in ("table_id", "bucket_start", "column_name", *self.segments)]
        return out.select(*self.segments, "column_name", F.col("bucket_start").alias("window_start"), self._end().alias("window_end"), *rest)

    def late_rows(self, spark: SparkSession) -> DataFrame:
        """(batch_id, segments.., window_start, rows): the late rows, one by one."""
        first = self._states(spark).where(F.col("late") & (F.col("column_name") == self.columns[0]))
        return first.groupBy("batch_id", *self.segments, F.col("bucket_start").alias("window_start")).agg(F.sum("rows").alias("rows"))


# ------------------------------------------------------------------ STR3

def stream_failures(runs: DataFrame, jobs: DataFrame, key: str = "job_source_id") -> DataFrame:
    """STR3: failed runs as they come, with the job name (stream-static left
    join; the static side is re-read per micro-batch)."""
    failed = runs.where(F.col("status_norm").isin(*ERROR_STATUSES))
    return failed.join(jobs, key, "left")


def idempotent_sink(path: str):
    """foreachBatch writer: each batch id owns one folder and a retried batch
    overwrites it, so a restart after a lost executor never doubles rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


# ------------------------------------------------------------------ STR4

_CHANGE = "run_source_id string, status_norm string, event_time timestamp_ntz, is_final boolean"
_MARK = "upto long, horizon timestamp_ntz"


def _read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The table at ``path``; an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def _newest(rows: DataFrame) -> DataFrame:
    """The newest state per run. At one time a final status beats an open one,
    then the greater name, so the answer does not hang on the order of arrival."""
    state = F.struct("event_time", "is_final", "status_norm")
    return rows.groupBy("run_source_id").agg(F.max(state).alias("s")).select("run_source_id", "s.status_norm", "s.event_time", "s.is_final")


class LatestRuns:
    """STR4: current state per run, as a keyed table under ``path`` that each
    micro-batch is merged into; every change of a state is one row of
    ``path``/changes. Use it as the ``foreachBatch`` function of a stream.

    A batch is reduced to one row per run, joined with the states of these
    runs, and what is newer is written under its batch id: a batch that is run
    again after a failure writes the same rows to the same place. Final states
    stay like any other, so a late event that is older than a run's state
    changes nothing. Every ``compact_every`` batches the states are written as
    one table; runs without news for ``timeout`` (event time) are left out
    there, and events from before that horizon no longer count, so a forgotten
    run does not come back. All of it is native: no Python runs per run.
    """

    def __init__(self, path: str, timeout: str = "1 day", compact_every: int = 20):
        self.path, self.timeout, self.compact_every = path, timeout, compact_every

    def _mark(self, spark: SparkSession, before: int | None) -> tuple[int, object]:
        """(last batch of the newest state table before a batch, its horizon)."""
        marks = _read_or_empty(spark, f"{self.path}/marks", _MARK)
        marks = marks if before is None else marks.where(F.col("upto") < before)
        row = marks.agg(F.max(F.struct("upto", "horizon"))).first()[0]
        return (-1, None) if row is None else (row[0], row[1])

    def current(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The state of each run after the batches before ``before`` (all)."""
        upto, _ = self._mark(spark, before)
        changes = _read_or_empty(spark, f"{self.path}/changes", _CHANGE + ", batch_id long").where(F.col("batch_id") > upto)
        if before is not None:
            changes = changes.where(F.col("batch_id") < before)
        rows = changes.drop("batch_id")
        if upto >= 0:
            rows = rows.unionByName(spark.read.schema(_CHANGE).parquet(f"{self.path}/states/upto={upto}"))
        return _newest(rows)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _, horizon = self._mark(spark, batch_id)
        events = batch.select("run_source_id", "status_norm", "event_time",
                              F.coalesce(F.col("status_norm").isin(*FINAL_STATUSES), F.lit(False)).alias("is_final"))
        if horizon is not None:
            events = events.where(F.col("event_time") >= F.lit(horizon).cast("timestamp_ntz"))
        new = _newest(events)
        old = self.current(spark, batch_id).select("run_source_id", F.struct("event_time", "is_final", "status_norm").alias("old"))
        state = F.struct("event_time", "is_final", "status_norm")
        changed = new.join(old, "run_source_id", "left").where(F.col("old").isNull() | (state > F.col("old"))).drop("old")
        changed.write.mode("overwrite").parquet(f"{self.path}/changes/batch_id={batch_id}")
        if batch_id % self.compact_every == self.compact_every - 1:
            self.compact(spark, batch_id)

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        now = self.current(spark, batch_id + 1)
        newest = now.agg(F.max("event_time") - F.expr(f"INTERVAL {self.timeout}")).first()[0]
        kept = now if newest is None else now.where(F.col("event_time") >= F.lit(newest).cast("timestamp_ntz"))
        kept.write.mode("overwrite").parquet(f"{self.path}/states/upto={batch_id}")
        # the mark comes last: a table that was not finished is never read
        spark.createDataFrame([(batch_id, newest)], _MARK).write.mode("append").parquet(f"{self.path}/marks")


def stream_latest(runs: DataFrame) -> DataFrame:
    """STR4: what ``LatestRuns`` needs of a stream of normalised run events."""
    return runs.select("run_source_id", "status_norm", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                  foreach_batch=None, query_name: str | None = None) -> StreamingQuery:
    """Process everything available now and stop (trigger availableNow); the
    checkpoint lives in the shared folder so a restarted job resumes."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format("parquet").option("path", sink).start()
    q.awaitTermination()
    return q


def dropped_late_rows(q: StreamingQuery) -> int:
    """Late input dropped by the watermark over the last batches (query
    progress) of a ``stream_metrics`` query; ``WindowMetrics`` counts each row.

    Spark counts at the state operator, after partial aggregation: late rows
    that share a window and segment within one micro-batch partition count
    once. Zero means nothing was late."""
    n = 0
    for p in q.recentProgress:
        ops = p.get("stateOperators", []) if isinstance(p, dict) else (p.stateOperators or [])
        for op in ops:
            v = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            n += int(v or 0)
    return n
