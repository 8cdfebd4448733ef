"""Registered queries for streams (STR1-STR4). Each writes its input as
time-ordered files into the shared scratch folder, runs the stream with
trigger(availableNow) and returns what the sink holds, so the result can be
compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import etl as X
from tidewatch.operators.monitors import MetricSpec as S
from tidewatch.plans import derived as D
from tidewatch.plans.common import query, rnd, tbl
from tidewatch.session import scratch_path
from tidewatch.streaming import streams as ST


def _as_stream(spark, df, time_col: str, slices: int = 6, per_trigger: int = 2, tasks: int = 2):
    """Land a batch DataFrame as time slices and open it as a stream that reads
    ``per_trigger`` slices per micro-batch.

    One range shuffle puts the rows in order of time and writes them by slice;
    each slice is then copied into the stream's folder by ``tasks`` tasks, one
    file each, slice after slice: the file source takes files in order of their
    modification time, so rows arrive in event-time order by slice and none is
    late by construction.
    """
    staged, path = scratch_path(spark, "stream-staged"), scratch_path(spark, "stream-in")
    (df.repartitionByRange(slices * tasks, time_col).withColumn("__slice", F.floor(F.spark_partition_id() / tasks))
     .write.partitionBy("__slice").parquet(staged))
    rows = spark.read.parquet(staged)
    for i in range(slices):
        rows.where(F.col("__slice") == i).drop("__slice").repartition(tasks).write.mode("append").parquet(path)
    return ST.read_stream(spark, path, df.schema, max_files_per_trigger=per_trigger * tasks)


@query("str_runs", D.RUNS_NORM_SQL + "\nSELECT status_norm, count(*) AS n FROM runs_norm GROUP BY 1")
def str_runs(spark, sf):
    r = D.runs(spark, sf).select("run_source_id", "job_source_id", "status", "event_time")
    # the connector re-sends every 'view' run event once
    dup = r.where(F.col("status") == "SUCCEEDED")
    s = ST.stream_runs(_as_stream(spark, r.unionByName(dup), "event_time"), D.RUN_MAP)
    out = scratch_path(spark, "str-runs")
    ST.run_available(s.drop("event_ts"), out, scratch_path(spark, "ckpt"))
    return spark.read.parquet(out).groupBy("status_norm").agg(F.count(F.lit(1)).alias("n"))


@query("str_metrics", """
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, row_count, mean_value, zero_count
FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS row_count,
             round(avg(value), 6) AS mean_value, count_if(value = 0) AS zero_count
      FROM events GROUP BY 1, 2) w
WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def str_metrics(spark, sf):
    ev = tbl(spark, sf, "events")
    s = ST.stream_metrics(_as_stream(spark, ev, "ts"),
                          [S("row_count"), S("numeric_mean", "value", "mean_value"),
                           S("zero_count", "value", "zero_count")],
                          time_col="ts", window="1 day", watermark="1 hour", segments=["event_type"])
    out = scratch_path(spark, "str-metrics")
    ST.run_available(s, out, scratch_path(spark, "ckpt"))
    back = spark.read.parquet(out)
    return back.select("window_start", "window_end", "event_type", "row_count", rnd("mean_value").alias("mean_value"),
                       "zero_count")


@query("str_late", """
WITH days AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS row_count,
         round(avg(value), 6) AS mean_value, count_if(value > 50) AS high_count,
         count_if(event_id % 9 = 0 AND date_trunc('day', ts) + INTERVAL 6 DAY <= (SELECT max(ts) FROM events)) AS late_rows
  FROM events GROUP BY 1, 2)
SELECT window_start, event_type, row_count, mean_value, high_count, late_rows FROM days
WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def str_late(spark, sf):
    """Each ninth event is sent again when its day has long been closed: the
    windows stay as they were, and every such row is counted."""
    ev = tbl(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    newest = ev.agg(F.max("ts").alias("newest"))
    again = ev.where(F.col("event_id") % 9 == 0).crossJoin(F.broadcast(newest)).where(
        F.date_trunc("DAY", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 6 DAYS") <= F.col("newest"))
    sent = ev.withColumn("seen", F.col("ts")).unionByName(
        again.withColumn("seen", F.col("newest") + F.expr("INTERVAL 1 DAY")).drop("newest"))
    s = _as_stream(spark, sent, "seen", per_trigger=1)
    windows = ST.WindowMetrics(scratch_path(spark, "str-late"), ["value"], "ts", segments=["event_type"],
                               conditions={"high_count": F.col("value") > 50})
    ST.run_available(s, "", scratch_path(spark, "ckpt"), foreach_batch=windows)
    late = windows.late_rows(spark).groupBy("event_type", "window_start").agg(F.sum("rows").alias("late_rows"))
    return (windows.closed(spark).join(late, ["event_type", "window_start"], "left")
            .select("window_start", "event_type", "row_count", rnd("numeric_mean").alias("mean_value"), "high_count",
                    F.coalesce("late_rows", F.lit(0).cast("long")).alias("late_rows")))


@query("str_failures", D.RUNS_NORM_SQL + ", " + D.EDGES_SQL + """
SELECT r.job_source_id, CASE WHEN j.job % 10 <> 0 THEN concat('Job ', CAST(j.job AS VARCHAR)) END AS job_name,
       count(*) AS failures
FROM runs_norm r LEFT JOIN (SELECT DISTINCT job FROM edges) j ON r.job_source_id = concat('job-', CAST(j.job AS VARCHAR))
WHERE r.status_norm IN ('failed', 'error') GROUP BY 1, 2
""")
def str_failures(spark, sf):
    r = D.runs(spark, sf).select("run_source_id", "job_source_id", "status", "event_time")
    s = X.normalize_status(_as_stream(spark, r, "event_time"), D.RUN_MAP)
    jobs = D.asset_events(spark, sf).select(X.vstr(F.col("v"), "$.job_source_id").alias("job_source_id"),
                                            X.vstr(F.col("v"), "$.name").alias("job_name"))
    out = scratch_path(spark, "str-failures")
    ST.run_available(ST.stream_failures(s, jobs), out, scratch_path(spark, "ckpt"),
                     foreach_batch=ST.idempotent_sink(out))
    back = spark.read.parquet(out)
    return back.groupBy("job_source_id", "job_name").agg(F.count(F.lit(1)).alias("failures"))


@query("str_latest", D.RUNS_NORM_SQL + """
SELECT CASE WHEN end_time IS NOT NULL THEN status_norm ELSE 'in_progress' END AS status_norm, count(*) AS runs
FROM runs_norm GROUP BY 1
""")
def str_latest(spark, sf):
    n = X.normalize_status(D.runs(spark, sf), D.RUN_MAP)
    started = n.select("run_source_id", F.lit("in_progress").alias("status_norm"), "event_time", F.col("event_time").alias("seen"))
    over = n.where(F.col("end_time").isNotNull())
    ended = over.select("run_source_id", "status_norm", F.col("end_time").alias("event_time"), F.col("end_time").alias("seen"))
    # every run that ended is reported as started, and as ended, once more, days later
    again = over.select("run_source_id", F.explode(F.array(
        F.struct(F.lit("in_progress").alias("status_norm"), F.col("event_time").alias("event_time")),
        F.struct(F.col("status_norm"), F.col("end_time").alias("event_time")))).alias("e"),
        (F.col("end_time") + F.expr("INTERVAL 3 DAYS")).alias("seen")).select("run_source_id", "e.*", "seen")
    s = ST.stream_latest(_as_stream(spark, started.unionByName(ended).unionByName(again), "seen"))
    latest = ST.LatestRuns(scratch_path(spark, "str-latest"), timeout="400 DAYS", compact_every=2)
    ST.run_available(s, "", scratch_path(spark, "ckpt"), foreach_batch=latest)
    return latest.current(spark).groupBy("status_norm").agg(F.count(F.lit(1)).alias("runs"))
