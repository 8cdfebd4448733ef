"""Streams equal the batch answer on the same files (availableNow)."""

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators import etl as X
from tidewatch.operators.monitors import MetricSpec as S
from tidewatch.session import scratch_path
from tidewatch.streaming import streams as ST


def _land(spark, df, slices):
    path = scratch_path(spark, "t-stream")
    for cond in slices:
        df.where(cond).coalesce(1).write.mode("append").parquet(path)
    return ST.read_stream(spark, path, df.schema, max_files_per_trigger=1)


def _runs(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(40):
        t = base + dt.timedelta(minutes=30 * i)
        rows.append((f"r{i % 10}", "j", "Running" if i < 30 else "Succeeded", t))
    rows.append(("r1", "j", "Running", base + dt.timedelta(minutes=30)))        # a re-sent event
    return spark.createDataFrame(rows, "run_source_id string, job_source_id string, status string, "
                                       "event_time timestamp_ntz")


def test_stream_runs_dedup(spark):
    runs = _runs(spark)
    mid = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    s = ST.stream_runs(_land(spark, runs, [F.col("event_time") < mid, F.col("event_time") >= mid]),
                       {"running": "in_progress", "succeeded": "success"})
    out = scratch_path(spark, "t-out")
    ST.run_available(s.drop("event_ts"), out, scratch_path(spark, "t-ckpt"))
    assert spark.read.parquet(out).count() == 40


def test_stream_metrics_equal_batch_windows(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), "a" if h % 2 else "b", float(h % 3)) for h in range(96)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, seg string, v double")
    slices = [(F.col("ts") >= F.lit(f"2024-01-0{d}").cast("timestamp_ntz")) &
              (F.col("ts") < F.lit(f"2024-01-0{d + 1}").cast("timestamp_ntz")) for d in range(1, 5)]
    s = ST.stream_metrics(_land(spark, df, slices), [S("row_count"), S("zero_count", "v", "zeros")],
                          time_col="ts", window="1 day", watermark="1 hour", segments=["seg"])
    out = scratch_path(spark, "t-out")
    q = ST.run_available(s, out, scratch_path(spark, "t-ckpt"))
    got = {(r.window_start.day, r.seg): (r.row_count, r.zeros) for r in spark.read.parquet(out).collect()}
    # the last day stays open: its end is beyond the final watermark
    want = {}
    for t, seg, v in rows:
        if t.day < 4:
            c, z = want.get((t.day, seg), (0, 0))
            want[(t.day, seg)] = (c + 1, z + (v == 0))
    assert got == want
    assert ST.dropped_late_rows(q) == 0


def test_stream_failures_and_latest(spark):
    runs = X.normalize_status(_runs(spark), {"running": "in_progress", "succeeded": "success", "failed": "failed"})
    runs = runs.withColumn("status_norm", F.when(F.col("run_source_id") == "r3", F.lit("failed"))
                           .otherwise(F.col("status_norm")))
    mid = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    jobs = spark.createDataFrame([("j", "Job J")], "job_source_id string, job_name string")
    out = scratch_path(spark, "t-fail")
    ST.run_available(ST.stream_failures(_land(spark, runs, [F.col("event_time") < mid, F.col("event_time") >= mid]),
                                        jobs), out, scratch_path(spark, "t-ckpt"), foreach_batch=ST.idempotent_sink(out))
    back = spark.read.parquet(out)
    assert back.count() == runs.where("status_norm = 'failed'").count() and back.first().job_name == "Job J"
    s = ST.stream_latest(_land(spark, runs.select("run_source_id", "status_norm", "event_time"),
                               [F.col("event_time") < mid, F.col("event_time") >= mid]))
    latest = ST.LatestRuns(scratch_path(spark, "t-latest"), timeout="30 DAYS", compact_every=1)
    ST.run_available(s, "", scratch_path(spark, "t-ckpt"), foreach_batch=latest)
    final = {r.run_source_id: r.status_norm for r in latest.current(spark).collect()}
    batch = {r.run_source_id: r.status_norm for r in X.latest_run_state(
        runs.select("run_source_id", "status_norm", "event_time")).collect()}
    assert final == batch


def _events(spark, *rows):
    return spark.createDataFrame([(run, status, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for run, status, h in rows],
                                 "run_source_id string, status_norm string, event_time timestamp_ntz")


def test_late_and_repeated_events_change_no_final_state(spark):
    latest = ST.LatestRuns(scratch_path(spark, "t-final"), timeout="1 DAY", compact_every=3)
    batches = [_events(spark, ("a", "in_progress", 0), ("b", "in_progress", 1)),
               _events(spark, ("a", "success", 5), ("a", "in_progress", 5)),           # one time: the final one holds
               _events(spark, ("a", "in_progress", 2), ("b", "in_progress", 1)),       # late, and sent again
               _events(spark, ("a", "success", 5), ("c", "failed", 6)),
               _events(spark, ("b", "success", 90)),
               _events(spark, ("d", "in_progress", 89)),                               # compacted: a and c are past the horizon
               _events(spark, ("a", "in_progress", 3))]                                # and do not come back
    states = []
    for i, batch in enumerate(batches):
        latest(batch, i)
        if i in (2, 5):
            latest(batch, i)                                                           # a batch that is run again
        states.append({r.run_source_id: r.status_norm for r in latest.current(spark).collect()})
    assert states[:4] == [{"a": "in_progress", "b": "in_progress"}, {"a": "success", "b": "in_progress"},
                          {"a": "success", "b": "in_progress"}, {"a": "success", "b": "in_progress", "c": "failed"}]
    assert states[5] == states[6] == {"b": "success", "d": "in_progress"}
    changes = spark.read.parquet(f"{latest.path}/changes").groupBy("batch_id").count()
    assert {r.batch_id: r["count"] for r in changes.collect()} == {0: 2, 1: 1, 3: 1, 4: 1, 5: 1}


def test_late_rows_are_dropped_and_counted(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), "a", 1.0) for h in range(72)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, seg string, v double")
    late = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "a", 1.0)] * 3, df.schema)
    path = scratch_path(spark, "t-late")
    for d in (1, 2, 3):
        df.where(F.dayofmonth("ts") == d).coalesce(1).write.mode("append").parquet(path)
    late.coalesce(1).write.mode("append").parquet(path)         # arrives after day 3
    s = ST.stream_metrics(ST.read_stream(spark, path, df.schema, max_files_per_trigger=1), [S("row_count")],
                          time_col="ts", window="1 day", watermark="1 hour", segments=["seg"])
    out = scratch_path(spark, "t-out")
    q = ST.run_available(s, out, scratch_path(spark, "t-ckpt"))
    got = {r.window_start.day: r.row_count for r in spark.read.parquet(out).collect()}
    assert got == {1: 24, 2: 24}                # day 1 is final and unchanged; day 3 stays open
    # counted after partial aggregation: the three late rows share one group
    assert ST.dropped_late_rows(q) == 1


def test_every_late_row_is_counted(spark):
    """Three late rows of one window count as three, over more than a hundred batches."""
    windows = ST.WindowMetrics(scratch_path(spark, "t-windows"), ["v"], "ts", segments=["seg"], conditions={"ones": F.col("v") == 1})
    rows = lambda *hours: spark.createDataFrame(
        [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), "a", float(h % 3)) for h in hours], "ts timestamp_ntz, seg string, v double")
    windows(rows(*range(0, 24)), 0)
    windows(rows(24, 25, 26, 3), 1)           # hour 3 is in time: the watermark stands at hour 22
    windows(rows(5, 5, 5, 27), 2)             # day 1 is closed
    windows(rows(5, 5, 5, 27), 2)             # and the batch is run again
    for i in range(3, 6):
        windows(rows(28 + i, 6), 100 + i)
    late = windows.late_rows(spark)
    assert {(r.batch_id, r.rows) for r in late.collect()} == {(2, 3), (103, 1), (104, 1), (105, 1)}
    got = windows.closed(spark).collect()
    assert [(r.window_start.day, r.row_count, r.ones, r.numeric_median) for r in got] == [(1, 25, 8, 1.0)]


def test_query_tags_on_a_stream(spark):
    from tidewatch.operators import lineage as L

    logs = spark.createDataFrame([("q1", dt.datetime(2024, 1, 1), '-- {"mcd_job_id": "j1"}\nSELECT 1'),
                                  ("q2", dt.datetime(2024, 1, 1), "SELECT 2")],
                                 "query_id string, start_time timestamp_ntz, query_text string")
    s = L.query_tags(_land(spark, logs, [F.lit(True)]))
    out = scratch_path(spark, "t-tags")
    ST.run_available(s, out, scratch_path(spark, "t-ckpt"))
    assert [(r.query_id, r.job_id) for r in spark.read.parquet(out).collect()] == [("q1", "j1")]
