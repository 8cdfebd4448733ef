"""Registered queries for ETL events (ETL1-ETL13) over the derived runs and
assets (FIXTURES section 3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import exprs as E
from tidewatch.operators import etl as X
from tidewatch.plans import derived as D
from tidewatch.plans.common import query, rnd
from tidewatch.sources.events import runs_by_id

# ------------------------------------------------------------------ ETL2

_RUN_ERRORS_SQL = D.RUNS_NORM_SQL + """,
errs AS (
  SELECT event_id, 7 AS k1, 0 AS k2, 0 AS k3, CAST(event_id AS VARCHAR) AS event_index, 'end_time' AS field,
         concat('status ''', status, ''' is final but end_time is missing') AS message
  FROM runs_norm WHERE status_norm IN ('success', 'failed') AND end_time IS NULL
  UNION ALL
  SELECT event_id, 8, 0, 0, CAST(event_id AS VARCHAR), 'error', concat('status ''', status, ''' is a failure but error is missing')
  FROM runs_norm WHERE status_norm = 'failed' AND error_message IS NULL
  UNION ALL
  SELECT event_id, 9, 0, 2, concat(CAST(event_id AS VARCHAR), '.inputs.0'), 'role',
         'role ''OUTPUT'' stands in inputs, which takes INPUT alone'
  FROM runs_norm WHERE event_id % 4 <> 0 AND event_id % 13 = 0
  UNION ALL
  SELECT event_id, 11, 0, 7, concat(CAST(event_id AS VARCHAR), '.0'), 'end_time',
         'status ''Done'' is final but end_time is missing'
  FROM runs_norm WHERE event_id % 3 = 0 AND end_time IS NULL
  UNION ALL
  SELECT event_id, 11, 1, 7, concat(CAST(event_id AS VARCHAR), '.1'), 'end_time',
         'status ''Broken'' is final but end_time is missing'
  FROM runs_norm WHERE event_id % 3 = 0
  UNION ALL
  SELECT event_id, 11, 1, 8, concat(CAST(event_id AS VARCHAR), '.1'), 'error',
         'status ''Broken'' is a failure but error is missing'
  FROM runs_norm WHERE event_id % 3 = 0
  UNION ALL
  SELECT NULL, 99, 0, 0, 'summary', 'status',
         concat('status ''', s, ''' has no entry in the status map, nodes: ', CAST(n AS VARCHAR))
  FROM (SELECT s, count(*) AS n FROM (
          SELECT status AS s FROM runs_norm WHERE unmapped
          UNION ALL SELECT 'Stalled' FROM runs_norm WHERE event_id % 3 = 0) u GROUP BY s) c)"""


def _run_errors(spark, sf):
    return X.validate_runs(D.run_events(spark, sf), D.RUN_MAP, D.TASK_MAP, one_scan=True)


@query("etl_validate_runs", _RUN_ERRORS_SQL + "\nSELECT event_index, field, message FROM errs")
def etl_validate_runs(spark, sf):
    return _run_errors(spark, sf).select("event_index", "field", "message")


@query("etl_first_errors", _RUN_ERRORS_SQL + """
SELECT event_index, field, message FROM errs
ORDER BY event_index = 'summary', event_id, k1, k2, k3 LIMIT 50""")
def etl_first_errors(spark, sf):
    return X.first_errors(_run_errors(spark, sf), 50).select("event_index", "field", "message")


# ------------------------------------------------------------------ ETL1

@query("etl_validate_assets", D.EDGES_SQL + """
SELECT event_index, field, message FROM (
  SELECT DISTINCT CAST(job AS VARCHAR) AS event_index, 'name' AS field, 'name is missing' AS message
  FROM edges WHERE job % 10 = 0
  UNION ALL SELECT DISTINCT CAST(job AS VARCHAR), 'group.source_id', 'the group has no source_id'
  FROM edges WHERE job % 9 = 0
  UNION ALL SELECT DISTINCT concat(CAST(job AS VARCHAR), '.tasks.1'), 'name', 'name is missing'
  FROM edges WHERE job % 7 = 0) e
""")
def etl_validate_assets(spark, sf):
    return X.validate_assets(D.asset_events(spark, sf)).select("event_index", "field", "message")


# ------------------------------------------------------------------ ETL3

@query("etl_flatten_tasks", D.RUNS_SQL + """
SELECT depth, status, count(*) AS nodes FROM (
  SELECT 0 AS depth, status FROM runs
  UNION ALL SELECT 1, 'Done' FROM runs WHERE event_id % 3 = 0
  UNION ALL SELECT 1, 'Broken' FROM runs WHERE event_id % 3 = 0
  UNION ALL SELECT 2, 'Stalled' FROM runs WHERE event_id % 3 = 0) n
GROUP BY 1, 2
""")
def etl_flatten_tasks(spark, sf):
    nodes, _ = X.flatten_task_runs(D.run_events(spark, sf))
    return (nodes.select("depth", X.vstr(F.col("v"), "$.status").alias("status"))
            .groupBy("depth", "status").agg(F.count(F.lit(1)).alias("nodes")))


# task runs nested as deep as the event's number says, 0 to 11 levels, none with a run id
@query("etl_deep_tasks", """
WITH nodes AS (
  SELECT event_id, unnest(generate_series(1, event_id % 12)) AS level FROM events)
SELECT concat(CAST(event_id AS VARCHAR), repeat('.0', CAST(level AS INTEGER))) AS event_index, 'run_source_id' AS field,
       'run_source_id is missing' AS message FROM nodes
UNION ALL
SELECT 'summary', 'status', concat('status ''Stuck'' has no entry in the status map, nodes: ', CAST(count(*) AS VARCHAR))
FROM nodes HAVING count(*) > 0
""")
def etl_deep_tasks(spark, sf):
    from tidewatch.plans.common import tbl

    levels = (F.col("event_id") % 12).cast("int")
    node = '"job_source_id":"j","event_time":"2024-01-01T00:00:00Z","status":'
    raw = F.concat(F.lit('{"run_source_id":"r",' + node + '"Running"'),
                   F.repeat(F.lit(',"task_runs":[{' + node + '"Stuck"'), levels),
                   F.repeat(F.lit("}]"), levels), F.lit("}"))
    texts = tbl(spark, sf, "events").select(F.col("event_id").alias("event_pos"), raw.alias("raw"))
    return X.validate_runs(X.events_from_json(texts), D.RUN_MAP).select("event_index", "field", "message")


# ------------------------------------------------------------------ ETL4, ETL5, ETL6

@query("etl_status", D.RUNS_NORM_SQL + """
SELECT status, status_norm, unmapped, count(*) AS n FROM runs_norm GROUP BY 1, 2, 3
""")
def etl_status(spark, sf):
    n = X.normalize_status(D.runs(spark, sf), D.RUN_MAP)
    return n.groupBy("status", "status_norm", "unmapped").agg(F.count(F.lit(1)).alias("n"))


@query("etl_unmapped", D.RUNS_NORM_SQL + """
SELECT status, count(*) AS count FROM runs_norm WHERE unmapped GROUP BY 1
""")
def etl_unmapped(spark, sf):
    return X.unmapped_statuses(D.runs(spark, sf), D.RUN_MAP)


_MAP_SQL = D.RUNS_SQL + """,
m AS (SELECT DISTINCT status AS key,
        CASE lower(status) WHEN 'succeeded' THEN 'success' WHEN 'failed' THEN 'failed'
             WHEN 'running' THEN 'in_progress' ELSE lower(status) END AS value FROM runs)"""


@query("etl_check_map", _MAP_SQL + """
SELECT key, value, problem FROM (
  SELECT key, value, 'value not canonical' AS problem FROM m
  WHERE value NOT IN ('success', 'failed', 'skipped', 'cancelled', 'error', 'timed_out', 'pass', 'fail',
                      'partial_success', 'in_progress', 'queued', 'unknown')
  UNION ALL SELECT key, value, 'duplicate key ignoring case' FROM m
  WHERE lower(key) IN (SELECT lower(key) FROM m GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT key, value, 'empty key' FROM m WHERE trim(key) = '') p
""")
def etl_check_map(spark, sf):
    st = F.col("status")
    value = F.coalesce(F.element_at(X._map_literal(D.RUN_MAP), F.lower(st)), F.lower(st))
    m = D.runs(spark, sf).select(st.alias("key"), value.alias("value")).distinct()
    return X.check_status_map(m)


# ------------------------------------------------------------------ ETL7, ETL8

@query("etl_asset_refs", """
SELECT concat(CAST(event_id AS VARCHAR), '.inputs.0') AS event_index, 'role' AS field,
       'role ''OUTPUT'' stands in inputs, which takes INPUT alone' AS message
FROM events WHERE event_id % 4 <> 0 AND event_id % 13 = 0
""")
def etl_asset_refs(spark, sf):
    ev = D.run_events(spark, sf).select("event_pos", F.col("event_pos").cast("string").alias("event_index"),
                                        F.array().cast("array<int>").alias("order_key"), "v")
    return (X.check_asset_refs(ev, "inputs", "INPUT", [9])
            .unionByName(X.check_asset_refs(ev, "outputs", "OUTPUT", [10]))
            .select("event_index", "field", "message"))


_ISO_TEXTS_SQL = """texts AS (
  SELECT 'naive' AS kind, CAST(ts AS VARCHAR) AS t FROM events
  UNION ALL SELECT 'zulu', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') FROM events
  UNION ALL SELECT 'offset', strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00') FROM events
  UNION ALL SELECT 'nanos', concat(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '789Z') FROM events
  UNION ALL SELECT 'hours', strftime(ts, '%Y-%m-%dT%H:%M:%S+00') FROM events
  UNION ALL SELECT 'date', CAST(CAST(ts AS DATE) AS VARCHAR) FROM events
  UNION ALL SELECT 'json', props FROM events
  UNION ALL SELECT 'word', event_type FROM events)"""


@query("etl_iso8601", "WITH " + _ISO_TEXTS_SQL + r"""
SELECT kind, CASE
  WHEN NOT (regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?$')
            AND TRY_CAST(regexp_replace(t, '(\.[0-9]{6})[0-9]+', '\1') AS TIMESTAMPTZ) IS NOT NULL) THEN 'invalid'
  WHEN regexp_matches(t, '[T ].*(Z|[+-][0-9]{2}(:?[0-9]{2})?)$') THEN 'valid' ELSE 'naive' END AS state,
  count(*) AS n
FROM texts GROUP BY 1, 2
""")
def etl_iso8601(spark, sf):
    from tidewatch.plans.common import tbl

    ev = tbl(spark, sf, "events")
    ts = F.col("ts")
    texts = E.union([
        ev.select(F.lit("naive").alias("kind"), E.to_string(ts).alias("t")),
        ev.select(F.lit("zulu").alias("kind"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("t")),
        ev.select(F.lit("offset").alias("kind"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias("t")),
        ev.select(F.lit("nanos").alias("kind"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'789Z'").alias("t")),
        ev.select(F.lit("hours").alias("kind"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00'").alias("t")),
        ev.select(F.lit("date").alias("kind"), E.to_string(E.to_date(ts)).alias("t")),
        ev.select(F.lit("json").alias("kind"), F.col("props").alias("t")),
        ev.select(F.lit("word").alias("kind"), F.col("event_type").alias("t"))])
    return texts.groupBy("kind", X.iso8601_state(F.col("t")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ ETL10-ETL13

@query("etl_latest", D.RUNS_SQL + """
SELECT job_source_id, arg_max(status, event_time) AS status, max(event_time) AS event_time, count(*) AS events
FROM runs GROUP BY 1
""")
def etl_latest(spark, sf):
    r = D.runs(spark, sf).select("job_source_id", "status", "event_time")
    return X.latest_run_state(r, key="job_source_id", time="event_time")


@query("etl_run_stats", D.RUNS_NORM_SQL + """
SELECT job_source_id, count(*) AS runs,
       round(avg(CASE WHEN end_time IS NOT NULL THEN event_id % 600 END), 6) AS mean_duration,
       round(quantile_cont(CASE WHEN end_time IS NOT NULL THEN event_id % 600 END, 0.95), 6) AS p95_duration,
       round(count_if(status_norm IN ('failed', 'error'))::DOUBLE / count(*), 6) AS failure_rate
FROM runs_norm GROUP BY 1
""")
def etl_run_stats(spark, sf):
    n = X.normalize_status(D.runs(spark, sf), D.RUN_MAP)
    s = X.run_stats(n, exact=True, start="event_time", end="end_time")
    return s.select("job_source_id", "runs", *[rnd(c).alias(c) for c in ("mean_duration", "p95_duration",
                                                                          "failure_rate")])


@query("etl_group", D.RUNS_SQL + """,
placements AS (
  SELECT DISTINCT concat('job-', CAST(user_id % 20 AS VARCHAR)) AS job_source_id,
         concat('ws-', CAST(user_id % 20 % 3 AS VARCHAR)) AS g FROM events
  UNION SELECT DISTINCT concat('job-', CAST(user_id % 20 AS VARCHAR)), 'ws-shared' FROM events WHERE user_id % 20 % 4 = 0),
one AS (SELECT job_source_id, CASE WHEN count(DISTINCT g) = 1 THEN min(g) END AS only_group, count(DISTINCT g) AS k
        FROM placements GROUP BY 1)
SELECT r.job_source_id,
       coalesce(CASE WHEN r.event_type = 'signup' THEN 'ws-explicit' END, o.only_group) AS group_source_id,
       CASE WHEN r.event_type = 'signup' THEN 'run' WHEN o.only_group IS NOT NULL THEN 'job'
            WHEN o.k > 1 THEN 'ambiguous' ELSE 'none' END AS group_origin,
       count(*) AS n
FROM runs r LEFT JOIN one o ON r.job_source_id = o.job_source_id GROUP BY 1, 2, 3
""")
def etl_group(spark, sf):
    r = D.runs(spark, sf).withColumn(
        "run_group", F.when(F.col("event_type") == "signup", F.lit("ws-explicit")))
    job = F.concat(F.lit("job-"), (F.col("user_id") % 20).cast("string"))
    ev = r.select("user_id")
    placements = (ev.select(job.alias("job_source_id"),
                            F.concat(F.lit("ws-"), (F.col("user_id") % 20 % 3).cast("string")).alias("group_source_id"))
                  .unionByName(ev.where(F.col("user_id") % 20 % 4 == 0)
                               .select(job.alias("job_source_id"), F.lit("ws-shared").alias("group_source_id")))
                  .distinct())
    g = X.attribute_group(r, placements)
    return g.groupBy("job_source_id", "group_source_id", "group_origin").agg(F.count(F.lit(1)).alias("n"))


@query("etl_coverage", D.RUNS_NORM_SQL + ", " + D.EDGES_SQL + """
SELECT feature, supported FROM (
  SELECT 'metadata_group' AS feature, count_if(job % 9 <> 0) > 0 AS supported FROM edges
  UNION ALL SELECT 'metadata_tasks', count(*) > 0 FROM edges
  UNION ALL SELECT 'metadata_inputs', count(*) > 0 FROM edges
  UNION ALL SELECT 'metadata_outputs', count(*) > 0 FROM edges
  UNION ALL SELECT 'metadata_schedule', false
  UNION ALL SELECT 'metadata_owner', false
  UNION ALL SELECT 'metadata_tags', false
  UNION ALL SELECT 'run_timing', count_if(end_time IS NOT NULL) > 0 FROM runs_norm
  UNION ALL SELECT 'run_error', count_if(status_norm IN ('failed', 'error') AND error_message IS NOT NULL) > 0 FROM runs_norm
  UNION ALL SELECT 'run_task_runs', count_if(event_id % 3 = 0) > 0 FROM runs_norm
  UNION ALL SELECT 'run_inputs', count_if(event_id % 4 = 0 OR event_id % 13 = 0) > 0 FROM runs_norm
  UNION ALL SELECT 'run_outputs', count_if(event_id % 4 = 0) > 0 FROM runs_norm
  UNION ALL SELECT 'run_group', false
  UNION ALL SELECT 'run_webhook_mode', count_if(run_source_id IN ('run-1', 'run-2', 'run-3')) > 0 FROM runs_norm
  UNION ALL VALUES ('manifest_run_status_mapping', true), ('manifest_task_status_mapping', true),
                   ('manifest_credentials_schema', false)) f
""")
def etl_coverage(spark, sf):
    return _coverage(spark, sf)


def _coverage(spark, sf):
    """All 17 features; the manifest's schema lacks its ``connect_args``."""
    asked, _ = runs_by_id(spark, D.runs(spark, sf), ["run-1", "run-2", "run-3"])
    manifest = {"run_status_mapping": D.RUN_MAP, "task_run_status_mapping": D.TASK_MAP, "credentials_schema": {"token": "string"}}
    return X.feature_coverage(D.asset_events(spark, sf), D.run_events(spark, sf), D.RUN_MAP, spark, manifest, asked)


@query("etl_coverage_totals", D.RUNS_NORM_SQL + ", " + D.EDGES_SQL + """,
hits AS (
  SELECT 'metadata' AS category, (count_if(job % 9 <> 0) > 0)::INT + 3 * (count(*) > 0)::INT AS supported, 7 AS total FROM edges
  UNION ALL SELECT 'run', (count_if(end_time IS NOT NULL) > 0)::INT
    + (count_if(status_norm IN ('failed', 'error') AND error_message IS NOT NULL) > 0)::INT + (count_if(event_id % 3 = 0) > 0)::INT
    + (count_if(event_id % 4 = 0 OR event_id % 13 = 0) > 0)::INT + (count_if(event_id % 4 = 0) > 0)::INT
    + (count_if(run_source_id IN ('run-1', 'run-2', 'run-3')) > 0)::INT, 7 FROM runs_norm
  UNION ALL VALUES ('manifest', 2, 3))
SELECT category, CAST(sum(supported) AS BIGINT) AS supported, CAST(sum(total) AS BIGINT) AS total FROM hits GROUP BY ROLLUP (category)
""")
def etl_coverage_totals(spark, sf):
    return X.coverage_totals(_coverage(spark, sf))
