"""Registered queries for lineage (ETL14-ETL20) over the derived assets,
runs and query logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import etl as X
from tidewatch.operators import lineage as L
from tidewatch.plans import derived as D
from tidewatch.plans.common import query


def _static(spark, sf):
    return L.lineage_edges(D.asset_events(spark, sf))


@query("lin_static", D.STATIC_SQL + "\nSELECT job_source_id, task_source_id, role, asset_name FROM static")
def lin_static(spark, sf):
    return _static(spark, sf).drop("asset_type")


_RUNTIME_SQL = D.STATIC_SQL + """,
runtime AS (
  SELECT DISTINCT concat('job-', CAST(user_id % 20 AS VARCHAR)) AS job_source_id, 'INPUT' AS role,
         concat('t', CAST(user_id % 40 AS VARCHAR)) AS asset_name FROM events WHERE event_id % 4 = 0 OR event_id % 13 = 0
  UNION SELECT DISTINCT concat('job-', CAST(user_id % 20 AS VARCHAR)), 'OUTPUT',
         concat('t', CAST((user_id * 3 + 1) % 40 AS VARCHAR)) FROM events WHERE event_id % 4 = 0),
declared AS (SELECT job_source_id, role, asset_name FROM static)"""


@query("lin_runtime", _RUNTIME_SQL + """
SELECT job_source_id, role, asset_name, 'static_only' AS drift FROM (SELECT * FROM declared EXCEPT SELECT * FROM runtime) a
UNION ALL
SELECT job_source_id, role, asset_name, 'runtime_only' FROM (SELECT * FROM runtime EXCEPT SELECT * FROM declared) b
""")
def lin_runtime(spark, sf):
    return L.lineage_drift(_static(spark, sf), L.runtime_edges(D.run_events(spark, sf)))


@query("lin_run_edges", """
SELECT concat('run-', CAST(event_id AS VARCHAR)) AS run_source_id, concat('job-', CAST(user_id % 20 AS VARCHAR)) AS job_source_id,
       'INPUT' AS role, concat('t', CAST(user_id % 40 AS VARCHAR)) AS asset_name
FROM events WHERE event_id % 4 = 0 OR event_id % 13 = 0
UNION ALL
SELECT concat('run-', CAST(event_id AS VARCHAR)), concat('job-', CAST(user_id % 20 AS VARCHAR)), 'OUTPUT',
       concat('t', CAST((user_id * 3 + 1) % 40 AS VARCHAR)) FROM events WHERE event_id % 4 = 0
""")
def lin_run_edges(spark, sf):
    return L.runtime_edges(D.run_events(spark, sf)).select("run_source_id", "job_source_id", "role", "asset_name")


@query("lin_table", D.STATIC_SQL + """
SELECT DISTINCT i.asset_name AS source_table, o.asset_name AS target_table, i.job_source_id
FROM static i JOIN static o ON i.job_source_id = o.job_source_id
  AND i.task_source_id IS NOT DISTINCT FROM o.task_source_id AND i.role = 'INPUT' AND o.role = 'OUTPUT'
""")
def lin_table(spark, sf):
    return L.table_edges(_static(spark, sf))


@query("lin_tasks", D.EDGES_SQL + """
SELECT concat('job-', CAST(job AS VARCHAR)) AS job_source_id, concat('t-', CAST(job AS VARCHAR), '-load') AS task_source_id,
       concat('t-', CAST(job AS VARCHAR), '-extract') AS target, 'upstream_task' AS edge_type
FROM (SELECT DISTINCT job FROM edges) j
UNION ALL
SELECT concat('job-', CAST(job AS VARCHAR)), concat('t-', CAST(job AS VARCHAR), '-load'),
       concat('job-', CAST((job + 1) % 50 AS VARCHAR)), 'triggered_job'
FROM (SELECT DISTINCT job FROM edges) j
""")
def lin_tasks(spark, sf):
    return L.task_edges(D.asset_events(spark, sf))


_TAGS_SQL = """tags AS (
  SELECT concat('q-', CAST(event_id AS VARCHAR)) AS query_id,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'custom' WHEN event_type = 'error' THEN 'dbt'
              ELSE 'airflow' END AS integration,
         CASE WHEN event_type IN ('purchase', 'view') THEN concat('job-', CAST(user_id % 20 AS VARCHAR))
              WHEN event_type <> 'error' THEN concat('dag-', CAST(user_id % 7 AS VARCHAR)) END AS job_id,
         CASE event_type WHEN 'purchase' THEN 't1' WHEN 'click' THEN 'load'
              WHEN 'error' THEN concat('model-', CAST(user_id % 11 AS VARCHAR)) END AS task_id,
         CASE WHEN event_type = 'purchase' THEN 'conn-a' END AS connection_id,
         CASE WHEN event_type = 'error' THEN 'm' END AS node_name,
         CASE WHEN event_type = 'error' THEN 'prod' END AS target
  FROM events WHERE event_type <> 'error' OR user_id % 3 = 0)"""


@query("lin_tags", _TAGS_SQL + "\nSELECT query_id, integration, job_id, task_id, connection_id, node_name, target FROM tags")
def lin_tags(spark, sf):
    return L.query_tags(D.query_logs(spark, sf), "query_tag").drop("start_time")


_RESOLVED_SQL = _TAGS_SQL + """,
jobs AS (
  SELECT DISTINCT concat('job-', CAST(user_id % 20 AS VARCHAR)) AS job_source_id, 'conn-a' AS connection_id FROM events
  UNION SELECT DISTINCT concat('job-', CAST(user_id % 20 AS VARCHAR)), 'conn-b' FROM events WHERE user_id % 20 % 5 = 0),
per_job AS (SELECT job_source_id, count(DISTINCT connection_id) AS conns, min(connection_id) AS only_conn FROM jobs GROUP BY 1),
resolved AS (SELECT t.query_id, t.integration, t.job_id, t.task_id,
       CASE WHEN p.job_source_id IS NULL THEN NULL
            WHEN t.connection_id IS NOT NULL THEN t.connection_id
            WHEN p.conns > 1 THEN NULL ELSE p.only_conn END AS resolved_connection,
       CASE WHEN p.job_source_id IS NULL THEN 'unmatched'
            WHEN t.connection_id IS NOT NULL THEN 'matched'
            WHEN p.conns > 1 THEN 'ambiguous' ELSE 'matched' END AS "match"
FROM tags t LEFT JOIN per_job p ON t.job_id = p.job_source_id)"""


def _resolved(spark, sf):
    from tidewatch.plans.common import tbl

    ev = tbl(spark, sf, "events")
    job = F.concat(F.lit("job-"), (F.col("user_id") % 20).cast("string"))
    jobs = (ev.select(job.alias("job_source_id"), F.lit("conn-a").alias("connection_id"))
            .unionByName(ev.where(F.col("user_id") % 20 % 5 == 0)
                         .select(job.alias("job_source_id"), F.lit("conn-b").alias("connection_id")))
            .distinct())
    tags = L.query_tags(D.query_logs(spark, sf), "query_tag")
    return L.resolve_tags(tags, jobs)


@query("lin_tag_edges", _RESOLVED_SQL + """
SELECT query_id, integration, job_id, task_id, resolved_connection, "match" FROM resolved
""")
def lin_tag_edges(spark, sf):
    return _resolved(spark, sf)


# every logged query reads t<user % 40>, and every second one writes
@query("lin_tag_tables", _RESOLVED_SQL + """
SELECT DISTINCT r.job_id AS job_source_id, r.task_id AS task_source_id, a.role, a.asset_name
FROM resolved r JOIN (
  SELECT concat('q-', CAST(event_id AS VARCHAR)) AS query_id, 'INPUT' AS role, concat('t', CAST(user_id % 40 AS VARCHAR)) AS asset_name
  FROM events
  UNION ALL
  SELECT concat('q-', CAST(event_id AS VARCHAR)), 'OUTPUT', concat('t', CAST((user_id * 3 + 1) % 40 AS VARCHAR))
  FROM events WHERE event_id % 2 = 0) a ON r.query_id = a.query_id
WHERE r."match" = 'matched'
""")
def lin_tag_tables(spark, sf):
    from tidewatch.plans.common import tbl

    ev, uid = tbl(spark, sf, "events"), F.col("user_id")
    query_id = F.concat(F.lit("q-"), F.col("event_id").cast("string")).alias("query_id")

    def named(n):
        return F.concat(F.lit("t"), n.cast("string")).alias("asset_name")
    access = (ev.select(query_id, F.lit("INPUT").alias("role"), named(uid % 40))
              .unionByName(ev.where("event_id % 2 = 0")
                           .select(query_id, F.lit("OUTPUT").alias("role"), named((uid * 3 + 1) % 40))))
    return L.tag_table_edges(_resolved(spark, sf), access)


_IMPACT_SQL = D.RUNS_NORM_SQL + ", " + D.STATIC_SQL + """,
latest AS (SELECT job_source_id, arg_max(status_norm, event_time) AS last_status FROM runs_norm GROUP BY 1),
start AS (SELECT DISTINCT s.asset_name FROM static s JOIN latest l ON s.job_source_id = l.job_source_id
          WHERE s.role = 'OUTPUT' AND l.last_status = 'failed'),
reach(asset_name, distance) AS (
  SELECT asset_name, 0 FROM start
  UNION
  SELECT o.asset_name, r.distance + 1 FROM reach r
  JOIN static i ON i.role = 'INPUT' AND i.asset_name = r.asset_name
  JOIN static o ON o.role = 'OUTPUT' AND o.job_source_id = i.job_source_id
                   AND o.task_source_id IS NOT DISTINCT FROM i.task_source_id
  WHERE r.distance < (SELECT count(DISTINCT asset_name) FROM static))"""


@query("lin_impact", "WITH RECURSIVE " + _IMPACT_SQL + """
SELECT asset_name, min(distance) AS distance FROM reach GROUP BY 1
""")
def lin_impact(spark, sf):
    static = _static(spark, sf)
    n = X.normalize_status(D.runs(spark, sf), D.RUN_MAP)
    latest = X.latest_run_state(n.select("job_source_id", "status_norm", "event_time"), key="job_source_id")
    failed = latest.where(F.col("status_norm") == "failed").select("job_source_id")
    start = (static.where(F.col("role") == "OUTPUT").join(failed, "job_source_id", "left_semi")
             .select("asset_name").distinct())
    return L.downstream(static, start)
