"""Views derived from the test tables (FIXTURES section 3), as Spark
DataFrames and as the matching DuckDB CTE text for the oracle.

D1 runs (events), D2 edges (part), D3 query logs (events), D4 volume
snapshots (orders), D5 status map. Run and asset events are rendered as
sparse JSON (NULL fields left out) and read back as VARIANT, exactly as a
connector's output would be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.etl import events_from_struct
from tidewatch.plans.common import tbl

# --- fixed values: status maps of the derived runs (D5 and its task twin) ---
RUN_MAP = {"succeeded": "success", "failed": "failed", "running": "in_progress"}
TASK_MAP = {"done": "success", "broken": "error"}


def _secs(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def _iso(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """One run event per event row."""
    ev = tbl(spark, sf, "events")
    eid, ts = F.col("event_id"), F.col("ts")
    et = F.col("event_type")
    status = (F.when(et == "purchase", "Succeeded").when(et == "view", "SUCCEEDED")
              .when(et == "error", "Failed").when(et == "click", "Running").otherwise("Paused"))
    return ev.select(
        eid, F.col("user_id"), et.alias("event_type"),
        F.concat(F.lit("run-"), eid.cast("string")).alias("run_source_id"),
        F.concat(F.lit("job-"), (F.col("user_id") % 20).cast("string")).alias("job_source_id"),
        status.alias("status"), ts.alias("event_time"),
        F.when(eid % 7 == 0, F.lit(None)).otherwise(ts + _secs(eid % 600)).alias("end_time"),
        F.when(eid % 5 == 0, F.lit(None)).otherwise(F.lit("boom")).alias("error_message"))


RUNS_SQL = """runs AS (
  SELECT event_id, user_id, event_type,
         concat('run-', CAST(event_id AS VARCHAR)) AS run_source_id,
         concat('job-', CAST(user_id % 20 AS VARCHAR)) AS job_source_id,
         CASE event_type WHEN 'purchase' THEN 'Succeeded' WHEN 'view' THEN 'SUCCEEDED'
              WHEN 'error' THEN 'Failed' WHEN 'click' THEN 'Running' ELSE 'Paused' END AS status,
         ts AS event_time,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts + to_seconds(event_id % 600) END AS end_time,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'boom' END AS error_message
  FROM events)"""

RUNS_NORM_SQL = RUNS_SQL + """,
runs_norm AS (
  SELECT *, CASE lower(status) WHEN 'succeeded' THEN 'success' WHEN 'failed' THEN 'failed'
                 WHEN 'running' THEN 'in_progress' ELSE 'unknown' END AS status_norm,
         lower(status) NOT IN ('succeeded', 'failed', 'running') AS unmapped
  FROM runs)"""


def _ref(asset_name: Column, role: str) -> Column:
    return F.struct(F.lit("TABLE").alias("asset_type"), F.lit(role).alias("role"),
                    asset_name.alias("fully_qualified_name"))


def run_events(spark: SparkSession, sf: str) -> DataFrame:
    """D1 as connector output: sparse JSON run events with task runs and
    runtime lineage, as (event_pos, v VARIANT).

    Every third event carries two task runs (the second one is 'Broken'
    without end_time or error, and has a nested task run 'Stalled'); every
    fourth event reports its input and output table; every 13th reports its
    input with role OUTPUT.
    """
    r = runs(spark, sf)
    eid, uid = F.col("event_id"), F.col("user_id")
    end_iso = _iso(F.col("end_time"))
    leaf_t = ("struct<job_source_id:string,run_source_id:string,status:string,event_time:string,"
              "end_time:string>")

    def task(suffix: str, status: str, end: Column, kids: Column) -> Column:
        # one struct shape for every task run; NULL fields vanish in to_json
        return F.struct(F.col("job_source_id"), F.concat("run_source_id", F.lit(suffix)).alias("run_source_id"),
                        F.lit(status).alias("status"), _iso(F.col("event_time")).alias("event_time"),
                        end.alias("end_time"), kids.alias("task_runs"))

    none = F.lit(None).cast("string")
    nested = F.struct(F.col("job_source_id"), F.concat("run_source_id", F.lit("-b-x")).alias("run_source_id"),
                      F.lit("Stalled").alias("status"), _iso(F.col("event_time")).alias("event_time"),
                      none.alias("end_time")).cast(leaf_t)
    task_a = task("-a", "Done", end_iso, F.lit(None).cast(f"array<{leaf_t}>"))
    task_b = task("-b", "Broken", none, F.array(nested))
    in_name = F.concat(F.lit("t"), (uid % 40).cast("string"))
    out_name = F.concat(F.lit("t"), ((uid * 3 + 1) % 40).cast("string"))
    typed = r.select(
        eid.alias("event_pos"), "job_source_id", "run_source_id", "status",
        _iso(F.col("event_time")).alias("event_time"), end_iso.alias("end_time"),
        F.when(F.col("error_message").isNotNull(),
               F.struct(F.col("error_message").alias("message"))).alias("error"),
        F.when(eid % 4 == 0, F.array(_ref(in_name, "INPUT")))
         .when(eid % 13 == 0, F.array(_ref(in_name, "OUTPUT"))).alias("inputs"),
        F.when(eid % 4 == 0, F.array(_ref(out_name, "OUTPUT"))).alias("outputs"),
        F.when(eid % 3 == 0, F.array(task_a, task_b)).alias("task_runs"))
    return events_from_struct(typed)


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (job, input, output) triples from part: every 2,000 parts
    make a group of 50 jobs over 40 tables, cycles included, and one job in 50
    writes into the next group, so jobs, tables and the longest way grow with
    the table."""
    p = tbl(spark, sf, "part")
    k = F.col("p_partkey")
    group = F.floor(k / 2000)
    ahead = F.when(k % 50 == 7, 40).otherwise(0)
    return p.select((group * 50 + k % 50).alias("job"), (group * 40 + k % 40).alias("input"),
                    (group * 40 + (k * 3 + 1) % 40 + ahead).alias("output")).distinct()


EDGES_SQL = """edges AS (
  SELECT DISTINCT p_partkey // 2000 * 50 + p_partkey % 50 AS job, p_partkey // 2000 * 40 + p_partkey % 40 AS input,
         p_partkey // 2000 * 40 + (p_partkey * 3 + 1) % 40 + CASE WHEN p_partkey % 50 = 7 THEN 40 ELSE 0 END AS output
  FROM part)"""

# static lineage as (job_source_id, task_source_id, role, asset_name)
STATIC_SQL = EDGES_SQL + """,
jobs AS (SELECT DISTINCT CAST(job AS VARCHAR) AS j, CAST(job % 5 AS VARCHAR) AS m FROM edges),
static AS (
  SELECT DISTINCT concat('job-', CAST(job AS VARCHAR)) AS job_source_id, NULL AS task_source_id, 'INPUT' AS role,
         concat('t', CAST(input AS VARCHAR)) AS asset_name FROM edges
  UNION SELECT concat('job-', CAST(job AS VARCHAR)), NULL, 'OUTPUT', concat('t', CAST(output AS VARCHAR)) FROM edges
  UNION SELECT concat('job-', j), concat('t-', j, '-extract'), 'INPUT', concat('raw', j) FROM jobs
  UNION SELECT concat('job-', j), concat('t-', j, '-extract'), 'OUTPUT', concat('stg', j) FROM jobs
  UNION SELECT concat('job-', j), concat('t-', j, '-load'), 'INPUT', concat('stg', j) FROM jobs
  UNION SELECT concat('job-', j), concat('t-', j, '-load'), 'OUTPUT', concat('mart', m) FROM jobs)"""


def asset_events(spark: SparkSession, sf: str) -> DataFrame:
    """Assets of the D2 jobs as sparse JSON events (event_pos = job number).

    Defects by construction: no name when job % 10 = 0; an empty group
    object when job % 9 = 0; the 'extract' task has no name when job % 7 = 0.
    Inputs and outputs are sorted lists of distinct tables (at most 40 each,
    so the per-job collection is bounded). The tasks have refs of their own:
    raw<job> -> stg<job> -> mart<job % 5>.
    """
    e = edges(spark, sf)
    j = F.col("job")
    ins = (e.select("job", "input").distinct().groupBy("job")
           .agg(F.array_sort(F.collect_list(F.concat(F.lit("t"), F.col("input").cast("string")))).alias("ins")))
    outs = (e.select("job", "output").distinct().groupBy("job")
            .agg(F.array_sort(F.collect_list(F.concat(F.lit("t"), F.col("output").cast("string")))).alias("outs")))
    a = ins.join(outs, "job", "full_outer")
    jid = F.concat(F.lit("job-"), j.cast("string"))
    stg = F.concat(F.lit("stg"), j.cast("string"))
    load = F.struct(F.concat(F.lit("t-"), j.cast("string"), F.lit("-load")).alias("task_source_id"),
                    F.lit("load").alias("name"),
                    F.array(F.concat(F.lit("t-"), j.cast("string"), F.lit("-extract"))).alias("upstream_task_source_ids"),
                    F.array(F.concat(F.lit("job-"), ((j + 1) % 50).cast("string"))).alias("triggered_job_source_ids"),
                    F.array(_ref(stg, "INPUT")).alias("inputs"),
                    F.array(_ref(F.concat(F.lit("mart"), (j % 5).cast("string")), "OUTPUT")).alias("outputs"))
    extract = F.struct(F.concat(F.lit("t-"), j.cast("string"), F.lit("-extract")).alias("task_source_id"),
                       F.when(j % 7 != 0, F.lit("extract")).alias("name"),
                       F.lit(None).cast("array<string>").alias("upstream_task_source_ids"),
                       F.lit(None).cast("array<string>").alias("triggered_job_source_ids"),
                       F.array(_ref(F.concat(F.lit("raw"), j.cast("string")), "INPUT")).alias("inputs"),
                       F.array(_ref(stg, "OUTPUT")).alias("outputs"))
    # source_id NULL is dropped by to_json, leaving an empty group object
    group = F.struct(F.when(j % 9 != 0, F.concat(F.lit("ws-"), (j % 3).cast("string"))).alias("source_id"))
    typed = a.select(
        j.alias("event_pos"), jid.alias("job_source_id"),
        F.when(j % 10 != 0, F.concat(F.lit("Job "), j.cast("string"))).alias("name"),
        group.alias("group"), F.array(load, extract).alias("tasks"),
        F.transform(F.coalesce("ins", F.array().cast("array<string>")), lambda n: _ref(n, "INPUT")).alias("inputs"),
        F.transform(F.coalesce("outs", F.array().cast("array<string>")), lambda n: _ref(n, "OUTPUT")).alias("outputs"))
    return events_from_struct(typed)


def query_logs(spark: SparkSession, sf: str) -> DataFrame:
    """D3: one logged query per event, tagged by event type:
    purchase: line tag with job, task and connection; view: line tag with
    job only, after a tag of another tool; click: block comment with an
    Airflow dag_id; signup: upper-case DAG_ID; error: broken JSON, and a tag
    inside a literal (both ignored), and for every third user a dbt node in
    the warehouse's own query tag."""
    ev = tbl(spark, sf, "events")
    job = F.concat(F.lit("job-"), (F.col("user_id") % 20).cast("string"))
    et = F.col("event_type")
    tag = (F.when(et == "purchase", F.concat(F.lit('-- {"mcd_job_id": "'), job,
                                            F.lit('", "mcd_task_id": "t1", "mcd_resource_id": "conn-a"}')))
           .when(et == "view", F.concat(F.lit('-- {"app": "it\'s"}\n-- {"mcd_job_id": "'), job, F.lit('"}')))
           .when(et == "click", F.concat(F.lit('/* {"dag_id": "dag-'), (F.col("user_id") % 7).cast("string"),
                                         F.lit('", "task_id": "load"} */')))
           .when(et == "signup", F.concat(F.lit('-- {"DAG_ID": "dag-'), (F.col("user_id") % 7).cast("string"),
                                          F.lit('"}')))
           .otherwise(F.lit('-- {"mcd_job_id": broken\nSELECT \'-- {"mcd_job_id": "decoy"}\', "/* {\'a\'} */"')))
    native = F.when((et == "error") & (F.col("user_id") % 3 == 0), F.concat(
        F.lit('{"dbt_node_id": "model-'), (F.col("user_id") % 11).cast("string"),
        F.lit('", "dbt_model": "m", "target_name": "prod"}')))
    return ev.select(F.concat(F.lit("q-"), F.col("event_id").cast("string")).alias("query_id"),
                     F.col("ts").alias("start_time"), (F.col("ts") + _secs(F.lit(2))).alias("end_time"),
                     F.concat(tag, F.lit("\nSELECT 1")).alias("query_text"), native.alias("query_tag"),
                     F.concat(F.lit("user-"), (F.col("user_id") % 5).cast("string")).alias("user"))


def volume_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Row count per order status (the 'table') and month (the snapshot)."""
    o = tbl(spark, sf, "orders")
    return (o.groupBy(F.col("o_orderstatus").alias("table_id"),
                      F.date_trunc("MONTH", "o_orderdate").cast("timestamp_ntz").alias("snapshot_time"))
            .agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.length("o_orderpriority")).alias("byte_count"),
                 F.max("o_orderdate").alias("last_update_time")))


VOLUME_SQL = """snaps AS (
  SELECT o_orderstatus AS table_id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS snapshot_time,
         count(*) AS row_count, sum(length(o_orderpriority)) AS byte_count, max(o_orderdate) AS last_update_time
  FROM orders GROUP BY 1, 2)"""
