"""Registered queries for sources and sinks (SRC1-SRC14)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tidewatch.functions import exprs as E
from tidewatch.operators import monitors as M

from tidewatch.plans import derived as D
from tidewatch.plans.common import query, tbl
from tidewatch.session import scratch_path
from tidewatch.sources import catalog as C
from tidewatch.sources import events as S
from tidewatch.sources.sinks import write_observations


def _db(sf: str) -> str:
    return "tw_" + re.sub(r"[^a-z0-9]+", "_", sf.rstrip("/").split("/")[-1].lower())


def _registered(spark, sf):
    db = _db(sf)
    C.register_tables(spark, sf, db)
    spark.sql(f"CREATE VIEW IF NOT EXISTS {db}.big_orders AS SELECT * FROM {db}.orders WHERE o_totalprice > 300000")
    return db


@query("src_tables", """
SELECT 'spark_catalog' AS database_name, 'lineitem' AS table_name, 'table' AS table_type, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'spark_catalog', 'orders', 'table', count(*) FROM orders
UNION ALL SELECT 'spark_catalog', 'part', 'table', count(*) FROM part
UNION ALL SELECT 'spark_catalog', 'big_orders', 'view', NULL
""")
def src_tables(spark, sf):
    db = _registered(spark, sf)
    inv = C.table_inventory(spark, [db], table_names=["LINEITEM", "Orders", "part", "BIG_orders"])
    return inv.select("database_name", "table_name", "table_type", "row_count")


_TYPE_SQL = """CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int'
     WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END"""


@query("src_columns", f"""
SELECT concat('tpch.', table_name) AS full_table_id, column_name, {_TYPE_SQL} AS column_type
FROM information_schema.columns WHERE table_name IN ('lineitem', 'orders', 'embeddings', 'events')
""")
def src_columns(spark, sf):
    return C.column_inventory(spark, {f"tpch.{t}": tbl(spark, sf, t)
                                      for t in ("lineitem", "orders", "embeddings", "events")})


@query("src_volume", """
SELECT 'lineitem' AS table_name, count(*) AS row_count, true AS has_bytes FROM lineitem
UNION ALL SELECT 'orders', count(*), true FROM orders
UNION ALL SELECT 'events', count(*), true FROM events
UNION ALL SELECT 'documents', count(*), true FROM documents
""")
def src_volume(spark, sf):
    db = _registered(spark, sf)
    v = C.volume_snapshot(spark, [f"{db}.{t}" for t in ("lineitem", "orders", "events", "documents")])
    return v.select(F.element_at(F.split("table_id", r"\."), -1).alias("table_name"), "row_count",
                    (F.col("byte_count") > 0).alias("has_bytes"))


@query("src_freshness", """
SELECT 'lineitem' AS table_name, max(l_shipdate) AS last_update_time FROM lineitem
UNION ALL SELECT 'orders', max(o_orderdate) FROM orders
UNION ALL SELECT 'events', max(ts) FROM events
""")
def src_freshness(spark, sf):
    db = _registered(spark, sf)
    fr = C.freshness_snapshot(spark, {f"{db}.lineitem": "l_shipdate", f"{db}.orders": "o_orderdate",
                                      f"{db}.events": "ts"})
    return fr.select(F.element_at(F.split("table_id", r"\."), -1).alias("table_name"), "last_update_time")


@query("src_pushed", """
SELECT 'lineitem' AS table_name, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part
""")
def src_pushed(spark, sf):
    """Metadata pushed by another system: here written from the inventory as
    JSON lines into the shared scratch folder and read back."""
    db = _registered(spark, sf)
    inv = C.table_inventory(spark, [db], table_names=["lineitem", "orders", "part"])
    path = scratch_path(spark, "pushed")
    inv.write.mode("overwrite").json(path)
    return S.read_pushed_metadata(spark, path).select("table_name", "row_count")


@query("src_query_logs", """
SELECT concat('q-', CAST(event_id AS VARCHAR)) AS query_id, ts AS start_time FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-06 00:00:00'
ORDER BY ts, query_id LIMIT 100 OFFSET 100
""")
def src_query_logs(spark, sf):
    logs = D.query_logs(spark, sf)
    return S.query_log_scan(logs, "2024-01-05 00:00:00", "2024-01-06 00:00:00", limit=100, offset=100) \
        .select("query_id", "start_time")


@query("src_assets", D.EDGES_SQL + """
SELECT concat('job-', CAST(job AS VARCHAR)) AS job_source_id,
       CASE WHEN job % 10 <> 0 THEN concat('Job ', CAST(job AS VARCHAR)) END AS name,
       count(DISTINCT input) AS n_inputs, count(DISTINCT output) AS n_outputs, 2 AS n_tasks
FROM edges GROUP BY job
""")
def src_assets(spark, sf):
    path = scratch_path(spark, "assets")
    D.asset_events(spark, sf).select(F.to_json("v").alias("value")).write.mode("overwrite").text(path)
    typed, raw = S.read_assets(spark, path)
    return typed.select("job_source_id", "name", F.size("inputs").alias("n_inputs"),
                        F.size("outputs").alias("n_outputs"), F.size("tasks").alias("n_tasks"))


@query("src_runs_window", D.RUNS_SQL + """
SELECT status, count(*) AS n, min(event_time) AS first_time, max(event_time) AS last_time FROM runs
WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_time < TIMESTAMP '2024-01-10 06:00:00'
  AND event_id % 11 <> 5 GROUP BY 1
""")
def src_runs_window(spark, sf):
    """Polling end to end: run events land as JSON lines, their times written
    with different offsets, some of them no times at all."""
    runs, eid = D.runs(spark, sf), F.col("event_id")
    at = lambda hours, zone: F.concat(F.date_format(
        F.col("event_time") + F.make_dt_interval(F.lit(0), F.lit(hours)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone))
    text = (F.when(eid % 11 == 5, F.lit("not a time")).when(eid % 4 == 0, at(0, "Z")).when(eid % 4 == 1, at(5, "+05:00"))
            .when(eid % 4 == 2, at(-8, "-0800")).otherwise(at(0, "")))
    path = scratch_path(spark, "runs")
    runs.select("job_source_id", "run_source_id", "status", text.alias("event_time")).write.json(path)
    r = S.runs_in_window(S.read_runs(spark, path), "2024-01-10 00:00:00", "2024-01-10 06:00:00")
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min("event_time").alias("first_time"),
                                   F.max("event_time").alias("last_time"))


_IDS = ["run-1", "run-10", "run-100", "run-1000", "run-999999999"]


@query("src_runs_by_id", D.RUNS_SQL + f""",
ids(run_source_id) AS (VALUES {", ".join(f"('{i}')" for i in _IDS)})
SELECT i.run_source_id, r.status, r.run_source_id IS NOT NULL AS found
FROM ids i LEFT JOIN runs r ON i.run_source_id = r.run_source_id
""")
def src_runs_by_id(spark, sf):
    found, missing = S.runs_by_id(spark, D.runs(spark, sf), _IDS)
    return (found.select("run_source_id", "status", F.lit(True).alias("found"))
            .unionByName(missing.select("run_source_id", F.lit(None).cast("string").alias("status"),
                                        F.lit(False).alias("found"))))


@query("src_page", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 300
""")
def src_page(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return S.page(o, ["o_orderkey"], 100, 300)


@query("src_page_keyset", """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
WHERE o_orderpriority > '2-HIGH' OR (o_orderpriority = '2-HIGH' AND o_orderkey > 500)
ORDER BY o_orderpriority, o_orderkey LIMIT 100
""")
def src_page_keyset(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return S.keyset_page(o, ["o_orderpriority", "o_orderkey"], ("2-HIGH", 500), 100)


@query("sink_mutations", """
SELECT 'created' AS step, 0 AS row_count, 2 AS n_columns
UNION ALL SELECT 'insert_regions', (SELECT count(*) FROM region), 2
UNION ALL SELECT 'insert_nations', (SELECT count(*) FROM region) + (SELECT count(*) FROM nation), 2
UNION ALL SELECT 'add_column', (SELECT count(*) FROM region) + (SELECT count(*) FROM nation), 3
UNION ALL SELECT 'drop_column', (SELECT count(*) FROM region) + (SELECT count(*) FROM nation), 2
""")
def sink_mutations(spark, sf):
    """Create, insert twice, add and drop a column; a snapshot after each
    step feeds the volume and schema diffs."""
    import uuid

    db = _registered(spark, sf)
    ident = f"{db}.mut_{uuid.uuid4().hex[:8]}"
    base = scratch_path(spark, "mutations")
    C.create_table(spark, ident, "id long, label string", f"{base}/v1")
    snaps = f"{base}/snapshots"

    def snap(step):
        # a snapshot is taken now, so it is written now (appended to the
        # snapshot table); nothing comes back to the driver
        t = spark.table(ident)
        (t.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("row_count"),
               F.lit(len(t.columns)).alias("n_columns"))
         .write.mode("append").parquet(snaps))

    snap("created")
    C.insert_rows(spark, ident, tbl(spark, sf, "region").select(F.col("r_regionkey").cast("long"), "r_name"))
    snap("insert_regions")
    C.insert_rows(spark, ident, tbl(spark, sf, "nation").select(F.col("n_nationkey").cast("long"), "n_name"))
    snap("insert_nations")
    C.add_column(spark, ident, "note", "string")
    snap("add_column")
    C.drop_column(spark, ident, "note", f"{base}/v2")
    snap("drop_column")
    C.drop_table(spark, ident)
    return spark.read.parquet(snaps).select("step", "row_count", "n_columns")


@query("sink_observations", """
SELECT CAST(ts AS DATE) AS metric_date, count(*) AS row_count FROM events GROUP BY 1
""")
def sink_observations(spark, sf):
    ev = tbl(spark, sf, "events")
    daily = M.metric_monitor(ev, ["row_count"], time_col="ts", grain="day")
    path = scratch_path(spark, "observations")
    write_observations(daily.withColumn("metric_date", E.to_date("bucket_start")), path)
    # a re-run of one day replaces only that partition
    again = daily.where(F.col("bucket_start") == E.lit_timestamp("2024-01-03 00:00:00"))
    write_observations(again.withColumn("metric_date", E.to_date("bucket_start")), path)
    back = spark.read.parquet(path)
    return back.select(F.col("metric_date").cast("date").alias("metric_date"), "row_count")
