"""Registered queries for the monitors (MON1-MON13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import history as H
from tidewatch.operators.diffs import row_diff
from tidewatch.operators import monitors as M
from tidewatch.plans.common import query, rounded, tbl


def flagship(spark, sf):
    """Row count, zero rate of the discount and mean quantity of lineitem by
    month of ship date and return flag, in one scan."""
    li = tbl(spark, sf, "lineitem")
    out = M.metric_monitor(
        li,
        [M.MetricSpec("row_count"),
         M.MetricSpec("zero_rate", "l_discount", "zero_rate"),
         M.MetricSpec("numeric_mean", "l_quantity", "mean_qty")],
        time_col="l_shipdate", grain="month", segments=["l_returnflag"])
    return rounded(out, "zero_rate", "mean_qty")


query("mon_metric", """
SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS bucket_start, l_returnflag,
       count(*) AS row_count,
       round(least(count_if(l_discount = 0)::DOUBLE / count(*), 1.0), 6) AS zero_rate,
       round(avg(l_quantity), 6) AS mean_qty
FROM lineitem GROUP BY 1, 2
""")(flagship)


# ------------------------------------------------------------------ MON2, MON3

from tidewatch.functions import exprs as E  # noqa: E402
from tidewatch.functions.capabilities import mapping_rows  # noqa: E402
from tidewatch.functions.metrics import kind_table  # noqa: E402
from tidewatch.operators import joins as J  # noqa: E402
from tidewatch.plans import derived as D  # noqa: E402
from tidewatch.plans.common import AS_OF_ORDERS, rnd  # noqa: E402
from tidewatch.plans.sql_templates import profile_sql  # noqa: E402
from tidewatch.session import scratch_path  # noqa: E402


def _profile_orders(spark, sf, columns=None):
    o = tbl(spark, sf, "orders")
    p = M.profile(o, "orders", columns=columns, as_of=AS_OF_ORDERS, exact=True)
    return p.select("table_id", "column_name", "metric", rnd("value").alias("value"))


def _orders_profile_specs(spark_free_columns):
    """(column, metric) pairs of the profile of orders, from the same schema
    rules the library uses (kinds of the parquet types)."""
    from pyspark.sql import types as T

    from tidewatch.operators.monitors import PROFILE_SKIP
    from tidewatch.functions.metrics import metrics_for

    types = {"o_orderkey": T.LongType(), "o_custkey": T.LongType(), "o_orderstatus": T.StringType(),
             "o_totalprice": T.DoubleType(), "o_orderdate": T.TimestampNTZType(),
             "o_orderpriority": T.StringType()}
    specs = [(None, "row_count")]
    for c in spark_free_columns:
        specs += [(c, m) for m in metrics_for(types[c]) if m not in PROFILE_SKIP]
    return specs


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("mon_profile", profile_sql("orders", "orders", _orders_profile_specs(_ORDER_COLS), AS_OF_ORDERS))
def mon_profile(spark, sf):
    return _profile_orders(spark, sf)


def _kind_values() -> str:
    return ", ".join(f"('{k}', '{m}')" for k, m in kind_table())


@query("mon_applicability", f"""
WITH kinds(kind, metric) AS (VALUES {_kind_values()}),
cols AS (
  SELECT column_name, CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT') OR data_type LIKE 'DECIMAL%'
                           THEN ['numeric', 'any']
                           WHEN data_type IN ('DOUBLE', 'FLOAT') THEN ['numeric', 'float', 'any']
                           WHEN data_type = 'VARCHAR' THEN ['string', 'any']
                           WHEN data_type = 'BOOLEAN' THEN ['boolean', 'any']
                           WHEN data_type IN ('TIMESTAMP', 'DATE') THEN ['timestamp', 'any']
                           WHEN data_type LIKE '%[]' THEN ['array', 'any'] ELSE ['any'] END AS ks
  FROM information_schema.columns WHERE table_name = 'lineitem')
SELECT c.column_name, k.metric FROM cols c, kinds k WHERE list_contains(c.ks, k.kind)
""")
def mon_applicability(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return M.applicable_metrics(spark, li.schema).select("column_name", "metric")


# ------------------------------------------------------------------ MON4

def _map_values() -> str:
    return ", ".join(f"('{t}', '{m}')" for t, m in mapping_rows())


_TEMPLATES = sorted({t for t, _ in mapping_rows()})
_TEMPLATE_CASE = "CASE doc_id % {n} " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TEMPLATES)) + " END"


@query("mon_capability", f"""
WITH mapping(template, metric) AS (VALUES {_map_values()}),
results AS (
  SELECT doc_id AS test_no, {_TEMPLATE_CASE.format(n=len(_TEMPLATES))} AS template,
         CASE WHEN toxic = 1 AND quality = 0 THEN 'failed' WHEN toxic = 1 THEN 'skipped' ELSE 'passed' END AS status
  FROM labels),
per_template AS (
  SELECT template, CASE WHEN bool_or(status = 'failed') THEN 'failed' ELSE arg_min(status, test_no) END AS template_status
  FROM results GROUP BY 1)
SELECT m.metric, bool_and(p.template_status = 'passed') AS supported
FROM mapping m JOIN per_template p ON m.template = p.template GROUP BY 1
""")
def mon_capability(spark, sf):
    lb = tbl(spark, sf, "labels")
    tmpl = E.case_when([(F.col("doc_id") % len(_TEMPLATES) == i, t) for i, t in enumerate(_TEMPLATES)])
    status = E.case_when([((F.col("toxic") == 1) & (F.col("quality") == 0), "failed"),
                          (F.col("toxic") == 1, "skipped")], "passed")
    results = lb.select(F.col("doc_id").alias("test_no"), tmpl.alias("template"), status.alias("status"))
    mapping = spark.createDataFrame(mapping_rows(), "template string, metric string")
    return M.capability_rollup(results, mapping)


# ------------------------------------------------------------------ MON5, MON6

@query("mon_custom_sql", """
WITH hits AS (SELECT * FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R')
SELECT count(*) AS row_count, least(count(*), 10) AS preview_rows, least(count(*), 10) AS preview_hits FROM hits
""")
def mon_custom_sql(spark, sf):
    # a view of our own name, so the caller's session keeps its own 'lineitem'
    tbl(spark, sf, "lineitem").createOrReplaceTempView("tw_lineitem")
    count, preview = M.custom_sql_monitor(
        spark, "SELECT * FROM tw_lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'", limit=10)
    shown = preview.agg(F.count(F.lit(1)).alias("preview_rows"),
                        F.count_if((F.col("l_quantity") > 45) & (F.col("l_returnflag") == "R")).alias("preview_hits"))
    return count.crossJoin(F.broadcast(shown))      # one row each


_RULES = [("r1", "numeric_mean", "gt", 20.0, None, None), ("r2", "zero_rate", "lte", 0.05, None, None),
          ("r3", "negative_count", "eq", 0.0, None, None), ("r4", "numeric_stddev", "inside", None, 5.0, 15.0),
          ("r5", "numeric_median", "outside", None, 0.02, 0.08), ("r6", "approx_distinct_count", "gte", 11.0,
                                                                   None, None)]


def _rules_values() -> str:
    def lit(v):
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else f"{v}")
    return ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in _RULES)


@query("mon_threshold", "WITH p AS (" + profile_sql(
    "lineitem", "lineitem", [(c, m) for c in ("l_quantity", "l_discount")
                             for m in ("numeric_mean", "zero_rate", "negative_count", "numeric_stddev",
                                       "numeric_median", "approx_distinct_count")], AS_OF_ORDERS) + f"""),
rules(rule_id, metric, operator, threshold, lower, upper) AS (VALUES {_rules_values()})
SELECT p.column_name, p.metric, p.value, r.rule_id,
       CASE r.operator WHEN 'eq' THEN p.value = r.threshold WHEN 'gt' THEN p.value > r.threshold
            WHEN 'gte' THEN p.value >= r.threshold WHEN 'lt' THEN p.value < r.threshold
            WHEN 'lte' THEN p.value <= r.threshold WHEN 'inside' THEN p.value BETWEEN r.lower AND r.upper
            WHEN 'outside' THEN (p.value < r.lower OR p.value > r.upper) END AS breached
FROM p JOIN rules r ON p.metric = r.metric
""")
def mon_threshold(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_quantity", "l_discount")
    specs = [M.MetricSpec(m, c, f"{c}::{m}") for c in ("l_quantity", "l_discount")
             for m in ("numeric_mean", "zero_rate", "negative_count", "numeric_stddev", "numeric_median",
                       "approx_distinct_count")]
    wide = M.metric_monitor(li, specs, exact=True)
    names = [s.name for s in specs]
    long = wide.select(*[F.col(f"`{n}`").cast("double").alias(n) for n in names]) \
        .unpivot([], [F.col(f"`{n}`") for n in names], "name", "value")
    long = long.select(F.split("name", "::").getItem(0).alias("column_name"),
                       F.split("name", "::").getItem(1).alias("metric"), rnd("value").alias("value"))
    rules = spark.createDataFrame(_RULES, "rule_id string, metric string, operator string, threshold double, "
                                          "lower double, upper double")
    return M.apply_rules(long, rules).select("column_name", "metric", "value", "rule_id", "breached")


# ------------------------------------------------------------------ MON7-MON10

@query("mon_volume_change", D.VOLUME_SQL + """
SELECT table_id, snapshot_time, row_count,
       row_count - lag(row_count) OVER (PARTITION BY table_id ORDER BY snapshot_time) AS row_count_change
FROM snaps
""")
def mon_volume_change(spark, sf):
    s = D.volume_snapshots(spark, sf)
    return M.row_count_change(s).select("table_id", "snapshot_time", "row_count", "row_count_change")


_B, _A = "1995-06-01 00:00:00", "2001-07-01 00:00:00"


@query("mon_volume", D.VOLUME_SQL + f""",
b AS (SELECT lower(table_id) AS k, row_count, byte_count FROM snaps WHERE snapshot_time = TIMESTAMP '{_B}'),
a AS (SELECT lower(table_id) AS k, row_count, byte_count FROM snaps WHERE snapshot_time = TIMESTAMP '{_A}')
SELECT coalesce(b.k, a.k) AS table_id, b.row_count AS rows_before, a.row_count AS rows_after,
       a.row_count - b.row_count AS row_delta,
       CASE WHEN b.k IS NULL THEN 'created' WHEN a.k IS NULL THEN 'dropped' WHEN a.row_count > b.row_count THEN 'grew'
            WHEN a.row_count < b.row_count THEN 'fell' ELSE 'same' END AS row_trend,
       b.byte_count AS bytes_before, a.byte_count AS bytes_after,
       CASE WHEN b.k IS NULL THEN 'created' WHEN a.k IS NULL THEN 'dropped' WHEN a.byte_count > b.byte_count THEN 'grew'
            WHEN a.byte_count < b.byte_count THEN 'fell' ELSE 'same' END AS byte_trend
FROM b FULL OUTER JOIN a ON b.k = a.k
""")
def mon_volume(spark, sf):
    values = ["row_count", "byte_count", "last_update_time"]
    history = H.intervals(D.volume_snapshots(spark, sf), ["table_id"], values)
    return M.volume_monitor(H.as_of(history, _B), H.as_of(history, _A))


@query("mon_freshness", D.VOLUME_SQL + f""",
moved AS (SELECT *, lag(last_update_time) OVER (PARTITION BY table_id ORDER BY snapshot_time) AS prev FROM snaps)
SELECT table_id, max(last_update_time) AS last_update_time,
       date_diff('second', TIMESTAMP '1970-01-01 00:00:00', TIMESTAMP '{AS_OF_ORDERS}')
         - date_diff('second', TIMESTAMP '1970-01-01 00:00:00', max(last_update_time)) AS age_seconds,
       (date_diff('second', TIMESTAMP '1970-01-01 00:00:00', TIMESTAMP '{AS_OF_ORDERS}')
         - date_diff('second', TIMESTAMP '1970-01-01 00:00:00', max(last_update_time))) > 86400 * 30 AS stale,
       arg_max(last_update_time > prev, snapshot_time) AS moved_forward
FROM moved GROUP BY 1
""")
def mon_freshness(spark, sf):
    return M.freshness_monitor(D.volume_snapshots(spark, sf), 86400 * 30, as_of=AS_OF_ORDERS)


# column snapshots of each day: a table per event type, columns that come and go
_COLUMN_SNAPS_SQL = """snaps AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS snapshot_time, concat('app.', event_type) AS full_table_id,
         concat('c', CAST(user_id % 40 AS VARCHAR)) AS column_name, CASE WHEN count(*) % 2 = 0 THEN 'int' ELSE 'string' END AS column_type
  FROM events WHERE (dayofmonth(ts) + length(event_type)) % 4 <> 0 GROUP BY 1, 2, 3)"""


def _column_history(spark, sf):
    """The days' snapshots, folded at once but for the last one, which is
    merged into the stored history."""
    ev = tbl(spark, sf, "events").where((F.dayofmonth("ts") + F.length("event_type")) % 4 != 0)
    snaps = (ev.groupBy(E.bucket("ts", "day").alias("snapshot_time"), F.concat(F.lit("app."), F.col("event_type")).alias("full_table_id"),
                        F.concat(F.lit("c"), (F.col("user_id") % 40).cast("string")).alias("column_name"))
             .agg(F.when(F.count("*") % 2 == 0, F.lit("int")).otherwise(F.lit("string")).alias("column_type")))
    path = scratch_path(spark, "column-snapshots")
    snaps.write.partitionBy("snapshot_time").parquet(path)
    stored = spark.read.schema(snaps.schema).parquet(path)
    days = [r[0] for r in stored.select("snapshot_time").distinct().orderBy(F.desc("snapshot_time")).limit(2).collect()][::-1]
    past = stored.where(F.col("snapshot_time") < F.lit(days[-1]))
    history = H.SnapshotHistory(scratch_path(spark, "column-history"), ["full_table_id", "column_name"], ["column_type"])
    history.start(H.intervals(past, history.keys, history.values), days[0])
    history.add(stored.where(F.col("snapshot_time") == F.lit(days[-1])), days[-1])
    return history.history(spark)


@query("mon_schema_change", "WITH " + _COLUMN_SNAPS_SQL + """,
b AS (SELECT * FROM snaps WHERE snapshot_time = TIMESTAMP '2024-01-09 00:00:00'),
a AS (SELECT * FROM snaps WHERE snapshot_time = TIMESTAMP '2024-01-15 00:00:00')
SELECT coalesce(b.full_table_id, a.full_table_id) AS full_table_id, coalesce(b.column_name, a.column_name) AS column_name,
       CASE WHEN coalesce(b.full_table_id, a.full_table_id) NOT IN (SELECT full_table_id FROM b) THEN 'table_created'
            WHEN coalesce(b.full_table_id, a.full_table_id) NOT IN (SELECT full_table_id FROM a) THEN 'table_dropped'
            WHEN b.column_name IS NULL THEN 'column_added' WHEN a.column_name IS NULL THEN 'column_dropped'
            ELSE 'column_retyped' END AS change
FROM b FULL OUTER JOIN a ON b.full_table_id = a.full_table_id AND b.column_name = a.column_name
WHERE b.column_type IS DISTINCT FROM a.column_type
""")
def mon_schema_change(spark, sf):
    history = _column_history(spark, sf)
    before, after = (H.as_of(history, f"2024-01-{d} 12:00:00") for d in ("09", "15"))
    return M.schema_change(before, after).select("full_table_id", "column_name", "change")


@query("mon_column_history", "WITH " + _COLUMN_SNAPS_SQL + """,
times AS (SELECT snapshot_time, lead(snapshot_time) OVER (ORDER BY snapshot_time) AS nxt FROM (SELECT DISTINCT snapshot_time FROM snaps)),
rows_ AS (SELECT s.*, t.nxt, lag(t.nxt) OVER w AS prev_nxt, lag(column_type) OVER w AS prev_type
          FROM snaps s JOIN times t USING (snapshot_time) WINDOW w AS (PARTITION BY full_table_id, column_name ORDER BY snapshot_time)),
runs AS (SELECT *, sum(CASE WHEN prev_nxt IS NOT DISTINCT FROM snapshot_time AND prev_type = column_type THEN 0 ELSE 1 END)
                OVER (PARTITION BY full_table_id, column_name ORDER BY snapshot_time) AS run FROM rows_)
SELECT full_table_id, column_name, column_type, min(snapshot_time) AS valid_from, arg_max(coalesce(nxt, TIMESTAMP '9999-12-31'), snapshot_time) AS valid_to
FROM runs GROUP BY full_table_id, column_name, column_type, run
""")
def mon_column_history(spark, sf):
    """All intervals; one that is still open ends at the end of time here."""
    end = F.coalesce("valid_to", E.lit_timestamp("9999-12-31 00:00:00")).alias("valid_to")
    return _column_history(spark, sf).select("full_table_id", "column_name", "column_type", "valid_from", end)


@query("mon_asof_join", "WITH " + _COLUMN_SNAPS_SQL + """,
ev AS (SELECT event_id, ts, concat('app.', event_type) AS full_table_id, concat('c', CAST(user_id % 40 AS VARCHAR)) AS column_name FROM events),
at_time AS (SELECT e.*, (SELECT max(snapshot_time) FROM snaps WHERE snapshot_time <= e.ts) AS seen FROM ev e)
SELECT e.event_id, s.column_type FROM at_time e
LEFT JOIN snaps s ON s.snapshot_time = e.seen AND s.full_table_id = e.full_table_id AND s.column_name = e.column_name
""")
def mon_asof_join(spark, sf):
    """Each event with the type that its column had when it happened."""
    ev = tbl(spark, sf, "events").select("event_id", "ts", F.concat(F.lit("app."), F.col("event_type")).alias("full_table_id"),
                                         F.concat(F.lit("c"), (F.col("user_id") % 40).cast("string")).alias("column_name"))
    return H.asof_join(ev, _column_history(spark, sf), ["full_table_id", "column_name"], "ts", ["column_type"]).select("event_id", "column_type")


# ------------------------------------------------------------------ MON11-MON13

@query("mon_query_captured", """
SELECT count(*) AS captured FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00' AND event_type <> 'error'
""")
def mon_query_captured(spark, sf):
    logs = D.query_logs(spark, sf).where(~F.col("query_text").contains("broken"))
    hits = M.query_captured(logs, "  SELECT 1 ", window=("2024-01-10 00:00:00", "2024-01-17 00:00:00"))
    return hits.agg(F.count(F.lit(1)).alias("captured"))


@query("mon_rca_sample", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000
ORDER BY md5(concat(CAST(o_orderkey AS VARCHAR), 'rca')), o_orderkey LIMIT 25
""")
def mon_rca_sample(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return M.rca_sample(o, F.col("o_totalprice") > 300000, "o_orderkey", 25, "rca")


@query("mon_rca_summary", """
WITH seg AS (SELECT o_orderpriority, count(*) AS rows, count_if(o_totalprice > 300000) AS breaching_rows,
                    max(o_orderdate) AS latest_time FROM orders GROUP BY 1),
tot AS (SELECT sum(breaching_rows)::DOUBLE / sum(rows) AS overall FROM seg)
SELECT o_orderpriority, rows, breaching_rows, round(breaching_rows::DOUBLE / rows, 6) AS breach_rate,
       round(abs(breaching_rows::DOUBLE / rows - overall), 6) AS rate_distance, latest_time
FROM seg, tot
""")
def mon_rca_summary(spark, sf):
    o = tbl(spark, sf, "orders")
    s = M.rca_summary(o, F.col("o_totalprice") > 300000, ["o_orderpriority"], "o_orderdate")
    return s.select("o_orderpriority", "rows", "breaching_rows", rnd("breach_rate").alias("breach_rate"),
                    rnd("rate_distance").alias("rate_distance"), "latest_time")


# ------------------------------------------------------------------ JOIN1, JOIN2

@query("join_run_asset", D.RUNS_SQL + ", " + D.EDGES_SQL + """,
jobs AS (SELECT DISTINCT concat('job-', CAST(job AS VARCHAR)) AS job_source_id,
                CASE WHEN job % 10 <> 0 THEN concat('Job ', CAST(job AS VARCHAR)) END AS job_name FROM edges)
SELECT r.job_source_id, j.job_name, 'run' AS kind, count(*) AS n FROM runs r JOIN jobs j USING (job_source_id) GROUP BY 1, 2
UNION ALL SELECT r.job_source_id, NULL, 'orphan_run', count(*) FROM runs r
  WHERE r.job_source_id NOT IN (SELECT job_source_id FROM jobs) GROUP BY 1
UNION ALL SELECT j.job_source_id, j.job_name, 'idle_job', 1 FROM jobs j
  WHERE j.job_source_id NOT IN (SELECT job_source_id FROM runs)
""")
def join_run_asset(spark, sf):
    from tidewatch.operators.etl import vstr

    assets = D.asset_events(spark, sf).select(vstr(F.col("v"), "$.job_source_id").alias("job_source_id"),
                                              vstr(F.col("v"), "$.name").alias("name"))
    runs = D.runs(spark, sf).select("job_source_id", "run_source_id")
    with_job, _, idle = J.run_asset_join(runs, assets)
    kind = F.when(F.col("has_job"), F.lit("run")).otherwise(F.lit("orphan_run")).alias("kind")
    counted = with_job.groupBy("job_source_id", "job_name", kind).agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(idle.select("job_source_id", "job_name", F.lit("idle_job").alias("kind"),
                                           F.lit(1).cast("long").alias("n")))


@query("join_compare", """
WITH l AS (SELECT l_returnflag, count(*) AS row_count, avg(l_quantity) AS mean_qty FROM lineitem GROUP BY 1),
r AS (SELECT l_returnflag, count(*) AS row_count, avg(l_quantity) AS mean_qty FROM lineitem WHERE l_discount > 0.02 GROUP BY 1)
SELECT coalesce(l.l_returnflag, r.l_returnflag) AS l_returnflag, l.row_count AS left_row_count,
       round(l.mean_qty, 6) AS left_mean_qty, r.row_count AS right_row_count, round(r.mean_qty, 6) AS right_mean_qty,
       r.row_count - l.row_count AS diff_row_count, round(r.mean_qty - l.mean_qty, 6) AS diff_mean_qty,
       (l.row_count IS NOT DISTINCT FROM r.row_count AND l.mean_qty IS NOT DISTINCT FROM r.mean_qty) AS same
FROM l FULL OUTER JOIN r ON l.l_returnflag IS NOT DISTINCT FROM r.l_returnflag
""")
def join_compare(spark, sf):
    li = tbl(spark, sf, "lineitem")
    out = J.compare(li, li.where(F.col("l_discount") > 0.02), ["l_returnflag"],
                    {"row_count": F.count(F.lit(1)), "mean_qty": F.avg("l_quantity")})
    return out.select("l_returnflag", "left_row_count", rnd("left_mean_qty").alias("left_mean_qty"),
                      "right_row_count", rnd("right_mean_qty").alias("right_mean_qty"), "diff_row_count",
                      rnd("diff_mean_qty").alias("diff_mean_qty"), "same")


# ------------------------------------------------------------------ results as OBSERVATION rows

@query("mon_observations", f"""
WITH g AS (SELECT CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS bucket_start, o_orderstatus,
                  count(*) AS rc, avg(o_totalprice) AS mean, count_if(o_totalprice = 0) AS zc
           FROM orders GROUP BY 1, 2)
SELECT 'orders' AS table_id, CAST(NULL AS VARCHAR) AS column_name, 'row_count' AS metric, o_orderstatus,
       bucket_start, round(rc::DOUBLE, 6) AS value, TIMESTAMP '{AS_OF_ORDERS}' AS as_of FROM g
UNION ALL SELECT 'orders', 'o_totalprice', 'numeric_mean', o_orderstatus, bucket_start, round(mean, 6),
       TIMESTAMP '{AS_OF_ORDERS}' FROM g
UNION ALL SELECT 'orders', 'o_totalprice', 'zero_count', o_orderstatus, bucket_start, round(zc::DOUBLE, 6),
       TIMESTAMP '{AS_OF_ORDERS}' FROM g
""")
def mon_observations(spark, sf):
    o = tbl(spark, sf, "orders")
    obs = M.observations(o, "orders", ["row_count", ("o_totalprice", "numeric_mean"), ("o_totalprice", "zero_count")],
                         time_col="o_orderdate", grain="year", segments=["o_orderstatus"], as_of=AS_OF_ORDERS)
    return obs.select("table_id", "column_name", "metric", F.col("segment")["o_orderstatus"].alias("o_orderstatus"),
                      "bucket_start", rnd("value").alias("value"), "as_of")


@query("mon_rca_search", """
WITH r AS (
  SELECT concat('o_orderpriority=', o_orderpriority) AS a, concat('o_orderstatus=', o_orderstatus) AS b,
         concat('year=', CAST(year(o_orderdate) AS VARCHAR)) AS c, (o_totalprice > 200000)::INT AS hit FROM orders),
g AS (SELECT a, b, c, count(*) AS n, sum(hit)::BIGINT AS breaches, sum(hit) / count(*) AS rate
      FROM r GROUP BY GROUPING SETS ((), (a), (b), (c), (a, b), (a, c), (b, c), (a, b, c))),
k AS (SELECT *, (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS attributes FROM g
      WHERE n >= 0.02 * (SELECT count(*) FROM orders)),
up AS (
  SELECT s.a, s.b, s.c, max(p.rate) AS parent_rate FROM k s JOIN k p ON p.attributes = s.attributes - 1
   AND (p.a IS NULL OR p.a = s.a) AND (p.b IS NULL OR p.b = s.b) AND (p.c IS NULL OR p.c = s.c) GROUP BY ALL)
SELECT concat_ws(', ', k.a, k.b, k.c) AS segment, k.attributes, k.n, k.breaches, round(k.rate, 6) AS rate,
       round(up.parent_rate, 6) AS parent_rate, round(k.rate - up.parent_rate, 6) AS gain
FROM k JOIN up ON k.a IS NOT DISTINCT FROM up.a AND k.b IS NOT DISTINCT FROM up.b AND k.c IS NOT DISTINCT FROM up.c
WHERE k.attributes > 0
""")
def mon_rca_search(spark, sf):
    o = tbl(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    out = M.rca_search(o, F.col("o_totalprice") > 200000, ["o_orderpriority", "o_orderstatus", "year"], min_share=0.02)
    return rounded(out, "rate", "parent_rate", "gain")


@query("join_diff", """
WITH r AS (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 194 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 101 <> 0
  UNION ALL SELECT -o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 103 = 0)
SELECT coalesce(l.o_orderkey, r.o_orderkey) AS o_orderkey,
       CASE WHEN r.o_orderkey IS NULL THEN 'missing' WHEN l.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS change,
       CASE WHEN l.o_orderkey IS NOT NULL AND r.o_orderkey IS NOT NULL THEN
         concat_ws(',', CASE WHEN l.o_totalprice <> r.o_totalprice THEN 'o_totalprice' END,
                   CASE WHEN l.o_orderpriority IS DISTINCT FROM r.o_orderpriority THEN 'o_orderpriority' END) END AS columns
FROM orders l FULL OUTER JOIN r ON l.o_orderkey = r.o_orderkey
WHERE r.o_orderkey IS NULL OR l.o_orderkey IS NULL OR l.o_totalprice <> r.o_totalprice OR l.o_orderpriority IS DISTINCT FROM r.o_orderpriority
""")
def join_diff(spark, sf):
    """Orders against a copy in which some prices and priorities changed, some
    rows are gone and some are new."""
    values = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
    o, k = tbl(spark, sf, "orders").select("o_orderkey", *values), F.col("o_orderkey")
    changed = o.where(k % 101 != 0).withColumns({
        "o_totalprice": F.col("o_totalprice") + F.when(k % 97 == 0, F.lit(1.0)).otherwise(F.lit(0.0)),
        "o_orderpriority": F.when(k % 194 != 0, F.col("o_orderpriority"))})
    copy = changed.unionByName(o.where(k % 103 == 0).withColumn("o_orderkey", -k))
    found = row_diff(o, copy, ["o_orderkey"], values)
    return found.select("o_orderkey", "change", F.array_join("columns", ",").alias("columns"))
