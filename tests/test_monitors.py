"""Monitors, joins and catalog snapshots on inline rows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from tidewatch.operators import joins as J
from tidewatch.operators import monitors as M
from tidewatch.session import scratch_path
from tidewatch.sources import catalog as C
from tidewatch.sources import events as S


def test_custom_sql_f23(spark):
    spark.range(10).withColumnRenamed("id", "val").createOrReplaceTempView("f23")
    count, preview = M.custom_sql_monitor(spark, "SELECT * FROM f23 WHERE val < 3", limit=5)
    assert count.first().row_count == 3
    _, preview = M.custom_sql_monitor(spark, "SELECT * FROM f23", limit=5)
    assert preview.count() == 5


def test_threshold_rules(spark):
    metrics = spark.createDataFrame([("m1", 5.0), ("m2", 12.0), ("m3", None)], "metric string, value double")
    rules = spark.createDataFrame(
        [("a", "m1", "gt", 4.0, None, None), ("b", "m2", "inside", None, 5.0, 10.0),
         ("c", "m2", "outside", None, 5.0, 10.0), ("d", "m3", "eq", 1.0, None, None),
         ("e", "m1", "lte", 5.0, None, None)],
        "rule_id string, metric string, operator string, threshold double, lower double, upper double")
    got = {r.rule_id: r.breached for r in M.apply_rules(metrics, rules).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": None, "e": True}


def test_capability_rollup(spark):
    results = spark.createDataFrame(
        [(1, "t_avg", "passed"), (2, "t_avg", "failed"), (3, "t_len", "skipped"), (4, "t_len", "passed"),
         (5, "t_sum", "passed")], "test_no long, template string, status string")
    mapping = spark.createDataFrame([("t_avg", "numeric_mean"), ("t_len", "text_max_length"),
                                     ("t_sum", "sum"), ("t_len", "text_std_length"), ("t_sum", "text_std_length"),
                                     ("t_none", "never_tested")], "template string, metric string")
    got = {r.metric: r.supported for r in M.capability_rollup(results, mapping).collect()}
    # failure wins; first result (skipped) stays; metrics without results are absent
    assert got == {"numeric_mean": False, "text_max_length": False, "sum": True, "text_std_length": False}


def test_volume_freshness_schema(spark):
    snaps = spark.createDataFrame([
        ("db.a", dt.datetime(2024, 1, 1), 10, 100, dt.datetime(2024, 1, 1)),
        ("db.a", dt.datetime(2024, 1, 2), 15, 150, dt.datetime(2024, 1, 2)),
        ("DB.B", dt.datetime(2024, 1, 1), 5, 50, dt.datetime(2023, 12, 1)),
        ("db.b", dt.datetime(2024, 1, 2), 5, 40, dt.datetime(2023, 12, 1)),
        ("db.c", dt.datetime(2024, 1, 2), 1, 1, dt.datetime(2024, 1, 2))],
        "table_id string, snapshot_time timestamp_ntz, row_count long, byte_count long, "
        "last_update_time timestamp_ntz")
    ch = {(r.table_id, r.snapshot_time.day): r.row_count_change for r in M.row_count_change(snaps).collect()}
    assert ch[("db.a", 2)] == 5 and ch[("db.a", 1)] is None
    before = snaps.where(F.dayofmonth("snapshot_time") == 1)
    after = snaps.where(F.dayofmonth("snapshot_time") == 2)
    vol = {r.table_id: (r.row_trend, r.byte_trend) for r in M.volume_monitor(before, after).collect()}
    assert vol == {"db.a": ("grew", "grew"), "db.b": ("same", "fell"), "db.c": ("created", "created")}
    fr = {r.table_id: r for r in M.freshness_monitor(
        snaps.withColumn("table_id", F.lower("table_id")), 86400 * 7, as_of="2024-01-03 00:00:00").collect()}
    assert fr["db.a"].moved_forward is True and fr["db.b"].moved_forward is False
    assert fr["db.b"].stale is True and fr["db.a"].stale is False and fr["db.a"].age_seconds == 86400


def test_mutations_f24(spark):
    """Create, insert, add a column, drop a column, drop the table; each state
    is seen by the snapshots and the diffs."""
    import uuid

    base = scratch_path(spark, "f24")
    db = "tw_tests"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{base}/db'")
    ident = f"{db}.t_{uuid.uuid4().hex[:6]}"
    C.create_table(spark, ident, "id long, value string", f"{base}/v1")
    snap0 = C.volume_snapshot(spark, [ident]).first()
    assert snap0.row_count == 0
    cols0 = C.column_inventory(spark, {ident: spark.table(ident)})
    C.insert_rows(spark, ident, spark.range(10).select("id", F.col("id").cast("string")))
    s1 = C.volume_snapshot(spark, [ident]).first()
    C.insert_rows(spark, ident, spark.range(5).select("id", F.col("id").cast("string")))
    s2 = C.volume_snapshot(spark, [ident]).first()
    assert (s1.row_count, s2.row_count) == (10, 15) and s2.byte_count > s1.byte_count > 0
    assert s2.last_update_time >= s1.last_update_time
    C.add_column(spark, ident, "extra", "int")
    cols1 = C.column_inventory(spark, {ident: spark.table(ident)})
    diff = {(r.column_name, r.change) for r in M.schema_change(cols0, cols1).collect()}
    assert diff == {("extra", "column_added")}
    C.drop_column(spark, ident, "extra", f"{base}/v2")
    cols2 = C.column_inventory(spark, {ident: spark.table(ident)})
    assert {(r.column_name, r.change) for r in M.schema_change(cols1, cols2).collect()} == {("extra", "column_dropped")}
    assert spark.table(ident).count() == 15
    inv = C.table_inventory(spark, [db], table_names=[ident.split(".")[1].upper()])
    assert inv.first().row_count == 15 and inv.first().table_type == "table"
    C.drop_table(spark, ident)
    gone = M.schema_change(cols2, spark.createDataFrame([], cols2.schema))
    assert {r.change for r in gone.collect()} == {"table_dropped"}


def test_query_log_window_and_paging(spark):
    logs = spark.createDataFrame(
        [(f"q{i}", dt.datetime(2024, 1, 1, 0, i), dt.datetime(2024, 1, 1, 0, i, 5), f"select {i}") for i in range(30)],
        "query_id string, start_time timestamp_ntz, end_time timestamp_ntz, query_text string")
    page = S.query_log_scan(logs, "2024-01-01 00:10:00", dt.datetime(2024, 1, 1, 0, 20), limit=4, offset=2)
    assert [r.query_id for r in page.collect()] == ["q12", "q13", "q14", "q15"]
    hits = M.query_captured(logs, "  SELECT 7 ")
    assert [r.query_id for r in hits.collect()] == ["q7"]
    import pytest
    with pytest.raises(ValueError):
        S.runs_in_window(logs, None, "2024-01-02")
    keys = [r.query_id for r in S.keyset_page(logs, "query_id", "q25", 3).collect()]
    assert keys == ["q26", "q27", "q28"]


def test_runs_by_id_and_compare(spark):
    runs = spark.createDataFrame([("r1", "ok"), ("r2", "bad")], "run_source_id string, status string")
    found, missing = S.runs_by_id(spark, runs, ["r1", "r9"])
    assert [r.run_source_id for r in found.collect()] == ["r1"]
    assert [r.run_source_id for r in missing.collect()] == ["r9"]
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    cmp = J.compare(li, li, ["l_returnflag"], {"n": F.count(F.lit(1))})
    assert all(r.same for r in cmp.collect())


def test_rca(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    cond = F.col("o_totalprice") > 200000
    s = M.rca_sample(o, cond, "o_orderkey", 5, "x")
    assert "TakeOrderedAndProject" in plan_text(s) and s.count() == 5
    rows = M.rca_summary(o, cond, ["o_orderstatus"]).collect()
    total = sum(r.breaching_rows for r in rows) / sum(r.rows for r in rows)
    for r in rows:
        assert abs(r.rate_distance - abs(r.breaching_rows / r.rows - total)) < 1e-12


def test_observations_schema_and_values(spark):
    from tidewatch.schemas import OBSERVATION
    from tidewatch.sources.sinks import write_observations

    rows = [("2024-01-01 10:00:00", "a", 0.0), ("2024-01-01 11:00:00", "a", 2.0), ("2024-01-02 09:00:00", "b", 4.0)]
    df = spark.createDataFrame(rows, "s string, seg string, v double").withColumn("ts", F.col("s").cast("timestamp_ntz"))
    obs = M.observations(df.drop("s"), "t", ["row_count", ("v", "zero_count"), ("v", "numeric_mean")],
                         time_col="ts", grain="day", segments=["seg"], as_of="2024-01-03 00:00:00")
    assert [f.name for f in obs.schema.fields] == [f.name for f in OBSERVATION.fields]
    got = {(r.metric, r.segment["seg"], r.bucket_start.day): r.value for r in obs.collect()}
    assert got[("row_count", "a", 1)] == 2 and got[("zero_count", "a", 1)] == 1 and got[("numeric_mean", "b", 2)] == 4.0
    path = scratch_path(spark, "obs")
    write_observations(obs.withColumn("metric_date", F.to_date("bucket_start")), path)
    assert spark.read.parquet(path).count() == obs.count()
    full = M.observations(df.drop("s", "ts"), "t")           # every metric that fits, no buckets
    assert 0.0 <= full.where("metric = 'numeric_median'").first().value <= 4.0
    assert full.where(F.col("bucket_start").isNotNull()).count() == 0
