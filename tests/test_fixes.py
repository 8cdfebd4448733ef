"""Inputs the fixtures do not hold: zones, ties, long chains, shared sinks."""

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions import exprs as E
from tidewatch.operators import etl as X
from tidewatch.operators import lineage as L
from tidewatch.session import scratch_path
from tidewatch.sources import events as S
from tidewatch.sources import sinks


def test_aware_bounds_and_text_zones(spark):
    east = dt.timezone(dt.timedelta(hours=5))
    row = spark.range(1).select(
        E.as_of(dt.datetime(2024, 1, 10, 5, tzinfo=east)).alias("a"), E.as_of("2024-01-10T05:00:00+05:00").alias("b"),
        E.as_of("2024-01-10 05:00:00").alias("c"), S._bound("2024-01-10T02:00:00+02:00").alias("d")).first()
    midnight = dt.datetime(2024, 1, 10)
    assert row.a == row.b == row.d == midnight and row.c == dt.datetime(2024, 1, 10, 5)


def test_epoch_milliseconds_are_null_not_an_error(spark):
    got = spark.createDataFrame([(0,), (1_700_000_000_000_000,)], "x long").select(E.epoch_to_ts("x").alias("t")).collect()
    assert got[0].t == dt.datetime(1970, 1, 1) and got[1].t is None


def test_latest_state_of_tied_events(spark):
    rows = [("r", "t1", "running", 1), ("r", "t1", "success", 2)]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "run_source_id string, event_time string, status string, event_pos int")
        assert X.latest_run_state(df).first().status == "success"


def test_downstream_follows_long_chains(spark):
    n = 10
    edges = [(f"j{i}", "INPUT", f"t{i}") for i in range(n)] + [(f"j{i}", "OUTPUT", f"t{i + 1}") for i in range(n)]
    got = L.downstream(spark.createDataFrame(edges, "job_source_id string, role string, asset_name string"),
                       spark.createDataFrame([("t0",)], "asset_name string"), checkpoint_every=2)
    assert got.agg(F.max("distance")).first()[0] == n


def test_keyset_pages_tied_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4), (1, 5), (2, 6)], "k int, id int")
    seen, after = [], None
    while page := S.keyset_page(df, ["k", "id"], after, 2).collect():
        seen += [r.id for r in page]
        after = (page[-1].k, page[-1].id)
    assert seen == [1, 2, 3, 4, 5, 6]


def test_tables_share_an_observation_path(spark):
    path = scratch_path(spark, "observations")
    for name in ("a", "b", "b"):
        sinks.write_observations(spark.createDataFrame([(name, 1.0, dt.date(2024, 1, 1))],
                                                       "table_id string, value double, metric_date date"), path)
    assert sorted(r.table_id for r in spark.read.parquet(path).collect()) == ["a", "b"]
