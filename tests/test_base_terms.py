"""Profiles from base terms equal the metrics measured one by one, in two scans."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from tidewatch.functions.metrics import REGISTRY, register_metric
from tidewatch.operators import monitors as M
from tidewatch.session import read_table


def _odd(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 7 == 0 else float(i % 5 - 2), ["", " ", "12", "n/a", "2024-01-01 10:00:00", "a@b.com", None][i % 7], i % 2 == 0,
             t + dt.timedelta(days=i - 20), [1] if i % 3 else [], None) for i in range(40)] + [
        (None, float("nan"), "x", None, None, None, None), (7, -0.0, "x", None, dt.datetime(1970, 1, 1), None, None)]
    return spark.createDataFrame(rows, "i int, d double, s string, b boolean, t timestamp_ntz, a array<int>, n string")


def _one_by_one(df, exact, at):
    specs = [s for s in M.profile_specs(df) if exact or not REGISTRY[s.metric].distinct]
    row = M.metric_monitor(df, specs, as_of=at, exact=exact, batch_size=40).first()
    return {(s.column, s.metric): row[s.name] for s in specs}


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("rows", ["odd", "none", "orders"])
def test_profile_equals_metrics_one_by_one(spark, exact, rows):
    df = read_table(spark, SF_SMALL, "orders") if rows == "orders" else _odd(spark)
    df, at = df.limit(0) if rows == "none" else df, "2024-01-10 00:00:00"
    got = {(r.column_name, r.metric): r.value for r in M.profile(df, "t", as_of=at, exact=exact).collect()}
    want = _one_by_one(df, exact, at)
    assert set(want) <= set(got) and (not exact or set(got) == set(want))
    for key, value in want.items():
        value = None if value is None else float(value)
        assert got[key] == value or (value is not None and got[key] is not None and (
            math.isclose(got[key], value, rel_tol=1e-9) or math.isnan(value) and math.isnan(got[key]))), (key, got[key], value)


def test_distinct_sketch_is_near(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    got = {r.column_name: r.value for r in M.profile(li, "li").collect() if r.metric == "approx_distinct_count"}
    for c, n in li.agg(*[F.count_distinct(c).alias(c) for c in li.columns]).first().asDict().items():
        assert abs(got[c] - n) <= 0.15 * n + 2, c


def test_profile_takes_two_scans(spark):
    df = M.profile(read_table(spark, SF_SMALL, "lineitem"), "li")
    df.write.format("noop").mode("overwrite").save()
    text = plan_text(df)
    assert text.count("FileScan parquet") + text.count("Scan parquet") <= 2 * 2   # initial and final form of an adaptive plan
    assert "percentile(" not in text


def test_profile_takes_registered_metrics_too(spark):
    register_metric("test_spread", "numeric", lambda x, c: F.max(x) - F.min(x))
    try:
        got = {(r.column_name, r.metric): r.value for r in M.profile(_odd(spark).select("i"), "t").collect()}
    finally:
        del REGISTRY["test_spread"]
    assert got["i", "test_spread"] == 39.0 and got["i", "zero_count"] == 1.0
