"""Metrics through the one-scan monitor, with plan checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from tidewatch.functions.metrics import REGISTRY, metrics_for
from tidewatch.operators import monitors as M
from tidewatch.operators.monitors import MetricSpec as S

# one string column, one row per text metric that must hit
F5 = ["12", "-3.5", "123e4567-e89b-12d3-a456-426614174000", "a@b.co", "NY", "ny", "ZZ", "12345",
      "12345-6789", "(415) 555-0100", "123-45-6789", "   ", "", "null", "N/A", "2024-01-15 10:30:00", None]


@pytest.fixture(scope="module")
def f5(spark):
    return spark.createDataFrame([(v,) for v in F5], "val string")


EXPECTED_F5 = {
    "int": 2, "number": 3, "uuid": 1, "email_address": 1, "us_state_code": 2, "us_zip_code": 2,
    "us_phone": 1, "ssn": 1,
}


def test_text_patterns_f5(f5):
    specs = []
    for n in EXPECTED_F5:
        specs += [S(f"text_{n}_count", "val", f"{n}_c"), S(f"text_not_{n}_count", "val", f"{n}_n"),
                  S(f"text_{n}_rate", "val", f"{n}_r")]
    specs += [S("text_all_spaces_count", "val", "sp"), S("empty_string_count", "val", "em"),
              S("text_null_keyword_count", "val", "nk"), S("text_timestamp_count", "val", "ts"),
              S("text_not_timestamp_count", "val", "nts"), S("row_count")]
    r = M.metric_monitor(f5, specs).first()
    non_null = len([v for v in F5 if v is not None])
    for n, want in EXPECTED_F5.items():
        assert r[f"{n}_c"] == want, n
        assert r[f"{n}_n"] == non_null - want, n        # NULL is in no count (P4)
        assert abs(r[f"{n}_r"] - want / len(F5)) < 1e-12
    assert (r.sp, r.em, r.nk, r.ts, r.nts, r.row_count) == (1, 1, 2, 1, non_null - 1, len(F5))


def test_numeric_metrics(spark):
    df = spark.createDataFrame([(5.0,), (-3.0,), (0.0,), (10.0,), (float("nan"),), (None,)], "val double")
    r = M.metric_monitor(df, [S(m, "val", m) for m in
                              ("zero_count", "zero_rate", "negative_count", "nan_count", "nan_rate", "sum",
                               "approx_distinct_count")], exact=True).first()
    assert (r.zero_count, r.negative_count, r.nan_count) == (1, 1, 1)
    assert abs(r.zero_rate - 1 / 6) < 1e-12 and abs(r.nan_rate - 1 / 6) < 1e-12
    assert r.approx_distinct_count == 5


def test_percentile_family_shares_one_sketch(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "val")
    names = ["numeric_median", "percentile_20", "percentile_80", "approx_quantiles", "approx_quantiles5"]
    out = M.metric_monitor(df, [S(n, "val", n) for n in names], exact=True)
    r = out.first()
    assert r.numeric_median == 50.5 and r.approx_quantiles5 == 100.0 and len(r.approx_quantiles) == 6
    assert plan_text(out).count("percentile(") <= 2       # one aggregate (partial + final)
    approx = M.metric_monitor(df, [S("numeric_median", "val", "m")]).first().m
    assert 45 <= approx <= 55


def test_boolean_array_timestamp_metrics(spark):
    df = spark.createDataFrame(
        [(True, [1], "2024-01-01 00:00:00"), (False, [], "1970-01-01 00:00:00"), (None, None, "2100-01-01 00:00:00")],
        "b boolean, a array<int>, s string").withColumn("t", F.col("s").cast("timestamp_ntz"))
    r = M.metric_monitor(df, [S("true_count", "b", "t1"), S("false_count", "b", "f1"), S("true_rate", "b", "tr"),
                              S("array_null_rate", "a", "an"), S("past_timestamp_count", "t", "past"),
                              S("future_timestamp_count", "t", "fut"), S("unix_zero_count", "t", "z")],
                         as_of=dt.datetime(2024, 6, 1)).first()
    assert (r.t1, r.f1, r.past, r.fut, r.z) == (1, 1, 2, 1, 1)
    assert abs(r.tr - 1 / 3) < 1e-12 and abs(r.an - 2 / 3) < 1e-12


def test_rates_are_null_for_zero_rows(spark):
    df = spark.createDataFrame([], "val long")
    r = M.metric_monitor(df, [S("zero_rate", "val", "r"), S("row_count")]).first()
    assert r.r is None and r.row_count == 0


def test_one_scan_and_no_expand(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    seven = M.metric_monitor(li, [S("row_count"), S("zero_count", "l_discount"), S("numeric_mean", "l_quantity"),
                                  S("numeric_stddev", "l_quantity"), S("numeric_median", "l_extendedprice"),
                                  S("approx_distinct_count", "l_partkey"), S("text_min_length", "l_returnflag")])
    p = plan_text(seven)
    assert p.count("FileScan parquet") == 1 and "Expand" not in p
    exact2 = M.metric_monitor(li, [S("approx_distinct_count", "l_partkey"), S("approx_distinct_count", "l_suppkey")],
                              segments=["l_returnflag"], exact=True)
    assert "Expand" not in plan_text(exact2)
    got = {r.l_returnflag: r for r in exact2.collect()}
    want = {r.l_returnflag: r for r in li.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("a"), F.count_distinct("l_suppkey").alias("b")).collect()}
    for k in want:
        assert got[k]["l_partkey__approx_distinct_count"] == want[k].a
        assert got[k]["l_suppkey__approx_distinct_count"] == want[k].b


def test_window_pushes_down(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = M.metric_monitor(ev, ["row_count"], time_col="ts", grain="day",
                           window=("2024-01-05 00:00:00", "2024-01-10 00:00:00"))
    p = plan_text(out)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert out.count() == 5


def test_batches_give_same_answer(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    specs = M.profile_specs(o)
    a = {(r.metric, r.column_name): r.value for r in M.profile(o, "o", exact=True, batch_size=7).collect()}
    b = {(r.metric, r.column_name): r.value for r in M.profile(o, "o", exact=True, batch_size=500).collect()}
    assert len(a) == len(specs) and a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or abs(a[k] - b[k]) <= 1e-9 * max(1.0, abs(a[k])), k


def test_fill_and_row_count_change(spark):
    rows = [("2024-01-01 10:00:00", "a"), ("2024-01-01 11:00:00", "a"), ("2024-01-03 09:00:00", "a"),
            ("2024-01-02 09:00:00", "b")]
    df = spark.createDataFrame(rows, "s string, seg string").withColumn("ts", F.col("s").cast("timestamp_ntz"))
    out = M.metric_monitor(df, ["row_count", "row_count_change"], time_col="ts", grain="day", segments=["seg"],
                           fill=True)
    got = sorted((r.seg, r.bucket_start.day, r.row_count, r.row_count_change) for r in out.collect())
    assert got == [("a", 1, 2, None), ("a", 2, 0, -2), ("a", 3, 1, 1), ("b", 2, 1, None)]


def test_registry_and_applicability(spark):
    assert len([m for m in REGISTRY if m not in ("row_count", "row_count_change")]) == 71
    from pyspark.sql import types as T
    assert "nan_count" in metrics_for(T.DoubleType()) and "nan_count" not in metrics_for(T.LongType())
    sch = T.StructType([T.StructField("x", T.StringType()), T.StructField("b", T.BooleanType())])
    got = {(r.column_name, r.metric) for r in M.applicable_metrics(spark, sch).collect()}
    assert ("x", "text_ssn_rate") in got and ("b", "true_rate") in got and ("b", "text_ssn_rate") not in got


def test_fill_with_exact_distinct_passes(spark):
    rows = [("2024-01-01 10:00:00", "a", 1, 7), ("2024-01-01 11:00:00", "a", 2, 7), ("2024-01-03 09:00:00", "a", 1, 8)]
    df = spark.createDataFrame(rows, "s string, seg string, x long, y long") \
        .withColumn("ts", F.col("s").cast("timestamp_ntz"))
    out = M.metric_monitor(df, ["row_count", S("approx_distinct_count", "x", "dx"), S("approx_distinct_count", "y", "dy"),
                                S("zero_count", "x", "zeros"), S("numeric_mean", "x", "mean")],
                           time_col="ts", grain="day", segments=["seg"], exact=True, fill=True)
    got = sorted((r.bucket_start.day, r.row_count, r.dx, r.dy, r.zeros, r.mean) for r in out.collect())
    assert got == [(1, 2, 2, 1, 0, 1.5), (2, 0, 0, 0, 0, None), (3, 1, 1, 1, 0, 1.0)]
