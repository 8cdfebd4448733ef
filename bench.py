"""Headline queries at one scale; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into the no-op sink (nothing is collected), so
the time is the full distributed work. Each is run twice; the second (warm)
run is reported, the first is kept under "cold".
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidewatch.functions import exprs as E  # noqa: E402
from tidewatch.operators import etl as X  # noqa: E402
from tidewatch.operators import monitors as M  # noqa: E402
from tidewatch.plans import derived as D  # noqa: E402
from tidewatch.plans.common import tbl  # noqa: E402
from tidewatch.session import build_session, scratch_path  # noqa: E402


def q_flagship(spark, sf):
    from tidewatch.plans.monitor_queries import flagship
    return flagship(spark, sf)


def q_seven_metrics(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return M.metric_monitor(li, [M.MetricSpec("row_count"), M.MetricSpec("zero_count", "l_discount"),
                                 M.MetricSpec("numeric_mean", "l_quantity"),
                                 M.MetricSpec("numeric_stddev", "l_quantity"),
                                 M.MetricSpec("numeric_median", "l_extendedprice"),
                                 M.MetricSpec("approx_distinct_count", "l_partkey")])


def q_profile_lineitem(spark, sf):
    return M.profile(tbl(spark, sf, "lineitem"), "lineitem")


def q_profile_documents(spark, sf):
    return M.profile(tbl(spark, sf, "documents"), "documents")


def q_profile_orders_by_month(spark, sf):
    o = tbl(spark, sf, "orders")
    specs = M.profile_specs(o)
    return M.metric_monitor(o, specs, time_col="o_orderdate", grain="month", segments=["o_orderstatus"])


LANDED: dict[str, str] = {}


def land_inputs(spark, sf):
    """Connector output as it arrives: JSON lines, one event per line, landed
    once before timing (the derivation from the test tables is not timed)."""
    for name, fn in (("runs", D.run_events), ("assets", D.asset_events)):
        path = scratch_path(spark, f"bench-{name}")
        fn(spark, sf).select(F.to_json("v").alias("value")).write.text(path)
        LANDED[name] = path


def _landed(spark, name):
    text = spark.read.text(LANDED[name])
    return X.events_from_json(text.select(F.monotonically_increasing_id().alias("event_pos"),
                                          F.col("value").alias("raw")))


def q_validate_runs(spark, sf):
    return X.validate_runs(_landed(spark, "runs"), D.RUN_MAP, D.TASK_MAP, one_scan=True)


def q_first_errors(spark, sf):
    return X.first_errors(X.validate_runs(_landed(spark, "runs"), D.RUN_MAP, D.TASK_MAP, one_scan=True), 50)


def q_validate_assets(spark, sf):
    return X.validate_assets(_landed(spark, "assets"))


def q_latest_state(spark, sf):
    n = X.normalize_status(D.runs(spark, sf), D.RUN_MAP)
    return X.latest_run_state(n.select("run_source_id", "status_norm", "event_time"))


def q_query_tags(spark, sf):
    from tidewatch.operators import lineage as L
    return L.query_tags(D.query_logs(spark, sf))


def q_lineage_impact(spark, sf):
    from tidewatch.plans.lineage_queries import lin_impact
    return lin_impact(spark, sf)


def q_rca_summary(spark, sf):
    o = tbl(spark, sf, "orders")
    return M.rca_summary(o, F.col("o_totalprice") > 300000, ["o_orderpriority", "o_orderstatus"], "o_orderdate")


def q_text_patterns(spark, sf):
    d = tbl(spark, sf, "documents")
    names = ["email_address", "us_phone", "ssn", "uuid"]
    return M.metric_monitor(d, [M.MetricSpec(f"text_{n}_count", "text") for n in names], segments=["lang"])


def q_rows_in_calendar_week(spark, sf):
    ev = tbl(spark, sf, "events")
    return ev.where(E.in_calendar_week("ts", "2024-01-20 12:00:00")).groupBy("event_type").count()


def q_exact_quantiles(spark, sf):
    from tidewatch.operators.quantiles import exact_quantiles
    return exact_quantiles(tbl(spark, sf, "lineitem"), {"l_extendedprice": [0.05, 0.5, 0.95]}, ["l_returnflag"])


def q_metric_state(spark, sf):
    from tidewatch.operators import sketches as SK
    days = SK.metric_state(tbl(spark, sf, "orders"), "orders", ["o_totalprice", "o_custkey"], "o_orderdate", "day")
    return SK.state_metrics(SK.merge_state(days, "month"))


QUERIES = {
    "flagship_month_returnflag": q_flagship,
    "seven_metrics_one_scan": q_seven_metrics,
    "profile_lineitem": q_profile_lineitem,
    "profile_documents": q_profile_documents,
    "profile_orders_by_month": q_profile_orders_by_month,
    "text_patterns_documents": q_text_patterns,
    "validate_runs": q_validate_runs,
    "first_errors": q_first_errors,
    "validate_assets": q_validate_assets,
    "latest_state": q_latest_state,
    "query_tags": q_query_tags,
    "lineage_impact": q_lineage_impact,
    "rca_summary": q_rca_summary,
    "calendar_week_filter": q_rows_in_calendar_week,
    "exact_quantiles_lineitem": q_exact_quantiles,
    "metric_state_months": q_metric_state,
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    land_inputs(spark, sf)
    warm, cold, built = {}, {}, {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        for rep in range(2):
            t0 = time.perf_counter()
            df = fn(spark, sf)
            built[name] = round(time.perf_counter() - t0, 3)     # of the warm run in the end
            df.write.format("noop").mode("overwrite").save()
            dt = round(time.perf_counter() - t0, 3)
            (cold if rep == 0 else warm)[name] = dt
    total = round(sum(warm.values()), 3)
    print(json.dumps({"metric": "total_warm_sec", "value": total, "unit": "sec", "queries": warm,
                      "cold": cold, "plan_sec": built, "sf": sf.rstrip("/").split("/")[-1], "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
