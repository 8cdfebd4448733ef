"""ETL validation: one hand-written event per rule (FIXTURES section 2)."""

import json

from pyspark.sql import functions as F

from conftest import plan_text
from tidewatch.operators import etl as X

OK = {"job_source_id": "j", "run_source_id": "r", "status": "Success",
      "event_time": "2024-01-01T00:00:00Z", "end_time": "2024-01-01T00:05:00Z"}


def ev(**kw):
    d = dict(OK)
    for k, v in kw.items():
        if v is ...:
            d.pop(k, None)
        else:
            d[k] = v
    return d


RUNS = [
    ev(),                                                           # 0 valid
    ev(event_time=...),                                             # 1
    ev(run_source_id=""),                                           # 2
    ev(job_source_id=...),                                          # 3
    ev(group={}),                                                   # 4
    ev(group="ws"),                                                 # 5
    ev(start_time="yesterday"),                                     # 6
    ev(end_time="2024-01-01T00:05:00"),                             # 7
    ev(end_time=...),                                               # 8
    ev(status="Failed"),                                            # 9
    ev(status="Failed", error={}),                                  # 10 valid: {} is an error object
    ev(status="Weird"),                                             # 11
    ev(status="Weird"),                                             # 12
    ev(status=None),                                                # 13
    ev(status="Mystery"),                                           # 14 mapped to unknown on purpose
    ev(inputs=[{"asset_type": "TABLE", "role": "OUTPUT", "fully_qualified_name": "a.b"}]),   # 15
    ev(inputs=[{"asset_type": "table", "role": "INPUT", "fully_qualified_name": "a.b"}]),    # 16
    ev(inputs=[{"asset_type": "TABLE", "role": "INPUT"}]),                                    # 17
    ev(task_runs=[ev(task_runs=[ev(status="Failed")])]),                                      # 18
    ev(group={"source_id": "ws-1"}, outputs=["oops"]),                                        # 19
    ev(task_runs=["not a run"]),                                                              # 20
]
MAP = {"Success": "success", "FAILED": "failed", "Mystery": "unknown"}

TYPES = "['DASHBOARD', 'DATASET', 'FILE', 'TABLE', 'TOPIC', 'VIEW']"
EXPECTED_RUNS = {
    ("1", "event_time", "event_time is missing"),
    ("2", "run_source_id", "run_source_id is missing"),
    ("3", "job_source_id", "job_source_id is missing"),
    ("4", "group.source_id", "the group has no source_id"),
    ("5", "group", "group is not an object"),
    ("6", "start_time", "not an ISO 8601 time: 'yesterday'"),
    ("7", "end_time", "time without a zone: '2024-01-01T00:05:00'"),
    ("8", "end_time", "status 'Success' is final but end_time is missing"),
    ("9", "error", "status 'Failed' is a failure but error is missing"),
    ("15.inputs.0", "role", "role 'OUTPUT' stands in inputs, which takes INPUT alone"),
    ("16.inputs.0", "asset_type", f"asset_type 'table' is none of {TYPES}"),
    ("17.inputs.0", "fully_qualified_name", "neither mcon nor fully_qualified_name is given"),
    ("18.0.0", "error", "status 'Failed' is a failure but error is missing"),
    ("19.outputs.0", "outputs", "entry 0 is not an object"),
    ("20", "task_runs", "task run 0 is not an object"),
    ("summary", "status", "status 'Weird' has no entry in the status map, nodes: 2"),
    ("summary", "status", "status '' has no entry in the status map, nodes: 1"),
}


def _events(spark, dicts):
    rows = [(i, json.dumps(d)) for i, d in enumerate(dicts)]
    return X.events_from_json(spark.createDataFrame(rows, "event_pos long, raw string"))


def test_validate_runs_rules(spark):
    errs = X.validate_runs(_events(spark, RUNS), MAP)
    got = {(r.event_index, r.field, r.message) for r in errs.collect()}
    assert got == EXPECTED_RUNS
    assert "Exchange" not in plan_text(errs.where("event_index <> 'summary'"))


def test_depth_bound_reports_overflow(spark):
    errs = X.validate_runs(_events(spark, RUNS), MAP, max_depth=1)
    got = {(r.event_index, r.field, r.message) for r in errs.collect()}
    assert ("18.0", "task_runs", "task runs below level 1 are left out, as the caller asked") in got
    assert not any(g[0] == "18.0.0" for g in got)     # not checked, but reported above
    nodes, overflow = X.flatten_task_runs(_events(spark, RUNS), 1)
    assert [r.event_index for r in overflow.collect()] == ["18.0"]


def test_task_runs_at_any_depth(spark):
    deep = ev(status="Odd", run_source_id="")
    for _ in range(29):
        deep = ev(task_runs=["x", deep], note="task_runs")
    wide = ev(task_runs=[ev(task_runs=[]), ev(task_runs={}), ev(task_runs=[ev(run_source_id="")])])
    events = _events(spark, [ev(task_runs=[deep]), wide, {"task_runs": None}, ["task_runs"]])
    nodes, overflow = X.flatten_task_runs(events)
    assert nodes.agg(F.max("depth")).first()[0] == 30 and overflow.count() == 0
    assert nodes.count() == 1 + 1 + 2 * 29 + 1 + 4 + 2
    got = {(r.event_index, r.field) for r in X.validate_runs(events, MAP).collect()}
    assert {("0.0" + ".1" * 29, "run_source_id"), ("1.2.0", "run_source_id"), ("3", "event"), ("summary", "status")} < got


def test_status_without_map_and_task_map(spark):
    runs = [ev(status="SUCCESS"), ev(status="done", task_runs=[ev(status="Bad", end_time=...)])]
    no_map = {(r.event_index, r.field) for r in X.validate_runs(_events(spark, runs)).collect()}
    assert no_map == set()           # lower-cased only: 'bad' is not final, 'done' is not final
    tm = {(r.event_index, r.field, r.message) for r in
          X.validate_runs(_events(spark, runs), {"success": "success", "done": "success"},
                          {"bad": "error"}).collect()}
    assert ("1.0", "end_time", "status 'Bad' is final but end_time is missing") in tm
    assert ("1.0", "error", "status 'Bad' is a failure but error is missing") in tm
    assert len(tm) == 2


def test_first_errors_orders_and_caps(spark):
    many = [ev(run_source_id="", job_source_id="") for _ in range(40)] + [ev(status="Weird")]
    errs = X.validate_runs(_events(spark, many), MAP)
    first = X.first_errors(errs, 50)
    rows = first.collect()
    assert len(rows) == 50 and rows[0].event_index == "0" and rows[1].event_index == "0"
    assert "TakeOrderedAndProject" in plan_text(first)
    assert errs.count() == 81         # the full table keeps everything


ASSETS = [
    {"job_source_id": "j0", "name": "n"},
    {"job_source_id": "j1"},
    {"job_source_id": "j2", "name": "n", "group": "ws"},
    {"job_source_id": "j3", "name": "n", "tasks": ["oops"]},
    {"job_source_id": "j4", "name": "n", "tasks": [{"name": "t"}]},
    {"job_source_id": "j5", "name": "n", "tasks": [{"task_source_id": "t", "name": "t", "outputs": [
        {"asset_type": "TABLE", "role": "INPUT", "fully_qualified_name": "x"}]}]},
]


def test_validate_assets_rules(spark):
    got = {(r.event_index, r.field, r.message) for r in X.validate_assets(_events(spark, ASSETS)).collect()}
    assert got == {
        ("1", "name", "name is missing"),
        ("2", "group", "group is not an object"),
        ("3", "tasks", "task 0 is not an object"),
        ("4.tasks.0", "task_source_id", "task_source_id is missing"),
        ("5.tasks.0.outputs.0", "role", "role 'INPUT' stands in outputs, which takes OUTPUT alone"),
    }


def test_iso8601_states(spark):
    rows = [("2024-01-01T10:00:00Z", "valid"), ("2024-01-01T10:00:00+02:00", "valid"),
            ("2024-01-01 10:00:00.123456-05:00", "valid"), ("2024-01-01T10:00:00", "naive"),
            ("2024-01-01", "naive"), ("10:30:00", "invalid"), ("2024-13-01T00:00:00Z", "invalid"),
            ("soon", "invalid")]
    df = spark.createDataFrame(rows, "t string, want string")
    for r in df.select("want", X.iso8601_state(F.col("t")).alias("got")).collect():
        assert r.got == r.want


def test_status_map_checks_and_normalize(spark):
    m = spark.createDataFrame([("Succeeded", "success"), ("SUCCEEDED", "success"), ("", "failed"),
                               ("Paused", "paused")], "key string, value string")
    got = {(r.key, r.problem) for r in X.check_status_map(m).collect()}
    assert got == {("Succeeded", "duplicate key ignoring case"), ("SUCCEEDED", "duplicate key ignoring case"),
                   ("", "empty key"), ("Paused", "value not canonical")}
    runs = spark.createDataFrame([("a", "SUCCEEDED"), ("b", "paused"), ("c", None)], "id string, status string")
    by_dict = {r.id: (r.status_norm, r.unmapped) for r in X.normalize_status(runs, {"succeeded": "Success"}).collect()}
    assert by_dict == {"a": ("success", False), "b": ("unknown", True), "c": ("unknown", True)}
    by_df = {r.id: r.status_norm for r in X.normalize_status(runs, m).collect()}
    assert by_df == {"a": "success", "b": "paused", "c": "failed"}     # NULL status is '', mapped by the empty key
    un = {r.status: r["count"] for r in X.unmapped_statuses(runs, {"succeeded": "success"}).collect()}
    assert un == {"paused": 1, "": 1}


def test_latest_stats_group_coverage(spark):
    runs = spark.createDataFrame([
        ("r1", "j1", "in_progress", "2024-01-01 00:00:00", None),
        ("r1", "j1", "failed", "2024-01-01 00:10:00", "2024-01-01 00:10:00"),
        ("r2", "j1", "success", "2024-01-01 01:00:00", "2024-01-01 01:00:30")],
        "run_source_id string, job_source_id string, status_norm string, s string, e string") \
        .select("run_source_id", "job_source_id", "status_norm", F.col("s").cast("timestamp_ntz").alias("event_time"),
                F.col("e").cast("timestamp_ntz").alias("end_time"))
    latest = {r.run_source_id: (r.status_norm, r.events) for r in X.latest_run_state(runs).collect()}
    assert latest == {"r1": ("failed", 2), "r2": ("success", 1)}
    st = X.run_stats(runs.where(F.col("end_time").isNotNull()), exact=True, start="event_time").first()
    assert st.runs == 2 and st.mean_duration == 15.0 and st.failure_rate == 0.5
    placements = spark.createDataFrame([("j1", "ws-a"), ("j2", "ws-a"), ("j2", "ws-b")],
                                       "job_source_id string, group_source_id string")
    rg = spark.createDataFrame([("x", "j1", None), ("y", "j2", None), ("z", "j2", "ws-b"), ("w", "j3", None)],
                               "run_source_id string, job_source_id string, run_group string")
    got = {r.run_source_id: (r.group_source_id, r.group_origin) for r in X.attribute_group(rg, placements).collect()}
    assert got == {"x": ("ws-a", "job"), "y": (None, "ambiguous"), "z": ("ws-b", "run"), "w": (None, "none")}
    cov = {r.feature: r.supported for r in X.feature_coverage(
        _events(spark, ASSETS), _events(spark, RUNS), MAP, spark,
        {"run_status_mapping": MAP}).collect()}
    assert cov["metadata_tasks"] and not cov["metadata_group"] and cov["run_task_runs"] and cov["run_group"]
    # the only failed run with an error carries {}, which is no error detail
    assert not cov["run_error"] and cov["manifest_run_status_mapping"] and not cov["manifest_credentials_schema"]
    assert len(cov) == 16


def test_one_scan_finds_the_same(spark):
    many = RUNS + RUNS[:3] + [{"event_time": "2024-01-01T00:00:00Z", "status": "odd", "run_source_id": f"m{i}", "job_source_id": "j",
                               "task_runs": [{"status": "Odd"}, 5, {"status": "odd"}]} for i in range(20)]
    rows = lambda x: sorted(map(repr, map(tuple, x.collect())))
    once = X.validate_runs(_events(spark, many), MAP, one_scan=True)
    assert rows(once) == rows(X.validate_runs(_events(spark, many), MAP))
    assert sum(r.event_index == "summary" for r in once.collect()) >= 2
    no_map = X.validate_runs(_events(spark, many), one_scan=True)
    assert rows(no_map) == rows(X.validate_runs(_events(spark, many)))


def test_task_runs_are_copied_once_a_level(spark):
    """A value taken out as a variant is written anew: the way to the task runs is followed in the cast to their array."""
    events = X.events_from_json(spark.createDataFrame([(1, '{"task_runs":[{"task_runs":[{"a":1}, 2]}]}'), (2, '{"task_runs":3}')], "event_pos long, raw string"))
    nodes, _ = X.flatten_task_runs(events)
    assert sorted(r["event_index"] for r in nodes.select("event_index").collect()) == ["1", "1.0", "1.0.0", "1.0.1", "2"]
    plan = nodes._jdf.queryExecution().analyzed().toString()
    assert "$.task_runs, ArrayType(VariantType" in plan and "$.task_runs, VariantType" not in plan
