"""Lineage: tags (FIXTURES section 2), edges, downstream impact against a
brute-force walk on a small graph with a cycle."""

import json
from collections import deque

from pyspark.sql import functions as F

from tidewatch.operators import etl as X
from tidewatch.operators import lineage as L

LOGS = [
    ("q1", '-- {"mcd_job_id": "job-1", "mcd_task_id": "t1"}\nINSERT INTO x SELECT 1'),
    ("q2", '-- {"mcd_task_id": "t1"}\nSELECT 1'),
    ("q3", '/* {"mcd_job_id": "job-3"} */ SELECT 1'),
    ("q4", '-- {"dag_id": "d1", "task_id": "x"}\nSELECT 1'),
    ("q5", '-- {"DAG_ID": "d2"}\nSELECT 1'),
    ("q6", '-- {"mcd_job_id": broken\nSELECT 1'),
    ("q7", "SELECT 1"),
    ("q8", '-- {"MCD_JOB_ID": "job-8", "mcd_resource_id": "conn-b"}\nSELECT 1'),
    ("q10", '-- {"app": "x"}\n-- {"task_id": "x"}\n/* {"mcd_job_id":\n "j10"} */ SELECT 1'),
    ("q11", "SELECT '-- {\"mcd_job_id\": \"no\"}', \"/* {\" -- {\"node_id\": \"n\", \"DBT_TARGET\": \"prod\"}"),
    ("q12", "SELECT 'it''s', '\n/* {\"mcd_job_id\": \"no\"} */'"),
    ("q13", None),
    ("q9", '-- {"airflow_dag_id": "d9", "airflow_task": "t9"}\nSELECT 1'),
]


def test_query_tags(spark):
    df = spark.createDataFrame(LOGS, "query_id string, query_text string")
    got = {r.query_id: (r.integration, r.job_id, r.task_id, r.connection_id) for r in L.query_tags(df).collect()}
    assert got == {
        "q1": ("custom", "job-1", "t1", None),
        "q3": ("custom", "job-3", None, None),
        "q4": ("airflow", "d1", "x", None),
        "q5": ("airflow", "d2", None, None),
        "q8": ("custom", "job-8", None, "conn-b"),
        "q9": ("airflow", "d9", "t9", None),
        "q10": ("custom", "j10", None, None),
        "q11": ("dbt", None, "n", None),
    }


def test_resolve_tags(spark):
    tags = spark.createDataFrame([("a", "custom", "j1", None, None), ("b", "custom", "j2", None, None),
                                  ("c", "custom", "j2", None, "c2"), ("d", "custom", "j9", None, None)],
                                 "query_id string, integration string, job_id string, task_id string, "
                                 "connection_id string")
    jobs = spark.createDataFrame([("c1", "j1"), ("c1", "j2"), ("c2", "j2")], "connection_id string, job_source_id string")
    res = L.resolve_tags(tags, jobs)
    from conftest import plan_text
    assert "collect_" not in plan_text(res)             # no list of a job's connections
    got = {r.query_id: (r.match, r.resolved_connection) for r in res.collect()}
    assert got == {"a": ("matched", "c1"), "b": ("ambiguous", None), "c": ("matched", "c2"), "d": ("unmatched", None)}


GRAPH = {"j1": (["A"], ["B"]), "j2": (["B"], ["C"]), "j3": (["C"], ["A"]), "j4": (["C"], ["D"]),
         "j5": (["E"], ["F"]), "j6": (["D", "B"], ["G", "H"])}


def _assets(spark):
    rows = []
    for i, (job, (ins, outs)) in enumerate(sorted(GRAPH.items())):
        rows.append((i, json.dumps({
            "job_source_id": job, "name": job,
            "inputs": [{"asset_type": "TABLE", "role": "INPUT", "fully_qualified_name": t} for t in ins],
            "outputs": [{"asset_type": "TABLE", "role": "OUTPUT", "fully_qualified_name": t} for t in outs],
            "tasks": [{"task_source_id": f"{job}-t", "name": "t", "upstream_task_source_ids": ["u"],
                       "inputs": [{"asset_type": "VIEW", "role": "INPUT", "fully_qualified_name": "V"}]}]})))
    return X.events_from_json(spark.createDataFrame(rows, "event_pos long, raw string"))


def brute(start):
    dist = {s: 0 for s in start}
    q = deque(start)
    while q:
        n = q.popleft()
        for ins, outs in GRAPH.values():
            if n in ins:
                for o in outs:
                    if o not in dist:
                        dist[o] = dist[n] + 1
                        q.append(o)
    return dist


def test_edges_and_table_edges(spark):
    edges = L.lineage_edges(_assets(spark))
    job_level = edges.where(F.col("task_source_id").isNull())
    assert job_level.count() == sum(len(i) + len(o) for i, o in GRAPH.values())
    assert edges.where(F.col("task_source_id").isNotNull()).count() == len(GRAPH)
    pairs = {(r.source_table, r.target_table) for r in L.table_edges(job_level).collect()}
    want = {(i, o) for ins, outs in GRAPH.values() for i in ins for o in outs}
    assert pairs == want
    te = L.task_edges(_assets(spark))
    assert te.where("edge_type = 'upstream_task'").count() == len(GRAPH)


def test_downstream_matches_brute_force(spark):
    edges = L.lineage_edges(_assets(spark)).where(F.col("task_source_id").isNull())
    for start in (["A"], ["E"], ["D", "F"]):
        s = spark.createDataFrame([(x,) for x in start], "asset_name string")
        got = {r.asset_name: r.distance for r in L.downstream(edges, s, max_depth=20, checkpoint_every=2).collect()}
        assert got == brute(start), start


def test_drift(spark):
    static = spark.createDataFrame([("j", "INPUT", "a"), ("j", "OUTPUT", "b")], "job_source_id string, role string, asset_name string")
    runtime = spark.createDataFrame([("j", "INPUT", "a"), ("j", "OUTPUT", "c")], "job_source_id string, role string, asset_name string")
    got = {(r.asset_name, r.drift) for r in L.lineage_drift(static, runtime).collect()}
    assert got == {("b", "static_only"), ("c", "runtime_only")}


def _chain_edges(spark, ways):
    rows = [(f"j{i}", role, t) for i, (a, b) in enumerate(ways) for role, t in (("INPUT", a), ("OUTPUT", b))]
    return spark.createDataFrame(rows, "job_source_id string, role string, asset_name string")


def _bfs(ways, start):
    out, todo = {s: 0 for s in start}, list(start)
    after = {}
    for a, b in ways:
        after.setdefault(a, []).append(b)
    for t in todo:
        for b in after.get(t, []):
            if b not in out:
                out[b] = out[t] + 1
                todo.append(b)
    return out


def test_long_chain_takes_few_rounds(spark):
    """2,000 tables in a row, with a shortcut, diamonds, a cycle on the way and one that nothing reaches."""
    ways = [(f"t{i}", f"t{i + 1}") for i in range(2000)] + [("t300", "t330"), ("t900", "t100"), ("x1", "x2"), ("x2", "x3"), ("x3", "x1"),
                                                             ("x2", "y1"), ("y1", "y2"), ("y2", "t1500")]
    ways += [e for i in range(0, 400, 2) for e in ((f"d{i}", f"d{i + 1}"), (f"d{i}", f"e{i + 1}"), (f"d{i + 1}", f"d{i + 2}"),
                                                   (f"e{i + 1}", f"d{i + 2}"))] + [("t20", "d0")]
    sc = spark.sparkContext
    sc.setJobGroup("chain", "long chain")
    try:
        got = L.downstream(_chain_edges(spark, ways), spark.createDataFrame([("t0",)], "asset_name string"))
        jobs = len(sc.statusTracker().getJobIdsForGroup("chain"))
    finally:
        sc.setJobGroup("rest", "")
    print("jobs:", jobs)
    assert {r.asset_name: r.distance for r in got.collect()} == _bfs(ways, ["t0"])
    assert jobs < 400


def test_random_graphs_beyond_the_first_rounds(spark):
    import random

    r = random.Random(13)
    ways = sorted({(f"n{r.randrange(120)}", f"n{r.randrange(120)}") for _ in range(150)})
    for start in (["n1"], ["n2", "n3", "n77"]):
        s = spark.createDataFrame([(x,) for x in start], "asset_name string")
        edges = _chain_edges(spark, ways)
        got = {x.asset_name: x.distance for x in L.downstream(edges, s, patience=1).collect()}
        assert got == _bfs(ways, start)
        near = {x.asset_name: x.distance for x in L.downstream(edges, s, max_depth=4, patience=2).collect()}
        assert near == {t: d for t, d in got.items() if d <= 4}


def test_long_nets_are_walked_by_clusters(spark, monkeypatch):
    """Layers of three nodes with two ways each into the next: nothing to
    contract, 60 edges long. A hub has more ways in than a cluster may have."""
    from tidewatch.operators import reach

    layers, rounds, write = 60, [], reach._written
    edges = [(f"{n}-{i}", f"{n + 1}-{(i + k) % 3}", 1 + (n + i * k) % 4) for n in range(layers) for i in range(3) for k in (1, 2)]
    edges += [(f"{n}-{i}", f"{n - 3}-{i}", 1) for n in range(3, layers, 7) for i in range(3)]
    edges += [(f"{n}-{i}", "hub", 900 - 3 * n) for n in range(layers) for i in range(3)] + [("hub", "30-1", 5), ("hub", "end", 2)]
    best = {"0-0": 0, "0-1": 0}
    for _ in range(3 * layers):
        for s, d, w in edges:
            if s in best and best[s] + w < best.get(d, 10**9):
                best[d] = best[s] + w
    monkeypatch.setattr(reach, "PATIENCE", 3, raising=False)
    monkeypatch.setattr(reach, "CLUSTER", 150, raising=False)
    monkeypatch.setattr(reach, "_written", lambda df, name: rounds.append(name) or write(df, name))
    found = reach.distances(spark.createDataFrame(edges, "src string, dst string, w long"),
                            spark.createDataFrame([("0-0",), ("0-1",)], "node string"))
    assert {r["node"]: r["distance"] for r in found.collect()} == best
    assert rounds.count("reach-front") < layers / 2
