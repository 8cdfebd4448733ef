"""Lineage.

Edges are DataFrames. Table-to-table reachability is computed over the
bipartite graph table -> job -> table, so a job with very many inputs and
outputs never has its input x output pairs materialised during traversal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.patterns import TAG_KEYS
from tidewatch.operators.etl import _levels, as_array, vget, vstr
from tidewatch.operators.reach import distances
from tidewatch.session import checkpoint_dir

# lists of asset refs and the role of each
REF_LISTS = (("inputs", "INPUT"), ("outputs", "OUTPUT"))


def _refs(v: Column, task: Column) -> Column:
    """Asset refs of a job, task or run as one array of (task_source_id, role,
    asset_type, asset_name). The list settles the role: a ref that claims
    another one is an error of ETL7, not another edge."""
    def of(field: str, role: str) -> Column:
        refs = F.coalesce(as_array(vget(v, f"$.{field}")), F.array().cast("array<variant>"))
        return F.transform(refs, lambda r: F.struct(
            task.alias("task_source_id"), F.lit(role).alias("role"), vstr(r, "$.asset_type").alias("asset_type"),
            F.coalesce(vstr(r, "$.fully_qualified_name"), vstr(r, "$.mcon")).alias("asset_name")))
    return F.concat(*[of(*x) for x in REF_LISTS])


def lineage_edges(assets: DataFrame) -> DataFrame:
    """ETL14: static job-to-asset edges from asset inputs/outputs, job and
    task level (task_source_id NULL: the job's own). Input: (event_pos, v)
    asset events, read once; all refs of an event are one array, exploded
    once. One shuffle (distinct)."""
    v = F.col("v")
    tasks = F.coalesce(as_array(vget(v, "$.tasks")), F.array().cast("array<variant>"))
    refs = F.concat(_refs(v, F.lit(None).cast("string")),
                    F.flatten(F.transform(tasks, lambda t: _refs(t, vstr(t, "$.task_source_id")))))
    return (assets.select(vstr(v, "$.job_source_id").alias("job_source_id"), F.explode(refs).alias("e"))
            .select("job_source_id", "e.*").where(F.col("asset_name").isNotNull()).distinct())


def runtime_edges(runs: DataFrame) -> DataFrame:
    """ETL15a: edges really read or written, per run: (run_source_id,
    job_source_id, task_source_id, role, asset_type, asset_name). Refs of task
    runs at any depth count; run_source_id is the event's own run, and a task
    run without a job belongs to the event's."""
    v, n = F.col("v"), F.col("n.v")
    events = runs.select("event_pos", "v", vstr(v, "$.run_source_id").alias("run_source_id"),
                         vstr(v, "$.job_source_id").alias("__job"))
    nodes = _levels(events, None, "run_source_id", "__job")
    return (nodes.select("run_source_id", F.coalesce(vstr(n, "$.job_source_id"), "__job").alias("job_source_id"),
                         F.explode(_refs(n, vstr(n, "$.task_source_id"))).alias("e"))
            .select("run_source_id", "job_source_id", "e.*").where(F.col("asset_name").isNotNull()).distinct())


def lineage_drift(static: DataFrame, runtime: DataFrame,
                  keys: Sequence[str] = ("job_source_id", "role", "asset_name")) -> DataFrame:
    """ETL15b: edges only in the static or only in the runtime lineage: one
    aggregation on the edge key with a flag per side (NULLs are equal)."""
    both = (static.select(*keys, F.lit(True).alias("__static"))
            .unionByName(runtime.select(*keys, F.lit(False).alias("__static"))))
    seen = both.groupBy(*keys).agg(F.bool_or("__static").alias("__s"), F.bool_or(~F.col("__static")).alias("__r"))
    return seen.where(F.col("__s") != F.col("__r")).select(
        *keys, F.when(F.col("__s"), F.lit("static_only")).otherwise(F.lit("runtime_only")).alias("drift"))


def _unit(edges: DataFrame) -> Column:
    """What reads and writes together: a task, or a job for its own refs."""
    if "task_source_id" not in edges.columns:
        return F.struct("job_source_id").alias("unit")
    task = F.col("task_source_id")
    return F.struct("job_source_id", task.isNull().alias("own"),
                    F.coalesce(task, F.lit("")).alias("task")).alias("unit")


def table_edges(edges: DataFrame) -> DataFrame:
    """ETL16: table-to-table edges: input x output of the same task, and of
    the refs a job gives for itself. Both sides are distinct first; the pairs
    are the answer itself (AQE splits a skewed job across tasks)."""
    side = {role: edges.where(F.col("role") == role).select("job_source_id", _unit(edges), F.col("asset_name"))
            .distinct() for _, role in REF_LISTS}
    ins = side["INPUT"].withColumnRenamed("asset_name", "source_table")
    outs = side["OUTPUT"].drop("job_source_id").withColumnRenamed("asset_name", "target_table")
    return ins.join(outs, "unit").select("source_table", "target_table", "job_source_id").distinct()


def task_edges(assets: DataFrame) -> DataFrame:
    """ETL17: task -> upstream task and task -> triggered job edges."""
    t = assets.select(vstr(F.col("v"), "$.job_source_id").alias("job_source_id"),
                      F.explode(as_array(vget(F.col("v"), "$.tasks"))).alias("t"))
    tid = vstr(F.col("t"), "$.task_source_id")
    up = t.select("job_source_id", tid.alias("task_source_id"),
                  F.explode(F.try_variant_get(F.col("t"), "$.upstream_task_source_ids", "array<string>"))
                  .alias("target"), F.lit("upstream_task").alias("edge_type"))
    trig = t.select("job_source_id", tid.alias("task_source_id"),
                    F.explode(F.try_variant_get(F.col("t"), "$.triggered_job_source_ids", "array<string>"))
                    .alias("target"), F.lit("triggered_job").alias("edge_type"))
    return up.unionByName(trig)


# ------------------------------------------------------------------ ETL18, ETL19

# a literal, a quoted name, or a comment, whichever begins first
SQL_TOKEN = r"""(?s)'[^']*+'|"[^"]*+"|--[^\n]*+|/\*.*?\*/"""
# the JSON object that a comment begins with
COMMENT_TAG = r"(?s)^(?:--|/\*)\s*(\{.*\})"

# integration -> (job keys, task keys, connection keys); priority in this order
INTEGRATIONS = (
    ("custom", TAG_KEYS["job"], TAG_KEYS["task"], TAG_KEYS["connection"]),
    ("airflow", TAG_KEYS["airflow_dag"], TAG_KEYS["airflow_task"], TAG_KEYS["airflow_connection"]),
    ("adf", TAG_KEYS["adf_pipeline"], TAG_KEYS["adf_activity"], TAG_KEYS["adf_connection"]),
    ("dbt_cloud", TAG_KEYS["dbt_cloud_job"], TAG_KEYS["dbt_cloud_run"], ()),
    ("dbt", TAG_KEYS["dbt_invocation"], TAG_KEYS["dbt_node"], ()),
)
# dbt tells its models apart by themselves: a tag without an invocation counts
DBT_ALONE = ("dbt_node", "dbt_node_name")


def _spellings(keys: Sequence[str]) -> list[str]:
    return [*keys, keys[0].upper()]


def _first_key(tag: Column, keys: Sequence[str]) -> Column:
    """Value under the first present alias; the upper case of the first
    alias is accepted too. ``tag`` is the tag object as map<string,string>."""
    if not keys:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.try_element_at(tag, F.lit(k)) for k in _spellings(keys)])


def query_tags(logs: DataFrame, tag_col: str | None = None) -> DataFrame:
    """ETL18: JSON tags of logged queries to (query_id, integration, job_id,
    task_id, connection_id, node_name, target).

    Tags stand at the start of SQL comments (``-- {..}`` or ``/* {..} */``),
    or in ``tag_col``, the warehouse's own query tag, which goes before them.
    Comments inside literals and quoted names are none. The first object that
    names a job (or, for dbt, a node) wins; a task id alone names none; queries
    without such an object give no row. Native expressions only."""
    from tidewatch.operators.monitors import spread

    # only rows that can hold a JSON tag go on; the parse is CPU work per row
    holds = F.col("query_text").contains("{")
    if tag_col:
        holds = F.coalesce(holds, F.lit(False)) | F.col(tag_col).contains("{")
    logs = spread(logs.where(holds), 0, heavy=True)
    tokens = F.regexp_extract_all(F.coalesce("query_text", F.lit("")), F.lit(SQL_TOKEN), 0)
    texts = F.transform(tokens, lambda t: F.regexp_extract(t, COMMENT_TAG, 1))
    if tag_col:
        texts = F.concat(F.array(F.col(tag_col)), texts)
    maps = F.transform(F.filter(texts, lambda t: t.startswith("{") | t.rlike(r"^\s+\{")),
                       lambda t: F.try_variant_get(F.try_parse_json(t), "$", "map<string,string>"))
    naming = [k for _, keys, _, _ in INTEGRATIONS for k in _spellings(keys)]
    naming += [k for name in DBT_ALONE for k in _spellings(TAG_KEYS[name])]
    owns = F.filter(maps, lambda m: F.coalesce(
        F.exists(F.map_entries(m), lambda e: e["key"].isin(*naming) & e["value"].isNotNull()), F.lit(False)))
    kept = ["query_id", *[c for c in ("start_time",) if c in logs.columns]]
    tagged = logs.select(*kept, F.try_element_at(owns, F.lit(1)).alias("tag")).where(F.col("tag").isNotNull())
    tag = F.col("tag")
    # the integrations in order of priority, then dbt nodes without a run
    rules = [(name, _first_key(tag, jk).isNotNull(), jk, tk, ck) for name, jk, tk, ck in INTEGRATIONS]
    rules.append(("dbt", F.lit(True), (), TAG_KEYS["dbt_node"], ()))

    def pick(value) -> Column:
        return F.coalesce(*[F.when(cond, F.struct(value(*rest).alias("x"))) for _, cond, *rest in rules])["x"]

    integration = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond, *_ in rules])
    dbt = integration == "dbt"
    return tagged.select(
        *kept, integration.alias("integration"), pick(lambda j, t, c: _first_key(tag, j)).alias("job_id"),
        pick(lambda j, t, c: _first_key(tag, t)).alias("task_id"),
        pick(lambda j, t, c: _first_key(tag, c)).alias("connection_id"),
        F.when(dbt, _first_key(tag, TAG_KEYS["dbt_node_name"])).alias("node_name"),
        F.when(dbt, _first_key(tag, TAG_KEYS["dbt_target"])).alias("target"))


def resolve_tags(tags: DataFrame, jobs: DataFrame) -> DataFrame:
    """ETL19: tags to jobs (and tasks). ``jobs``: (connection_id,
    job_source_id). A connection tag settles clashes between connections
    that share a job id; without it, a job id known in several connections is
    'ambiguous'. Jobs are reduced to one row per job id, and to distinct (job,
    connection) pairs, before the joins."""
    known = jobs.select(F.col("job_source_id").alias("job_id"), "connection_id").distinct()
    per_job = known.groupBy("job_id").agg(F.count("connection_id").alias("__conns"),
                                          F.min("connection_id").alias("__only"), F.lit(True).alias("__job"))
    j = (tags.join(per_job, "job_id", "left")
         .join(known.withColumn("__pair", F.lit(True)), ["job_id", "connection_id"], "left"))
    given = F.col("connection_id").isNotNull()
    status = (F.when(F.col("__job").isNull(), F.lit("unmatched"))
              .when(given & F.col("__pair").isNull(), F.lit("unmatched"))
              .when(~given & (F.col("__conns") > 1), F.lit("ambiguous"))
              .otherwise(F.lit("matched")))
    conn = F.when(status == "matched", F.coalesce(F.col("connection_id"), F.col("__only")))
    return j.select("query_id", "integration", "job_id", "task_id", conn.alias("resolved_connection"),
                    status.alias("match"))


def tag_table_edges(resolved: DataFrame, access: DataFrame) -> DataFrame:
    """Job-to-asset edges from tagged queries, as ETL14 gives them for
    declared refs: ``resolved`` of ETL19 joined with ``access`` (query_id,
    role, asset_name), the tables a logged query read or wrote. Only matched
    tags make edges."""
    hits = resolved.where(F.col("match") == "matched").select(
        "query_id", F.col("job_id").alias("job_source_id"), F.col("task_id").alias("task_source_id"))
    return (hits.join(access.select("query_id", "role", "asset_name"), "query_id")
            .select("job_source_id", "task_source_id", "role", "asset_name").distinct())


# ------------------------------------------------------------------ ETL20

def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that computes ``df`` once: persisted first, so
    writing the checkpoint files reads the cache instead of recomputing."""
    held = df.persist()
    out = held.checkpoint()
    held.unpersist()
    return out


def downstream(edges: DataFrame, start: DataFrame, max_depth: int | None = None,
               checkpoint_every: int = 4, patience: int = 8) -> DataFrame:
    """ETL20: tables reachable from ``start`` (column ``asset_name``) with the
    shortest distance in jobs or tasks crossed.

    ``edges``: job-to-asset edges (job_source_id, role, asset_name, and
    task_source_id where tasks have refs of their own). A round goes table ->
    reading jobs or tasks -> their outputs; rows already visited are
    removed with left_anti, so cycles end. Each frontier is persisted and
    counted once, and released two rounds later; the visited set is cut with a
    reliable checkpoint in the session's shared checkpoint folder every few
    rounds (never a local checkpoint). What lies beyond ``patience`` rounds is
    a long way off: there, chains are contracted instead of walked
    (``reach.distances``), so that a chain of n tables takes log n rounds.
    ``max_depth`` leaves out what is farther.
    """
    checkpoint_dir(start.sparkSession)
    # both sides of the edges are joined every round: cut them once
    ends = _cut(edges.where(F.col("role").isin("INPUT", "OUTPUT")).select(_unit(edges), "role", "asset_name").distinct())
    reads = ends.where(F.col("role") == "INPUT").select(F.col("asset_name").alias("node"), "unit")
    writes = ends.where(F.col("role") == "OUTPUT").select("unit", F.col("asset_name").alias("next"))
    visited = _cut(start.select(F.col("asset_name").alias("node")).distinct().withColumn("distance", F.lit(0)))
    frontier = visited.select("node").persist()
    held = [frontier]
    far = True
    for d in range(1, (patience if max_depth is None else min(patience, max_depth)) + 1):
        # one job per round: the new frontier is computed once, kept in
        # memory and counted; a lost partition is recomputed from the last
        # reliable cut below
        nxt = (frontier.join(reads, "node").join(writes, "unit")
               .select(F.col("next").alias("node")).distinct()
               .join(visited.select("node"), "node", "left_anti")).persist()
        held.append(nxt)
        far = nxt.count() > 0
        if not far:
            break
        visited = visited.unionByName(nxt.withColumn("distance", F.lit(d)))
        if d % checkpoint_every == 0:
            # reliable cut into the shared folder: bounds the plan and what a
            # lost executor forces to recompute
            visited = _cut(visited)
            nxt = visited.where(F.col("distance") == d).select("node")
            while len(held) > 1:
                held.pop(0).unpersist()
        frontier = nxt
    if far and (max_depth is None or max_depth > patience):
        visited = _cut(visited)
        beyond = _beyond(reads, writes, visited, patience)
        visited = visited.unionByName(beyond if max_depth is None else beyond.where(F.col("distance") <= max_depth))
    # the answer is cut reliably once more, then nothing stays cached
    result = _cut(visited.select(F.col("node").alias("asset_name"), "distance"))
    for h in held:
        h.unpersist()
    return result


def _beyond(reads: DataFrame, writes: DataFrame, visited: DataFrame, depth: int) -> DataFrame:
    """(node, distance) of the tables farther than ``depth``: the tables and
    units that are left are nodes alike, an edge is half a step."""
    front = visited.where(F.col("distance") == depth).select("node")
    inner = visited.where(F.col("distance") < depth).select("node")
    table, unit = F.concat(F.lit("t"), F.col("node")), F.concat(F.lit("u"), F.to_json("unit"))
    half = F.lit(1).cast("long").alias("w")
    ways = (reads.join(inner, "node", "left_anti").select(table.alias("src"), unit.alias("dst"), half)
            .unionByName(writes.join(visited.select(F.col("node").alias("next")), "next", "left_anti")
                         .select(unit.alias("src"), F.concat(F.lit("t"), F.col("next")).alias("dst"), half)))
    found = distances(ways, front.select(table.alias("node")))
    return found.where("distance > 0 AND startswith(node, 't')").select(
        F.expr("substr(node, 2)").alias("node"), (F.col("distance") / 2 + depth).cast("int").alias("distance"))
