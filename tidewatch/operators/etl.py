"""ETL run and asset checks.

Events arrive as sparse JSON objects. They are read into a VARIANT column so
that "absent", "JSON null", "wrong type" and "empty" stay distinguishable
(a struct schema would fold them together). Every check is a native
expression; the validators are narrow (no shuffle): one row per event in,
one row per error out. Nested task runs are flattened with one posexplode per
level up to a depth bound; deeper levels are counted and reported.

Input frame for the validators: ``event_pos`` (bigint, order of the event in
its batch) and ``v`` (VARIANT), see :func:`events_from_json`.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.patterns import (
    ASSET_ROLES, ASSET_TYPES, ERROR_STATUSES, FINAL_STATUSES, ISO_DATETIME, ISO_ZONE, OPEN_STATUSES,
)

StatusMap = Mapping[str, str] | DataFrame | None


# ------------------------------------------------------------------ VARIANT access

def events_from_json(df: DataFrame, text_col: str = "raw", pos_col: str | None = "event_pos") -> DataFrame:
    """(event_pos, raw JSON text) -> (event_pos, v VARIANT). Unparseable text
    becomes a NULL variant and is reported as not an object."""
    pos = F.col(pos_col) if pos_col else F.monotonically_increasing_id()
    return df.select(pos.cast("long").alias("event_pos"), F.try_parse_json(F.col(text_col)).alias("v"))


def events_from_struct(df: DataFrame, pos_col: str = "event_pos") -> DataFrame:
    """Typed rows -> sparse JSON objects (NULL fields are left out, as the
    contract wants) -> VARIANT."""
    body = F.struct(*[F.col(c) for c in df.columns if c != pos_col])
    return df.select(F.col(pos_col).cast("long").alias("event_pos"), F.parse_json(F.to_json(body)).alias("v"))


def vget(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def vtype(x: Column) -> Column:
    return F.schema_of_variant(x)


def vstr(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def is_obj(x: Column) -> Column:
    """JSON object test. A cast to a one-field struct succeeds for any object
    and fails for anything else; unlike schema_of_variant it does not walk
    the whole (possibly deep) value."""
    return F.try_variant_get(x, "$", "struct<__tw_probe:variant>").isNotNull()


def is_missing(x: Column) -> Column:
    """Absent key or JSON null: Python's ``d.get(k) is None``."""
    return x.isNull() | F.coalesce(F.is_variant_null(x), F.lit(False))


def is_field_obj(x: Column) -> Column:
    """Object test for a field value (small): by its schema string."""
    return F.coalesce(vtype(x).startswith("OBJECT"), F.lit(False))


def truthy(x: Column) -> Column:
    """Python truthiness of a JSON field value.

    The type comes from schema_of_variant, which is cheap on field values
    (scalars, small objects); no cast is attempted that could fail."""
    t = vtype(x)
    return (F.when(x.isNull() | (t == "VOID"), F.lit(False))
            .when(t == "STRING", F.try_variant_get(x, "$", "string") != "")
            .when(t == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
            .when(t.startswith("ARRAY"), F.array_size(F.try_variant_get(x, "$", "array<variant>")) > 0)
            .when(t.startswith("OBJECT"), t != "OBJECT<>")
            .otherwise(F.coalesce(F.try_variant_get(x, "$", "double") != 0, F.lit(True))))


def present(v: Column, path: str) -> Column:
    return truthy(vget(v, path))


def py_repr(x: Column) -> Column:
    """Python-like repr of a JSON value: quoted text for strings, JSON otherwise."""
    return F.when(vtype(x) == "STRING",
                  F.concat(F.lit("'"), F.try_variant_get(x, "$", "string"), F.lit("'"))) \
        .otherwise(F.to_json(x))


def as_array(x: Column, path: str = "$") -> Column:
    """The array at ``path`` (NULL if there is none). A value taken out as a
    variant is written anew, so the path is followed in the same cast."""
    return F.try_variant_get(x, path, "array<variant>")


# ------------------------------------------------------------------ ETL8

def iso8601_state(text: Column) -> Column:
    """ETL8: 'valid', 'invalid' or 'naive' for zone-aware ISO 8601 text
    (extended form; date-only text parses and is naive)."""
    shaped = text.rlike(ISO_DATETIME)
    parses = text.try_cast("timestamp").isNotNull()
    return (F.when(text.isNull(), F.lit(None))
            .when(~shaped, F.lit("invalid"))
            .when(~parses, F.lit("invalid"))
            .when(text.rlike(ISO_ZONE), F.lit("valid"))
            .otherwise(F.lit("naive")))


def _iso_state_of(x: Column) -> Column:
    """ISO state of a field value; non-text values are invalid."""
    text = F.when(vtype(x) == "STRING", F.try_variant_get(x, "$", "string"))
    return F.coalesce(iso8601_state(text), F.lit("invalid"))


def _iso_error(x: Column, field: str, check_no: int, state: Column | None = None) -> Column:
    """Format error of one time field (``x`` is the field's variant)."""
    state = _iso_state_of(x) if state is None else state
    return (F.when(state == "invalid", _err(field, F.concat(F.lit("not an ISO 8601 time: "), py_repr(x)),
                                            [check_no]))
            .when(state == "naive", _err(field, F.concat(
                F.lit("time without a zone: "), py_repr(x)), [check_no])))


# ------------------------------------------------------------------ error rows

_ERR_TYPE = "struct<field:string,message:string,idx:string,key:array<int>>"


def _err(field: str | Column, message: str | Column, key, idx: Column | None = None) -> Column:
    """One error: field, message, its own index (NULL = the node's) and its
    sort key relative to the node."""
    f = F.lit(field) if isinstance(field, str) else field
    m = F.lit(message) if isinstance(message, str) else message
    k = key if isinstance(key, Column) else F.array(*[F.lit(i) if isinstance(i, int) else i for i in key])
    i = idx if idx is not None else F.lit(None).cast("string")
    return F.struct(f.alias("field"), m.alias("message"), i.alias("idx"), k.cast("array<int>").alias("key"))


def _no_errs() -> Column:
    return F.array().cast(f"array<{_ERR_TYPE}>")


def _errs(*checks: Column) -> Column:
    """The non-NULL error structs of a node, as one array."""
    return F.filter(F.array(*[c.cast(_ERR_TYPE) for c in checks]), lambda e: e.isNotNull())


def _explode_errors(nodes: DataFrame, errs: Column) -> DataFrame:
    """nodes(event_pos, event_index, order_key, ..) + per-node error array
    -> ERROR rows (one explode; narrow)."""
    e = nodes.select("event_pos", "event_index", "order_key", F.explode(errs).alias("e"))
    key = F.concat(F.col("order_key"), F.col("e.key"))
    return e.select("event_pos", F.coalesce(F.col("e.idx"), F.col("event_index")).alias("event_index"),
                    F.element_at(key, 1).alias("check_no"), F.col("e.field").alias("field"),
                    F.col("e.message").alias("message"), key.alias("order_key"))


# ------------------------------------------------------------------ ETL7

_REF_FIELDS = "struct<asset_type:variant,role:variant,mcon:variant,fully_qualified_name:variant>"
_TYPES_TEXT = "[" + ", ".join(f"'{t}'" for t in sorted(ASSET_TYPES)) + "]"
_ROLES_TEXT = "[" + ", ".join(f"'{r}'" for r in sorted(ASSET_ROLES)) + "]"


def ref_errors(v: Column, field: str, role: str, node_idx: Column, key_prefix: list,
               refs_value: Column | None = None) -> Column:
    """ETL7 as an expression: errors of every asset ref in ``v[field]``:
    object; asset_type present and in its set; role present, in its set and
    equal to the list's role; mcon or fully_qualified_name present. Indexes
    are '<node>.<field>.<i>'. Evaluated inside the node's row: no explode."""
    refs = as_array(refs_value if refs_value is not None else vget(v, f"$.{field}"))
    prefix = [F.lit(k) if isinstance(k, int) else k for k in key_prefix]

    def one(r: Column, i: Column) -> Column:
        idx = F.concat_ws(".", node_idx, F.lit(field), i.cast("string"))

        def key(sub: int) -> Column:
            return F.array(*prefix, i, F.lit(sub))
        f = F.try_variant_get(r, "$", _REF_FIELDS)     # NULL unless r is an object
        at, ro = f["asset_type"], f["role"]
        at_s, ro_s = F.try_variant_get(at, "$", "string"), F.try_variant_get(ro, "$", "string")
        obj = f.isNotNull()
        return F.array(
            F.when(~obj, _err(field, F.concat(F.lit("entry "), i.cast("string"), F.lit(" is not an object")),
                              key(0), idx)),
            F.when(obj & ~truthy(at), _err("asset_type", "asset_type is missing", key(1), idx))
             .when(obj & ~F.coalesce(at_s.isin(*ASSET_TYPES) & (vtype(at) == "STRING"), F.lit(False)),
                   _err("asset_type", F.concat(F.lit("asset_type "), py_repr(at),
                                               F.lit(f" is none of {_TYPES_TEXT}")), key(1), idx)),
            F.when(obj & ~truthy(ro), _err("role", "role is missing", key(2), idx))
             .when(obj & ~F.coalesce(ro_s.isin(*ASSET_ROLES) & (vtype(ro) == "STRING"), F.lit(False)),
                   _err("role", F.concat(F.lit("role "), py_repr(ro), F.lit(f" is none of {_ROLES_TEXT}")),
                        key(2), idx))
             .when(obj & (ro_s != role),
                   _err("role", F.concat(F.lit("role "), py_repr(ro), F.lit(f" stands in {field}, which takes {role} alone")),
                        key(2), idx)),
            F.when(obj & ~truthy(f["mcon"]) & ~truthy(f["fully_qualified_name"]),
                   _err("fully_qualified_name", "neither mcon nor fully_qualified_name is given",
                        key(3), idx)),
        ).cast(f"array<{_ERR_TYPE}>")

    per_ref = F.transform(refs, one)
    return F.filter(F.flatten(F.coalesce(per_ref, F.array().cast(f"array<array<{_ERR_TYPE}>>"))),
                    lambda e: e.isNotNull())


def check_asset_refs(nodes: DataFrame, field: str, role: str, key_prefix: list[int]) -> DataFrame:
    """ETL7 as rows: ERROR rows for the asset refs of ``nodes`` (event_pos,
    event_index, order_key, v)."""
    return _explode_errors(nodes, ref_errors(F.col("v"), field, role, F.col("event_index"), key_prefix))


# ------------------------------------------------------------------ ETL3

_NODE = "struct<v:variant,idx:string,key:array<int>,depth:int,parent:string,pos:int>"


def _children(level: Column) -> Column:
    """Task runs of every node of a level, as the next level (in-row)."""
    def kids(n: Column) -> Column:
        return F.transform(as_array(n["v"], "$.task_runs"), lambda c, i: F.struct(
            c.alias("v"), F.concat_ws(".", n["idx"], i.cast("string")).alias("idx"),
            F.concat(n["key"], F.array(F.lit(11), i)).alias("key"), (n["depth"] + 1).alias("depth"),
            n["idx"].alias("parent"), i.alias("pos")))
    return F.flatten(F.transform(level, lambda n: F.coalesce(kids(n), F.array().cast(f"array<{_NODE}>"))))


def _has_task_runs(v: Column) -> Column:
    return F.coalesce(F.array_size(as_array(v, "$.task_runs")), F.lit(0)) > 0


def _levels(events: DataFrame, max_depth: int | None, *keep: str) -> DataFrame:
    """(event_pos, *keep, n) one row per node: each level is built from the one
    above inside the same row (higher-order functions), so an event is read
    and parsed once and the whole tree costs one narrow stage.

    The rounds come from the row itself: an event nests no deeper than its
    text names ``task_runs``, and rounds past the last level add nothing."""
    v = F.col("v")
    root = F.array(F.struct(
        v.alias("v"), F.col("event_pos").cast("string").alias("idx"),
        F.array().cast("array<int>").alias("key"), F.lit(0).alias("depth"),
        F.lit(None).cast("string").alias("parent"), F.lit(None).cast("int").alias("pos")).cast(_NODE))
    rounds = F.when(_has_task_runs(v), F.regexp_count(F.to_json(v), F.lit('"task_runs"'))).otherwise(F.lit(0))
    if max_depth is not None:
        rounds = F.least(rounds, F.lit(max_depth))
    steps = F.when(rounds > 0, F.sequence(F.lit(1), rounds)).otherwise(F.array().cast("array<int>"))

    def grow(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.when(F.size(last) > 0, F.concat(levels, F.array(_children(last)))).otherwise(levels)

    tree = F.flatten(F.aggregate(steps, F.array(root), grow))
    return events.select("event_pos", *keep, F.explode(tree).alias("n"))


def flatten_task_runs(events: DataFrame, max_depth: int | None = None) -> tuple[DataFrame, DataFrame]:
    """ETL3: events and their nested task runs, at any depth, as one node per
    row.

    Node columns: event_pos, event_index ('3', '3.0', '3.0.1'), order_key
    (sort key reproducing event order, then depth-first task order), depth
    (0 = the run itself), parent_index, task_pos, v, too_deep.
    Returns (nodes, overflow): if the caller sets ``max_depth``, overflow lists
    the nodes at that depth that still carry task runs; else it is empty.
    """
    n = F.col("n")
    cut_here = F.lit(False) if max_depth is None else (n["depth"] == max_depth) & _has_task_runs(n["v"])
    nodes = _levels(events, max_depth).select(
        "event_pos", n["idx"].alias("event_index"), n["key"].alias("order_key"), n["depth"].alias("depth"),
        n["parent"].alias("parent_index"), n["pos"].alias("task_pos"), n["v"].alias("v"),
        cut_here.alias("too_deep"))
    overflow = nodes.where("too_deep").select("event_pos", "event_index",
                                              F.lit(max_depth).cast("int").alias("max_depth"))
    return nodes, overflow


# ------------------------------------------------------------------ ETL4, ETL5, ETL6

def _map_literal(mapping: Mapping[str, str]) -> Column:
    """Case-insensitive status map as a literal map; first key wins."""
    seen: dict[str, str] = {}
    for k, val in mapping.items():
        seen.setdefault(k.lower(), val.lower())
    if not seen:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for kv in seen.items() for x in kv])


def normalize_status(df: DataFrame, mapping: StatusMap, status_col: str = "status",
                     out: str = "status_norm") -> DataFrame:
    """ETL4: vendor status -> canonical, case-insensitive; unmapped ->
    'unknown'; without a map only lower case. Adds ``out`` and ``unmapped``.

    A dict map becomes a literal map expression (no join at all); a map
    given as a DataFrame (key, value) is joined on lower(key); a table has no
    first row, so of several values for one key the smallest holds. AQE
    broadcasts the map from its measured size.
    """
    raw = F.coalesce(F.col(status_col).cast("string"), F.lit(""))
    if mapping is None:
        return df.withColumn(out, F.lower(raw)).withColumn("unmapped", F.lit(False))
    if isinstance(mapping, DataFrame):
        m = (mapping.select(F.lower("key").alias("__k"), F.lower("value").alias("__v"))
             .groupBy("__k").agg(F.min("__v").alias("__v")))
        j = df.withColumn("__k", F.lower(raw)).join(m, "__k", "left")
        return (j.withColumn(out, F.coalesce(F.col("__v"), F.lit("unknown")))
                .withColumn("unmapped", F.col("__v").isNull()).drop("__k", "__v"))
    hit = F.element_at(_map_literal(mapping), F.lower(raw))
    return df.withColumn(out, F.coalesce(hit, F.lit("unknown"))).withColumn("unmapped", hit.isNull())


def unmapped_statuses(df: DataFrame, mapping: StatusMap, status_col: str = "status") -> DataFrame:
    """ETL5: statuses absent from the map with their counts, by raw spelling.
    A status mapped to 'unknown' on purpose is not reported."""
    n = normalize_status(df, mapping, status_col)
    return (n.where("unmapped").groupBy(F.coalesce(F.col(status_col).cast("string"), F.lit("")).alias("status"))
            .agg(F.count(F.lit(1)).alias("count")))


CANONICAL = FINAL_STATUSES + OPEN_STATUSES


def check_status_map(map_df: DataFrame) -> DataFrame:
    """ETL6: map rows that are bad: empty key, value not canonical, or keys
    equal but for case. The window is partitioned by the lower-cased key."""
    w = Window.partitionBy(F.lower("key"))
    dup = F.count(F.lit(1)).over(w) > 1
    problems = F.filter(F.array(
        F.when(F.coalesce(F.trim("key"), F.lit("")) == "", F.lit("empty key")),
        F.when(~F.coalesce(F.lower("value").isin(*CANONICAL), F.lit(False)), F.lit("value not canonical")),
        F.when(dup, F.lit("duplicate key ignoring case"))), lambda x: x.isNotNull())
    return (map_df.select("key", "value", problems.alias("problems"))
            .select("key", "value", F.explode("problems").alias("problem")))


# ------------------------------------------------------------------ ETL2

def _group_check(g: Column, check_no: int) -> Column:
    """``g`` is the group field's variant."""
    gobj = is_field_obj(g)
    return (F.when(~is_missing(g) & ~gobj, _err("group", "group is not an object", [check_no]))
            .when(gobj & ~present(g, "$.source_id"),
                  _err("group.source_id", "the group has no source_id", [check_no])))


def _lookup(mapping: Mapping[str, str] | None, raw: Column) -> tuple[Column, Column]:
    """(normalised status, unmapped flag) for a dict map (None: lower case)."""
    if mapping is None:
        return F.lower(raw), F.lit(False)
    if isinstance(mapping, DataFrame):
        raise TypeError("validators take status maps as dicts (the manifest form)")
    hit = F.element_at(_map_literal(mapping), F.lower(raw))
    return F.coalesce(hit, F.lit("unknown")), hit.isNull()


def _unmapped_text(status: Column, n: Column) -> Column:
    return F.concat(F.lit("status '"), status, F.lit("' has no entry in the status map, nodes: "), n.cast("string"))


_RUN_FIELDS = ("struct<event_time:variant,run_source_id:variant,job_source_id:variant,group:variant,"
               "start_time:variant,end_time:variant,status:variant,error:variant,inputs:variant,"
               "outputs:variant>")


def validate_runs(events: DataFrame, run_map: Mapping[str, str] | None = None,
                  task_map: Mapping[str, str] | None = None, max_depth: int | None = None,
                  one_scan: bool = False) -> DataFrame:
    """ETL2: ERROR rows for run events and every nested task run.

    Checks per node, in this order: event_time present and ISO 8601 with
    zone; run_source_id; job_source_id; group; start_time and end_time
    format; final status needs end_time; failed/error needs an error object;
    input and output asset refs. Task runs are checked at any depth, unless the
    caller sets ``max_depth``: what lies below it is then reported as left out.
    Task runs use ``task_map``, else ``run_map``. Unmapped statuses are
    summarised in rows with event_index 'summary' (all of them, not only those
    before the first 50 errors). A task run that is not an object is reported
    at its parent's index.

    Plan: one narrow stage builds every node and all its errors in-row. The
    summary is a second pass over the events, which falls away where only the
    errors are asked for. With ``one_scan`` the unmapped statuses are entries
    among the errors and one aggregation (partial first) sums them up: the
    events are read and parsed once, and the error rows are shuffled.
    """
    nodes, _ = flatten_task_runs(events, max_depth)
    task_map = task_map if task_map is not None else run_map
    # every top-level field in one cast (NULL unless the node is an object)
    # facts of every node, computed once: one cast reads all fields
    # (NULL unless the node is an object), then small per-field tests
    f0 = F.try_variant_get(F.col("v"), "$", _RUN_FIELDS)
    nodes = nodes.withColumn("f", f0)
    f = F.col("f")
    depth = F.col("depth")
    raw_e = F.coalesce(F.try_variant_get(f["status"], "$", "string"), F.lit(""))
    top_s, top_u = _lookup(run_map, F.col("raw"))
    sub_s, sub_u = _lookup(task_map, F.col("raw"))
    nodes = nodes.select(
        "*", raw_e.alias("raw"), f.isNotNull().alias("obj"),
        truthy(f["event_time"]).alias("has_event_time"), truthy(f["end_time"]).alias("has_end_time"),
        truthy(f["start_time"]).alias("has_start_time"),
        _iso_state_of(f["event_time"]).alias("st_event_time"), _iso_state_of(f["end_time"]).alias("st_end_time"),
        _iso_state_of(f["start_time"]).alias("st_start_time"))
    nodes = nodes.select(
        "*", F.when(depth == 0, top_s).otherwise(sub_s).alias("status_norm"),
        F.when(depth == 0, top_u).otherwise(sub_u).alias("unmapped"))
    raw = F.col("raw")
    status = F.col("status_norm")
    unmapped = F.col("unmapped")
    tracked = F.when(depth == 0, F.lit(run_map is not None)).otherwise(F.lit(task_map is not None))
    obj = F.col("obj")
    end_ok = F.col("has_end_time")
    idx = F.col("event_index")
    own = _errs(
        F.when(~obj & (depth > 0),
               _err("task_runs", F.concat(F.lit("task run "), F.col("task_pos").cast("string"),
                                          F.lit(" is not an object")), [0], F.col("parent_index")))
         .when(~obj, _err("event", "event is not an object", [0])),
        F.when(obj & ~F.col("has_event_time"), _err("event_time", "event_time is missing", [1]))
         .when(obj, _iso_error(f["event_time"], "event_time", 1, F.col("st_event_time"))),
        F.when(obj & ~truthy(f["run_source_id"]), _err("run_source_id", "run_source_id is missing", [2])),
        F.when(obj & ~truthy(f["job_source_id"]), _err("job_source_id", "job_source_id is missing", [3])),
        F.when(obj, _group_check(f["group"], 4)),
        F.when(obj & F.col("has_start_time"), _iso_error(f["start_time"], "start_time", 5, F.col("st_start_time"))),
        F.when(obj & end_ok, _iso_error(f["end_time"], "end_time", 6, F.col("st_end_time"))),
        F.when(obj & status.isin(*FINAL_STATUSES) & ~end_ok,
               _err("end_time", F.concat(F.lit("status '"), raw, F.lit("' is final but end_time is missing")), [7])),
        F.when(obj & status.isin(*ERROR_STATUSES) & is_missing(f["error"]),
               _err("error", F.concat(F.lit("status '"), raw, F.lit("' is a failure but error is missing")), [8])),
        F.when(F.col("too_deep"), _err("task_runs", F.lit(f"task runs below level {max_depth} are left out, "
                                                           "as the caller asked"), [12])),
    )
    v = F.col("v")
    refs = F.when(obj, F.concat(ref_errors(v, "inputs", "INPUT", idx, [9], f["inputs"]),
                                ref_errors(v, "outputs", "OUTPUT", idx, [10], f["outputs"]))).otherwise(_no_errs())
    if not one_scan:
        errors = _explode_errors(nodes, F.concat(own, refs))
        counts = (nodes.where(obj & tracked & unmapped).groupBy(raw.alias("raw_status"))
                  .agg(F.count(F.lit(1)).alias("n"))
                  .select(F.lit(None).cast("long").alias("event_pos"), F.lit("summary").alias("event_index"),
                          F.lit(99).alias("check_no"), F.lit("status").alias("field"),
                          _unmapped_text(F.col("raw_status"), F.col("n")).alias("message"),
                          F.array(F.lit(99)).alias("order_key")))
        return errors.unionByName(counts)
    # an unmapped status is a marked entry beside the node's errors, so one
    # scan and one explode give both; equal rows are counted within the map
    # tasks first, which folds the marked ones to one row per status
    marked = F.when(obj & tracked & unmapped, _err("status", raw, [99], F.lit("summary")))
    found = _explode_errors(nodes, F.concat(own, _errs(marked), refs))
    summary = F.col("event_index") == "summary"
    keyed = found.select(F.when(~summary, F.col("event_pos")).alias("event_pos"), "event_index",
                         F.when(summary, F.lit(99)).otherwise(F.col("check_no")).alias("check_no"), "field", "message",
                         F.when(summary, F.array(F.lit(99))).otherwise(F.col("order_key")).alias("order_key"))
    counted = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n"))
    text = F.when(summary, _unmapped_text(F.col("message"), F.col("n"))).otherwise(F.col("message"))
    times = F.when(summary, F.lit(1)).otherwise(F.col("n")).cast("int")
    return counted.select("event_pos", "event_index", "check_no", "field", text.alias("message"), "order_key",
                          F.explode(F.array_repeat(F.lit(1), times)).alias("__n")).drop("__n")


# ------------------------------------------------------------------ ETL1

_ASSET_FIELDS = ("struct<job_source_id:variant,name:variant,group:variant,tasks:variant,inputs:variant,"
                 "outputs:variant>")


def validate_assets(events: DataFrame) -> DataFrame:
    """ETL1: ERROR rows for job assets: job_source_id and name present; group
    an object with source_id; each task an object with task_source_id and
    name; asset refs of tasks and of the job. All checks of an asset are
    evaluated in its own row (tasks and refs through higher-order
    functions), then exploded once: one narrow stage."""
    base = events.select("event_pos", F.col("event_pos").cast("string").alias("event_index"),
                         F.array().cast("array<int>").alias("order_key"), "v",
                         F.try_variant_get(F.col("v"), "$", _ASSET_FIELDS).alias("f"))
    v, f = F.col("v"), F.col("f")
    obj = f.isNotNull()
    idx = F.col("event_index")

    def task_errs(t: Column, i: Column) -> Column:
        tf = F.try_variant_get(t, "$", "struct<task_source_id:variant,name:variant,inputs:variant,outputs:variant>")
        tobj = tf.isNotNull()
        tidx = F.concat_ws(".", idx, F.lit("tasks"), i.cast("string"))
        own = F.array(
            F.when(~tobj, _err("tasks", F.concat(F.lit("task "), i.cast("string"),
                                                 F.lit(" is not an object")), F.array(F.lit(4), i, F.lit(0)))),
            F.when(tobj & ~truthy(tf["task_source_id"]),
                   _err("task_source_id", "task_source_id is missing", F.array(F.lit(4), i, F.lit(1)), tidx)),
            F.when(tobj & ~truthy(tf["name"]),
                   _err("name", "name is missing", F.array(F.lit(4), i, F.lit(2)), tidx)),
        ).cast(f"array<{_ERR_TYPE}>")
        refs = F.when(tobj, F.concat(ref_errors(t, "inputs", "INPUT", tidx, [4, i, 3], tf["inputs"]),
                                     ref_errors(t, "outputs", "OUTPUT", tidx, [4, i, 4], tf["outputs"]))
                      ).otherwise(_no_errs())
        return F.concat(F.filter(own, lambda e: e.isNotNull()), refs)

    tasks = F.when(obj & truthy(f["tasks"]), as_array(f["tasks"]))
    per_task = F.flatten(F.coalesce(F.transform(tasks, task_errs), F.array().cast(f"array<array<{_ERR_TYPE}>>")))
    own = _errs(
        F.when(~obj, _err("event", "event is not an object", [0])),
        F.when(obj & ~truthy(f["job_source_id"]), _err("job_source_id", "job_source_id is missing", [1])),
        F.when(obj & ~truthy(f["name"]), _err("name", "name is missing", [2])),
        F.when(obj, _group_check(f["group"], 3)),
    )
    refs = F.when(obj, F.concat(ref_errors(v, "inputs", "INPUT", idx, [5], f["inputs"]),
                                ref_errors(v, "outputs", "OUTPUT", idx, [6], f["outputs"]))).otherwise(_no_errs())
    return _explode_errors(base, F.concat(own, per_task, refs))


# ------------------------------------------------------------------ ETL9

def first_errors(errors: DataFrame, n: int = 50) -> DataFrame:
    """ETL9: first n errors in event order, summary rows last. A top-n
    (TakeOrderedAndProject), never a full sort; the full table stays
    available."""
    return errors.orderBy(F.col("event_index") == "summary", F.col("event_pos").asc_nulls_last(),
                          "order_key", "message").limit(n)


# ------------------------------------------------------------------ ETL10-ETL13

def latest_run_state(runs: DataFrame, key: str = "run_source_id", time: str = "event_time") -> DataFrame:
    """ETL10: newest event of each run. max_by combines partial results before
    the shuffle, so a hot run moves one row per map task, not all its events.
    Events of one time are ordered by ``event_pos`` if there is one, then by
    their other plain columns, so the answer does not depend on row order."""
    cols = [c for c in runs.columns if c != key]
    plain = [c for c, t in runs.dtypes if c in cols and "map<" not in t and "variant" not in t]
    order = [time, *sorted(c for c in plain if c == "event_pos"), *(c for c in plain if c not in (time, "event_pos"))]
    latest = runs.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("__s"),
                                   F.count(F.lit(1)).alias("events"))
    return latest.select(key, *[F.col(f"__s.{c}").alias(c) for c in cols], "events")


def run_stats(runs: DataFrame, exact: bool = False, job: str = "job_source_id",
              start: str = "start_time", end: str = "end_time", status: str = "status_norm") -> DataFrame:
    """ETL11: per job: runs, mean and p95 duration (seconds), failure rate.
    The p95 is a sketch's, or with ``exact`` selected (``exact_quantiles``)."""
    from tidewatch.functions import exprs as E
    from tidewatch.operators.monitors import _join_on_keys
    from tidewatch.operators.quantiles import exact_quantiles

    dur = (E.epoch(F.col(end)) - E.epoch(F.col(start))).cast("double")
    stats = runs.groupBy(job).agg(
        F.count(F.lit(1)).alias("runs"), F.avg(dur).alias("mean_duration"),
        *([] if exact else [F.percentile_approx(dur, 0.95, 10000).alias("p95_duration")]),
        (F.count_if(F.col(status).isin(*ERROR_STATUSES)) / F.count(F.lit(1))).alias("failure_rate"))
    if exact:
        p95 = exact_quantiles(runs.select(job, dur.alias("p95_duration")), {"p95_duration": [0.95]}, [job])
        stats = _join_on_keys(stats, p95.withColumn("p95_duration", F.get("p95_duration", F.lit(0))), [job])
    return stats.select(job, "runs", "mean_duration", "p95_duration", "failure_rate")


def attribute_group(runs: DataFrame, assets_groups: DataFrame, job: str = "job_source_id") -> DataFrame:
    """ETL12: group of a run: its own, else the only group of its job, else
    NULL (ambiguous or unknown). ``assets_groups`` is (job_source_id,
    group_source_id) placements; reduced to one row per job before the join."""
    only = (assets_groups.groupBy(job)
            .agg(F.count_distinct("group_source_id").alias("__n"), F.min("group_source_id").alias("__g"))
            .select(job, F.when(F.col("__n") == 1, F.col("__g")).alias("only_group"),
                    F.col("__n").alias("placements")))
    j = runs.join(only, job, "left")
    return j.withColumn("group_source_id", F.coalesce(F.col("run_group"), F.col("only_group"))) \
        .withColumn("group_origin", F.when(F.col("run_group").isNotNull(), F.lit("run"))
                    .when(F.col("only_group").isNotNull(), F.lit("job"))
                    .when(F.col("placements") > 1, F.lit("ambiguous"))
                    .otherwise(F.lit("none")))


ASSET_FEATURES = ("metadata_group", "metadata_tasks", "metadata_inputs", "metadata_outputs",
                  "metadata_schedule", "metadata_owner", "metadata_tags")
RUN_FEATURES = ("run_timing", "run_error", "run_task_runs", "run_inputs", "run_outputs", "run_group")
MANIFEST_FEATURES = ("manifest_run_status_mapping", "manifest_task_status_mapping", "manifest_credentials_schema")


def feature_coverage(assets: DataFrame | None, runs: DataFrame | None, run_map: StatusMap = None,
                     spark: SparkSession | None = None, manifest: Mapping | None = None,
                     webhook: DataFrame | None = None) -> DataFrame:
    """ETL13: which optional features appear in at least one event.

    One aggregation per input (bool_or per feature), then unpivoted to
    (feature, supported). Manifest features come from the manifest dict: a
    mapping must be a filled object, a credentials schema one that nests its
    keys under ``connect_args``. ``webhook``: the runs that came back for asked
    ids (``runs_by_id``); webhook mode is there if any did.
    """
    parts = []

    def _listy(x):
        return F.coalesce(vtype(x).startswith("ARRAY") & truthy(x), F.lit(False))

    if assets is not None:
        v = F.col("v")
        a = assets.agg(
            F.bool_or(is_obj(vget(v, "$.group")) & present(vget(v, "$.group"), "$.source_id")).alias("metadata_group"),
            F.bool_or(_listy(vget(v, "$.tasks"))).alias("metadata_tasks"),
            F.bool_or(_listy(vget(v, "$.inputs"))).alias("metadata_inputs"),
            F.bool_or(_listy(vget(v, "$.outputs"))).alias("metadata_outputs"),
            F.bool_or(present(v, "$.schedule")).alias("metadata_schedule"),
            F.bool_or(present(v, "$.owner")).alias("metadata_owner"),
            F.bool_or(present(v, "$.tags") | present(v, "$.properties")).alias("metadata_tags"))
        parts.append(a.unpivot([], list(ASSET_FEATURES), "feature", "supported"))
    if runs is not None:
        n = normalize_status(runs.withColumn("__st", F.coalesce(vstr(F.col("v"), "$.status"), F.lit(""))),
                             run_map, "__st")
        v = F.col("v")
        failed = F.col("status_norm").isin(*ERROR_STATUSES)
        r = n.agg(
            F.bool_or(present(v, "$.start_time") | present(v, "$.end_time")).alias("run_timing"),
            (F.bool_or(failed & present(v, "$.error"))).alias("run_error"),
            F.bool_or(_listy(vget(v, "$.task_runs"))).alias("run_task_runs"),
            F.bool_or(_listy(vget(v, "$.inputs"))).alias("run_inputs"),
            F.bool_or(_listy(vget(v, "$.outputs"))).alias("run_outputs"),
            F.bool_or(is_obj(vget(v, "$.group")) & present(vget(v, "$.group"), "$.source_id")).alias("run_group"))
        parts.append(r.unpivot([], list(RUN_FEATURES), "feature", "supported"))
    if manifest is not None and spark is not None:
        filled = [isinstance(v, Mapping) and bool(v) for v in map(manifest.get, (
            "run_status_mapping", "task_run_status_mapping", "credentials_schema"))]
        filled[2] = filled[2] and "connect_args" in manifest["credentials_schema"]
        parts.append(spark.createDataFrame(list(zip(MANIFEST_FEATURES, filled, strict=True)), "feature string, supported boolean"))
    if webhook is not None:
        parts.append(webhook.agg(F.lit("run_webhook_mode").alias("feature"), (F.count(F.lit(1)) > 0).alias("supported")))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select("feature", F.coalesce(F.col("supported"), F.lit(False)).alias("supported"))


def coverage_totals(coverage: DataFrame) -> DataFrame:
    """ETL13: (category, supported, total) of a feature coverage; the category
    is the first word of a feature's name, NULL for all of them."""
    counted = coverage.select(F.substring_index("feature", "_", 1).alias("category"), "supported")
    return counted.rollup("category").agg(F.count_if("supported").alias("supported"), F.count(F.lit(1)).alias("total"))
