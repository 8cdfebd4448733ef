"""Fixed schemas (SURVEY 1, "Schemas to declare"). Readers use them so no
inference pass runs over the data."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, TS, D = T.StringType(), T.LongType(), T.TimestampNTZType(), T.DoubleType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


TABLE = T.StructType([
    _f("database_name", S, False), _f("schema_name", S, False), _f("table_name", S, False),
    _f("table_type", S, False), _f("row_count", L), _f("byte_count", L),
    _f("last_update_time", TS), _f("view_query", S),
])

COLUMN = T.StructType([_f("full_table_id", S), _f("column_name", S), _f("column_type", S)])

QUERY_LOG = T.StructType([
    _f("query_id", S, False), _f("start_time", TS, False), _f("end_time", TS, False),
    _f("query_text", S, False), _f("user", S), _f("error_code", S), _f("error_text", S),
    _f("returned_rows", L), _f("extra", T.MapType(S, S)),
])

ASSET_REF = T.StructType([_f("asset_type", S), _f("role", S), _f("fully_qualified_name", S), _f("mcon", S)])
SCHEDULE = T.StructType([_f("kind", S), _f("cron_expression", S), _f("interval_seconds", L),
                         _f("event_trigger", S)])
GROUP = T.StructType([_f("source_id", S), _f("name", S), _f("group_type", S), _f("schedule", SCHEDULE),
                      _f("attributes", T.MapType(S, S))])
TAG = T.StructType([_f("key", S), _f("value", S)])
TASK = T.StructType([
    _f("task_source_id", S), _f("name", S), _f("task_type", S), _f("description", S),
    _f("inputs", T.ArrayType(ASSET_REF)), _f("outputs", T.ArrayType(ASSET_REF)),
    _f("upstream_task_source_ids", T.ArrayType(S)), _f("triggered_job_source_ids", T.ArrayType(S)),
])
ASSET = T.StructType([
    _f("job_source_id", S), _f("name", S), _f("description", S), _f("folder", S),
    _f("schedule", SCHEDULE), _f("owner", T.StructType([_f("primary_email", S), _f("primary_name", S)])),
    _f("tags", T.ArrayType(TAG)), _f("properties", T.ArrayType(TAG)), _f("group", GROUP),
    _f("tasks", T.ArrayType(TASK)), _f("inputs", T.ArrayType(ASSET_REF)), _f("outputs", T.ArrayType(ASSET_REF)),
])
ERROR_OBJ = T.StructType([_f("message", S), _f("code", S), _f("failure_type", S)])
# task_runs nest without limit in the contract; the typed view keeps them as
# raw JSON text (the validator works on VARIANT and flattens any depth)
RUN = T.StructType([
    _f("job_source_id", S), _f("run_source_id", S), _f("status", S), _f("event_time", S),
    _f("start_time", S), _f("end_time", S), _f("trigger", S), _f("error", ERROR_OBJ),
    _f("run_url", S), _f("inputs", T.ArrayType(ASSET_REF)), _f("outputs", T.ArrayType(ASSET_REF)),
    _f("group", GROUP), _f("task_runs", S),
])

ERROR = T.StructType([
    _f("event_pos", L), _f("event_index", S), _f("check_no", T.IntegerType()), _f("field", S),
    _f("message", S), _f("order_key", T.ArrayType(T.IntegerType())),
])

OBSERVATION = T.StructType([
    _f("table_id", S), _f("column_name", S), _f("metric", S), _f("segment", T.MapType(S, S)),
    _f("bucket_start", TS), _f("value", D), _f("as_of", TS),
])
