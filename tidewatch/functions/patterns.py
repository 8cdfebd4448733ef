"""Fixed values. These must stay as they are for results to agree with the
documented semantics (SURVEY P5, P13, P15, P20); patterns use the common
subset of Java regex and RE2 so Spark and the SQL oracle agree."""

# --- fixed values: text patterns (unanchored search unless anchored) ---
PATTERNS = {
    "int": r"^[0-9]+$",
    "number": r"^[-+]?[0-9]+(\.[0-9]+)?$",
    "uuid": r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    "email_address": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z][a-zA-Z]+",
    "us_state_code": (
        r"^(AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|MA|MI|MN|MS|MO|"
        r"MT|NE|NV|NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|TX|UT|VT|VA|WA|WV|WI|WY|DC)$"
    ),
    "us_zip_code": r"^[0-9]{5}(-[0-9]{4})?$",
    "us_phone": r"(\+?1[-. ]?)?\(?[0-9]{3}\)?[-. ]?[0-9]{3}[-. ][0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "all_spaces": r"^\s+$",
}

# patterns matched case-insensitively
CASE_INSENSITIVE = frozenset({"us_state_code"})

# --- fixed values: shape of a text timestamp (P13) ---
TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}"

# --- fixed values: null keywords compared on upper(x) (P15) ---
NULL_KEYWORDS = ("NULL", "NONE", "NIL", "NA", "N/A", "NAN", "UNDEFINED")

# --- fixed values: ISO 8601 extended form with zone (ETL8) ---
ISO_DATETIME = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?$"
)
ISO_ZONE = r"[T ].*(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"

# --- fixed values: ETL value sets ---
FINAL_STATUSES = (
    "success", "failed", "skipped", "cancelled", "error", "timed_out", "pass",
    "fail", "partial_success",
)
OPEN_STATUSES = ("in_progress", "queued", "unknown")
ERROR_STATUSES = ("failed", "error")
ASSET_TYPES = ("TABLE", "VIEW", "FILE", "TOPIC", "DATASET", "DASHBOARD")
ASSET_ROLES = ("INPUT", "OUTPUT")

# --- fixed values: query tag keys (first alias is the recommended one) ---
TAG_KEYS = {
    "job": ("mcd_job_id",),
    "task": ("mcd_task_id",),
    "connection": ("mcd_resource_id",),
    "airflow_dag": ("dag_id", "dag", "dag_name", "airflow_dag", "airflow_dag_id"),
    "airflow_task": ("task_id", "task", "task_name", "airflow_task", "airflow_task_id"),
    "adf_pipeline": ("adf_pipeline_name",),
    "adf_activity": ("adf_activity_name",),
    "dbt_invocation": ("dbt_invocation_id", "invocation_id"),
    "dbt_node": ("dbt_node_id", "model_id", "node_id"),
    "dbt_node_name": ("dbt_model", "dbt_model_name", "model_name", "node_name"),
    "dbt_target": ("dbt_target", "dbt_target_name", "target_name"),
    "dbt_cloud_job": ("dbt_cloud_job_id",),
    "dbt_cloud_run": ("dbt_cloud_run_id",),
    "adf_connection": ("mc_integration_name",),
    "airflow_connection": ("airflow_env",),
}
