"""DuckDB SQL templates of the metrics, the oracle's independent twin of
``functions.metrics`` (exact forms). ``{x}`` is the quoted column,
``{as_of}`` a TIMESTAMP literal."""

from __future__ import annotations

from tidewatch.functions.patterns import CASE_INSENSITIVE, NULL_KEYWORDS, PATTERNS, TIMESTAMP_SHAPE


def _rate(cond: str) -> str:
    return f"CASE WHEN count(*) = 0 THEN NULL ELSE least(count_if({cond})::DOUBLE / count(*), 1.0) END"


def _rx(name: str) -> str:
    return f"regexp_matches({{x}}, '{'(?i)' if name in CASE_INSENSITIVE else ''}{PATTERNS[name]}')"


_EPOCH = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', {x})"
_EPOCH_AT = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', {as_of})"
_IS_TS = f"(regexp_matches({{x}}, '{TIMESTAMP_SHAPE}') AND TRY_CAST({{x}} AS TIMESTAMP) IS NOT NULL)"
_NULL_KW = "upper({x}) IN (" + ", ".join(f"'{k}'" for k in NULL_KEYWORDS) + ")"

TEMPLATES: dict[str, str] = {
    "row_count": "count(*)",
    "numeric_mean": "avg({x})",
    "numeric_stddev": "stddev_samp({x})",
    "numeric_median": "quantile_cont({x}, 0.5)",
    "percentile_20": "quantile_cont({x}, 0.2)",
    "percentile_40": "quantile_cont({x}, 0.4)",
    "percentile_60": "quantile_cont({x}, 0.6)",
    "percentile_80": "quantile_cont({x}, 0.8)",
    "sum": "sum(TRY_CAST({x} AS DECIMAL(38,10)))",
    "approx_distinct_count": "count(DISTINCT {x})",
    "approx_distinctness": "count(DISTINCT {x})::DOUBLE / count({x})",
    "zero_count": "count_if({x} = 0)",
    "zero_rate": _rate("{x} = 0"),
    "negative_count": "count_if({x} < 0)",
    "negative_rate": _rate("{x} < 0"),
    "nan_count": "count_if(isnan({x}))",
    "nan_rate": _rate("isnan({x})"),
    "true_count": "count_if({x})",
    "true_rate": _rate("{x}"),
    "false_count": "count_if(NOT {x})",
    "false_rate": _rate("NOT {x}"),
    "array_null_rate": _rate("{x} IS NULL OR len({x}) = 0"),
    "past_timestamp_count": f"count_if({_EPOCH} < {_EPOCH_AT})",
    "past_timestamp_rate": _rate(f"{_EPOCH} < {_EPOCH_AT}"),
    "future_timestamp_count": f"count_if({_EPOCH} > {_EPOCH_AT})",
    "future_timestamp_rate": _rate(f"{_EPOCH} > {_EPOCH_AT}"),
    "unix_zero_count": f"count_if({_EPOCH} = 0)",
    "unix_zero_rate": _rate(f"{_EPOCH} = 0"),
    "text_mean_length": "avg(length({x}))",
    "text_min_length": "min(length({x}))",
    "text_max_length": "max(length({x}))",
    "text_std_length": "stddev_samp(length({x}))",
    "empty_string_count": "count_if({x} = '')",
    "empty_string_rate": _rate("{x} = ''"),
    "text_timestamp_count": f"count_if({_IS_TS})",
    "text_timestamp_rate": _rate(_IS_TS),
    "text_not_timestamp_count": f"count_if({{x}} IS NOT NULL AND NOT {_IS_TS})",
    "text_null_keyword_count": f"count_if({_NULL_KW})",
    "text_null_keyword_rate": _rate(_NULL_KW),
    "text_all_spaces_count": f"count_if({_rx('all_spaces')})",
    "text_all_spaces_rate": _rate(_rx("all_spaces")),
}
for _i, _q in enumerate((0.0, 0.2, 0.4, 0.6, 0.8, 1.0)):
    TEMPLATES[f"approx_quantiles{_i}"] = f"quantile_cont({{x}}, {_q})"
for _n in ("int", "number", "uuid", "email_address", "us_state_code", "us_zip_code", "us_phone", "ssn"):
    TEMPLATES[f"text_{_n}_count"] = f"count_if({_rx(_n)})"
    TEMPLATES[f"text_not_{_n}_count"] = f"count_if({{x}} IS NOT NULL AND NOT {_rx(_n)})"
    TEMPLATES[f"text_{_n}_rate"] = _rate(_rx(_n))


def render(metric: str, column: str | None, as_of: str = "") -> str:
    # plain replacement: the regex patterns carry braces of their own
    return (TEMPLATES[metric].replace("{x}", f'"{column}"' if column else "")
            .replace("{as_of}", f"TIMESTAMP '{as_of}'"))


def profile_sql(table: str, table_id: str, specs: list[tuple[str | None, str]], as_of: str) -> str:
    """Long-form profile: one UNION ALL branch per (column, metric)."""
    parts = []
    for col, metric in specs:
        cname = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT '{table_id}' AS table_id, {cname} AS column_name, '{metric}' AS metric, "
                     f"round(CAST({render(metric, col, as_of)} AS DOUBLE), 6) AS value FROM {table}")
    return "\nUNION ALL ".join(parts)
