"""Which metric each SQL template enables (the capability map of MON4).

Fixed values: template name -> metric names, as the metric map states them.
"""

# --- fixed values: template -> metrics ---
TEMPLATE_METRICS: dict[str, tuple[str, ...]] = {
    "get_avg_function": ("numeric_mean",),
    "get_stddev_function": ("numeric_stddev", "text_std_length"),
    "get_approx_percentile_func": (
        "numeric_median", "percentile_20", "percentile_40", "percentile_60", "percentile_80",
        "approx_quantiles0", "approx_quantiles1", "approx_quantiles2", "approx_quantiles3",
        "approx_quantiles4", "approx_quantiles5"),
    "get_approx_quantiles_func": ("approx_quantiles",),
    "get_distinct_count_func": ("approx_distinct_count", "approx_distinctness"),
    "get_distinctness_func": ("approx_distinctness",),
    "get_casting_to_decimal_expression": ("sum",),
    "get_length": ("text_mean_length", "text_min_length", "text_max_length", "text_std_length"),
    "get_conditional_count_expression": (
        "zero_count", "zero_rate", "negative_count", "negative_rate", "nan_count", "nan_rate",
        "empty_string_count", "empty_string_rate", "true_count", "true_rate", "false_count", "false_rate",
        "text_timestamp_count", "text_timestamp_rate", "text_not_timestamp_count", "past_timestamp_count",
        "past_timestamp_rate", "future_timestamp_count", "future_timestamp_rate", "unix_zero_count",
        "unix_zero_rate", "text_null_keyword_count", "text_null_keyword_rate", "array_null_rate"),
    "get_isnan_expression": ("nan_count", "nan_rate"),
    "get_is_empty_string_expression": ("empty_string_count", "empty_string_rate"),
    "get_boolean_match_expression": ("true_count", "true_rate", "false_count", "false_rate"),
    "get_is_timestamp_expression": ("text_timestamp_count", "text_timestamp_rate"),
    "get_not_is_timestamp_expression": ("text_not_timestamp_count",),
    "get_epoch_seconds_expression": (
        "past_timestamp_count", "past_timestamp_rate", "future_timestamp_count", "future_timestamp_rate",
        "unix_zero_count", "unix_zero_rate"),
    "get_array_length_func": ("array_null_rate",),
    "convert_field_to_uppercase": ("text_null_keyword_count", "text_null_keyword_rate"),
    "in_values": ("text_null_keyword_count", "text_null_keyword_rate"),
}

# the regex-family metrics are enabled by three templates each
_REGEX_METRICS = tuple(
    m for n in ("int", "number", "uuid", "email_address", "us_state_code", "us_zip_code", "us_phone", "ssn")
    for m in (f"text_{n}_count", f"text_not_{n}_count", f"text_{n}_rate")) + (
    "text_all_spaces_count", "text_all_spaces_rate")
for _t in ("get_regexp_count_expression", "get_regexp_expression", "literal_regex"):
    TEMPLATE_METRICS[_t] = _REGEX_METRICS


def mapping_rows() -> list[tuple[str, str]]:
    return [(t, m) for t, ms in TEMPLATE_METRICS.items() for m in ms]
