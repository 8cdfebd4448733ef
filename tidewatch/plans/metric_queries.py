"""Registered queries for the metrics M1-M73.

Every query is one ``metric_monitor`` call (one scan) over a whole test table.
Sketch metrics run with ``exact=True`` here so the DuckDB oracle can check
them value by value; the approximate default is covered by the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import exprs as E
from tidewatch.functions.patterns import CASE_INSENSITIVE, PATTERNS
from tidewatch.operators import sketches as SK
from tidewatch.operators.monitors import MetricSpec as S
from tidewatch.operators.monitors import metric_monitor
from tidewatch.plans.common import AS_OF_ORDERS, query, rnd, rounded, tbl
from tidewatch.session import scratch_path
from tidewatch.sources.sinks import write_observations


def _mm(df, specs, round_cols=(), **kw):
    out = metric_monitor(df, specs, exact=True, **kw)
    return rounded(out, *round_cols) if round_cols else out


def rate_sql(cond: str) -> str:
    return f"round(CASE WHEN count(*) = 0 THEN NULL ELSE least(count_if({cond})::DOUBLE / count(*), 1.0) END, 6)"


def rx(x: str, name: str) -> str:
    p = PATTERNS[name]
    return f"regexp_matches({x}, '{'(?i)' if name in CASE_INSENSITIVE else ''}{p}')"


# ------------------------------------------------------------------ generic / numeric

@query("m_row_count", """
SELECT l_returnflag, l_linestatus, count(*) AS row_count FROM lineitem GROUP BY 1, 2
""")
def m_row_count(spark, sf):
    return _mm(tbl(spark, sf, "lineitem"), [S("row_count")], segments=["l_returnflag", "l_linestatus"])


@query("m_row_count_change", """
SELECT bucket_start, event_type, row_count,
       row_count - lag(row_count) OVER (PARTITION BY event_type ORDER BY bucket_start) AS row_count_change
FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS bucket_start, event_type, count(*) AS row_count
      FROM events GROUP BY 1, 2)
""")
def m_row_count_change(spark, sf):
    return _mm(tbl(spark, sf, "events"), [S("row_count"), S("row_count_change")],
               time_col="ts", grain="day", segments=["event_type"])


@query("m_mean", "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1")
def m_mean(spark, sf):
    return _mm(tbl(spark, sf, "lineitem"), [S("numeric_mean", "l_quantity", "mean")], ["mean"],
               segments=["l_returnflag"])


@query("m_stddev", "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS stddev FROM lineitem GROUP BY 1")
def m_stddev(spark, sf):
    return _mm(tbl(spark, sf, "lineitem"), [S("numeric_stddev", "l_quantity", "stddev")], ["stddev"],
               segments=["l_returnflag"])


for _key, _metric, _p in (("m_median", "numeric_median", 0.5), ("m_p20", "percentile_20", 0.2),
                          ("m_p40", "percentile_40", 0.4), ("m_p60", "percentile_60", 0.6),
                          ("m_p80", "percentile_80", 0.8), ("m_q0", "approx_quantiles0", 0.0),
                          ("m_q1", "approx_quantiles1", 0.2), ("m_q2", "approx_quantiles2", 0.4),
                          ("m_q3", "approx_quantiles3", 0.6), ("m_q4", "approx_quantiles4", 0.8),
                          ("m_q5", "approx_quantiles5", 1.0)):
    def _mk(metric=_metric):
        return lambda spark, sf: _mm(tbl(spark, sf, "orders"), [S(metric, "o_totalprice", "value")],
                                     ["value"], segments=["o_orderstatus"])
    query(_key, f"""
SELECT o_orderstatus, round(quantile_cont(o_totalprice, {_p}), 6) AS value FROM orders GROUP BY 1
""")(_mk())


@query("m_quantiles", """
SELECT o_orderstatus,
       list_transform(quantile_cont(o_totalprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]), lambda x: round(x, 6)) AS quantiles
FROM orders GROUP BY 1
""")
def m_quantiles(spark, sf):
    out = _mm(tbl(spark, sf, "orders"), [S("approx_quantiles", "o_totalprice", "quantiles")],
              segments=["o_orderstatus"])
    return out.select("o_orderstatus", F.transform("quantiles", lambda x: F.round(x, 6)).alias("quantiles"))


@query("m_sum", """
SELECT l_returnflag, sum(TRY_CAST(l_extendedprice AS DECIMAL(38,10))) AS total FROM lineitem GROUP BY 1
""")
def m_sum(spark, sf):
    return _mm(tbl(spark, sf, "lineitem"), [S("sum", "l_extendedprice", "total")], segments=["l_returnflag"])


@query("m_distinct", """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS distinct_customers,
       count(DISTINCT o_orderstatus) AS distinct_status
FROM orders GROUP BY 1
""")
def m_distinct(spark, sf):
    return _mm(tbl(spark, sf, "orders"),
               [S("approx_distinct_count", "o_custkey", "distinct_customers"),
                S("approx_distinct_count", "o_orderstatus", "distinct_status")],
               segments=["o_orderpriority"])


@query("m_distinctness", """
SELECT o_orderpriority, round(count(DISTINCT o_custkey)::DOUBLE / count(o_custkey), 6) AS distinctness
FROM orders GROUP BY 1
""")
def m_distinctness(spark, sf):
    return _mm(tbl(spark, sf, "orders"), [S("approx_distinctness", "o_custkey", "distinctness")],
               ["distinctness"], segments=["o_orderpriority"])


@query("m_zero", f"""
SELECT l_linestatus, count_if(l_discount = 0) AS zero_count, {rate_sql('l_discount = 0')} AS zero_rate
FROM lineitem GROUP BY 1
""")
def m_zero(spark, sf):
    return _mm(tbl(spark, sf, "lineitem"),
               [S("zero_count", "l_discount", "zero_count"), S("zero_rate", "l_discount", "zero_rate")],
               ["zero_rate"], segments=["l_linestatus"])


@query("m_negative", f"""
SELECT c_mktsegment, count_if(c_acctbal < 0) AS negative_count, {rate_sql('c_acctbal < 0')} AS negative_rate
FROM customer GROUP BY 1
""")
def m_negative(spark, sf):
    return _mm(tbl(spark, sf, "customer"),
               [S("negative_count", "c_acctbal", "negative_count"),
                S("negative_rate", "c_acctbal", "negative_rate")],
               ["negative_rate"], segments=["c_mktsegment"])


_NAN_V = "CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END"


@query("m_nan", f"""
SELECT count_if(isnan(value)) AS value_nan_count, {rate_sql('isnan(value)')} AS value_nan_rate,
       count_if(isnan({_NAN_V})) AS marked_nan_count, {rate_sql(f'isnan({_NAN_V})')} AS marked_nan_rate
FROM events
""")
def m_nan(spark, sf):
    ev = tbl(spark, sf, "events").withColumn(
        "marked", F.when(F.col("event_type") == "error", E.nan()).otherwise(F.col("value")))
    return _mm(ev, [S("nan_count", "value", "value_nan_count"), S("nan_rate", "value", "value_nan_rate"),
                    S("nan_count", "marked", "marked_nan_count"), S("nan_rate", "marked", "marked_nan_rate")],
               ["value_nan_rate", "marked_nan_rate"])


@query("m_bool", f"""
SELECT toxic, count_if(quality = 1) AS true_count, {rate_sql('quality = 1')} AS true_rate,
       count_if(NOT (quality = 1)) AS false_count, {rate_sql('NOT (quality = 1)')} AS false_rate
FROM labels GROUP BY 1
""")
def m_bool(spark, sf):
    lb = tbl(spark, sf, "labels").withColumn("good", F.col("quality") == 1)
    return _mm(lb, [S("true_count", "good", "true_count"), S("true_rate", "good", "true_rate"),
                    S("false_count", "good", "false_count"), S("false_rate", "good", "false_rate")],
               ["true_rate", "false_rate"], segments=["toxic"])


@query("m_array_null", f"""
SELECT label, {rate_sql('embedding IS NULL OR len(embedding) = 0')} AS embedding_null_rate,
       {rate_sql('len(list_filter(embedding, lambda x: x > 0.2)) = 0')} AS high_null_rate
FROM embeddings GROUP BY 1
""")
def m_array_null(spark, sf):
    em = tbl(spark, sf, "embeddings").withColumn("high", F.filter("embedding", lambda x: x > 0.2))
    return _mm(em, [S("array_null_rate", "embedding", "embedding_null_rate"),
                    S("array_null_rate", "high", "high_null_rate")],
               ["embedding_null_rate", "high_null_rate"], segments=["label"])


# ------------------------------------------------------------------ timestamp

_EP = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', {x})"
_EP_AS_OF = _EP.format(x=f"TIMESTAMP '{AS_OF_ORDERS}'")
_EP_O = _EP.format(x="o_orderdate")


@query("m_past_ts", f"""
SELECT o_orderstatus, count_if({_EP_O} < {_EP_AS_OF}) AS past_count,
       {rate_sql(f'{_EP_O} < {_EP_AS_OF}')} AS past_rate
FROM orders GROUP BY 1
""")
def m_past_ts(spark, sf):
    return _mm(tbl(spark, sf, "orders"),
               [S("past_timestamp_count", "o_orderdate", "past_count"),
                S("past_timestamp_rate", "o_orderdate", "past_rate")],
               ["past_rate"], segments=["o_orderstatus"], as_of=AS_OF_ORDERS)


@query("m_future_ts", f"""
SELECT o_orderstatus, count_if({_EP_O} > {_EP_AS_OF}) AS future_count,
       {rate_sql(f'{_EP_O} > {_EP_AS_OF}')} AS future_rate
FROM orders GROUP BY 1
""")
def m_future_ts(spark, sf):
    return _mm(tbl(spark, sf, "orders"),
               [S("future_timestamp_count", "o_orderdate", "future_count"),
                S("future_timestamp_rate", "o_orderdate", "future_rate")],
               ["future_rate"], segments=["o_orderstatus"], as_of=AS_OF_ORDERS)


_EP_Z = _EP.format(x="CAST(CAST(o_orderdate AS DATE) - CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS INTEGER) AS TIMESTAMP)")


@query("m_unix_zero", f"""
SELECT o_orderstatus, count_if({_EP_O} = 0) AS zero_count, {rate_sql(f'{_EP_O} = 0')} AS zero_rate,
       count_if({_EP_Z} = 0) AS epoch_start_count
FROM orders GROUP BY 1
""")
def m_unix_zero(spark, sf):
    o = tbl(spark, sf, "orders")
    d = E.to_date("o_orderdate")
    # the day of each order moved back by its own distance to 1970-01-01
    o = o.withColumn("epoch_start", E.date_to_ts(F.date_sub(d, F.datediff(d, F.lit("1970-01-01").cast("date")))))
    return _mm(o, [S("unix_zero_count", "o_orderdate", "zero_count"),
                   S("unix_zero_rate", "o_orderdate", "zero_rate"),
                   S("unix_zero_count", "epoch_start", "epoch_start_count")],
               ["zero_rate"], segments=["o_orderstatus"])


# ------------------------------------------------------------------ text

@query("m_len", """
SELECT lang, round(avg(length(text)), 6) AS mean_length, min(length(text)) AS min_length,
       max(length(text)) AS max_length, round(stddev_samp(length(text)), 6) AS std_length
FROM documents GROUP BY 1
""")
def m_len(spark, sf):
    return _mm(tbl(spark, sf, "documents"),
               [S("text_mean_length", "text", "mean_length"), S("text_min_length", "text", "min_length"),
                S("text_max_length", "text", "max_length"), S("text_std_length", "text", "std_length")],
               ["mean_length", "std_length"], segments=["lang"])


_SOME_EMPTY = "CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN ' ' ELSE text END"


@query("m_empty", f"""
SELECT source, count_if(text = '') AS empty_count, {rate_sql("text = ''")} AS empty_rate
FROM (SELECT source, {_SOME_EMPTY} AS text FROM documents) d GROUP BY 1
""")
def m_empty(spark, sf):
    return _mm(tbl(spark, sf, "documents").withColumn("text", F.expr(_SOME_EMPTY)),
               [S("empty_string_count", "text", "empty_count"), S("empty_string_rate", "text", "empty_rate")],
               ["empty_rate"], segments=["source"])


_TS_SHAPE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}"
_IS_TS = f"(regexp_matches(t, '{_TS_SHAPE}') AND TRY_CAST(t AS TIMESTAMP) IS NOT NULL)"


@query("m_text_ts", f"""
SELECT kind, count_if({_IS_TS}) AS ts_count, {rate_sql(_IS_TS)} AS ts_rate,
       count_if(t IS NOT NULL AND NOT {_IS_TS}) AS not_ts_count
FROM (SELECT 'ts' AS kind, CAST(ts AS VARCHAR) AS t FROM events
      UNION ALL SELECT 'props', props FROM events
      UNION ALL SELECT 'day', CAST(CAST(ts AS DATE) AS VARCHAR) FROM events) x
GROUP BY 1
""")
def m_text_ts(spark, sf):
    ev = tbl(spark, sf, "events")
    texts = E.union([ev.select(F.lit("ts").alias("kind"), E.to_string("ts").alias("t")),
                     ev.select(F.lit("props").alias("kind"), F.col("props").alias("t")),
                     ev.select(F.lit("day").alias("kind"), E.to_string(E.to_date("ts")).alias("t"))])
    return _mm(texts, [S("text_timestamp_count", "t", "ts_count"), S("text_timestamp_rate", "t", "ts_rate"),
                       S("text_not_timestamp_count", "t", "not_ts_count")], ["ts_rate"], segments=["kind"])


_NULL_KW = "upper(text) IN ('NULL', 'NONE', 'NIL', 'NA', 'N/A', 'NAN', 'UNDEFINED')"


_SOME_KEYWORDS = "CASE length(text) % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN 'None' WHEN 2 THEN 'nulls' WHEN 3 THEN NULL ELSE text END"


@query("m_null_kw", f"""
SELECT role, count_if({_NULL_KW}) AS null_keyword_count, {rate_sql(_NULL_KW)} AS null_keyword_rate
FROM (SELECT role, {_SOME_KEYWORDS} AS text FROM conversations) c GROUP BY 1
""")
def m_null_kw(spark, sf):
    return _mm(tbl(spark, sf, "conversations").withColumn("text", F.expr(_SOME_KEYWORDS)),
               [S("text_null_keyword_count", "text", "null_keyword_count"),
                S("text_null_keyword_rate", "text", "null_keyword_rate")],
               ["null_keyword_rate"], segments=["role"])


def _family_sql(name: str, table: str, col_sql: str, segment: str, alias: str) -> str:
    m = rx("x", name)
    return f"""
SELECT {segment}, count_if({m}) AS {alias}_count, count_if(x IS NOT NULL AND NOT {m}) AS {alias}_not_count,
       {rate_sql(m)} AS {alias}_rate
FROM (SELECT {segment}, {col_sql} AS x FROM {table}) t GROUP BY 1
"""


def _family(name: str, table: str, col_expr, segment: str, alias: str):
    def fn(spark, sf):
        df = tbl(spark, sf, table).select(segment, col_expr().alias("x"))
        return _mm(df, [S(f"text_{name}_count", "x", f"{alias}_count"),
                        S(f"text_not_{name}_count", "x", f"{alias}_not_count"),
                        S(f"text_{name}_rate", "x", f"{alias}_rate")],
                   [f"{alias}_rate"], segments=[segment])
    return fn


# texts of which some hold what is looked for, and some nearly do
_SOME_UUIDS = """CASE doc_id % 4 WHEN 0 THEN concat('id ', substr(md5(text), 1, 8), '-', substr(md5(text), 9, 4), '-', substr(md5(text), 13, 4),
 '-', substr(md5(text), 17, 4), '-', substr(md5(text), 21, 12)) WHEN 1 THEN md5(text) WHEN 2 THEN NULL ELSE text END"""
_SOME_SSNS = """CASE doc_id % 4 WHEN 0 THEN concat('no. ', 100 + doc_id % 800, '-', 10 + doc_id % 80, '-', 1000 + doc_id % 8000)
 WHEN 1 THEN concat(100 + doc_id % 800, '-', 1 + doc_id % 8, '-', 1000 + doc_id % 8000) ELSE text END"""
_SOME_INTS = "CASE p_partkey % 3 WHEN 0 THEN concat('', p_partkey) WHEN 1 THEN concat('-', p_partkey) ELSE p_name END"
_SOME_SPACES = "CASE length(text) % 5 WHEN 0 THEN '  ' WHEN 1 THEN '' WHEN 2 THEN concat(' ', text) ELSE text END"

_FAMILIES = (
    ("m_text_int", "int", "part", "CAST(p_partkey AS VARCHAR)", lambda: E.to_string("p_partkey"), "p_brand", "int"),
    ("m_text_number", "number", "lineitem", "CAST(l_discount AS VARCHAR)", lambda: E.to_string("l_discount"),
     "l_returnflag", "number"),
    ("m_text_uuid", "uuid", "documents", _SOME_UUIDS, lambda: F.expr(_SOME_UUIDS), "lang", "uuid"),
    ("m_text_email_address", "email_address", "documents", "text", lambda: F.col("text"), "lang", "email"),
    ("m_text_us_state_code", "us_state_code", "documents", "lang", lambda: F.col("lang"), "source", "state"),
    ("m_text_us_zip_code", "us_zip_code", "orders", "CAST(o_orderkey AS VARCHAR)",
     lambda: E.to_string("o_orderkey"), "o_orderstatus", "zip"),
    ("m_text_us_phone", "us_phone", "documents", "text", lambda: F.col("text"), "lang", "phone"),
    ("m_text_ssn", "ssn", "documents", _SOME_SSNS, lambda: F.expr(_SOME_SSNS), "lang", "ssn"),
)
for _key, _name, _table, _sqlcol, _colfn, _seg, _alias in _FAMILIES:
    query(_key, _family_sql(_name, _table, _sqlcol, _seg, _alias))(_family(_name, _table, _colfn, _seg, _alias))


@query("m_text_int_name", _family_sql("int", "part", _SOME_INTS, "p_brand", "int"))
def m_text_int_name(spark, sf):
    return _family("int", "part", lambda: F.expr(_SOME_INTS), "p_brand", "int")(spark, sf)


_SP = rx("text", "all_spaces")


@query("m_text_spaces", f"""
SELECT role, count_if({_SP}) AS spaces_count, {rate_sql(_SP)} AS spaces_rate
FROM (SELECT role, {_SOME_SPACES} AS text FROM conversations) c GROUP BY 1
""")
def m_text_spaces(spark, sf):
    return _mm(tbl(spark, sf, "conversations").withColumn("text", F.expr(_SOME_SPACES)),
               [S("text_all_spaces_count", "text", "spaces_count"),
                S("text_all_spaces_rate", "text", "spaces_rate")], ["spaces_rate"], segments=["role"])


# ------------------------------------------------------------------ metric state that merges

@query("m_sketch_rollup", """
SELECT event_type, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month, count(*) AS row_count,
       round(avg(value), 6) AS mean_value, round(stddev_samp(value), 6) AS stddev_value,
       true AS median_rank_holds, true AS p80_rank_holds, true AS users_hold
FROM events GROUP BY 1, 2
""")
def m_sketch_rollup(spark, sf):
    """Day states are written once; the months come from them. The table is
    read again only to check them: the rank of each sketch quantile lies within
    the stated error (plus one row) of the one asked for, the distinct count
    within four standard deviations of the exact one."""
    ev = tbl(spark, sf, "events")
    path = scratch_path(spark, "metric-state")
    state = SK.metric_state(ev, "events", ["value", "user_id"], "ts", "day", ["event_type"])
    write_observations(state.withColumn("metric_date", E.to_date("bucket_start")), path)
    months = SK.state_metrics(SK.merge_state(spark.read.parquet(path), "month", ["event_type"]), (0.5, 0.8))
    value, user = (months.where(F.col("column_name") == c).withColumnRenamed("bucket_start", "month") for c in ("value", "user_id"))
    value = value.select("event_type", "month", "row_count", rnd("numeric_mean").alias("mean_value"),
                         rnd("numeric_stddev").alias("stddev_value"), "numeric_median", "percentile_80")
    user = user.select(F.col("event_type").alias("t"), F.col("month").alias("m"), F.col("approx_distinct_count").alias("users"))
    rows = ev.select(F.col("event_type").alias("t"), E.bucket("ts", "month").alias("m"), "value", "user_id")
    far = lambda p, q: F.greatest(  # noqa: E731 -- how far p lies outside the ranks of the values that equal the sketch's
        F.count_if(F.col("value") < F.col(q)) / F.count("value") - p, p - F.count_if(F.col("value") <= F.col(q)) / F.count("value"))
    exact = (rows.join(value, (rows["t"] == value["event_type"]) & (rows["m"] == value["month"])).groupBy("t", "m")
             .agg(far(0.5, "numeric_median").alias("f50"), far(0.8, "percentile_80").alias("f80"), F.count("value").alias("n"),
                  F.count_distinct("user_id").alias("exact_users")))
    allowed = F.lit(SK.RANK_ERROR) + 1 / F.col("n")
    checked = exact.join(user, ["t", "m"]).select(
        F.col("t").alias("event_type"), F.col("m").alias("month"), (F.col("f50") <= allowed).alias("median_rank_holds"),
        (F.col("f80") <= allowed).alias("p80_rank_holds"),
        (F.abs(F.col("users") - F.col("exact_users")) <= 4 * 1.04 / 2 ** (SK.HLL_BITS / 2) * F.col("exact_users") + 1).alias("users_hold"))
    return value.drop("numeric_median", "percentile_80").join(checked, ["event_type", "month"])
