"""Registered queries for the expression rows E1-E77.

Each query runs a library helper over a whole test table; the SQL next to it
is the DuckDB oracle. Doubles are rounded on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import exprs as E
from tidewatch.functions.patterns import PATTERNS
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.plans.common import AS_OF_EVENTS, query, rnd, tbl

ATS = f"TIMESTAMP '{AS_OF_EVENTS}'"


def _at():
    """The fixed as-of instant (built lazily: no Column at import time)."""
    return E.as_of(AS_OF_EVENTS)

# ------------------------------------------------------------------ projections


@query("proj_select", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def proj_select(spark, sf):
    return E.select(tbl(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", "l_quantity")


@query("proj_wildcard", "SELECT * FROM nation")
def proj_wildcard(spark, sf):
    return E.select_all(tbl(spark, sf, "nation"))


@query("proj_alias", "SELECT c_custkey AS id, c_name AS name, c_acctbal * 2 AS double_balance FROM customer")
def proj_alias(spark, sf):
    c = tbl(spark, sf, "customer")
    return c.select(E.alias("c_custkey", "id"), E.alias("c_name", "name"),
                    E.alias(F.col("c_acctbal") * 2, "double_balance"))


@query("scan_table", "SELECT * FROM region")
def scan_table(spark, sf):
    return E.table(spark, f"{sf}/region.parquet")


@query("cte", """
WITH big_orders AS (SELECT * FROM orders WHERE o_totalprice > 100000)
SELECT o_orderstatus, count(*) AS n FROM big_orders GROUP BY o_orderstatus
""")
def cte(spark, sf):
    big = tbl(spark, sf, "orders").where(F.col("o_totalprice") > 100000)
    E.with_view(big, "tw_big_orders")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM tw_big_orders GROUP BY o_orderstatus")


@query("case_when", """
SELECT CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' END AS band,
       count(*) AS n
FROM orders GROUP BY 1
""")
def case_when(spark, sf):
    p = F.col("o_totalprice")
    band = E.case_when([(p > 200000, "high"), (p > 100000, "mid")])
    return tbl(spark, sf, "orders").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ predicates

def _count_where(df, cond):
    return df.where(cond).agg(F.count(F.lit(1)).alias("n"))


@query("pred_true", "SELECT count(*) AS n FROM lineitem WHERE true")
def pred_true(spark, sf):
    return _count_where(tbl(spark, sf, "lineitem"), E.always_true())


@query("pred_not", "SELECT count(*) AS n FROM lineitem WHERE NOT (l_returnflag = 'R')")
def pred_not(spark, sf):
    return _count_where(tbl(spark, sf, "lineitem"), E.negate(E.eq("l_returnflag", "R")))


_NO_ORDERS = """
SELECT count(*) AS n FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
WHERE o.o_orderkey IS {} NULL
"""


def _cust_orders(spark, sf):
    c = tbl(spark, sf, "customer").select("c_custkey")
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "left")


@query("pred_is_null", _NO_ORDERS.format(""))
def pred_is_null(spark, sf):
    return _count_where(_cust_orders(spark, sf), E.is_null("o_orderkey"))


@query("pred_is_not_null", _NO_ORDERS.format("NOT"))
def pred_is_not_null(spark, sf):
    return _count_where(_cust_orders(spark, sf), E.is_not_null("o_orderkey"))


@query("pred_eq", """
SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_orderstatus
""")
def pred_eq(spark, sf):
    return (tbl(spark, sf, "orders").where(E.eq("o_orderpriority", "1-URGENT"))
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


for _name, _fn, _op in (("pred_gt", E.gt, ">"), ("pred_gte", E.gte, ">="),
                        ("pred_lt", E.lt, "<"), ("pred_lte", E.lte, "<=")):
    def _mk(fn=_fn):
        return lambda spark, sf: _count_where(tbl(spark, sf, "events"), fn("value", 50.0))
    query(_name, f"SELECT count(*) AS n FROM events WHERE value {_op} 50.0")(_mk())


@query("pred_inside", "SELECT count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 10 AND 20")
def pred_inside(spark, sf):
    return _count_where(tbl(spark, sf, "lineitem"), E.inside("l_quantity", 10, 20))


@query("pred_outside", "SELECT count(*) AS n FROM lineitem WHERE (l_quantity < 10 OR l_quantity > 20)")
def pred_outside(spark, sf):
    return _count_where(tbl(spark, sf, "lineitem"), E.outside("l_quantity", 10, 20))


@query("pred_empty", """
SELECT role, count(*) FILTER (WHERE length(text) % 5 = 0) AS empty_texts, count(*) AS n
FROM conversations GROUP BY role
""")
def pred_empty(spark, sf):
    n = F.length("text") % 5
    said = F.when(n == 0, F.lit("")).when(n == 1, F.lit(" ")).when(n > 2, F.col("text"))
    return (tbl(spark, sf, "conversations").withColumn("said", said).groupBy("role")
            .agg(E.count_if(E.is_empty("said")).alias("empty_texts"), F.count(F.lit(1)).alias("n")))


@query("pred_regex", f"""
SELECT lang, count(*) AS n FROM documents
WHERE regexp_matches(text, '(?i){PATTERNS["email_address"]}') GROUP BY lang
""")
def pred_regex(spark, sf):
    return (tbl(spark, sf, "documents").where(E.matches("text", PATTERNS["email_address"], ci=True))
            .groupBy("lang").agg(F.count(F.lit(1)).alias("n")))


_NAN_VALUE = "CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END"


def _nan_value():
    return F.when(F.col("event_type") == "error", E.nan()).otherwise(F.col("value"))


@query("pred_isnan", f"""
SELECT event_type, count(*) AS n FROM events WHERE isnan({_NAN_VALUE}) GROUP BY event_type
""")
def pred_isnan(spark, sf):
    return (tbl(spark, sf, "events").where(E.is_nan(_nan_value()))
            .groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


_TEXTS = """
(SELECT CAST(ts AS VARCHAR) AS t FROM events UNION ALL SELECT props FROM events
 UNION ALL SELECT event_type FROM events UNION ALL SELECT CAST(CAST(ts AS DATE) AS VARCHAR) FROM events)
"""
_IS_TS = "(regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}') AND TRY_CAST(t AS TIMESTAMP) IS NOT NULL)"


def _texts(spark, sf):
    ev = tbl(spark, sf, "events")
    return E.union([ev.select(E.to_string("ts").alias("t")), ev.select(F.col("props").alias("t")),
                    ev.select(F.col("event_type").alias("t")),
                    ev.select(E.to_string(E.to_date("ts")).alias("t"))])


@query("pred_is_ts", f"SELECT count(*) AS n FROM {_TEXTS} x WHERE {_IS_TS}")
def pred_is_ts(spark, sf):
    return _count_where(_texts(spark, sf), E.is_timestamp("t"))


@query("pred_not_ts", f"SELECT count(*) AS n FROM {_TEXTS} x WHERE t IS NOT NULL AND NOT {_IS_TS}")
def pred_not_ts(spark, sf):
    return _count_where(_texts(spark, sf), E.not_timestamp("t"))


@query("pred_yesterday", f"SELECT count(*) AS n FROM events WHERE CAST(ts AS DATE) = CAST({ATS} AS DATE) - 1")
def pred_yesterday(spark, sf):
    return _count_where(tbl(spark, sf, "events"), E.is_yesterday("ts", _at()))


@query("pred_past_days", f"SELECT count(*) AS n FROM events WHERE ts >= {ATS} - INTERVAL 7 DAY")
def pred_past_days(spark, sf):
    return _count_where(tbl(spark, sf, "events"), E.in_past_days("ts", 7, _at()))


@query("pred_past_hours", f"SELECT count(*) AS n FROM events WHERE ts >= {ATS} - INTERVAL 36 HOUR")
def pred_past_hours(spark, sf):
    return _count_where(tbl(spark, sf, "events"), E.in_past_hours("ts", 36, _at()))


@query("pred_cal_week", f"""
SELECT count(*) AS n FROM events WHERE date_trunc('week', ts) = date_trunc('week', {ATS})
""")
def pred_cal_week(spark, sf):
    return _count_where(tbl(spark, sf, "events"), E.in_calendar_week("ts", _at()))


@query("pred_cal_month", """
SELECT count(*) AS n FROM orders WHERE date_trunc('month', o_orderdate) = date_trunc('month', TIMESTAMP '1998-03-15 10:00:00')
""")
def pred_cal_month(spark, sf):
    return _count_where(tbl(spark, sf, "orders"), E.in_calendar_month("o_orderdate", "1998-03-15 10:00:00"))


# ------------------------------------------------------------------ aggregates

@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def agg_count(spark, sf):
    return tbl(spark, sf, "lineitem").agg(E.count_all().alias("n"))


@query("agg_count_if", "SELECT l_returnflag, count_if(l_discount > 0.05) AS n FROM lineitem GROUP BY 1")
def agg_count_if(spark, sf):
    return tbl(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        E.count_if(F.col("l_discount") > 0.05).alias("n"))


@query("agg_avg", "SELECT l_linestatus, round(avg(l_extendedprice), 6) AS avg_price FROM lineitem GROUP BY 1")
def agg_avg(spark, sf):
    return tbl(spark, sf, "lineitem").groupBy("l_linestatus").agg(rnd(E.avg("l_extendedprice")).alias("avg_price"))


@query("agg_stddev", "SELECT o_orderstatus, round(stddev_samp(o_totalprice), 6) AS sd FROM orders GROUP BY 1")
def agg_stddev(spark, sf):
    return tbl(spark, sf, "orders").groupBy("o_orderstatus").agg(rnd(E.stddev("o_totalprice")).alias("sd"))


@query("agg_count_distinct", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1")
def agg_count_distinct(spark, sf):
    return tbl(spark, sf, "orders").groupBy("o_orderpriority").agg(E.count_distinct("o_custkey").alias("n"))


@query("agg_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def agg_distinct(spark, sf):
    return E.distinct(tbl(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("agg_approx_distinct", """
SELECT o_orderstatus, count(DISTINCT o_custkey) AS exact,
       abs(approx_count_distinct(o_custkey) - count(DISTINCT o_custkey)) <= 0.1 * count(DISTINCT o_custkey) AS within_10pct
FROM orders GROUP BY 1
""")
def agg_approx_distinct(spark, sf):
    o = tbl(spark, sf, "orders")
    exact = E.count_distinct("o_custkey")
    return o.groupBy("o_orderstatus").agg(
        exact.alias("exact"),
        (F.abs(E.approx_distinct("o_custkey") - exact) <= 0.1 * exact).alias("within_10pct"))


@query("agg_percentile", """
SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.5), 6) AS median,
       round(quantile_cont(o_totalprice, 0.9), 6) AS p90
FROM orders GROUP BY 1
""")
def agg_percentile(spark, sf):
    q = exact_quantiles(tbl(spark, sf, "orders"), {"o_totalprice": [0.5, 0.9]}, ["o_orderstatus"])
    return q.select("o_orderstatus", *[rnd(F.col("o_totalprice")[i]).alias(n) for i, n in enumerate(("median", "p90"))])


@query("agg_quantiles", """
SELECT o_orderstatus, list_transform(quantile_cont(o_totalprice, [0.0, 0.25, 0.5, 0.75, 1.0]), lambda x: round(x, 6)) AS q
FROM orders GROUP BY 1
""")
def agg_quantiles(spark, sf):
    q = exact_quantiles(tbl(spark, sf, "orders"), {"o_totalprice": E.quantile_points(4)}, ["o_orderstatus"])
    return q.select("o_orderstatus", F.transform("o_totalprice", lambda x: F.round(x, 6)).alias("q"))


@query("agg_any_value", """
SELECT c_nationkey, any_value(n_name) AS nation, count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey
""")
def agg_any_value(spark, sf):
    c, n = tbl(spark, sf, "customer"), tbl(spark, sf, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey).groupBy("c_nationkey")
            .agg(E.any_value("n_name").alias("nation"), F.count(F.lit(1)).alias("customers")))


@query("agg_max_time", "SELECT l_returnflag, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1")
def agg_max_time(spark, sf):
    return tbl(spark, sf, "lineitem").groupBy("l_returnflag").agg(E.max_time("l_shipdate").alias("last_ship"))


@query("agg_safe_divide", """
SELECT o_orderstatus,
       round(CASE WHEN count(*) = 0 THEN NULL ELSE count_if(o_orderpriority = '1-URGENT')::DOUBLE / count(*) END, 6) AS urgent_share,
       CASE WHEN count_if(o_totalprice < 0) = 0 THEN NULL ELSE count(*)::DOUBLE / count_if(o_totalprice < 0) END AS per_negative
FROM orders GROUP BY 1
""")
def agg_safe_divide(spark, sf):
    return tbl(spark, sf, "orders").groupBy("o_orderstatus").agg(
        rnd(E.safe_divide(E.count_if(F.col("o_orderpriority") == "1-URGENT"), E.count_all())).alias("urgent_share"),
        E.safe_divide(E.count_all(), E.count_if(F.col("o_totalprice") < 0)).alias("per_negative"))


# ------------------------------------------------------------------ sorting, sets, reshaping

@query("sort_asc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice ASC NULLS FIRST")
def sort_asc(spark, sf):
    return tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(E.asc("o_totalprice"))


@query("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST")
def sort_desc(spark, sf):
    return tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(E.desc("o_totalprice"))


@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_rows(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return E.limit(o, 10, E.desc("o_totalprice"), E.asc("o_orderkey"))


@query("sample_random", """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY md5(concat(CAST(o_orderkey AS VARCHAR), 'tw')), o_orderkey LIMIT 20
""")
def sample_random(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return E.sample_rows(o, "o_orderkey", 20, "tw")


@query("set_union", """
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier
""")
def set_union(spark, sf):
    c = tbl(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = tbl(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return E.union([c, s], distinct_rows=True)


@query("src_values", """
SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_orderstatus IN (SELECT * FROM (VALUES ('F'), ('O')) v(value)) GROUP BY 1
""")
def src_values(spark, sf):
    vals = E.values_table(spark, ["F", "O"], "value")
    o = tbl(spark, sf, "orders")
    return (o.join(F.broadcast(vals), o.o_orderstatus == vals.value, "left_semi")
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@query("unpivot", """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS name, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem
""")
def unpivot(spark, sf):
    return E.unpivot(tbl(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                     ["l_quantity", "l_discount", "l_tax"], "name", "value")


# ------------------------------------------------------------------ casts

@query("cast_numeric", """
SELECT o_orderpriority, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS level,
       TRY_CAST(o_orderstatus AS DOUBLE) AS status_num, count(*) AS n
FROM orders GROUP BY 1, 2, 3
""")
def cast_numeric(spark, sf):
    o = tbl(spark, sf, "orders")
    return o.groupBy("o_orderpriority", E.to_numeric(E.substr("o_orderpriority", 1, 1)).alias("level"),
                     E.to_numeric("o_orderstatus").alias("status_num")).agg(F.count(F.lit(1)).alias("n"))


@query("cast_decimal", """
SELECT l_returnflag, sum(TRY_CAST(l_extendedprice AS DECIMAL(38,10))) AS total FROM lineitem GROUP BY 1
""")
def cast_decimal(spark, sf):
    return tbl(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(E.to_decimal("l_extendedprice")).alias("total"))


@query("cast_string", """
SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day_text FROM orders
""")
def cast_string(spark, sf):
    o = tbl(spark, sf, "orders")
    return o.select(E.to_string("o_orderkey").alias("key_text"),
                    E.to_string(E.to_date("o_orderdate")).alias("day_text"))


@query("cast_ts_default", """
SELECT event_id, TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS from_text,
       TIMESTAMP '1970-01-01 00:00:00' + to_seconds(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts)) AS from_epoch,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS from_date
FROM events
""")
def cast_ts_default(spark, sf):
    ev = tbl(spark, sf, "events")
    txt = E.to_string("ts")
    ep = E.epoch("ts")
    d = E.to_date("ts")
    return ev.select("event_id",
                     E.to_timestamp_any(txt, T.StringType()).alias("from_text"),
                     E.to_timestamp_any(ep, T.LongType()).alias("from_epoch"),
                     E.to_timestamp_any(d, T.DateType()).alias("from_date"))


@query("cast_ts_string", """
SELECT event_id, TRY_CAST(concat(CAST(CAST(ts AS DATE) AS VARCHAR), ' 12:00:00') AS TIMESTAMP) AS noon,
       TRY_CAST(event_type AS TIMESTAMP) AS bad,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 7 HOUR AS zoned,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '20 hours 500 milliseconds' AS zoned_short
FROM events
""")
def cast_ts_string(spark, sf):
    ev = tbl(spark, sf, "events")
    return ev.select("event_id",
                     E.string_to_ts(F.concat(E.to_string(E.to_date("ts")), F.lit(" 12:00:00"))).alias("noon"),
                     E.string_to_ts("event_type").alias("bad"),
                     E.string_to_ts(F.concat(E.to_string(E.to_date("ts")), F.lit("T12:00:00+05:00"))).alias("zoned"),
                     E.string_to_ts(F.concat(E.to_string(E.to_date("ts")), F.lit(" 12:00:00.5-08"))
                                    ).cast("timestamp_ntz").alias("zoned_short"))


@query("cast_ts_epoch", """
SELECT event_id, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(1704067200 + user_id * 3600 + event_id) AS t FROM events
""")
def cast_ts_epoch(spark, sf):
    ev = tbl(spark, sf, "events")
    return ev.select("event_id", E.epoch_to_ts(F.lit(1704067200) + F.col("user_id") * 3600 + F.col("event_id")).alias("t"))


@query("cast_ts_date", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS t FROM orders")
def cast_ts_date(spark, sf):
    o = tbl(spark, sf, "orders")
    return o.select("o_orderkey", E.date_to_ts(E.to_date("o_orderdate")).alias("t"))


@query("cast_date", "SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1")
def cast_date(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return li.groupBy(E.to_date("l_shipdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))


@query("cast_ntz", """
SELECT event_id, CAST(concat(CAST(CAST(ts AS DATE) AS VARCHAR), ' 08:00:00') AS TIMESTAMP) AS t FROM events
""")
def cast_ntz(spark, sf):
    ev = tbl(spark, sf, "events")
    return ev.select("event_id", E.to_ntz(F.concat(E.to_string(E.to_date("ts")), F.lit(" 08:00:00"))).alias("t"))


@query("cast_ltz", """
SELECT event_id, ts AS back, CAST(floor(epoch(ts)) AS BIGINT) - 7200 AS instant FROM events
""")
def cast_ltz(spark, sf):
    """Zoned cast: the wall time read in the session zone and back (no
    daylight-saving gap in these January times), and the instant of a text
    whose zone is two hours ahead, in any session zone."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00"))
    return tbl(spark, sf, "events").select("event_id", E.to_ntz(E.to_ltz("ts")).alias("back"),
                                           F.unix_seconds(E.to_ltz(text)).alias("instant"))


# ------------------------------------------------------------------ date and time

@query("ts_to_utc", """
SELECT event_id, (ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS utc FROM events
""")
def ts_to_utc(spark, sf):
    return tbl(spark, sf, "events").select("event_id", E.to_utc("ts", "America/New_York").alias("utc"))


@query("ts_from_zone", """
SELECT event_id, ts - INTERVAL 5 HOUR - INTERVAL 30 MINUTE AS utc FROM events
""")
def ts_from_zone(spark, sf):
    return tbl(spark, sf, "events").select("event_id", E.from_zone("ts", "+05:30").alias("utc"))


@query("ts_as_of", f"""
SELECT {ATS} AS as_of, count_if(ts < {ATS}) AS before_n, count_if(ts >= {ATS}) AS after_n FROM events
""")
def ts_as_of(spark, sf):
    ev = tbl(spark, sf, "events")
    return ev.agg(F.first(_at()).alias("as_of"), E.count_if(F.col("ts") < _at()).alias("before_n"),
                  E.count_if(F.col("ts") >= _at()).alias("after_n"))


@query("ts_add_days_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS due, CAST(o_orderdate AS DATE) - 7 AS week_before FROM orders
""")
def ts_add_days_date(spark, sf):
    o = tbl(spark, sf, "orders")
    d = E.to_date("o_orderdate")
    return o.select("o_orderkey", E.add_days(d, 30).alias("due"), E.add_days(d, -7).alias("week_before"))


@query("ts_add_days", "SELECT event_id, ts + INTERVAL 3 DAY AS t FROM events")
def ts_add_days(spark, sf):
    return tbl(spark, sf, "events").select("event_id", E.add_days_ts("ts", 3).alias("t"))


@query("ts_add_hours", "SELECT event_id, ts + INTERVAL 5 HOUR AS t, ts - INTERVAL 30 HOUR AS b FROM events")
def ts_add_hours(spark, sf):
    return tbl(spark, sf, "events").select("event_id", E.add_hours("ts", 5).alias("t"),
                                          E.add_hours("ts", -30).alias("b"))


@query("ts_trunc", """
SELECT CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS q, count(*) AS n FROM orders GROUP BY 1
""")
def ts_trunc(spark, sf):
    return tbl(spark, sf, "orders").groupBy(E.trunc("o_orderdate", "quarter").alias("q")).agg(
        F.count(F.lit(1)).alias("n"))


_GRAINS = ("hour", "day", "week", "month", "year")


@query("ts_buckets", " UNION ALL ".join(
    f"SELECT '{g}' AS grain, CAST(date_trunc('{g}', ts) AS TIMESTAMP) AS bucket_start, count(*) AS n "
    f"FROM events GROUP BY 1, 2" for g in _GRAINS))
def ts_buckets(spark, sf):
    ev = tbl(spark, sf, "events")
    return E.union([ev.groupBy(F.lit(g).alias("grain"), E.bucket("ts", g).alias("bucket_start"))
                    .agg(F.count(F.lit(1)).alias("n")) for g in _GRAINS])


@query("ts_diff", f"""
SELECT date_diff('day', ts, {ATS}) AS days, date_diff('day', date_trunc('week', ts), date_trunc('week', {ATS})) // 7 AS weeks,
       date_diff('month', ts, {ATS}) AS months, count(*) AS n,
       sum(date_diff('hour', ts, {ATS})) AS hours, sum(date_diff('minute', ts, {ATS})) AS minutes
FROM events GROUP BY 1, 2, 3
""")
def ts_diff(spark, sf):
    ev = tbl(spark, sf, "events")
    return ev.groupBy(E.date_diff("ts", _at(), "day").alias("days"), E.date_diff("ts", _at(), "week").alias("weeks"),
                      E.date_diff("ts", _at(), "month").alias("months")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(E.date_diff("ts", _at(), "hour")).alias("hours"),
        F.sum(E.date_diff("ts", _at(), "minute")).alias("minutes"))


@query("ts_dow", "SELECT dayofweek(o_orderdate) AS dow, count(*) AS n FROM orders GROUP BY 1")
def ts_dow(spark, sf):
    return tbl(spark, sf, "orders").groupBy(E.day_of_week("o_orderdate").alias("dow")).agg(
        F.count(F.lit(1)).alias("n"))


@query("ts_epoch", """
SELECT o_orderstatus, min(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o_orderdate)) AS first_epoch,
       sum(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o_orderdate)) AS epoch_sum
FROM orders GROUP BY 1
""")
def ts_epoch(spark, sf):
    ep = E.epoch("o_orderdate")
    return tbl(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.min(ep).alias("first_epoch"), F.sum(ep).alias("epoch_sum"))


@query("ts_literals", """
SELECT count_if(ts >= TIMESTAMP '2024-01-10 06:00:00') AS after_ts,
       count_if(CAST(ts AS DATE) < DATE '2024-01-05') AS before_date,
       count_if(strftime(ts, '%H:%M:%S') < '12:00:00') AS mornings
FROM events
""")
def ts_literals(spark, sf):
    import datetime as dt

    ev = tbl(spark, sf, "events")
    t = F.col("ts")
    return ev.agg(E.count_if(t >= E.lit_timestamp(dt.datetime(2024, 1, 10, 6))).alias("after_ts"),
                  E.count_if(E.to_date(t) < E.lit_date(dt.date(2024, 1, 5))).alias("before_date"),
                  E.count_if(E.time_of_day(t) < E.lit_time(dt.time(12, 0, 0))).alias("mornings"))


# ------------------------------------------------------------------ strings, math, arrays, constants

@query("str_length", """
SELECT lang, min(length(text)) AS min_len, max(length(text)) AS max_len, sum(length(text)) AS total_len
FROM documents GROUP BY 1
""")
def str_length(spark, sf):
    ln = E.length("text")
    return tbl(spark, sf, "documents").groupBy("lang").agg(
        F.min(ln).alias("min_len"), F.max(ln).alias("max_len"), F.sum(ln).alias("total_len"))


@query("str_substr", "SELECT DISTINCT substr(c_name, 1, 12) AS prefix FROM customer")
def str_substr(spark, sf):
    return tbl(spark, sf, "customer").select(E.substr("c_name", 1, 12).alias("prefix")).distinct()


@query("str_regex_total", """
SELECT lang, sum(len(regexp_extract_all(text, '[0-9]+'))) AS matches,
       count_if(regexp_matches(text, '^[0-9]+$')) AS rows_matching
FROM documents GROUP BY 1
""")
def str_regex_total(spark, sf):
    return tbl(spark, sf, "documents").groupBy("lang").agg(
        E.regex_match_total("text", "[0-9]+").alias("matches"),
        E.count_if(E.matches("text", "^[0-9]+$")).alias("rows_matching"))


@query("str_regex_lit", r"""
SELECT count_if(regexp_matches(text, '\d{3}-\d{4}')) AS n FROM documents
""")
def str_regex_lit(spark, sf):
    return tbl(spark, sf, "documents").agg(E.count_if(E.matches("text", E.regex_lit(r"\d{3}-\d{4}"))).alias("n"))


@query("math_abs", """
SELECT c_mktsegment, round(sum(abs(c_acctbal)), 6) AS abs_total FROM customer GROUP BY 1
""")
def math_abs(spark, sf):
    return tbl(spark, sf, "customer").groupBy("c_mktsegment").agg(rnd(F.sum(E.abs_("c_acctbal"))).alias("abs_total"))


@query("math_nan", f"""
SELECT count_if(isnan({_NAN_VALUE})) AS nan_rows, count_if(NOT isnan({_NAN_VALUE})) AS number_rows FROM events
""")
def math_nan(spark, sf):
    v = _nan_value()
    return tbl(spark, sf, "events").agg(E.count_if(F.isnan(v)).alias("nan_rows"),
                                        E.count_if(~F.isnan(v)).alias("number_rows"))


@query("arr_literal", """
SELECT r_regionkey, [r_regionkey, r_regionkey + 1, 7] AS a FROM region
""")
def arr_literal(spark, sf):
    r = tbl(spark, sf, "region")
    return r.select("r_regionkey", E.array_lit(F.col("r_regionkey"), F.col("r_regionkey") + 1, 7).alias("a"))


@query("arr_length", """
SELECT label, count(*) AS n, sum(len(embedding)) AS total_len FROM embeddings GROUP BY 1
""")
def arr_length(spark, sf):
    ln = E.array_length("embedding")
    return tbl(spark, sf, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                                             F.sum(ln).alias("total_len"))


@query("lit_value", """
SELECT r_regionkey, 1 AS one, 'x' AS letter, 2.5 AS half, true AS yes FROM region
""")
def lit_value(spark, sf):
    return tbl(spark, sf, "region").select("r_regionkey", E.lit(1).alias("one"), E.lit("x").alias("letter"),
                                           E.lit(2.5).alias("half"), E.lit(True).alias("yes"))
