"""Expression helpers.

Every helper returns a native Column (or DataFrame for the relational ones),
so Catalyst sees through it and everything stays inside whole-stage codegen.
No Python runs per row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.patterns import NULL_KEYWORDS, TIMESTAMP_SHAPE

ColumnOrName = Column | str

EPOCH_NTZ = "1970-01-01 00:00:00"


def col(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- projections

def select(df: DataFrame, *exprs: ColumnOrName) -> DataFrame:
    """SELECT list; an empty list means all columns."""
    return df.select(*exprs) if exprs else df.select("*")


def select_all(df: DataFrame) -> DataFrame:
    """Wildcard projection."""
    return df.select("*")


def alias(expr: ColumnOrName, name: str) -> Column:
    """Rename an expression."""
    return col(expr).alias(name)


def table(spark: SparkSession, ident: str) -> DataFrame:
    """Read a named table (catalog.schema.table or a path to parquet)."""
    if "/" in ident:
        return spark.read.parquet(ident)
    return spark.table(ident)


def with_view(df: DataFrame, name: str) -> DataFrame:
    """E5: named sub-query, usable from SQL as a CTE-like view."""
    df.createOrReplaceTempView(name)
    return df


def case_when(pairs: Sequence[tuple[Column, object]], else_: object = None) -> Column:
    """Ordered CASE WHEN; NULL when nothing matches and no ELSE."""
    if not pairs:
        return F.lit(else_)
    out = None
    for cond, value in pairs:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if else_ is not None:
        out = out.otherwise(else_ if isinstance(else_, Column) else F.lit(else_))
    return out


# ---------------------------------------------------------------- predicates

def always_true() -> Column:
    """E7."""
    return F.lit(True)


def negate(cond: Column) -> Column:
    """Three-valued NOT."""
    return ~cond


def is_null(x: ColumnOrName) -> Column:
    return col(x).isNull()


def is_not_null(x: ColumnOrName) -> Column:
    return col(x).isNotNull()


def _v(y):
    return y if isinstance(y, Column) else F.lit(y)


def eq(x: ColumnOrName, y) -> Column:
    """Plain equality; NULL never matches."""
    return col(x) == _v(y)


def gt(x: ColumnOrName, y) -> Column:
    return col(x) > _v(y)


def gte(x: ColumnOrName, y) -> Column:
    return col(x) >= _v(y)


def lt(x: ColumnOrName, y) -> Column:
    return col(x) < _v(y)


def lte(x: ColumnOrName, y) -> Column:
    return col(x) <= _v(y)


def inside(x: ColumnOrName, lo, hi) -> Column:
    """Lo <= x <= hi."""
    return col(x).between(_v(lo), _v(hi))


def outside(x: ColumnOrName, lo, hi) -> Column:
    """X < lo OR x > hi."""
    c = col(x)
    return (c < _v(lo)) | (c > _v(hi))


def is_empty(x: ColumnOrName) -> Column:
    """Exactly the empty string (blanks are not empty)."""
    return col(x) == F.lit("")


def matches(x: ColumnOrName, regex: str, ci: bool = False) -> Column:
    """Unanchored regex search (P5)."""
    return col(x).rlike(("(?i)" if ci else "") + regex)


def is_nan(x: ColumnOrName) -> Column:
    """NaN test; isnan(NULL) is false."""
    return F.isnan(col(x))


def is_timestamp(x: ColumnOrName) -> Column:
    """Text that has the timestamp shape and casts."""
    c = col(x)
    return c.rlike(TIMESTAMP_SHAPE) & c.try_cast("timestamp_ntz").isNotNull()


def not_timestamp(x: ColumnOrName) -> Column:
    """Non-NULL text that is not a timestamp."""
    c = col(x)
    return c.isNotNull() & ~F.coalesce(is_timestamp(c), F.lit(False))


def _utc_wall(value) -> str:
    """Wall time in UTC of a datetime, date or ISO text; a zone is converted,
    without one the value is UTC already."""
    if isinstance(value, str):
        try:
            parsed = _dt.datetime.fromisoformat(value)
        except ValueError:
            return value
        value = parsed if parsed.tzinfo is not None else value
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return value.isoformat(sep=" ")
    return value.isoformat() if isinstance(value, _dt.date) else str(value)


def as_of(value=None) -> Column:
    """The job's reference time as TIMESTAMP_NTZ in UTC wall time.

    ``None`` means now (one value per query); a datetime / ISO string pins it.
    """
    if value is None:
        return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp()).cast("timestamp_ntz")
    if isinstance(value, Column):
        return value
    return F.lit(_utc_wall(value)).cast("timestamp_ntz")


def _as_of(a) -> Column:
    return a if isinstance(a, Column) else as_of(a)


def is_yesterday(x: ColumnOrName, at=None) -> Column:
    """date(x) = date(as_of) - 1."""
    return F.to_date(col(x)) == F.date_sub(F.to_date(_as_of(at)), 1)


def in_past_days(x: ColumnOrName, n: int, at=None) -> Column:
    """X >= as_of - n days; no upper bound."""
    return col(x) >= _as_of(at) - F.make_dt_interval(F.lit(n))


def in_past_hours(x: ColumnOrName, n: int, at=None) -> Column:
    """X >= as_of - n hours; no upper bound."""
    return col(x) >= _as_of(at) - F.make_dt_interval(F.lit(0), F.lit(n))


def week_start(t: Column) -> Column:
    return F.date_trunc("WEEK", t).cast("timestamp_ntz")


def month_start(t: Column) -> Column:
    return F.date_trunc("MONTH", t).cast("timestamp_ntz")


def in_calendar_week(x: ColumnOrName, at=None) -> Column:
    """Same Monday-based week as as_of.

    Written as a range on the raw column so parquet statistics can prune.
    """
    start = week_start(_as_of(at))
    return (col(x) >= start) & (col(x) < start + F.make_dt_interval(F.lit(7)))


def in_calendar_month(x: ColumnOrName, at=None) -> Column:
    """Same calendar month as as_of, as a range on x."""
    start = month_start(_as_of(at))
    return (col(x) >= start) & (col(x) < F.add_months(start, 1).cast("timestamp_ntz"))


# ---------------------------------------------------------------- aggregates

def count_all() -> Column:
    """E28."""
    return F.count(F.lit(1))


def count_if(cond: Column) -> Column:
    """Rows where cond is true (NULL is not true)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def avg(x: ColumnOrName) -> Column:
    return F.avg(col(x))


def stddev(x: ColumnOrName) -> Column:
    """Sample standard deviation."""
    return F.stddev_samp(col(x))


def count_distinct(x: ColumnOrName) -> Column:
    return F.count_distinct(col(x))


def distinct(df: DataFrame, *cols: ColumnOrName) -> DataFrame:
    """E33."""
    return df.select(*cols).distinct()


def approx_distinct(x: ColumnOrName, rsd: float = 0.05) -> Column:
    """HyperLogLog++ sketch; mergeable, partial before the shuffle."""
    return F.approx_count_distinct(col(x), rsd)


def percentile(x: ColumnOrName, p, exact: bool = False, accuracy: int = 10000) -> Column:
    """Approx by default (a mergeable sketch); exact = interpolating
    percentile, which keeps a value map per group (small data only, P7)."""
    ps = F.array(*[F.lit(float(v)) for v in p]) if isinstance(p, (list, tuple)) else F.lit(float(p))
    if exact:
        return F.percentile(col(x).cast("double"), ps)
    return F.percentile_approx(col(x).cast("double"), ps, accuracy)


def quantile_points(n: int) -> list[float]:
    return [i / n for i in range(n + 1)]


def quantiles(x: ColumnOrName, n: int, exact: bool = False) -> Column:
    """The n+1 cut points 0, 1/n, .., 1."""
    return percentile(x, quantile_points(n), exact=exact)


def any_value(x: ColumnOrName) -> Column:
    return F.any_value(col(x))


def max_time(x: ColumnOrName) -> Column:
    return F.max(col(x))


def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """NULL for a zero divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


# ---------------------------------------------------------------- ordering, sets, reshaping

def asc(x: ColumnOrName) -> Column:
    return col(x).asc_nulls_first()


def desc(x: ColumnOrName) -> Column:
    return col(x).desc_nulls_last()


def limit(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Capped preview; with an order it plans TakeOrderedAndProject."""
    return (df.orderBy(*order) if order else df).limit(n)


def sample_key(key: ColumnOrName, seed: str | int) -> Column:
    return F.md5(F.concat(col(key).cast("string"), F.lit(str(seed))))


def sample_rows(df: DataFrame, key: ColumnOrName, n: int, seed: str | int = 0) -> DataFrame:
    """Repeatable pseudo-random sample: order by md5(key || seed), take n.

    Independent of partitioning (unlike rand(seed)); a top-n per partition,
    never a full sort.
    """
    k = sample_key(key, seed)
    return df.orderBy(k, col(key)).limit(n)


def union(dfs: Iterable[DataFrame], distinct_rows: bool = False) -> DataFrame:
    """UNION ALL by name (UNION when distinct_rows)."""
    dfs = list(dfs)
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct() if distinct_rows else out


def values_table(spark: SparkSession, values: Sequence, name: str = "value",
                 dtype: T.DataType | None = None) -> DataFrame:
    """One-column table from a value list (semi/anti join side)."""
    dtype = dtype or (T.LongType() if all(isinstance(v, int) for v in values) else T.StringType())
    schema = T.StructType([T.StructField(name, dtype, True)])
    return spark.createDataFrame([(v,) for v in values], schema)


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "name",
            value: str = "value", drop_nulls: bool = False) -> DataFrame:
    """Columns to rows. Keeps NULL values unless drop_nulls (SQL UNPIVOT
    default drops them)."""
    out = df.unpivot(list(ids), list(cols), name, value)
    return out.where(F.col(value).isNotNull()) if drop_nulls else out


# ---------------------------------------------------------------- casts (ANSI-safe)

def to_numeric(x: ColumnOrName) -> Column:
    return col(x).try_cast("double")


def to_decimal(x: ColumnOrName) -> Column:
    return col(x).try_cast("decimal(38,10)")


def to_string(x: ColumnOrName) -> Column:
    return col(x).cast("string")


# --- fixed values: a zone behind a time of day, as ISO 8601 writes it ---
_ZONE_BEHIND = r"(?i):[0-9]{2}(\.[0-9]+)?\s*(Z|UTC|GMT|[+-][0-9]{2}(:?[0-9]{2})?)$"
_HOURS_BEHIND, _COLONLESS = r"([+-][0-9]{2})$", r"([+-][0-9]{2})([0-9]{2})$"


def string_to_ts(x: ColumnOrName) -> Column:
    """Text to timestamp (UTC wall time, NTZ); NULL on failure. A text
    with a zone is an instant and converted to UTC, one without is UTC wall
    time already; neither depends on the session's zone."""
    c = F.trim(col(x).cast("string"))
    full = F.regexp_replace(F.regexp_replace(c, _COLONLESS, "$1:$2"), r"(:[0-9]{2}(?:\.[0-9]+)?)\s*" + _HOURS_BEHIND, "$1$2:00")
    instant = full.try_cast("timestamp")
    utc = F.lit(EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(instant) / 1_000_000).cast("decimal(18,6)"))
    return F.when(c.rlike(_ZONE_BEHIND), utc).otherwise(c.try_cast("timestamp_ntz"))


def epoch_to_ts(x: ColumnOrName) -> Column:
    """Epoch seconds to TIMESTAMP_NTZ (UTC wall time), session-zone free;
    NULL for numbers that are no epoch seconds (milliseconds overflow)."""
    return (F.lit(EPOCH_NTZ).cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), col(x).try_cast("decimal(18,6)")))


def date_to_ts(x: ColumnOrName) -> Column:
    """Date to midnight."""
    return col(x).cast("timestamp_ntz")


def to_timestamp_any(x: ColumnOrName, dtype: T.DataType) -> Column:
    """Dispatch on the column's type; tolerant (NULL on failure)."""
    c = col(x)
    if isinstance(dtype, T.StringType):
        return string_to_ts(c)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.DoubleType,
                          T.FloatType, T.DecimalType)):
        return epoch_to_ts(c)
    if isinstance(dtype, T.DateType):
        return date_to_ts(c)
    if isinstance(dtype, T.TimestampType):
        return to_ntz(c)
    return c.cast("timestamp_ntz")


def to_date(x: ColumnOrName) -> Column:
    return F.to_date(col(x))


def to_ntz(x: ColumnOrName) -> Column:
    """Zone-less timestamp (a zoned value keeps its session-zone wall time)."""
    return col(x).cast("timestamp_ntz")


def to_ltz(x: ColumnOrName) -> Column:
    """Zone-aware timestamp (session zone)."""
    return col(x).cast("timestamp")


# ---------------------------------------------------------------- time

def to_utc(x: ColumnOrName, tz: str | None = None) -> Column:
    """To UTC wall time; with tz, x is read as wall time in tz, without
    it as a zoned value (or as wall time of the session zone)."""
    if tz is None:
        return F.convert_timezone(None, F.lit("UTC"), col(x).cast("timestamp_ntz"))
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), col(x).cast("timestamp_ntz"))


def from_zone(x: ColumnOrName, tz: str) -> Column:
    """Wall time in an IANA zone or fixed offset to UTC."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), col(x).cast("timestamp_ntz"))


def add_days(d: ColumnOrName, n) -> Column:
    """Date + n days."""
    return F.date_add(col(d), _v(n))


def add_days_ts(t: ColumnOrName, n: int) -> Column:
    return col(t) + F.make_dt_interval(F.lit(n))


def add_hours(t: ColumnOrName, n: int) -> Column:
    return col(t) + F.make_dt_interval(F.lit(0), F.lit(n))


_UNITS = {"second", "minute", "hour", "day", "week", "month", "quarter", "year"}


def trunc(t: ColumnOrName, unit: str) -> Column:
    """Truncate, keeping TIMESTAMP_NTZ (date_trunc returns TIMESTAMP)."""
    unit = unit.lower()
    if unit not in _UNITS:
        raise ValueError(f"unknown unit {unit!r}")
    return F.date_trunc(unit.upper(), col(t)).cast("timestamp_ntz")


def bucket(t: ColumnOrName, grain: str) -> Column:
    """Hour / day / week (Monday) / month / year bucket start."""
    return trunc(t, grain)


def epoch(t: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Epoch seconds. NTZ is read as UTC wall time, independent of the
    session zone; zoned timestamps are absolute."""
    c = col(t)
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(c)
    if isinstance(dtype, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long") * 86400
    return F.timestamp_diff("SECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), c.cast("timestamp_ntz"))


def date_diff(start: ColumnOrName, end: ColumnOrName, unit: str = "day") -> Column:
    """Unit boundaries crossed from start to end, sign end - start."""
    s, e = col(start).cast("timestamp_ntz"), col(end).cast("timestamp_ntz")
    u = unit.lower()
    if u == "day":
        return F.datediff(e, s).cast("long")
    if u == "week":
        return (F.datediff(trunc(e, "week"), trunc(s, "week")) / 7).cast("long")
    if u == "month":
        return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("long")
    if u == "quarter":
        return ((F.year(e) * 4 + F.quarter(e)) - (F.year(s) * 4 + F.quarter(s))).cast("long")
    if u == "year":
        return (F.year(e) - F.year(s)).cast("long")
    per = {"second": 1, "minute": 60, "hour": 3600}[u]
    return ((epoch(trunc(e, u)) - epoch(trunc(s, u))) / per).cast("long")


def day_of_week(t: ColumnOrName) -> Column:
    """0 = Sunday .. 6 = Saturday (P10)."""
    return F.dayofweek(col(t)) - 1


def lit_timestamp(v) -> Column:
    """TIMESTAMP_NTZ literal."""
    return as_of(v)


def lit_date(v) -> Column:
    return F.lit(v.isoformat() if isinstance(v, _dt.date) else str(v)).cast("date")


def lit_utc(v=None) -> Column:
    """UTC literal; no value means now."""
    return as_of(v)


def lit_time(v) -> Column:
    """Time-of-day literal as fixed-width 'HH:mm:ss' text.

    Spark 4.1 has a TIME type, but it is off unless the session enables
    ``spark.sql.timeType.enabled``; the text form compares the same way.
    """
    s = v.strftime("%H:%M:%S") if isinstance(v, _dt.time) else str(v)
    return F.lit(s)


def time_of_day(t: ColumnOrName) -> Column:
    """'HH:mm:ss' of a timestamp, comparable with ``lit_time``."""
    return F.date_format(col(t), "HH:mm:ss")


# ---------------------------------------------------------------- strings, math, arrays

def length(x: ColumnOrName) -> Column:
    return F.length(col(x))


def substr(x: ColumnOrName, start: int, n: int) -> Column:
    """1-based substring."""
    return F.substring(col(x), start, n)


def regex_match_count(x: ColumnOrName, regex: str, ci: bool = False) -> Column:
    """Matches of regex within one value."""
    return F.regexp_count(col(x), F.lit(("(?i)" if ci else "") + regex))


def regex_match_total(x: ColumnOrName, regex: str, ci: bool = False) -> Column:
    """Total number of matches over the group."""
    return F.sum(regex_match_count(x, regex, ci))


def regex_lit(pattern: str) -> str:
    """A regex constant is a plain string; no double escaping."""
    return pattern


def abs_(x: ColumnOrName) -> Column:
    return F.abs(col(x))


def nan() -> Column:
    return F.lit(float("nan"))


def array_lit(*values) -> Column:
    return F.array(*[_v(v) for v in values])


def array_length(x: ColumnOrName) -> Column:
    """NULL for a NULL array."""
    return F.array_size(col(x))


def lit(v) -> Column:
    """Typed constant (datetime values become NTZ)."""
    if isinstance(v, (_dt.datetime, _dt.date)) and not isinstance(v, Column):
        return lit_timestamp(v) if isinstance(v, _dt.datetime) else lit_date(v)
    return F.lit(v)


def is_null_keyword(x: ColumnOrName) -> Column:
    """upper(x) is one of the null keywords."""
    return F.upper(col(x)).isin(*NULL_KEYWORDS)
