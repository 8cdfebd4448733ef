"""Metric registry.

A metric is a named Column builder over one column of a group. All metrics of
a table are evaluated in one aggregation (see ``operators.monitors``); the
builders only return native aggregate expressions, so partial aggregation runs
before the shuffle and no Python runs per row.

Metrics that share a sketch (all percentiles of one column) declare a
``quantile`` so the monitor computes one percentile array per column instead
of one sketch per metric.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import exprs as E
from tidewatch.functions.patterns import CASE_INSENSITIVE, PATTERNS

# column kinds a metric can apply to
NUMERIC, FLOAT, STRING, BOOLEAN, TIMESTAMP, ARRAY, ANY = (
    "numeric", "float", "string", "boolean", "timestamp", "array", "any")


def kinds_of(dtype: T.DataType) -> frozenset[str]:
    """Kinds of a Spark type (a double is numeric and float)."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return frozenset({NUMERIC, FLOAT, ANY})
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return frozenset({NUMERIC, ANY})
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return frozenset({STRING, ANY})
    if isinstance(dtype, T.BooleanType):
        return frozenset({BOOLEAN, ANY})
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return frozenset({TIMESTAMP, ANY})
    if isinstance(dtype, T.ArrayType):
        return frozenset({ARRAY, ANY})
    return frozenset({ANY})


@dataclass
class Ctx:
    """Evaluation context of one monitor run."""
    as_of: Column
    exact: bool = False
    dtype: T.DataType | None = None
    rows: Column = field(default_factory=lambda: F.count(F.lit(1)))


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str                      # column kind it needs; None column for row metrics
    build: Callable[[Column, Ctx], Column] | None = None
    quantile: float | tuple | None = None   # percentile metrics share one sketch
    distinct: bool = False          # exact distinct count (planned separately)
    post: bool = False              # computed after aggregation (row_count_change)
    needs_column: bool = True


REGISTRY: dict[str, Metric] = {}

# relative standard deviation of the distinct-count sketch (Spark's default:
# HyperLogLog++ with 2^10 registers, mergeable, partial before the shuffle)
RSD = 0.05


def register_metric(name: str, kind: str, build=None, **kw) -> Metric:
    """Add a metric. ``build(x, ctx) -> Column`` must return an aggregate."""
    m = Metric(name, kind, build, **kw)
    REGISTRY[name] = m
    return m


def rate(count: Column, ctx: Ctx) -> Column:
    """count / rows, NULL for zero rows, capped at 1.0."""
    r = F.try_divide(count.cast("double"), ctx.rows.cast("double"))
    return F.when(r > 1.0, F.lit(1.0)).otherwise(r)      # least() would turn NULL into 1.0


@dataclass(frozen=True)
class Conditional:
    """A metric that counts the values for which a condition holds: how many
    ("count"), their share of the rows ("rate"), or the other non-NULL values
    ("rest"). Called, it is the aggregate; profiles read the condition."""
    how: str
    condition: Callable[[Column, Ctx], Column]

    def __call__(self, x: Column, c: Ctx) -> Column:
        n = E.count_if(self.condition(x, c))
        if self.how == "rest":       # shares the condition's aggregate
            return F.count(x) - n
        return rate(n, c) if self.how == "rate" else n


def _cnt(pred: Callable[[Column, Ctx], Column]):
    return Conditional("count", pred)


def _rt(pred: Callable[[Column, Ctx], Column]):
    return Conditional("rate", pred)


def _not_count(pred: Callable[[Column, Ctx], Column]):
    return Conditional("rest", pred)


def _epoch(x: Column, c: Ctx) -> Column:
    return E.epoch(x, c.dtype)


# ---- row metrics
register_metric("row_count", ANY, lambda x, c: c.rows, needs_column=False)
register_metric("row_count_change", ANY, None, post=True, needs_column=False)

# ---- numeric
register_metric("numeric_mean", NUMERIC, lambda x, c: F.avg(x.cast("double")))
register_metric("numeric_stddev", NUMERIC, lambda x, c: F.stddev_samp(x.cast("double")))
register_metric("numeric_median", NUMERIC, quantile=0.5)
for _p in (20, 40, 60, 80):
    register_metric(f"percentile_{_p}", NUMERIC, quantile=_p / 100)
register_metric("approx_quantiles", NUMERIC, quantile=tuple(E.quantile_points(5)))
for _i, _q in enumerate(E.quantile_points(5)):
    register_metric(f"approx_quantiles{_i}", NUMERIC, quantile=_q)
register_metric("sum", NUMERIC, lambda x, c: F.try_sum(x.try_cast("decimal(38,10)")))
register_metric("approx_distinct_count", ANY,
                lambda x, c: F.approx_count_distinct(x, RSD).cast("long"), distinct=True)
register_metric("approx_distinctness", ANY,
                lambda x, c: F.try_divide(F.approx_count_distinct(x, RSD).cast("double"),
                                          F.count(x).cast("double")), distinct=True)
register_metric("zero_count", NUMERIC, _cnt(lambda x, c: x == 0))
register_metric("zero_rate", NUMERIC, _rt(lambda x, c: x == 0))
register_metric("negative_count", NUMERIC, _cnt(lambda x, c: x < 0))
register_metric("negative_rate", NUMERIC, _rt(lambda x, c: x < 0))
register_metric("nan_count", FLOAT, _cnt(lambda x, c: F.isnan(x)))
register_metric("nan_rate", FLOAT, _rt(lambda x, c: F.isnan(x)))

# ---- boolean
register_metric("true_count", BOOLEAN, _cnt(lambda x, c: x))
register_metric("true_rate", BOOLEAN, _rt(lambda x, c: x))
register_metric("false_count", BOOLEAN, _cnt(lambda x, c: ~x))
register_metric("false_rate", BOOLEAN, _rt(lambda x, c: ~x))

# ---- array
register_metric("array_null_rate", ARRAY,
                _rt(lambda x, c: x.isNull() | (F.array_size(x) == 0)))

# ---- timestamp
register_metric("past_timestamp_count", TIMESTAMP,
                _cnt(lambda x, c: _epoch(x, c) < E.epoch(c.as_of)))
register_metric("past_timestamp_rate", TIMESTAMP,
                _rt(lambda x, c: _epoch(x, c) < E.epoch(c.as_of)))
register_metric("future_timestamp_count", TIMESTAMP,
                _cnt(lambda x, c: _epoch(x, c) > E.epoch(c.as_of)))
register_metric("future_timestamp_rate", TIMESTAMP,
                _rt(lambda x, c: _epoch(x, c) > E.epoch(c.as_of)))
register_metric("unix_zero_count", TIMESTAMP, _cnt(lambda x, c: _epoch(x, c) == 0))
register_metric("unix_zero_rate", TIMESTAMP, _rt(lambda x, c: _epoch(x, c) == 0))

# ---- text
register_metric("text_mean_length", STRING, lambda x, c: F.avg(F.length(x).cast("double")))
register_metric("text_min_length", STRING, lambda x, c: F.min(F.length(x)))
register_metric("text_max_length", STRING, lambda x, c: F.max(F.length(x)))
register_metric("text_std_length", STRING, lambda x, c: F.stddev_samp(F.length(x).cast("double")))
register_metric("empty_string_count", STRING, _cnt(lambda x, c: x == ""))
register_metric("empty_string_rate", STRING, _rt(lambda x, c: x == ""))
register_metric("text_timestamp_count", STRING, _cnt(lambda x, c: E.is_timestamp(x)))
register_metric("text_timestamp_rate", STRING, _rt(lambda x, c: E.is_timestamp(x)))
register_metric("text_not_timestamp_count", STRING, _not_count(lambda x, c: E.is_timestamp(x)))
register_metric("text_null_keyword_count", STRING, _cnt(lambda x, c: E.is_null_keyword(x)))
register_metric("text_null_keyword_rate", STRING, _rt(lambda x, c: E.is_null_keyword(x)))


def _match(name: str):
    return lambda x, c: E.matches(x, PATTERNS[name], name in CASE_INSENSITIVE)


for _name in ("int", "number", "uuid", "email_address", "us_state_code", "us_zip_code",
              "us_phone", "ssn"):
    register_metric(f"text_{_name}_count", STRING, _cnt(_match(_name)))
    register_metric(f"text_not_{_name}_count", STRING, _not_count(_match(_name)))
    register_metric(f"text_{_name}_rate", STRING, _rt(_match(_name)))
register_metric("text_all_spaces_count", STRING, _cnt(_match("all_spaces")))
register_metric("text_all_spaces_rate", STRING, _rt(_match("all_spaces")))


def metrics_for(dtype: T.DataType) -> list[str]:
    """Column metrics that apply to a type (MON3)."""
    ks = kinds_of(dtype)
    return [m.name for m in REGISTRY.values() if m.needs_column and m.kind in ks]


def kind_table() -> list[tuple[str, str]]:
    """(kind, metric) pairs of the registry, in registry order."""
    return [(m.kind, m.name) for m in REGISTRY.values() if m.needs_column]
