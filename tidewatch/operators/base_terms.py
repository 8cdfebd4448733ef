"""Profiles from base terms (MON2).

Every metric of a profile is taken apart into terms that several metrics share:

* a condition on a value ("is zero", "looks like an email address") is one bit
  of a code that each value gets; rows are counted by column and code, and all
  counts, rates and "not X" counts are sums over the codes;
* means, deviations, extremes, sums, quantiles and distinct counts are
  aggregates of one number (a string counts with its length) and one hash per
  value.

Both work on the long form, one row per value with the place of its column, so
the number of aggregate expressions does not grow with the number of columns:
a table of any width takes two scans, and what is shuffled is one row per
column and code. Exact distinct counts and quantiles replace the sketches by
passes of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import exprs as E
from tidewatch.functions.metrics import NUMERIC, REGISTRY, RSD, STRING, Conditional, Ctx, kinds_of, metrics_for
from tidewatch.operators.quantiles import exact_quantiles

# metric -> the aggregate of the value that it is
VALUE_TERMS = {
    "numeric_mean": "mean", "text_mean_length": "mean", "numeric_stddev": "stddev", "text_std_length": "stddev",
    "text_min_length": "least", "text_max_length": "most", "sum": "total",
    "approx_distinct_count": "distinct", "approx_distinctness": "distinctness",
}


def _stem(metric: str) -> str:
    """The condition that a count, a rate and a "not" count have in common."""
    return metric.removesuffix("_count").removesuffix("_rate").replace("text_not_", "text_")


def _long(df: DataFrame, fields: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*fields)).alias("__v")).select("__v.*")


def _code(x: Column, conditions: dict[str, Conditional], ctx: Ctx) -> Column:
    """Bit 0: the value is NULL; bit i: the i-th condition holds."""
    bits = [x.isNull(), *(F.coalesce(c.condition(x, ctx), F.lit(False)) for c in conditions.values())]
    return reduce(lambda a, b: a + b, [F.when(b, F.lit(1 << i)).otherwise(F.lit(0)) for i, b in enumerate(bits)])


def _number(x: Column, dtype: T.DataType) -> Column:
    kinds = kinds_of(dtype)
    if NUMERIC in kinds:
        return x.cast("double")
    return F.length(x).cast("double") if STRING in kinds else F.lit(None).cast("double")


def _text(x: Column, dtype: T.DataType) -> Column:
    """A text that two values share just if they are the same."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        x = F.when(x == 0, F.lit(0).cast(dtype)).otherwise(x)       # the two zeros
    return F.hex(x) if isinstance(dtype, T.BinaryType) else x.cast("string")


def profile_terms(df: DataFrame, skip: Sequence[str] = (), as_of=None, exact: bool = False) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(column_name, metric, value) of all columns of ``df``, and the (column,
    metric) pairs that are no base terms: metrics registered with an aggregate
    of their own."""
    spark, at = df.sparkSession, E.as_of(as_of)
    conditions: list[dict[str, Conditional]] = []
    counted: list[tuple] = [(0, None, "row_count", "rows", 0)]
    valued: list[tuple] = []
    points: dict[str, list[float]] = {}
    rest: list[tuple[str, str]] = []
    for c, f in enumerate(df.schema.fields):
        own: dict[str, Conditional] = {}
        for name in metrics_for(f.dataType):
            m = REGISTRY[name]
            if name in skip:
                continue
            if isinstance(m.build, Conditional):
                own.setdefault(_stem(name), m.build)
                counted.append((c, f.name, name, m.build.how, 1 << 1 + list(own).index(_stem(name))))
            elif m.quantile is not None and not isinstance(m.quantile, tuple):
                points.setdefault(f.name, []).append(m.quantile)
                valued.append((c, f.name, name, "quantile", m.quantile))
            elif name in VALUE_TERMS:
                valued.append((c, f.name, name, VALUE_TERMS[name], None))
            else:
                rest.append((f.name, name))
        conditions.append(own)
    asked = sorted({p for ps in points.values() for p in ps})

    # scan 1: rows by column and code
    fields = [(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    codes = _long(df, [F.struct(F.lit(c).alias("c"), _code(x, conditions[c], Ctx(as_of=at, dtype=t)).alias("code"))
                       for c, (x, t) in enumerate(fields)]).groupBy("c", "code").agg(F.count("*").alias("n"))
    wanted = F.broadcast(spark.createDataFrame(counted, "c int, column_name string, metric string, how string, mask int"))
    hit = F.coalesce(F.sum(F.when(F.col("code").bitwiseAND(F.col("mask")) != 0, F.col("n"))), F.lit(0))
    filled = F.coalesce(F.sum(F.when(F.col("code").bitwiseAND(1) == 0, F.col("n"))), F.lit(0))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    # tables of metrics are lists built here; the join's other side is one row per column and code
    sums = wanted.join(codes, "c", "left").groupBy("column_name", "metric", "how").agg(hit.alias("hit"), filled.alias("filled"), rows.alias("rows"))
    counts = sums.select("column_name", "metric", F.expr(
        "CASE how WHEN 'rows' THEN rows WHEN 'count' THEN hit WHEN 'rest' THEN filled - hit ELSE try_divide(hit, rows) END").cast("double").alias("value"))

    # scan 2: aggregates of one number and one hash per value
    values = _long(df, [F.struct(
        F.lit(c).alias("c"), _number(x, t).alias("x"),
        (x.try_cast("decimal(38,10)") if NUMERIC in kinds_of(t) else F.lit(None).cast("decimal(38,10)")).alias("d"),
        F.when(x.isNotNull(), F.xxhash64(_text(x, t))).alias("h")) for c, (x, t) in enumerate(fields)])
    sketch = [] if exact or not asked else [F.percentile_approx("x", F.array(*map(F.lit, asked)), F.lit(10000)).alias("quantiles")]
    terms = values.groupBy("c").agg(
        F.avg("x").alias("mean"), F.stddev_samp("x").alias("stddev"), F.min("x").alias("least"), F.max("x").alias("most"),
        F.try_sum("d").cast("double").alias("total"), F.count("h").alias("filled"),
        *([] if exact else [F.approx_count_distinct("h", RSD).alias("distinct")]), *sketch)
    if exact:
        terms = _with_exact(df, terms, fields, points, asked)
    terms = terms.withColumn("distinctness", F.try_divide(F.col("distinct").cast("double"), F.col("filled").cast("double")))
    wanted = F.broadcast(spark.createDataFrame(valued, "c int, column_name string, metric string, term string, point double"))
    quantile = F.get("quantiles", F.array_position(F.array(*map(F.lit, asked)), F.col("point")).cast("int") - 1) if asked else F.lit(None)
    plain = [F.when(F.col("term") == t, F.col(t).cast("double")) for t in ("mean", "stddev", "least", "most", "total", "distinctness")]
    value = F.coalesce(*plain, F.when(F.col("term") == "distinct", F.coalesce("distinct", F.lit(0)).cast("double")),
                       F.when(F.col("term") == "quantile", quantile))
    return counts.unionByName(wanted.join(terms, "c", "left").select("column_name", "metric", value.alias("value"))), rest


def _with_exact(df: DataFrame, terms: DataFrame, fields: list[tuple], points: dict[str, list[float]], asked: list[float]) -> DataFrame:
    """``terms`` with exact distinct counts and, for numeric columns, exact
    quantiles at all the points asked for."""
    texts = _long(df, [F.struct(F.lit(c).alias("c"), _text(x, t).alias("s")) for c, (x, t) in enumerate(fields)])
    distinct = texts.where("s IS NOT NULL").distinct().groupBy("c").agg(F.count("*").alias("distinct"))
    out = terms.join(distinct, "c", "left").withColumn("distinct", F.coalesce("distinct", F.lit(0)))
    if not points:
        return out.withColumn("quantiles", F.lit(None).cast("array<double>"))
    one = exact_quantiles(df.select(*[F.col(f"`{n}`") for n in points]), {n: asked for n in points})
    cells = [F.struct(F.lit(df.columns.index(n)).alias("c"), F.col(f"`{n}`").alias("quantiles")) for n in points]
    return out.join(_long(one, cells), "c", "left")
