"""Exact quantiles by distributed selection.

No group is ever sorted or kept whole. A mergeable sketch brackets every
quantile asked for between two values (its rank error is bounded), one
aggregation counts the values below and within each bracket, brackets that
still hold too much are narrowed by a sketch of what lies within them, and only
the values left in the brackets are counted one by one and cumulated. Each step
is an aggregation that combines within the map tasks, so a group that holds all
rows costs every task the same; what is shuffled is one row per group and
column, and at the end at most ``WITHIN`` distinct values per bracket.

The brackets are written between steps: their size is then known to the
planner, which broadcasts them only if they are small and joins on the group
keys otherwise. A bracket is checked against the exact counts before it is
used; one that missed its rank is opened to the group's whole range, so the
result never hangs on the sketch.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

ACCURACY = 10_000           # rank error of a sketch: 1 / ACCURACY of its rows
WITHIN = 500_000            # distinct values of a bracket that one task may cumulate
ROUNDS = 40                 # each leaves a few hundredths of a bracket; three are many
GRID = [i / 200 for i in range(201)]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__r{i}"]) for i, k in enumerate(keys)], left["__c"] == right["__rc"])


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__r{i}" for i, k in enumerate(keys)} | {"__c": "__rc"})


def exact_quantiles(df: DataFrame, asked: dict[str, list[float]], keys: list[str] | None = None, within: int = WITHIN) -> DataFrame:
    """One row per group of ``keys`` that has rows: the keys and, for each
    column of ``asked``, an array of its quantiles at the given points, with
    linear interpolation between neighbours. NULLs do not count, NaN is the
    greatest value; a group without values has NULLs."""
    names, given = list(asked), list(keys or [])
    # keys under names of our own, so that they may be called like anything here
    keys = [f"__k{i}" for i in range(len(given))]
    df = df.select(*[F.col(f"`{k}`").alias(own) for k, own in zip(given, keys)], *[F.col(f"`{c}`") for c in names])
    points = sorted({p for ps in asked.values() for p in ps})
    if any(not 0 <= p <= 1 for p in points):
        raise ValueError("quantile points lie between 0 and 1")
    groups = df.select(*keys).distinct() if keys else None
    # long form: one row per value, with the place of its column in the list
    values = F.filter(F.array(*[F.struct(F.lit(i).alias("__c"), F.col(f"`{c}`").cast("double").alias("__x")) for i, c in enumerate(names)]),
                      lambda v: v["__x"].isNotNull())
    long = df.select(*keys, F.explode(values).alias("__v")).select(*keys, "__v.__c", "__v.__x")
    by = [*keys, "__c"]

    # 1. brackets from the sketch; a small group is one bracket by itself
    slack = 2 / ACCURACY
    edges = [x for p in points for x in (max(0.0, p - slack), min(1.0, p + slack))]
    first = long.groupBy(*by).agg(F.count("__x").alias("n"), F.min("__x").alias("lo"), F.max("__x").alias("hi"),
                                  F.percentile_approx("__x", F.array(*map(F.lit, edges)), F.lit(ACCURACY)).alias("s"))
    few = F.col("n") <= F.lit(within)
    los = F.array(*[F.when(few | F.lit(edges[2 * i] <= 0), F.col("lo")).otherwise(F.element_at("s", 2 * i + 1)) for i in range(len(points))])
    his = F.array(*[F.when(few | F.lit(edges[2 * i + 1] >= 1), F.col("hi")).otherwise(F.element_at("s", 2 * i + 2)) for i in range(len(points))])
    state = _written(first.select(*by, "n", "lo", "hi", los.alias("los"), his.alias("his")), "quantile-brackets")

    # 2. exact counts; narrowing until no bracket holds too much between its ends
    for _ in range(ROUNDS):
        state = _checked(_written(_counted(long, state, keys, len(points)), "quantile-counts"), points)
        left = state.agg(F.bool_or("missed"), F.max(F.array_max("core"))).first()
        if not left[0] and (left[1] or 0) <= within:
            break
        state = _narrowed(long, state, keys, points, within)
    else:
        raise RuntimeError(f"the brackets did not settle in {ROUNDS} rounds")

    # 3. the values within the brackets, cumulated; ranks k and k + 1 of each point
    brackets = F.zip_with("los", "his", lambda a, b: F.struct(a, b))
    slots = F.sequence(F.lit(1), F.size("los"))
    # the first of the brackets that equal this one: they share their values
    homes = F.transform(slots, lambda i: F.array_position(brackets, F.element_at(brackets, i.cast("int"))).cast("int"))
    state = state.withColumn("homes", homes)       # once per group, not per value
    side = _renamed(state.select(*by, "los", "his", "homes"), keys)
    home = lambda i: F.element_at("homes", i.cast("int"))
    places = F.filter(slots, lambda i: (F.col("__x") >= F.element_at("los", i)) & (F.col("__x") <= F.element_at("his", i)) & (home(i) == i))
    met = (long.join(side, _same(long, side, keys)).select(*by, "__x", F.explode(places).alias("slot"))
           .groupBy(*by, "slot", "__x").agg(F.count("*").alias("m")))
    w = Window.partitionBy(*by, "slot").orderBy("__x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = met.withColumn("upto", F.sum("m").over(w))
    back = _renamed(state.select(*by, "n", "los", "below", "homes"), keys)
    # points whose bracket this slot is, with the two ranks that each needs
    own = F.filter(slots, lambda i: home(i) == F.col("slot"))
    ps = F.array(*map(F.lit, points))
    wanted = F.transform(own, lambda i: F.struct(
        i.alias("i"), F.floor(F.element_at(ps, i) * (F.col("n") - 1)).alias("k"),
        (F.element_at(ps, i) * (F.col("n") - 1)).alias("h")))
    # of a slot's values only those at a rank that is asked for go on
    met_by = lambda k: (F.col("begin") <= k + 1) & (F.col("last") >= k)
    joined = (ranked.join(back, _same(ranked, back, keys)).withColumn("at", F.element_at("below", F.col("slot")))
              .withColumn("last", F.col("at") + F.col("upto") - 1).withColumn("begin", F.col("at") + F.col("upto") - F.col("m"))
              .withColumn("want", F.explode(F.filter(wanted, lambda w: met_by(w["k"])))))
    k = F.col("want.k")
    low = F.max(F.when((F.col("begin") <= k) & (F.col("last") >= k), F.col("__x")))
    up = F.least(k + 1, F.col("n") - 1)
    high = F.max(F.when((F.col("begin") <= up) & (F.col("last") >= up), F.col("__x")))
    share = F.max(F.col("want.h") - k)
    found = joined.groupBy(*by, F.col("want.i").alias("i")).agg(low.alias("a"), high.alias("b"), share.alias("f"))
    value = F.when(F.col("f") == 0, F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("f"))
    cells = found.select(*by, "i", value.alias("q"))
    wide = []
    for c, name in enumerate(names):
        cell = [F.max(F.when((F.col("__c") == c) & (F.col("i") == points.index(p) + 1), F.col("q"))) for p in asked[name]]
        wide.append(F.when(F.count(F.when(F.col("__c") == c, 1)) > 0, F.array(*cell)).alias(name))
    out = cells.groupBy(*keys).agg(*wide) if keys else cells.agg(*wide)
    if groups is None:
        return out
    right = out.withColumnsRenamed({k: f"__r{i}" for i, k in enumerate(keys)})
    cond = reduce(lambda a, b: a & b, [groups[k].eqNullSafe(right[f"__r{i}"]) for i, k in enumerate(keys)])
    return groups.join(right, cond, "left").select(*[F.col(own).alias(k) for k, own in zip(given, keys)], *[F.col(f"`{c}`") for c in names])


def _counted(long: DataFrame, state: DataFrame, keys: list[str], slots: int) -> DataFrame:
    """``state`` with the number of values of each bracket: below it, at its
    lower end (ties), strictly between its ends (core), and in all (inside)."""
    by = [*keys, "__c"]
    side = _renamed(state.select(*by, "los", "his"), keys)
    x = F.col("__x")
    kinds = {"below": lambda a, b: x < a, "ties": lambda a, b: x == a, "core": lambda a, b: (x > a) & (x < b),
             "inside": lambda a, b: (x >= a) & (x <= b)}
    sums = [F.count_if(test(F.element_at("los", i + 1), F.element_at("his", i + 1))).alias(f"{kind}{i}")
            for kind, test in kinds.items() for i in range(slots)]
    counts = _renamed(long.join(side, _same(long, side, keys)).groupBy(*by).agg(*sums), keys)
    return state.join(counts, _same(state, counts, keys)).select(
        *by, "n", "lo", "hi", "los", "his", *[F.array(*[f"{kind}{i}" for i in range(slots)]).alias(kind) for kind in kinds])


def _checked(state: DataFrame, points: list[float]) -> DataFrame:
    """Brackets that miss a rank of their point, opened to the whole range."""
    holds = []
    for i, p in enumerate(points):
        k = F.floor(F.lit(p) * (F.col("n") - 1))
        end = F.element_at("below", i + 1) + F.element_at("inside", i + 1)
        holds.append((F.element_at("below", i + 1) <= k) & (end > F.least(k + 1, F.col("n") - 1)))
    ends = {ends: F.array(*[F.when(h, F.element_at(ends, i + 1)).otherwise(F.col(whole)) for i, h in enumerate(holds)])
            for ends, whole in (("los", "lo"), ("his", "hi"))}
    return state.withColumns(ends | {"missed": ~reduce(lambda a, b: a & b, holds)})


def _narrowed(long: DataFrame, state: DataFrame, keys: list[str], points: list[float], within: int) -> DataFrame:
    """Brackets that hold more than ``within`` values between their ends, cut
    to the cells of a grid of these values' quantiles in which the rank asked
    for and the next one lie; an end stays where the rank is near it."""
    by = [*keys, "__c"]
    side = _renamed(state.where("NOT missed").select(*by, "los", "his", "core"), keys)
    large = F.filter(F.sequence(F.lit(1), F.size("los")), lambda i: (F.element_at("core", i) > F.lit(within))
                     & (F.col("__x") > F.element_at("los", i)) & (F.col("__x") < F.element_at("his", i)))
    grid = (long.join(side, _same(long, side, keys)).select(*by, "__x", F.explode(large).alias("slot"))
            .groupBy(*by, "slot").agg(F.percentile_approx("__x", F.array(*map(F.lit, GRID)), F.lit(ACCURACY)).alias("g")))
    grids = _renamed(grid.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("slot", "g"))).alias("grids")), keys)
    met = state.join(grids, _same(state, grids, keys), "left")
    los, his = [], []
    for i, p in enumerate(points):
        at = F.lit(i + 1)
        g = F.element_at("grids", at)
        rank = F.floor(F.lit(p) * (F.col("n") - 1)) - F.element_at("below", at) - F.element_at("ties", at)
        core = F.element_at("core", at).cast("double")
        cell = F.floor(F.try_divide(((len(GRID) - 1) * rank).cast("double"), core)).cast("int")
        # cells that cover the sketch's error twice, and two ranks
        room = F.lit(1 + ceil(2 * len(GRID) / ACCURACY)) + F.ceil(F.try_divide(F.lit(2.0 * len(GRID)), core)).cast("int")
        low, high = cell - room, F.greatest(cell, F.lit(0)) + 1 + room
        los.append(F.when(g.isNotNull() & (low >= 0), F.get(g, low)).otherwise(F.element_at("los", at)))
        his.append(F.when(g.isNotNull() & (high < len(GRID)), F.get(g, high)).otherwise(F.element_at("his", at)))
    return _written(met.select(*by, "n", "lo", "hi", F.array(*los).alias("los"), F.array(*his).alias("his")), "quantile-brackets")
