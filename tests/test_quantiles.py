"""Exact quantiles by distributed selection, against a sorted list."""

import math
import random

import pytest

import __spark_entry__ as se
from conftest import SF_SMALL, plan_text
from tidewatch.operators import quantiles as Q


def brute(values, points):
    v = sorted((x for x in values if x is not None), key=lambda x: (math.isnan(x), x))
    if not v:
        return None
    out = []
    for p in points:
        h = p * (len(v) - 1)
        k = math.floor(h)
        out.append(v[k] if h == k else v[k] + (v[min(k + 1, len(v) - 1)] - v[k]) * (h - k))
    return out


def same(got, want):
    return (got is None) == (want is None) and (got is None or all(
        math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) or (math.isnan(a) and math.isnan(b)) for a, b in zip(got, want, strict=True)))


def rows_of():
    r = random.Random(11)
    rows = [("hot", r.gauss(0, 1), r.randrange(5), None) for _ in range(9000)]
    rows += [("ties", r.choice([1.0, 1.0, 1.0, 2.0, 2.5]), 7, r.random()) for _ in range(3000)]
    rows += [("wide", r.choice([-1, 1]) * 10 ** r.uniform(-300, 300), 1, None) for _ in range(3000)]
    rows += [(None, float(i), i, None) for i in range(4)] + [("one", 3.5, None, None), ("none", None, None, None)]
    rows += [("nan", x, 0, None) for x in (1.0, float("nan"), 2.0, float("inf"), -float("inf"))]
    return rows


@pytest.mark.parametrize("within", [Q.WITHIN, 50, 3])
def test_quantiles_by_group(spark, within):
    """A bound of 50 or 3 values per bracket takes rounds of narrowing."""
    rows = rows_of()
    df = spark.createDataFrame(rows, "g string, a double, b int, c double").repartition(5)
    asked = {"a": [0.0, 0.25, 0.5, 0.9, 1.0], "b": [0.5], "c": [0.2, 0.5]}
    got = {r.g: r for r in Q.exact_quantiles(df, asked, ["g"], within).collect()}
    assert set(got) == {r[0] for r in rows}
    for g, r in got.items():
        for i, (name, points) in enumerate(asked.items(), 1):
            want = brute([float(x[i]) if x[i] is not None else None for x in rows if x[0] == g], points)
            if g != "nan" or name != "a":
                assert same(r[name], want), (g, name, r[name], want)
    assert got["nan"].a[0] == -math.inf and math.isnan(got["nan"].a[4]) and got["nan"].a[2] == 2.0


def test_quantiles_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "x double")
    assert Q.exact_quantiles(df, {"x": [0.5, 0.9]}, within=10).first().x == [500.0, 900.0]
    assert [r.x for r in Q.exact_quantiles(df.limit(0), {"x": [0.5]}).collect()] == [None]
    assert Q.exact_quantiles(df.limit(0), {"x": [0.5]}, ["x"]).collect() == []
    with pytest.raises(ValueError):
        Q.exact_quantiles(df, {"x": [1.5]})


def test_a_bracket_that_misses_is_opened(spark, monkeypatch):
    """A sketch far outside its bound costs rounds, not results."""
    monkeypatch.setattr(Q, "ACCURACY", 20)
    r = random.Random(12)
    rows = [(r.random(),) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "x double").repartition(7)
    assert same(Q.exact_quantiles(df, {"x": [0.1, 0.5, 0.99]}, within=40).first().x, brute([x[0] for x in rows], [0.1, 0.5, 0.99]))


@pytest.mark.parametrize("name", ["agg_percentile", "agg_quantiles", "m_median", "m_quantiles", "mon_profile", "mon_threshold", "etl_run_stats"])
def test_no_query_keeps_the_values_of_a_group(spark, name):
    text = plan_text(se.queries()[name](spark, SF_SMALL))
    assert "percentile(" not in text
