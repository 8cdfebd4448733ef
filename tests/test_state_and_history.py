"""Metric state that merges, snapshot histories, row differences, file statistics and found segments."""

import datetime as dt
import math
import os
import random
import statistics
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from tidewatch.operators import history as H
from tidewatch.operators import monitors as M
from tidewatch.operators import sketches as SK
from tidewatch.operators.diffs import row_diff
from tidewatch.session import read_table, scratch_path
from tidewatch.sources import catalog as C

DAY = dt.datetime(2024, 1, 1)


def test_state_merged_from_days_equals_the_whole(spark):
    r = random.Random(1)
    rows = [(DAY + dt.timedelta(hours=r.randrange(60 * 24)), r.choice("ab"), None if r.random() < 0.1 else r.gauss(1e6, 3), r.choice("xyz"))
            for _ in range(4000)] + [(DAY, "c", None, None)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, seg string, v double, w string")
    days = SK.metric_state(df, "t", ["v", "w"], "ts", "day", ["seg"], {"high": F.col("v") > 1e6})
    for grain, segments in (("month", ["seg"]), (None, [])):
        got = SK.state_metrics(SK.merge_state(days, grain, segments, 1), conditions=["high"]).collect()
        for m in got:
            of = [x for x in rows if (grain is None or x[0].month == m.bucket_start.month) and (not segments or x[1] == m.seg)]
            v = sorted(x[2] for x in of if x[2] is not None)
            assert m.row_count == len(of) and m.high == sum(x > 1e6 for x in v)
            if m.column_name == "w":
                assert m.approx_distinct_count == len({x[3] for x in of} - {None}) and m.numeric_median is None
            elif v:
                assert math.isclose(m.numeric_mean, statistics.fmean(v)) and math.isclose(m.numeric_stddev, statistics.stdev(v), rel_tol=1e-6)
                rank = sum(x <= m.numeric_median for x in v) / len(v)
                assert abs(rank - 0.5) <= SK.RANK_ERROR + 1 / len(v)
            else:
                assert m.numeric_mean is None and m.numeric_median is None and m.approx_distinct_count == 0


def _snapshots():
    """Days on which tables have columns with types; a table goes and comes back."""
    r = random.Random(2)
    out = {}
    for day in range(12):
        out[day] = {(t, c): r.choice(["int", "int", "int", "string"]) for t in "pqr" for c in "uvw"
                    if r.random() < 0.9 and not (t == "q" and 4 <= day < 7)}
    return out


def _rows(day, state):
    return [(DAY + dt.timedelta(days=day), t, c, kind) for (t, c), kind in state.items()]


def test_history_folded_and_merged(spark):
    ddl, keys, values = "snapshot_time timestamp_ntz, t string, c string, kind string", ["t", "c"], ["kind"]
    snaps = _snapshots()
    df = spark.createDataFrame([x for d, s in snaps.items() for x in _rows(d, s)], ddl)
    folded = H.intervals(df, keys, values)
    stored = H.SnapshotHistory(scratch_path(spark, "t-history"), keys, values)
    for day, state in list(snaps.items())[:6] + [(5, snaps[5])]:          # the last one is added twice
        stored.add(spark.createDataFrame(_rows(day, state), ddl), DAY + dt.timedelta(days=day))
    early = H.intervals(df.where(F.col("snapshot_time") <= F.lit(DAY + dt.timedelta(days=5)).cast("timestamp_ntz")), keys, values)
    order = lambda x: sorted(map(repr, map(tuple, x.select("t", "c", "kind", "valid_from", "valid_to").collect())))
    assert order(stored.history(spark)) == order(early)
    for day in (0, 3, 5, 8, 11):
        at = DAY + dt.timedelta(days=day, hours=7)
        assert {(r.t, r.c): r.kind for r in H.as_of(folded, at).collect()} == snaps[day]


def test_asof_join(spark):
    snaps, r = _snapshots(), random.Random(3)
    ddl = "snapshot_time timestamp_ntz, t string, c string, kind string"
    history = H.intervals(spark.createDataFrame([x for d, s in snaps.items() for x in _rows(d, s)], ddl), ["t", "c"], ["kind"])
    events = [(i, r.choice("pqrz"), r.choice("uvw"), DAY + dt.timedelta(hours=r.randrange(-30, 300), minutes=r.choice([0, 1]))) for i in range(500)]
    events += [(500 + d, "p", "u", DAY + dt.timedelta(days=d)) for d in range(12)]         # at the very time of a change
    got = H.asof_join(spark.createDataFrame(events, "i int, t string, c string, at timestamp_ntz"), history, ["t", "c"], "at", ["kind"])
    assert got.columns == ["i", "t", "c", "at", "kind"]
    want = {i: snaps.get(min(11, (at - DAY).days), {}).get((t, c)) if at >= DAY else None for i, t, c, at in events}
    assert {x.i: x.kind for x in got.collect()} == want


def test_row_diff(spark):
    r = random.Random(4)
    left = [(i, r.choice("abc"), None if r.random() < 0.2 else r.random()) for i in range(3000)]
    right = [x if x[0] % 41 else (x[0], "z", x[2]) for x in left if x[0] % 53] + [(5000, "n", 1.0)]
    ddl = "k long, a string, b double"
    left, right = left + [(9000, "twice", 1.0)] * 2 + [(None, "no key", 2.0)], right + [(9000, "twice", 1.0), (None, "no key", 2.0)]
    got = {x.k: (x.change, x.left_rows, x.right_rows, x.columns) for x in row_diff(
        spark.createDataFrame(left, ddl).repartition(3), spark.createDataFrame(right, ddl).repartition(5), ["k"], ["a", "b"]).collect()}
    want = {i: ("missing", 1, 0, None) for i in range(0, 3000, 53)}
    want |= {i: ("changed", 1, 1, ["a"]) for i in range(0, 3000, 41) if i % 53} | {5000: ("extra", 0, 1, None), 9000: ("missing", 1, 0, None)}
    assert got == want
    same = spark.createDataFrame(left, ddl)
    assert row_diff(same, same.repartition(7), ["k"], ["a", "b"]).count() == 0


def test_file_stats_in_one_scan(spark):
    base = scratch_path(spark, "t-files")
    spark.range(10).repartition(3).write.parquet(f"{base}/a b/plain")
    spark.range(20).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{base}/parts")
    where = {"plain": f"{base}/a b/plain", "parts": f"{base}/parts", "none": f"{base}/not-there", "orders": f"{SF_SMALL}/orders.parquet"}
    df = C.file_stats(spark, where)
    got = {r.table_id: r for r in df.collect()}
    assert plan_text(df).count("Scan parquet") <= 2      # initial and final form of one scan
    files = lambda p: [os.path.join(d, f) for d, _, fs in os.walk(p.removeprefix("file:")) for f in fs if f.endswith(".parquet")]
    for name in ("plain", "parts"):
        mine = files(where[name])
        assert (got[name].byte_count, got[name].n_files) == (sum(map(os.path.getsize, mine)), len(mine))
        newest = max(map(os.path.getmtime, mine))
        assert abs((got[name].last_update_time - dt.datetime(1970, 1, 1)).total_seconds() - newest) < 1
    assert (got["plain"].row_count, got["parts"].row_count, got["none"].row_count, got["none"].byte_count) == (10, 20, 0, 0)
    assert got["orders"].byte_count == os.path.getsize(f"{SF_SMALL}/orders.parquet") and got["none"].last_update_time is None


def test_rca_search_against_all_combinations(spark):
    r = random.Random(5)
    rows = [(r.choice(["x", "y", None]), r.choice([1, 2, 3]), r.choice("pqrst")) for _ in range(3000)]
    rows = [(*x, r.random() < (0.6 if x[1] == 2 and x[2] == "p" else 0.1)) for x in rows]
    df = spark.createDataFrame(rows, "a string, b int, c string, bad boolean")
    got = {x.segment: x for x in M.rca_search(df, F.col("bad"), ["a", "b", "c"], min_share=0.05).collect()}
    text = lambda n, v: f"{n}={'NULL' if v is None else v}"
    groups = {}
    for x in rows:
        items = [text(n, v) for n, v in zip("abc", x)]
        for k in range(4):
            for part in combinations(items, k):
                n, bad = groups.get(part, (0, 0))
                groups[part] = (n + 1, bad + x[3])
    large = {p: b / n for p, (n, b) in groups.items() if n >= 0.05 * len(rows)}
    assert set(got) == {", ".join(p) for p in large if p}
    for p, rate in large.items():
        if p:
            above = max(large[p[:i] + p[i + 1 :]] for i in range(len(p)))
            x = got[", ".join(p)]
            assert x.n == groups[p][0] and math.isclose(x.rate, rate) and math.isclose(x.parent_rate, above) and x.attributes == len(p)
    assert max((x for x in got.values() if x.attributes > 1), key=lambda x: x.gain).segment == "b=2, c=p"


@pytest.mark.parametrize("text,want", [
    ("2024-01-01T00:00:00+05:00", "2023-12-31 19:00:00"), ("2024-01-01 12:00:00.25-0330", "2024-01-01 15:30:00.250000"),
    ("2024-01-01T12:00:00Z", "2024-01-01 12:00:00"), ("2024-01-01 12:00:00 -08", "2024-01-01 20:00:00"),
    ("2024-01-01 12:00:00", "2024-01-01 12:00:00"), ("2024-01-01", "2024-01-01 00:00:00"), ("nonsense", None), ("2024-13-01T00:00:00Z", None),
    ("1969-12-31T23:59:59.5Z", "1969-12-31 23:59:59.500000"), (None, None)])
@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_text_times_with_zones(spark, text, want, zone):
    from tidewatch.functions import exprs as E

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = spark.createDataFrame([(text,)], "t string").select(E.string_to_ts("t").alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (None if got is None else str(got)) == want
