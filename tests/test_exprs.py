"""Expression rows on the reference's inline cases (FIXTURES section 1)."""

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions import exprs as E


def one(df, col):
    return df.select(col.alias("x")).first()["x"]


def test_avg_stddev_f1(spark):
    df = spark.createDataFrame([(10,), (20,), (30,)], "val long")
    r = df.agg(E.avg("val").alias("a"), E.stddev("val").alias("s")).first()
    assert r.a == 20.0 and abs(r.s - 10.0) < 1e-9


def test_nan_f2(spark):
    df = spark.createDataFrame([(float("nan"),), (None,)], "val double")
    assert df.where(E.is_nan("val")).count() == 1
    assert one(spark.range(1), F.isnan(E.nan())) is True


def test_distinct_f3(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "val string")
    assert df.agg(E.count_distinct("val")).first()[0] == 3
    assert E.distinct(df, "val").count() == 3


def test_epoch_f4(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("1970-01-01 00:00:00",)], "val string")
    ts = E.string_to_ts("val")
    out = sorted(r[0] for r in df.select(E.epoch(ts)).collect())
    assert out == [0, 1704067200]


def test_count_if_f6(spark):
    df = spark.createDataFrame([(5,), (-3,), (0,), (10,)], "val long")
    r = df.agg(E.count_if(F.col("val") > 0).alias("p"), E.count_if(F.col("val") == 0).alias("z")).first()
    assert (r.p, r.z) == (2, 1)


def test_median_f7(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "val")
    approx = df.agg(E.percentile("val", 0.5)).first()[0]
    exact = df.agg(E.percentile("val", 0.5, exact=True)).first()[0]
    assert 45 <= approx <= 55 and exact == 50.5
    q = df.agg(E.quantiles("val", 4, exact=True)).first()[0]
    assert len(q) == 5 and q[2] == 50.5


def test_length_empty_f8(spark):
    df = spark.createDataFrame([("hello",), ("",), ("world!",)], "val string")
    assert df.agg(F.sum(E.length("val"))).first()[0] == 11
    assert df.where(E.is_empty("val")).count() == 1
    blanks = spark.createDataFrame([("   ",)], "val string")
    assert blanks.where(E.is_empty("val")).count() == 0


def test_regex_f9_f10(spark):
    df = spark.createDataFrame([("123",), ("abc",), ("456",)], "val string")
    r = df.agg(E.count_if(E.matches("val", "^[0-9]+$")).alias("rows"),
               E.regex_match_total("val", "^[0-9]+$").alias("total")).first()
    assert (r.rows, r.total) == (2, 2)
    em = spark.createDataFrame([("user@example.com",), ("not-an-email",), ("admin@test.org",)], "val string")
    from tidewatch.functions.patterns import PATTERNS
    assert em.where(E.matches("val", PATTERNS["email_address"])).count() == 2
    assert em.where(E.matches("val", "USER@", ci=True)).count() == 1


def test_inside_outside_f11(spark):
    df = spark.createDataFrame([(1,), (5,), (10,), (15,)], "val long")
    assert df.where(E.inside("val", 5, 10)).count() == 2
    assert df.where(E.outside("val", 5, 10)).count() == 2


def test_arrays_f12(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), (None,)], "val array<int>")
    assert [r[0] for r in df.select(E.array_length("val")).collect()] == [3, 0, None]
    assert one(spark.range(1), E.array_length(E.array_lit(1, 2, 3))) == 3


def test_timestamp_text_f13(spark):
    rows = [("2024-01-15 10:30:00",), ("not-a-timestamp",), ("2024",), ("10:30:00",),
            ("2024-01-01 extra text",), (None,)]
    df = spark.createDataFrame(rows, "val string")
    assert df.where(E.is_timestamp("val")).count() == 1
    assert df.where(E.not_timestamp("val")).count() == 4


def test_approx_distinct_f14(spark):
    df = spark.range(50).select((F.col("id") % 10).alias("val"))
    assert 8 <= df.agg(E.approx_distinct("val")).first()[0] <= 12


def test_unpivot_f15(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    assert E.unpivot(df, [], ["a", "b", "c"]).count() == 3
    df2 = spark.createDataFrame([(None, 2, 3)], "a long, b long, c long")
    assert E.unpivot(df2, [], ["a", "b", "c"]).count() == 3
    assert E.unpivot(df2, [], ["a", "b", "c"], drop_nulls=True).count() == 2


def test_comparisons_f16_f17_f18(spark):
    xy = spark.createDataFrame([(10, 10), (10, 20)], "x long, y long")
    assert xy.where(E.eq("x", F.col("y"))).count() == 1
    v = spark.createDataFrame([(5,), (10,), (15,)], "val long")
    assert v.where(E.gt("val", 8)).count() == 2
    assert v.where(E.lt("val", 8)).count() == 1
    assert v.where(E.gte("val", 10)).count() == 2
    assert v.where(E.lte("val", 10)).count() == 2
    n = spark.createDataFrame([(1,), (None,), (3,)], "val long")
    assert n.where(E.is_null("val")).count() == 1
    assert n.where(E.is_not_null("val")).count() == 2
    assert n.where(E.negate(E.eq("val", 1))).count() == 1      # NULL stays unknown
    assert n.where(E.always_true()).count() == 3


def test_relative_time_f19(spark):
    at = dt.datetime(2024, 3, 14, 15, 0, 0)
    rows = [(at - dt.timedelta(days=2),), (at - dt.timedelta(days=30),), (at - dt.timedelta(hours=1),),
            (at - dt.timedelta(hours=48),), (dt.datetime(2024, 3, 13, 12),), (dt.datetime(2024, 3, 14, 12),),
            (at - dt.timedelta(days=60),)]
    df = spark.createDataFrame([(r[0].isoformat(sep=" "),) for r in rows], "s string") \
        .select(E.string_to_ts("s").alias("ts"))
    assert df.where(E.in_past_days("ts", 7, at)).count() == 5
    assert df.where(E.in_past_hours("ts", 24, at)).count() == 2
    assert df.where(E.is_yesterday("ts", at)).count() == 1
    assert df.where(E.in_calendar_week("ts", at)).count() >= 1
    assert df.where(E.in_calendar_month("ts", at)).count() == 5


def test_trunc_f20(spark):
    df = spark.createDataFrame([("2024-06-15 14:30:45",)], "s string").select(E.string_to_ts("s").alias("ts"))
    got = df.select(*[E.trunc("ts", u).alias(u) for u in ("hour", "day", "week", "month", "year")]).first()
    assert got.hour == dt.datetime(2024, 6, 15, 14)
    assert got.day == dt.datetime(2024, 6, 15)
    assert got.week == dt.datetime(2024, 6, 10)
    assert got.month == dt.datetime(2024, 6, 1)
    assert got.year == dt.datetime(2024, 1, 1)
    assert one(df, E.day_of_week("ts")) == 6      # Saturday; 0 = Sunday


def test_date_diff_f21(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-11 00:00:00")], "a string, b string") \
        .select(E.string_to_ts("a").alias("a"), E.string_to_ts("b").alias("b"))
    assert one(df, E.date_diff("a", "b", "day")) == 10
    assert one(df, E.date_diff("b", "a", "day")) == -10
    late = spark.createDataFrame([("2024-01-01 23:59:00", "2024-01-02 00:01:00")], "a string, b string") \
        .select(E.string_to_ts("a").alias("a"), E.string_to_ts("b").alias("b"))
    assert one(late, E.date_diff("a", "b", "day")) == 1       # boundaries crossed (P11)
    assert one(late, E.date_diff("a", "b", "hour")) == 1


def test_safe_divide_f22(spark):
    r = spark.range(1).select(E.safe_divide(F.lit(10), F.lit(2)).alias("a"),
                              E.safe_divide(F.lit(10), F.lit(0)).alias("b")).first()
    assert r.a == 5.0 and r.b is None


def test_casts_and_zones(spark):
    df = spark.createDataFrame([("12.5", "2024-01-01", 1704067200)], "n string, d string, e long")
    r = df.select(E.to_numeric("n").alias("n"), E.to_numeric("d").alias("bad"), E.to_decimal("n").alias("dec"),
                  E.epoch_to_ts("e").alias("ts"), E.date_to_ts(E.to_date("d")).alias("mid"),
                  E.from_zone(F.lit("2024-01-01 05:00:00"), "+05:00").alias("utc"),
                  E.to_utc(F.lit("2024-01-01 00:00:00"), "America/New_York").alias("ny")).first()
    assert r.n == 12.5 and r.bad is None and str(r.dec) == "12.5000000000"
    assert r.ts == dt.datetime(2024, 1, 1) and r.mid == dt.datetime(2024, 1, 1)
    assert r.utc == dt.datetime(2024, 1, 1) and r.ny == dt.datetime(2024, 1, 1, 5)


def test_case_when_and_sample(spark):
    df = spark.range(10)
    band = E.case_when([(F.col("id") < 3, "low"), (F.col("id") < 6, "mid")])
    got = {r[0]: r[1] for r in df.groupBy(band.alias("b")).count().collect()}
    assert got == {"low": 3, "mid": 3, None: 4}
    a = [r.id for r in E.sample_rows(df, "id", 4, "s").collect()]
    b = [r.id for r in E.sample_rows(df.repartition(3), "id", 4, "s").collect()]
    assert a == b and len(a) == 4                 # independent of partitioning
    assert E.limit(df, 5).count() == 5
