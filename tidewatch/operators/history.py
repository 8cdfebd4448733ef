"""Snapshots with validity intervals (SRC3-SRC6, MON7-MON10).

A snapshot lists what is there at one time: tables, columns, volumes. Stored
one after the other, snapshots repeat themselves; here a row says from when to
when (half open, NULL: still) a key had its values. A key that is missing in a
snapshot was dropped then, and one that comes back starts a new interval.

``intervals`` folds any number of stored snapshots at once, ``SnapshotHistory``
merges one snapshot after the other into a stored table, and both give the
same rows. ``as_of`` is the state at any time; ``asof_join`` gives each event
the state of its key at its own time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions import exprs as E


def intervals(snapshots: DataFrame, keys: Sequence[str], values: Sequence[str], time: str = "snapshot_time") -> DataFrame:
    """(keys, values, valid_from, valid_to) of snapshots that list every key
    that is there. The window runs over the snapshots of one key; the list of
    times has one row per snapshot."""
    times = snapshots.select(F.col(time).alias("__t")).distinct()
    following = times.withColumn("__next", F.lead("__t").over(Window.orderBy("__t"))).withColumnRenamed("__t", time)
    rows = snapshots.join(following, time)
    w = Window.partitionBy(*keys).orderBy(time)
    state = F.struct(*values)
    goes_on = F.lag("__next").over(w).eqNullSafe(F.col(time)) & F.lag(state).over(w).eqNullSafe(state) & F.lag(time).over(w).isNotNull()
    runs = rows.withColumn("__new", (~goes_on).cast("int")).withColumn("__run", F.sum("__new").over(w))
    return runs.groupBy(*keys, *values, "__run").agg(
        F.min(time).alias("valid_from"), F.max_by("__next", time).alias("valid_to")).drop("__run")


def as_of(history: DataFrame, at) -> DataFrame:
    """The keys and values at a time."""
    t = E.as_of(at)
    return history.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))).drop("valid_from", "valid_to")


def asof_join(events: DataFrame, history: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], grain: str = "day") -> DataFrame:
    """``events`` with the values that their key had at their time (NULL where
    it was not there): both sides are put in one order of time and the last
    state is carried forward. Keys are split by ``grain``, so that a hot key is
    as many groups as it has days; a day starts with the last state of the days
    before it, which is carried over one row per key and day."""
    cells = F.struct(*[F.col(v) for v in values])
    left = events.select(F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("__row"), *keys, F.col(time).alias("__t"),
                         F.lit(1).alias("__kind"), F.lit(None).cast(history.select(cells.alias("s")).schema["s"].dataType).alias("__s"))
    none = F.lit(None).cast(left.schema["__row"].dataType)
    # an end is a change to nothing, unless a new state starts just then
    starts = history.select(none.alias("__row"), *keys, F.col("valid_from").alias("__t"), F.lit(0).alias("__kind"), cells.alias("__s"))
    ends = history.where("valid_to IS NOT NULL").select(none.alias("__row"), *keys, F.col("valid_to").alias("__t"), F.lit(-1).alias("__kind"),
                                                        F.lit(None).cast(left.schema["__s"].dataType).alias("__s"))
    both = left.unionByName(starts).unionByName(ends).withColumn("__day", E.bucket("__t", grain))
    # what is carried: a struct that is there for every change, its state or nothing
    change = F.when(F.col("__kind") < 1, F.struct(F.col("__s").alias("s")))
    both = both.withColumn("__change", change)
    days = both.groupBy(*keys, "__day").agg(F.max_by("__change", F.when(F.col("__kind") < 1, F.struct("__t", "__kind"))).alias("__last"))
    before = F.last("__last", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1))
    carried = days.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)], F.col("__day").alias("__rday"), before.alias("__before"))
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r{i}")) for i, k in enumerate(keys)], F.col("__day").eqNullSafe(F.col("__rday")))
    w = Window.partitionBy(*keys, "__day").orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    now = F.coalesce(F.last("__change", ignorenulls=True).over(w), F.col("__before"))
    done = both.join(carried, cond).withColumn("__now", now).where("__kind = 1")
    return done.select("__row.*", *[F.col(f"__now.s.{v}").alias(v) for v in values])


class SnapshotHistory:
    """A stored history that takes one snapshot after the other.

    ``add`` joins the open intervals with the snapshot and writes, under the
    snapshot's time, what ended and what is open now; a snapshot that is added
    again replaces itself. Only open intervals are read, so the cost of a
    snapshot does not grow with the history.
    """

    def __init__(self, path: str, keys: Sequence[str], values: Sequence[str]):
        self.path, self.keys, self.values = path, list(keys), list(values)

    def _rows(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def start(self, history: DataFrame, at) -> None:
        """Take over intervals that were folded elsewhere, up to ``at``."""
        self._write(history, at)

    def _write(self, rows: DataFrame, at) -> None:
        out = rows.select(*self.keys, *self.values, "valid_from", "valid_to", E.as_of(at).cast("string").alias("written"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("written").parquet(self.path)

    def add(self, snapshot: DataFrame, at) -> None:
        spark, t = snapshot.sparkSession, E.as_of(at)
        rows = self._rows(spark)
        new = snapshot.select(*self.keys, *self.values)
        if rows is None:
            self._write(new.withColumns({"valid_from": t, "valid_to": F.lit(None).cast("timestamp_ntz")}), at)
            return
        earlier = rows.where(F.col("written").cast("timestamp_ntz") < t)
        last = earlier.agg(F.max(F.col("written").cast("timestamp_ntz"))).first()[0]
        opened = earlier.where((F.col("written").cast("timestamp_ntz") == F.lit(last)) & F.col("valid_to").isNull())
        old = opened.select(*[F.col(k).alias(f"__o_{k}") for k in self.keys], F.struct(*self.values).alias("__old"), F.col("valid_from").alias("__from"))
        new = new.select(*self.keys, F.struct(*self.values).alias("__new"))
        cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__o_{k}")) for k in self.keys])
        met = new.join(old, cond, "full_outer")
        had, has = F.col("__from").isNotNull(), F.col("__new").isNotNull()
        same = had & has & F.col("__old").eqNullSafe(F.col("__new"))
        none = F.lit(None).cast("timestamp_ntz")
        key = [F.when(had, F.col(f"__o_{k}")).otherwise(F.col(k)).alias(k) for k in self.keys]
        ended = F.when(had & ~same, F.struct(F.col("__old").alias("s"), F.col("__from").alias("a"), t.alias("b")))
        now = F.when(has, F.struct(F.col("__new").alias("s"), F.when(same, F.col("__from")).otherwise(t).alias("a"), none.alias("b")))
        out = met.select(*key, F.explode(F.array_compact(F.array(ended, now))).alias("r"))
        self._write(out.select(*self.keys, "r.s.*", F.col("r.a").alias("valid_from"), F.col("r.b").alias("valid_to")), at)

    def history(self, spark: SparkSession) -> DataFrame:
        """All intervals: those that ended, and the open ones of the last snapshot."""
        rows = self._rows(spark)
        last = rows.agg(F.max("written")).first()[0]
        return rows.where(F.col("valid_to").isNotNull() | (F.col("written") == F.lit(last))).drop("written")
