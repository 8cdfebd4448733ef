"""Row-level difference of two tables by checksums (JOIN2).

Rows are dealt by the hash of their key into buckets, level by level: 4,096 at
the first, each of them 4,096 more at the next. A bucket's checksum adds up its
rows' hashes, so it hangs neither on their order nor on how the table is
partitioned, and it combines within the map tasks. Only buckets whose checksums
differ are opened at the next level, and only the rows of the last ones are
compared, so what is shuffled grows with the rows that differ, not with the
tables. Each level reads both tables once, the compared columns only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

FAN = 4096


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucket(keys: Sequence[str], level: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(*keys), 12 * level), F.lit(FAN)).cast("int")


def _opened(rows: DataFrame, keys: Sequence[str], level: int, differing: DataFrame | None) -> DataFrame:
    """Rows of the buckets of ``differing`` (b0, .. of the levels before)."""
    rows = rows.withColumns({f"b{i}": _bucket(keys, i) for i in range(level)})
    if differing is None:
        return rows
    names = [f"b{i}" for i in range(level)]
    # left to AQE: a few buckets are broadcast, half a table of them is not
    return rows.join(differing, names, "left_semi")


def row_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], levels: int = 2) -> DataFrame:
    """(keys, change, left_rows, right_rows, columns) of the keys whose rows
    differ: change is ``missing`` (nothing on the right), ``extra`` (nothing on
    the left) or ``changed``; left_rows and right_rows count the rows that the
    other side does not have, and columns names the values that differ where
    that is one row each. NULLs equal each other; keys may repeat."""
    cols = [*keys, *values]
    if {"__side", "change", "left_rows", "right_rows", "columns"} & set(cols):
        raise ValueError("compared columns must not be named like the result's")
    both = (left.select(*cols, F.lit(1).alias("__side")), right.select(*cols, F.lit(-1).alias("__side")))
    rows = both[0].unionByName(both[1])
    differing = None
    for level in range(levels):
        at = [f"b{i}" for i in range(level + 1)]
        side = F.col("__side")
        sums = _opened(rows, keys, level, differing).withColumn(f"b{level}", _bucket(keys, level)).groupBy(*at).agg(
            F.sum(side).alias("n"), F.sum(side * F.xxhash64(*cols).cast("decimal(20,0)")).alias("s"),
            F.sum(side * F.xxhash64(F.lit(level + 1), *cols).cast("decimal(20,0)")).alias("t"))
        differing = _written(sums.where("n <> 0 OR s <> 0 OR t <> 0").select(*at), "differing-buckets")
    left_over = (_opened(rows, keys, levels, differing).groupBy(*cols).agg(F.sum("__side").alias("n")).where("n <> 0"))
    own = F.struct(*[F.col(v) for v in values]) if values else F.struct(F.lit(0).alias("none"))
    of = lambda s: F.max(F.when(F.col("n") * s > 0, own))
    count = lambda s: F.sum(F.when(F.col("n") * s > 0, F.abs("n")).otherwise(F.lit(0)))
    found = left_over.groupBy(*keys).agg(count(1).alias("left_rows"), count(-1).alias("right_rows"), of(1).alias("__l"), of(-1).alias("__r"))
    change = (F.when(F.col("right_rows") == 0, F.lit("missing")).when(F.col("left_rows") == 0, F.lit("extra")).otherwise(F.lit("changed")))
    names = F.array_compact(F.array(*[F.when(~F.col(f"__l.{v}").eqNullSafe(F.col(f"__r.{v}")), F.lit(v)) for v in values])) if values else F.array().cast("array<string>")
    one = (F.col("left_rows") == 1) & (F.col("right_rows") == 1)
    # a key that still has equal rows on both sides has lost or gained some of its rows only
    return found.select(*keys, change.alias("change"), "left_rows", "right_rows", F.when(one, names).alias("columns"))
