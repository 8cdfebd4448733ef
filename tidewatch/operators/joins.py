"""Joins that are operators of their own."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def run_asset_join(runs: DataFrame, assets: DataFrame, key: str = "job_source_id"
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """JOIN1: (runs with their job, runs without a job, jobs without a run).

    Assets are reduced to one row per job (the smallest name) first; AQE
    broadcasts them from their measured size, and splits a hot job's partition
    where they are too large for that. The first result marks runs without a
    job (has_job); who wants both kinds takes them from it in one read. Idle
    jobs need the runs' distinct keys only."""
    jobs = assets.groupBy(key).agg(F.min("name").alias("job_name"), F.lit(True).alias("has_job"))
    with_job = runs.join(jobs, key, "left").withColumn("has_job", F.coalesce("has_job", F.lit(False)))
    orphans = with_job.where(~F.col("has_job")).select(*runs.columns)
    idle = jobs.join(runs.select(key).distinct(), key, "left_anti").drop("has_job")
    return with_job, orphans, idle


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str], metrics: dict[str, Column],
            tolerance: float = 0.0) -> DataFrame:
    """JOIN2: the same metrics of two tables by segment.

    Both sides are aggregated first (the shuffle moves groups, not rows),
    then joined full outer on the keys with NULL-safe equality. Output per
    key: left_<m>, right_<m>, diff_<m> and ``same`` (all metrics equal
    within ``tolerance``, NULL-safe)."""
    agg = [c.alias(n) for n, c in metrics.items()]
    lft = left.groupBy(*keys).agg(*agg)
    rgt = right.groupBy(*keys).agg(*agg)
    for n in metrics:
        lft = lft.withColumnRenamed(n, f"left_{n}")
        rgt = rgt.withColumnRenamed(n, f"right_{n}")
    for k in keys:
        rgt = rgt.withColumnRenamed(k, f"__r_{k}")
    cond = reduce(lambda a, b: a & b, [lft[k].eqNullSafe(rgt[f"__r_{k}"]) for k in keys])
    j = lft.join(rgt, cond, "full_outer")
    out_keys = [F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) for k in keys]
    diffs, sames = [], []
    for n in metrics:
        lv, rv = F.col(f"left_{n}"), F.col(f"right_{n}")
        diffs.append((rv - lv).alias(f"diff_{n}"))
        sames.append(lv.eqNullSafe(rv) | (F.abs(rv - lv) <= tolerance))
    same = reduce(lambda a, b: a & b, [F.coalesce(s, F.lit(False)) for s in sames])
    return j.select(*out_keys, *[F.col(f"left_{n}") for n in metrics], *[F.col(f"right_{n}") for n in metrics],
                    *diffs, same.alias("same"))
