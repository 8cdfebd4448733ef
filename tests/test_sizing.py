"""Scale helpers: spreading of small inputs, and plans that are built without a job."""

from tidewatch.operators.monitors import spread
from pyspark.sql import functions as F

from tidewatch.operators import etl as X
from tidewatch.operators import lineage as L
from tidewatch.operators.joins import run_asset_join
from tidewatch.operators.monitors import MetricSpec, metric_monitor


def test_spread_fires_only_on_small_inputs(spark):
    cores = spark.sparkContext.defaultParallelism
    thin = spark.range(100).coalesce(1)
    assert spread(thin, 1, heavy=True).rdd.getNumPartitions() == cores
    assert spread(thin, 1).rdd.getNumPartitions() == 1                 # light work: left alone
    wide = spark.range(1 << 40, numPartitions=3)
    assert spread(wide, 100, heavy=True).rdd.getNumPartitions() == 3   # too large to move


def test_plans_are_built_without_a_job(spark):
    sc = spark.sparkContext
    runs = spark.range(1000).select(F.concat(F.lit("j"), (F.col("id") % 9).cast("string")).alias("job_source_id"),
                                    F.lit("Done").alias("status"), F.lit(None).cast("string").alias("run_group"), "id")
    runs = runs.groupBy("job_source_id", "status", "run_group").agg(F.max("id").alias("id"))
    jobs = spark.range(9).select(F.concat(F.lit("j"), F.col("id").cast("string")).alias("job_source_id"),
                                 F.lit("n").alias("name"), F.lit("g").alias("group_source_id"),
                                 F.lit("c").alias("connection_id"))
    tags = runs.select(F.col("id").alias("query_id"), F.lit("custom").alias("integration"),
                       F.col("job_source_id").alias("job_id"), F.lit("t").alias("task_id"),
                       F.lit("c").alias("connection_id"))
    edges = runs.select("job_source_id", F.lit("INPUT").alias("role"), F.col("status").alias("asset_name"))
    sc.setJobGroup("plans", "plans only")
    try:
        run_asset_join(runs, jobs)
        X.attribute_group(runs, jobs)
        X.normalize_status(runs, jobs.select(F.col("name").alias("key"), F.col("name").alias("value")))
        L.resolve_tags(tags, jobs)
        L.table_edges(edges)
        L.query_tags(runs.select(F.col("id").alias("query_id"), F.col("status").alias("query_text")))
        metric_monitor(runs, [MetricSpec("row_count"), ("id", "numeric_median")], segments=["status"])
        assert list(sc.statusTracker().getJobIdsForGroup("plans")) == []
    finally:
        sc.setJobGroup("rest", "")
