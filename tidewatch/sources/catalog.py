"""Catalog sources.

Listings are catalog metadata (driver side, one command for each schema).
Counts, sizes and times of all tables of a listing come from one scan that
reads no column but the hidden file metadata.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import exprs as E
from tidewatch.schemas import COLUMN
from tidewatch.session import TABLES, checkpoint_dir

CATALOG = "spark_catalog"


def register_tables(spark: SparkSession, sf_dir: str, database: str,
                    tables: Sequence[str] = TABLES) -> list[str]:
    """Expose parquet tables of a folder as external tables of ``database``
    (metadata only; the data stays where it is)."""
    loc = f"{checkpoint_dir(spark)}/warehouse/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{loc}'")
    out = []
    for t in tables:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t} USING parquet "
                  f"OPTIONS (path '{sf_dir.rstrip('/')}/{t}.parquet')")
        out.append(f"{database}.{t}")
    return out


def catalog_databases(spark: SparkSession) -> DataFrame:
    """SRC1: accessible databases (namespaces of the session catalog)."""
    return spark.sql("SHOW NAMESPACES").select(F.col("namespace").alias("database_name"))


def catalog_schemas(spark: SparkSession, database: str = CATALOG) -> DataFrame:
    """SRC2: schemas of one catalog."""
    return spark.sql(f"SHOW NAMESPACES IN {database}").select(
        F.lit(database).alias("database_name"), F.col("namespace").alias("schema_name"))


_ABOUT = "catalog string, schema_name string, table_name string, table_type string, provider string, location string, view_query string"


def table_listing(spark: SparkSession, schemas: Sequence[str]) -> DataFrame:
    """(catalog, schema_name, table_name, table_type, provider, location,
    view_query) of the tables and views of ``schemas``: one catalog command for
    each schema, none for a table."""
    info = F.col("information")
    line = lambda name: F.nullif(F.regexp_extract(info, rf"(?m)^{name}: (.*)$", 1), F.lit(""))
    out = spark.createDataFrame([], _ABOUT)
    for s in schemas:
        shown = spark.sql(f"SHOW TABLE EXTENDED IN {s} LIKE '*'").where("NOT isTemporary")
        out = out.union(shown.select(
            F.lit(CATALOG), "namespace", "tableName", F.when(line("Type") == "VIEW", F.lit("view")).otherwise(F.lit("table")),
            F.lower(line("Provider")), line("Location"), line("View Text")))
    return out


def _plain_path(c):
    """A location without a slash at its end; a local one without its scheme."""
    return F.regexp_replace(F.regexp_replace(c, "^file:/+", "/"), "(?<=.)/+$", "")


def _folders(c):
    """All prefixes of a path at its slashes, itself included."""
    steps = F.split(c, "/")
    return F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))


def file_stats(spark: SparkSession, locations: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """(table_id, row_count, byte_count, last_update_time, n_files) of any
    number of tables, in one scan: all locations are read together without a
    column, and the hidden file metadata says which file a row stands in, its
    size and its time. A file belongs to the location that is one of its
    parent folders, or itself. Tables without rows count as 0 rows, 0 bytes and
    no time; a location that does not exist yet likewise."""
    known = spark.createDataFrame([(t, loc) for t, loc in locations.items()], "table_id string, location string")
    known = known.withColumn("location", _plain_path(F.col("location")))
    paths = sorted(set(locations.values()))
    scan = None
    while paths and scan is None:
        try:
            scan = spark.read.schema("`__none` int").option("recursiveFileLookup", "true").format(fmt).load(paths)
        except AnalysisException as e:     # a new table has no folder until its first write
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = e.getMessageParameters()["path"]
            paths = [p for p in paths if _bare(p) != _bare(missing)]
    if scan is None:
        return known.select("table_id", F.lit(0).cast("long").alias("row_count"), F.lit(0).cast("long").alias("byte_count"),
                            F.lit(None).cast("timestamp_ntz").alias("last_update_time"), F.lit(0).cast("long").alias("n_files"))
    meta = F.col("_metadata")
    files = scan.groupBy(meta["file_path"].alias("path"), meta["file_size"].alias("bytes"),
                         meta["file_modification_time"].alias("changed")).agg(F.count(F.lit(1)).alias("rows"))
    path = _plain_path(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))))
    # a location may leave out scheme and host, which the files' paths have
    above = F.array_union(_folders(path), _folders(F.regexp_replace(path, "^[a-z0-9]+:(//[^/]*)?/*", "/")))
    placed = files.select("bytes", "changed", "rows", F.explode(above).alias("location"))
    # the list of locations was made here, its length is known
    sums = placed.join(F.broadcast(known), "location").groupBy("table_id").agg(
        F.sum("rows").alias("row_count"), F.sum("bytes").alias("byte_count"),
        F.max("changed").cast("timestamp_ntz").alias("last_update_time"), F.count("*").alias("n_files"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("row_count", "byte_count")]
    return known.select("table_id").join(sums, "table_id", "left").select(
        "table_id", *zero, "last_update_time", F.coalesce("n_files", F.lit(0).cast("long")).alias("n_files"))


def _bare(path: str) -> str:
    """``path`` without scheme and surplus slashes."""
    return "/" + re.sub(r"^[a-z0-9]+:", "", path).strip("/")


def _located(spark: SparkSession, tables: Sequence[str]) -> list[tuple]:
    """(table_id, provider, location) of the named tables (db.table): catalog
    metadata of one page of names."""
    schemas = list(dict.fromkeys(t.rpartition(".")[0] for t in tables))
    wanted = {t.lower(): t for t in tables}
    rows = table_listing(spark, schemas).select("schema_name", "table_name", "provider", "location").collect()
    found = {f"{r.schema_name}.{r.table_name}".lower(): (r.provider, r.location) for r in rows}
    return [(name, *found.get(key, (None, None))) for key, name in wanted.items()]


_METADATA_FORMATS = ("parquet", "orc")


def volume_snapshot(spark: SparkSession, tables: Sequence[str], as_of=None) -> DataFrame:
    """SRC5: row and byte count of every table at a snapshot time.

    All tables of a columnar format share one scan of their files' metadata
    (``file_stats``); of the others (text formats, views) rows are counted by
    the table's own reader, without file statistics."""
    at = E.as_of(as_of)
    located = _located(spark, tables)
    parts = []
    for fmt in _METADATA_FORMATS:
        own = {t: loc for t, provider, loc in located if provider == fmt and loc}
        if own:
            parts.append(file_stats(spark, own, fmt).drop("n_files"))
    for t, provider, loc in located:
        if provider not in _METADATA_FORMATS or not loc:
            parts.append(spark.table(t).agg(F.lit(t).alias("table_id"), F.count(F.lit(1)).alias("row_count"),
                                            F.lit(None).cast("long").alias("byte_count"),
                                            F.lit(None).cast("timestamp_ntz").alias("last_update_time")))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("snapshot_time", at)


def freshness_snapshot(spark: SparkSession, tables: Mapping[str, str | None]) -> DataFrame:
    """SRC6: last update time per table: max of its time column when given
    (reads that one column; parquet min/max statistics help), else the newest
    modification time of its files (one scan for all such tables)."""
    parts = [spark.table(t).agg(F.lit(t).alias("table_id"), F.max(F.col(c).cast("timestamp_ntz")).alias("last_update_time"))
             for t, c in tables.items() if c]
    by_file = [t for t, c in tables.items() if not c]
    if by_file:
        parts.append(volume_snapshot(spark, by_file).select("table_id", "last_update_time"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def table_inventory(spark: SparkSession, schemas: Sequence[str], table_names: Sequence[str] | None = None,
                    offset: int = 0, limit: int = 5000, with_volume: bool = True) -> DataFrame:
    """SRC3: one row per table or view (TABLE schema), filtered by schema and
    by table name (case-insensitive), ordered by identity, paged."""
    lst = table_listing(spark, schemas)
    if table_names:
        lst = lst.where(F.lower("table_name").isin(*[t.lower() for t in table_names]))
    lst = lst.orderBy("catalog", "schema_name", "table_name").offset(offset).limit(limit)
    page = lst.select("catalog", "schema_name", "table_name", "table_type", "view_query").collect()   # one page of names
    names = [(r.schema_name, r.table_name, r.table_type) for r in page]
    base = spark.createDataFrame(
        page, "database_name string, schema_name string, table_name string, table_type string, view_query string")
    if not with_volume or not names:
        return base.select("database_name", "schema_name", "table_name", "table_type",
                           F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("long").alias("byte_count"),
                           F.lit(None).cast("timestamp_ntz").alias("last_update_time"), "view_query")
    tables = [f"{s}.{t}" for s, t, kind in names if kind == "table"]
    vol = volume_snapshot(spark, tables) if tables else None
    out = base.withColumn("table_id", F.concat_ws(".", "schema_name", "table_name"))
    if vol is not None:
        out = out.join(vol.drop("snapshot_time"), "table_id", "left")
    else:
        out = out.withColumn("row_count", F.lit(None).cast("long")).withColumn(
            "byte_count", F.lit(None).cast("long")).withColumn("last_update_time", F.lit(None).cast("timestamp_ntz"))
    return out.select("database_name", "schema_name", "table_name", "table_type", "row_count", "byte_count",
                      "last_update_time", "view_query")


def column_inventory(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """SRC4: (full_table_id, column_name, column_type) from the schemas; no scan."""
    rows = [(tid, f.name, f.dataType.simpleString()) for tid, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, COLUMN)


# ------------------------------------------------------------------ SRC13

def create_table(spark: SparkSession, ident: str, schema: str, location: str) -> None:
    spark.sql(f"CREATE TABLE {ident} ({schema}) USING parquet LOCATION '{location}'")


def insert_rows(spark: SparkSession, ident: str, df: DataFrame) -> None:
    """Append rows (a partitioned append; existing files stay)."""
    df.write.insertInto(ident)


def add_column(spark: SparkSession, ident: str, name: str, dtype: str) -> None:
    spark.sql(f"ALTER TABLE {ident} ADD COLUMNS ({name} {dtype})")


def drop_column(spark: SparkSession, ident: str, name: str, location: str) -> None:
    """DROP COLUMN is refused for v1 parquet tables: rewrite without it into
    a new location and re-point the table."""
    df = spark.table(ident).drop(name)
    df.write.mode("overwrite").parquet(location)
    spark.sql(f"DROP TABLE {ident}")
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE {ident} ({cols}) USING parquet LOCATION '{location}'")


def drop_table(spark: SparkSession, ident: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {ident}")
