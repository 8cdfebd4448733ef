"""Driver contract: entry smoke, registry consistency, and a sample of the
registered queries against DuckDB on the smallest tables."""

import datetime as dt
import decimal
import math
import re

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from tidewatch.session import TABLES

SAMPLE = ["mon_metric", "proj_alias", "pred_is_ts", "agg_percentile", "ts_diff", "cast_ts_default", "m_text_ts",
          "m_row_count_change", "m_unix_zero", "mon_profile", "mon_threshold", "mon_freshness", "join_compare",
          "etl_validate_runs", "etl_first_errors", "etl_validate_assets", "etl_coverage", "lin_tags",
          "lin_impact", "src_tables", "sink_observations", "str_metrics", "str_latest"]


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert [f.name for f in df.schema.fields] == ["bucket_start", "l_returnflag", "row_count", "zero_rate", "mean_qty"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 170
    # the training-data subpackage tests what SQL cannot express by itself
    assert all(n == "pipeline" or re.match(r"op\d+_", n) for n in set(q) - set(o))


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 4)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    res = con.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    assert _rows(cols, rows) == _rows(ocols, res.fetchall())
