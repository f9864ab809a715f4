"""Driver contract: entry, registry and oracle agree (checked on sf0.001 with DuckDB)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "orders lineitem events".split()
# fast, representative subset; the whole registry is checked by tools/check_oracle.py at sf0.01
SAMPLE = [
    "view_tipo_cambio",
    "view_ipc_mensual",
    "dashboard_long",
    "value_coercion",
    "period_windows",
    "backfill_outcomes",
    "run_summary",
    "alert_error_rate",
]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["series_id", "observation_date", "clp_per_usd", "cambio_diario_clp", "variacion_pct", "media_movil_7d"]


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", SAMPLE)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    res = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    dorder = sorted(range(len(res.columns)), key=lambda i: res.columns[i])
    s = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in df.collect())
    d = sorted(repr(tuple(_norm(r[i]) for i in dorder)) for r in res.fetchall())
    assert s == d
