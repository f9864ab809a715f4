"""Window semantics on small frames, and plan shape of the views."""

import datetime as dt

from pyspark.sql import functions as F

from obsflow.plans import views as V
from obsflow.schema import OBSERVATIONS
from obsflow.sources import adapters as A
from tests.conftest import SF_SMALL

T1 = dt.datetime(2026, 1, 1)


def _series(spark, sid, values, status=None, start=dt.date(2020, 1, 1)):
    rows = []
    for i, v in enumerate(values):
        st = status[i] if status else "OK"
        rows.append((sid, start + dt.timedelta(days=i), v, st, "daily", T1))
    return rows


def test_filter_before_window_and_labels(spark):
    rows = _series(spark, "A", [1.0, 1.0, 2.0, None, 1.5, 9.0], ["OK", "OK", "OK", "OK", "OK", "ND"])
    rows += _series(spark, "B", [5.0, 4.0])
    out = V.view_tpm(spark.createDataFrame(rows, OBSERVATIONS)).orderBy("series_id", "observation_date").collect()
    assert [(r.series_id, r.tpm_pct, r.cambio_pp, r.movimiento) for r in out] == [
        ("A", 1.0, None, None),
        ("A", 1.0, 0.0, "sin_cambio"),
        ("A", 2.0, 1.0, "alza"),
        ("A", 1.5, -0.5, "baja"),  # the NULL row and the ND row are gone before the lag
        ("B", 5.0, None, None),
        ("B", 4.0, -1.0, "baja"),
    ]


def test_pct_change_safe_division_and_moving_average(spark):
    rows = _series(spark, "A", [0.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0])
    out = V.view_tipo_cambio(spark.createDataFrame(rows, OBSERVATIONS)).orderBy("observation_date").collect()
    assert out[1].variacion_pct is None  # previous value 0 → NULL, not an error
    assert out[2].variacion_pct == 50.0
    assert out[0].media_movil_7d == 0.0 and out[1].media_movil_7d == 1.0  # early rows average what exists
    assert out[7].media_movil_7d == sum([2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]) / 7


def test_compound_growth_and_guard(spark):
    vals = [1.0] * 12 + [-100.0] + [1.0] * 12
    out = V.view_ipc_mensual(spark.createDataFrame(_series(spark, "A", vals), OBSERVATIONS)).orderBy("observation_date").collect()
    assert out[11].variacion_12m_pct == round((1.01 ** 12 - 1) * 100, 4)
    assert out[11].meses_en_ventana == 12 and out[0].meses_en_ventana == 1
    assert all(r.variacion_12m_pct is None for r in out[12:24])  # frames holding -100 %
    assert out[24].variacion_12m_pct == round((1.01 ** 12 - 1) * 100, 4)


def test_yoy_counts_rows_not_days(spark):
    vals = [100.0 + i for i in range(13)]
    out = V.view_imacec(spark.createDataFrame(_series(spark, "A", vals), OBSERVATIONS)).orderBy("observation_date").collect()
    assert out[11].variacion_12m_pct is None and out[12].variacion_12m_pct == 12.0


def test_dashboard_left_join_keeps_unmatched(spark):
    obs = A.observations(spark, SF_SMALL)
    seed = spark.createDataFrame([(s, n, u, f, d, None) for s, n, u, f, d in A.DIM_SEED], "series_id string, name string, unit string, frequency string, description string, updated_at timestamp")
    out = V.dashboard_long(obs, seed)
    low = out.where(F.col("series_id") == "5-LOW").select("series_nombre", "unidad").distinct().collect()
    assert [(r.series_nombre, r.unidad) for r in low] == [("5-LOW", None)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_views_partition_by_series_never_single_partition(spark):
    obs = A.obs_daily(spark, SF_SMALL)
    for build in V.VIEW_BUILDERS.values():
        plan = _plan(build(obs))
        assert "SinglePartition" not in plan
        assert "hashpartitioning(series_id" in plan


def test_series_selection_is_pushed_below_the_window(spark):
    obs = A.obs_daily(spark, SF_SMALL)
    df = V.view_tipo_cambio(obs).where(F.col("series_id") == "1-URGENT")
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    window_at = optimized.index("Window")
    assert "1-URGENT" in optimized[window_at:]  # the filter sits under the Window node
    assert df.count() == V.view_tipo_cambio(obs, "1-URGENT").count()


def test_register_views(spark):
    obs = A.obs_daily(spark, SF_SMALL)
    seed = spark.createDataFrame([], "series_id string, name string, unit string")
    names = V.register_views(obs, seed)
    assert "v_tipo_cambio" in names and spark.table("v_tipo_cambio").count() > 0


def test_namespaces_and_pinned_views(spark):
    V.ensure_namespaces(spark)
    V.ensure_namespaces(spark)  # idempotent
    names = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    assert {"raw", "analytics"} <= names
    obs = A.obs_daily(spark, SF_SMALL)
    seed = spark.createDataFrame([], "series_id string, name string, unit string")
    V.register_views(obs, seed, {"v_uf_diaria": ["2-HIGH"], "v_tpm": F.col("series_id").startswith("1-")})
    assert {r.series_id for r in spark.table("v_uf_diaria").select("series_id").distinct().collect()} == {"2-HIGH"}
    assert {r.series_id for r in spark.table("v_tpm").select("series_id").distinct().collect()} == {"1-URGENT"}
