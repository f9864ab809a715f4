"""The served analytical views, as DataFrame builders.

Each view keeps the output columns of the served contract and adds ``series_id`` in
front: the builders work over any number of series at once (windows partitioned by
series) and take an optional series selection, which Catalyst pushes below the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.operators import windows as W
from obsflow.operators.joins import lookup_join

Series = Sequence[str] | str | Column | None


def _base(obs: DataFrame, series_ids: Series, alias: str) -> DataFrame:
    """The ``base`` step of every view: valid rows, optional selection, value renamed."""
    valid = W.select_series(W.valid_observations(obs), series_ids)
    return valid.select("series_id", "observation_date", F.col("value").alias(alias))


def view_uf_diaria(obs: DataFrame, series_ids: Series = None) -> DataFrame:
    """VIEW-1: daily level, change vs previous row, % change (6 dp)."""
    w = W.series_window()
    return _base(obs, series_ids, "uf_clp").select(
        "series_id",
        "observation_date",
        "uf_clp",
        W.abs_change("uf_clp", w).alias("cambio_diario_clp"),
        W.pct_change_over("uf_clp", w, 1, 6).alias("variacion_pct"),
    )


def view_tipo_cambio(obs: DataFrame, series_ids: Series = None) -> DataFrame:
    """VIEW-2: exchange rate, change, % change (4 dp), 7-row moving average."""
    w = W.series_window()
    return _base(obs, series_ids, "clp_per_usd").select(
        "series_id",
        "observation_date",
        "clp_per_usd",
        W.abs_change("clp_per_usd", w).alias("cambio_diario_clp"),
        W.pct_change_over("clp_per_usd", w, 1, 4).alias("variacion_pct"),
        W.moving_avg("clp_per_usd", w, 7).alias("media_movil_7d"),
    )


def view_tpm(obs: DataFrame, series_ids: Series = None) -> DataFrame:
    """VIEW-3: policy rate, change in points, movement label."""
    w = W.series_window()
    return _base(obs, series_ids, "tpm_pct").select(
        "series_id",
        "observation_date",
        "tpm_pct",
        W.abs_change("tpm_pct", w).alias("cambio_pp"),
        W.change_label("tpm_pct", w).alias("movimiento"),
    )


def view_ipc_mensual(obs: DataFrame, series_ids: Series = None) -> DataFrame:
    """VIEW-4: monthly % variation, compounded 12-row variation (4 dp), rows in window."""
    w = W.series_window()
    return _base(obs, series_ids, "variacion_mensual_pct").select(
        "series_id",
        "observation_date",
        "variacion_mensual_pct",
        W.compounded_growth("variacion_mensual_pct", w, 12, 4).alias("variacion_12m_pct"),
        W.frame_rows(w, 12).alias("meses_en_ventana"),
    )


def view_imacec(obs: DataFrame, series_ids: Series = None) -> DataFrame:
    """VIEW-5: monthly index, 12-row and 1-row % change (2 dp)."""
    w = W.series_window()
    return _base(obs, series_ids, "imacec_indice").select(
        "series_id",
        "observation_date",
        "imacec_indice",
        W.pct_change_over("imacec_indice", w, 12, 2).alias("variacion_12m_pct"),
        W.pct_change_over("imacec_indice", w, 1, 2).alias("variacion_mensual_pct"),
    )


def view_pib_trimestral(obs: DataFrame, series_ids: Series = None) -> DataFrame:
    """VIEW-6: quarterly level with year/quarter parts, 1-row and 4-row % change (2 dp)."""
    w = W.series_window()
    return _base(obs, series_ids, "pib_mmm_clp_encadenados").select(
        "series_id",
        "observation_date",
        F.year("observation_date").cast("int").alias("anio"),
        F.quarter("observation_date").cast("int").alias("trimestre"),
        "pib_mmm_clp_encadenados",
        W.pct_change_over("pib_mmm_clp_encadenados", w, 1, 2).alias("variacion_trimestral_pct"),
        W.pct_change_over("pib_mmm_clp_encadenados", w, 4, 2).alias("variacion_12m_pct"),
    )


def dashboard_long(obs: DataFrame, dim_series: DataFrame) -> DataFrame:
    """VIEW-7: valid observations with series metadata (unmatched series keep their id)."""
    valid = W.valid_observations(obs).select("observation_date", "frequency", "series_id", "value")
    dim = dim_series.select("series_id", "name", "unit")
    joined = lookup_join(valid, dim, "series_id")
    d = F.col("observation_date")
    return joined.select(
        "observation_date",
        "frequency",
        "series_id",
        F.coalesce(F.col("name"), F.col("series_id")).alias("series_nombre"),
        F.col("unit").alias("unidad"),
        "value",
        F.year(d).cast("int").alias("anio"),
        F.month(d).cast("int").alias("mes"),
        F.quarter(d).cast("int").alias("trimestre"),
    )


VIEW_BUILDERS = {
    "v_uf_diaria": view_uf_diaria,
    "v_tipo_cambio": view_tipo_cambio,
    "v_tpm": view_tpm,
    "v_ipc_mensual": view_ipc_mensual,
    "v_imacec": view_imacec,
    "v_pib_trimestral": view_pib_trimestral,
}


def ensure_namespaces(spark: SparkSession, names: Sequence[str] = ("raw", "analytics")) -> None:
    """SNK-6: idempotent namespaces for tables and views."""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def register_views(obs: DataFrame, dim_series: DataFrame, series_by_view: dict[str, Series] | None = None) -> list[str]:
    """SNK-7: (re)register every served view as a replaceable session view.

    ``series_by_view`` optionally pins a view to its series, as the served views do.
    """
    series_by_view = series_by_view or {}
    names = []
    for name, build in VIEW_BUILDERS.items():
        build(obs, series_by_view.get(name)).createOrReplaceTempView(name)
        names.append(name)
    dashboard_long(obs, dim_series).createOrReplaceTempView("v_dashboard_consolidado")
    names.append("v_dashboard_consolidado")
    return names
