"""The served views as catalog views over the stored tables (SNK-6, SNK-7).

``CREATE OR REPLACE VIEW`` needs SQL text, so the views of ``plans.views`` are written here as
statements over a fact table and a series dimension. A view keeps its text only: it reads
the tables as they are when it is queried, follows a switch of their location, and is seen
by every session that shares the catalog.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from obsflow.plans.views import ensure_namespaces
from obsflow.schema import CHANGE_LABELS, VALID_STATUS


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _base(fact: str, name: str, series: Sequence[str] | str | None) -> str:
    if isinstance(series, str):
        chosen = f" AND ({series})"
    elif series is not None:
        chosen = f" AND series_id IN ({', '.join(map(_literal, series))})" if len(series) else " AND false"
    else:
        chosen = ""
    return f"SELECT series_id, observation_date, value AS {name} FROM {fact} WHERE status_code = '{VALID_STATUS}' AND value IS NOT NULL{chosen}"


def _change(name: str, rows: int, digits: int) -> str:
    """Percent change against the row ``rows`` before."""
    return f"round(try_divide({name} - lag({name}, {rows}) OVER w, lag({name}, {rows}) OVER w) * 100, {digits})"


def _view(fact: str, name: str, series: Sequence[str] | str | None, columns: Mapping[str, str]) -> str:
    shown = ", ".join(f"{expr} AS {alias}" for alias, expr in columns.items())
    return f"SELECT series_id, observation_date, {shown} FROM ({_base(fact, name, series)}) WINDOW w AS (PARTITION BY series_id ORDER BY observation_date)"


def _direction(name: str) -> str:
    step = f"sign({name} - lag({name}) OVER w)"
    return f"element_at(map(1, '{CHANGE_LABELS['up']}', -1, '{CHANGE_LABELS['down']}', 0, '{CHANGE_LABELS['same']}'), cast({step} AS int))"


def view_statements(fact: str, dim_series: str, series_by_view: Mapping[str, Sequence[str] | str] | None = None) -> dict[str, str]:
    """The SELECT of each served view; ``series_by_view`` pins a view to its series, by a list of
    ids or a SQL predicate on the fact's columns."""
    pinned = dict(series_by_view or {})
    last12 = "OVER (PARTITION BY series_id ORDER BY observation_date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
    growth = "ln(CASE WHEN variacion_mensual_pct > -100 THEN 1 + variacion_mensual_pct / 100 END)"
    bad = f"count_if(variacion_mensual_pct <= -100) {last12}"
    day = "uf_clp - lag(uf_clp) OVER w"
    tables: dict[str, tuple[str, dict[str, str]]] = {
        "v_uf_diaria": ("uf_clp", {"uf_clp": "uf_clp", "cambio_diario_clp": day, "variacion_pct": _change("uf_clp", 1, 6)}),
        "v_tipo_cambio": (
            "clp_per_usd",
            {
                "clp_per_usd": "clp_per_usd",
                "cambio_diario_clp": "clp_per_usd - lag(clp_per_usd) OVER w",
                "variacion_pct": _change("clp_per_usd", 1, 4),
                "media_movil_7d": "avg(clp_per_usd) OVER (PARTITION BY series_id ORDER BY observation_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)",
            },
        ),
        "v_tpm": ("tpm_pct", {"tpm_pct": "tpm_pct", "cambio_pp": "tpm_pct - lag(tpm_pct) OVER w", "movimiento": _direction("tpm_pct")}),
        "v_ipc_mensual": (
            "variacion_mensual_pct",
            {
                "variacion_mensual_pct": "variacion_mensual_pct",
                "variacion_12m_pct": f"CASE WHEN {bad} = 0 THEN round((exp(sum({growth}) {last12}) - 1) * 100, 4) END",
                "meses_en_ventana": f"count(*) {last12}",
            },
        ),
        "v_imacec": (
            "imacec_indice",
            {"imacec_indice": "imacec_indice", "variacion_12m_pct": _change("imacec_indice", 12, 2), "variacion_mensual_pct": _change("imacec_indice", 1, 2)},
        ),
        "v_pib_trimestral": (
            "pib_mmm_clp_encadenados",
            {
                "anio": "year(observation_date)",
                "trimestre": "quarter(observation_date)",
                "pib_mmm_clp_encadenados": "pib_mmm_clp_encadenados",
                "variacion_trimestral_pct": _change("pib_mmm_clp_encadenados", 1, 2),
                "variacion_12m_pct": _change("pib_mmm_clp_encadenados", 4, 2),
            },
        ),
    }
    views = {view: _view(fact, name, pinned.get(view), columns) for view, (name, columns) in tables.items()}
    views["v_dashboard_consolidado"] = (
        "SELECT o.observation_date, o.frequency, o.series_id, coalesce(d.name, o.series_id) AS series_nombre, d.unit AS unidad, o.value, "
        "year(o.observation_date) AS anio, month(o.observation_date) AS mes, quarter(o.observation_date) AS trimestre "
        f"FROM {fact} o LEFT JOIN {dim_series} d ON d.series_id = o.series_id WHERE o.status_code = '{VALID_STATUS}' AND o.value IS NOT NULL"
    )
    return views


def create_views(
    spark: SparkSession, fact: str, dim_series: str, series_by_view: Mapping[str, Sequence[str] | str] | None = None, namespace: str = "analytics"
) -> list[str]:
    """Create or replace every served view in ``namespace``; returns their full names."""
    ensure_namespaces(spark, (namespace,))
    names = []
    for view, text in view_statements(fact, dim_series, series_by_view).items():
        spark.sql(f"CREATE OR REPLACE VIEW `{namespace}`.{view} AS {text}")
        names.append(f"{namespace}.{view}")
    return names
