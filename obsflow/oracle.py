"""Independent SQL (DuckDB dialect) for every registered query.

These texts re-derive the same results from the raw tables with plain SQL: they share no
code with the DataFrame builders, so a match is evidence that the builders are right.
"""

from __future__ import annotations

from obsflow.plans.reports import CADENCE_DAYS
from obsflow.schema import DIM_FREQUENCY_ROWS
from obsflow.sources.adapters import DIM_SEED, SEED_UPDATED_AT
from obsflow.sources.landing_fixture import IGNORED_SHAPES, NAME_PREFIX, REJECT_CASES


def _lit(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def _stamp() -> str:
    return "CAST(observation_date AS TIMESTAMP) + INTERVAL 1 DAY"


def _gapped(source_sql: str, null_every: int, nd_every: int) -> str:
    return f"""SELECT series_id, observation_date,
       CASE WHEN day(observation_date) % {null_every} = 0 THEN NULL ELSE v END AS value,
       CASE WHEN day(observation_date) % {nd_every} = 0 THEN 'ND' ELSE 'OK' END AS status_code,
       'daily' AS frequency, {_stamp()} AS ingested_at
FROM ({source_sql}) q"""


OBS_DAILY = _gapped(
    """SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS observation_date,
          CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v
   FROM orders GROUP BY 1, 2""",
    13,
    10,
)
OBS_RATE = _gapped(
    """SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS observation_date,
          CAST(COUNT(*) AS DOUBLE) AS v
   FROM orders GROUP BY 1, 2""",
    13,
    10,
)
OBS_EVENTS = _gapped(
    """SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_date,
          CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v
   FROM events GROUP BY 1, 2""",
    7,
    10,
)


def _orders_by(unit: str, frequency: str, suffix: str = "") -> str:
    sid = f"o_orderpriority || '{suffix}'" if suffix else "o_orderpriority"
    return f"""SELECT series_id, observation_date, value, 'OK' AS status_code, '{frequency}' AS frequency,
       {_stamp()} AS ingested_at
FROM (SELECT {sid} AS series_id, CAST(date_trunc('{unit}', o_orderdate) AS DATE) AS observation_date,
             CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
      FROM orders GROUP BY 1, 2) q"""


OBS_MONTHLY = _orders_by("month", "monthly")
OBS_QUARTERLY = _orders_by("quarter", "quarterly")


def _pct(prefix: str = "") -> str:
    sid = f"'{prefix}' || l_returnflag" if prefix else "l_returnflag"
    return f"""SELECT series_id, observation_date, value, 'OK' AS status_code, 'monthly' AS frequency,
       {_stamp()} AS ingested_at
FROM (SELECT {sid} AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS observation_date,
             CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS value
      FROM lineitem GROUP BY 1, 2) q"""


OBS_PCT = _pct()
OBS_RATE_N = _gapped(
    """SELECT o_orderpriority || '.N' AS series_id, CAST(o_orderdate AS DATE) AS observation_date,
          CAST(COUNT(*) AS DOUBLE) AS v
   FROM orders GROUP BY 1, 2""",
    13,
    10,
)

OBSERVATIONS = f"""{OBS_DAILY}
UNION ALL
{OBS_RATE_N}
UNION ALL
{_orders_by('month', 'monthly', '.M')}
UNION ALL
{_orders_by('quarter', 'quarterly', '.Q')}
UNION ALL
{_pct('RF-')}"""

DIM_SEED_SQL = "SELECT * FROM (VALUES " + ",\n  ".join(
    "(" + ", ".join(_lit(v) for v in row) + f", TIMESTAMP '{SEED_UPDATED_AT}')" for row in DIM_SEED
) + ") AS t(series_id, name, unit, frequency, description, updated_at)"

VALID = "status_code = 'OK' AND value IS NOT NULL"

FAMILY = {
    "daily_value": "frequency = 'daily' AND NOT ends_with(series_id, '.N')",
    "daily_count": "ends_with(series_id, '.N')",
    "monthly_value": "ends_with(series_id, '.M')",
    "quarterly_value": "ends_with(series_id, '.Q')",
    "monthly_pct": "starts_with(series_id, 'RF-')",
}


def _fam(name: str) -> str:
    return f"SELECT * FROM ({OBSERVATIONS}) f WHERE {FAMILY[name]}"


def _view(obs: str, body: str) -> str:
    return f"WITH obs AS ({obs}),\nbase AS (SELECT * FROM obs WHERE {VALID})\n{body}"


W = "PARTITION BY series_id ORDER BY observation_date"


def _pct_sql(col: str, n: int, digits: int) -> str:
    lag = f"LAG({col}, {n}) OVER ({W})"
    return f"ROUND(({col} - {lag}) / NULLIF({lag}, 0) * 100, {digits})"


VIEW_UF_DIARIA = _view(
    _fam("daily_value"),
    f"""SELECT series_id, observation_date, value AS uf_clp,
       value - LAG(value) OVER ({W}) AS cambio_diario_clp,
       {_pct_sql('value', 1, 6)} AS variacion_pct
FROM base""",
)

VIEW_TIPO_CAMBIO = _view(
    _fam("daily_value"),
    f"""SELECT series_id, observation_date, value AS clp_per_usd,
       value - LAG(value) OVER ({W}) AS cambio_diario_clp,
       {_pct_sql('value', 1, 4)} AS variacion_pct,
       AVG(value) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS media_movil_7d
FROM base""",
)

VIEW_TPM = _view(
    _fam("daily_count"),
    f"""SELECT series_id, observation_date, tpm_pct, tpm_pct - before AS cambio_pp,
       ['baja', 'sin_cambio', 'alza'][CAST(sign(tpm_pct - before) AS INTEGER) + 2] AS movimiento
FROM (SELECT series_id, observation_date, value AS tpm_pct, LAG(value) OVER ({W}) AS before FROM base)""",
)

VIEW_IPC_MENSUAL = _view(
    _fam("monthly_pct"),
    f"""SELECT series_id, observation_date, value AS variacion_mensual_pct,
       CASE WHEN SUM(CASE WHEN 1 + value / 100 <= 0 THEN 1 ELSE 0 END)
                 OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) > 0 THEN NULL
            ELSE ROUND((EXP(SUM(LN(GREATEST(1 + value / 100, 1e-300)))
                 OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)) - 1) * 100, 4) END AS variacion_12m_pct,
       COUNT(*) OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS meses_en_ventana
FROM base""",
)

VIEW_IMACEC = _view(
    _fam("monthly_value"),
    f"""SELECT series_id, observation_date, value AS imacec_indice,
       {_pct_sql('value', 12, 2)} AS variacion_12m_pct,
       {_pct_sql('value', 1, 2)} AS variacion_mensual_pct
FROM base""",
)

VIEW_PIB_TRIMESTRAL = _view(
    _fam("quarterly_value"),
    f"""SELECT series_id, observation_date,
       CAST(EXTRACT(YEAR FROM observation_date) AS INTEGER) AS anio,
       CAST(EXTRACT(QUARTER FROM observation_date) AS INTEGER) AS trimestre,
       value AS pib_mmm_clp_encadenados,
       {_pct_sql('value', 1, 2)} AS variacion_trimestral_pct,
       {_pct_sql('value', 4, 2)} AS variacion_12m_pct
FROM base""",
)

DASHBOARD_LONG = f"""WITH obs AS ({OBSERVATIONS}), dim AS ({DIM_SEED_SQL})
SELECT o.observation_date, o.frequency, o.series_id,
       COALESCE(s.name, o.series_id) AS series_nombre, s.unit AS unidad, o.value,
       CAST(EXTRACT(YEAR FROM o.observation_date) AS INTEGER) AS anio,
       CAST(EXTRACT(MONTH FROM o.observation_date) AS INTEGER) AS mes,
       CAST(EXTRACT(QUARTER FROM o.observation_date) AS INTEGER) AS trimestre
FROM obs o LEFT JOIN dim s USING (series_id)
WHERE o.status_code = 'OK' AND o.value IS NOT NULL"""

VALID_OBSERVATIONS = f"WITH obs AS ({OBSERVATIONS}) SELECT series_id, observation_date, value, frequency FROM obs WHERE {VALID}"

SQL: dict[str, str] = {
    "valid_observations": VALID_OBSERVATIONS,
    "view_uf_diaria": VIEW_UF_DIARIA,
    "view_tipo_cambio": VIEW_TIPO_CAMBIO,
    "view_tpm": VIEW_TPM,
    "view_ipc_mensual": VIEW_IPC_MENSUAL,
    "view_imacec": VIEW_IMACEC,
    "view_pib_trimestral": VIEW_PIB_TRIMESTRAL,
    "dashboard_long": DASHBOARD_LONG,
}


# ------------------------------------------------------------------- landing and payloads

_CASES = "SELECT * FROM (VALUES " + ", ".join(f"({k}, {_lit(r)}, {_lit(NAME_PREFIX.get(k, ''))})" for k, r in REJECT_CASES) + ") AS t(k, reason, mark)"
_SHAPES = "SELECT * FROM (VALUES " + ", ".join(f"({_lit(s)})" for s in IGNORED_SHAPES) + ") AS t(shape)"

# the two load stamps of the queries
LOAD_1, LOAD_2 = "TIMESTAMP '2026-01-01 00:00:00'", "TIMESTAMP '2026-02-01 00:00:00'"

LANDING_CTE = f"""ev AS ({OBS_EVENTS}),
last AS (SELECT series_id, max(observation_date) AS last_day FROM ev GROUP BY 1),
monthly AS (SELECT event_type || '.M' AS series_id, CAST(date_trunc('month', ts) AS DATE) AS observation_date,
                   CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
            FROM events GROUP BY 1, 2),
cases AS ({_CASES}),
shapes AS ({_SHAPES}),
daily_files AS (SELECT 'raw/daily/' || series_id || '/' || strftime(observation_date, '%Y-%m-%d') || '.json' AS relative_path,
                       day(observation_date) AS dom FROM ev),
monthly_files AS (SELECT 'raw/monthly/' || series_id || '/' || strftime(observation_date, '%Y-%m') || '.json' AS relative_path FROM monthly),
reject_files AS (SELECT 'raw/daily/' || l.series_id || '/' || c.mark || strftime(l.last_day + c.k, '%Y-%m-%d') || '.json' AS relative_path, c.reason
                 FROM last l CROSS JOIN cases c),
ignored_files AS (SELECT replace(replace(s.shape, '{{s}}', l.series_id), '{{d}}', strftime(l.last_day, '%Y-%m-%d')) AS relative_path
                  FROM last l CROSS JOIN shapes s),
all_files AS (SELECT relative_path FROM daily_files UNION ALL SELECT relative_path FROM monthly_files
              UNION ALL SELECT relative_path FROM reject_files UNION ALL SELECT relative_path FROM ignored_files),
loaded AS (SELECT series_id, observation_date, value, status_code, frequency FROM ev
           UNION ALL SELECT series_id, observation_date, value, 'OK', 'monthly' FROM monthly)"""

_PATH_RE = r"^raw/(daily|monthly|quarterly)/([^/]+)/([^/]+)\.json$"

SQL.update(
    {
        "landing_scan": f"WITH {LANDING_CTE} SELECT relative_path FROM all_files",
        "landing_prefix_scan": f"WITH {LANDING_CTE} SELECT relative_path FROM all_files WHERE starts_with(relative_path, 'raw/monthly/')",
        "landing_path_decode": f"""WITH {LANDING_CTE}
SELECT relative_path, regexp_matches(relative_path, '{_PATH_RE}') AS on_pattern,
       CASE WHEN regexp_matches(relative_path, '{_PATH_RE}') THEN regexp_extract(relative_path, '{_PATH_RE}', 1) END AS frequency,
       CASE WHEN regexp_matches(relative_path, '{_PATH_RE}') THEN regexp_extract(relative_path, '{_PATH_RE}', 2) END AS series_id,
       CASE WHEN regexp_matches(relative_path, '{_PATH_RE}') THEN regexp_extract(relative_path, '{_PATH_RE}', 3) END AS period_label
FROM all_files""",
        "payload_flatten": f"WITH {LANDING_CTE} SELECT *, {LOAD_1} AS ingested_at FROM loaded",
        "payload_rejects": f"WITH {LANDING_CTE} SELECT relative_path, reason FROM reject_files WHERE reason IS NOT NULL",
        "unparseable_counts": f"""WITH {LANDING_CTE}
SELECT series_id, CAST(count(*) FILTER (WHERE value IS NULL AND day(observation_date) % 14 <> 0) AS BIGINT) AS unparseable_values
FROM ev GROUP BY 1
UNION ALL SELECT series_id, CAST(0 AS BIGINT) FROM monthly GROUP BY 1""",
        "load_summary": f"""WITH {LANDING_CTE}
SELECT (SELECT count(*) FROM daily_files) + (SELECT count(*) FROM monthly_files)
         + (SELECT count(*) FROM reject_files WHERE reason IS NULL) AS files_scanned,
       (SELECT count(*) FROM ignored_files) AS files_skipped,
       (SELECT count(*) FROM reject_files WHERE reason IS NOT NULL) AS files_failed,
       (SELECT count(*) FROM loaded) AS rows_extracted""",
        "bulk_reload": f"WITH {LANDING_CTE} SELECT *, {LOAD_2} AS ingested_at FROM loaded",
        "payload_roundtrip": f"SELECT series_id, observation_date, value / 7 AS value, status_code, frequency, {LOAD_1} AS ingested_at FROM ({OBS_EVENTS}) q",
        "value_coercion": r"""WITH r AS (
  SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, o_orderkey % 12 AS k FROM orders),
raw AS (
  SELECT o_orderkey, CASE k WHEN 0 THEN 'NA' WHEN 1 THEN ' ' || price || ' ' WHEN 2 THEN 'nan' WHEN 3 THEN ''
    WHEN 4 THEN 'NULL' WHEN 5 THEN price || 'x' WHEN 6 THEN '+' || price WHEN 7 THEN replace(price, '.', ',')
    WHEN 8 THEN price || 'e2' WHEN 9 THEN '1_' || price WHEN 10 THEN '-inf' ELSE price END AS raw FROM r)
SELECT o_orderkey, raw,
  CASE WHEN raw IS NULL OR trim(raw) = '' OR upper(trim(raw)) IN ('NA', 'NAN', 'NULL') THEN NULL
       WHEN regexp_full_match(trim(raw), '[+-]?(?:[0-9](?:_?[0-9])*(?:\.(?:[0-9](?:_?[0-9])*)?)?|\.[0-9](?:_?[0-9])*)(?:[eE][+-]?[0-9](?:_?[0-9])*)?')
         THEN CAST(replace(trim(raw), '_', '') AS DOUBLE)
       WHEN regexp_full_match(lower(trim(raw)), '[+-]?(?:inf|infinity)')
         THEN CASE WHEN starts_with(trim(raw), '-') THEN CAST('-inf' AS DOUBLE) ELSE CAST('inf' AS DOUBLE) END
       WHEN regexp_full_match(lower(trim(raw)), '[+-]?nan') THEN CAST('nan' AS DOUBLE)
  END AS value
FROM raw""",
        "upsert_observations": f"""WITH ev AS ({OBS_EVENTS})
SELECT series_id, observation_date, value, status_code, frequency, TIMESTAMP '2026-01-01 00:00:00' AS ingested_at
FROM ev WHERE day(observation_date) <= 14
UNION ALL
SELECT series_id, observation_date, value + 1, status_code, frequency, TIMESTAMP '2026-02-01 00:00:00'
FROM ev WHERE day(observation_date) >= 15""",
        "upsert_empty_noop": f"""WITH ev AS ({OBS_EVENTS})
SELECT series_id, observation_date, value, status_code, frequency, TIMESTAMP '2026-01-01 00:00:00' AS ingested_at,
       CAST(0 AS BIGINT) AS rows_sent
FROM ev""",
        "landing_write_if_absent": f"""WITH {LANDING_CTE}
SELECT relative_path, CASE WHEN dom <= 10 THEN 'skipped' ELSE 'written' END AS outcome FROM daily_files""",
        "upsert_dim_series": f"""WITH obs AS ({OBSERVATIONS}), seed AS ({DIM_SEED_SQL}),
src AS (SELECT DISTINCT series_id, frequency FROM obs)
SELECT series_id, 'Serie ' || series_id AS name, 'USD' AS unit, frequency, CAST(NULL AS VARCHAR) AS description,
       TIMESTAMP '2026-02-01 00:00:00' AS updated_at FROM src
UNION ALL
SELECT * FROM seed WHERE series_id NOT IN (SELECT series_id FROM src)""",
        "split_payload_by_day": f"""WITH d AS ({OBS_DAILY})
SELECT series_id, strftime(observation_date, '%Y-%m-%d') AS period_label, observation_date, value / 7 AS value, status_code FROM d""",
    }
)


# ---------------------------------------------------------------- calendars, plans, reports


def _label(freq: str, d: str) -> str:
    return (
        f"CASE {freq} WHEN 'daily' THEN strftime({d}, '%Y-%m-%d') WHEN 'monthly' THEN strftime({d}, '%Y-%m') "
        f"ELSE strftime({d}, '%Y') || '-Q' || CAST(quarter({d}) AS VARCHAR) END"
    )


FREQ_VALUES = "(VALUES ('daily'), ('monthly'), ('quarterly')) AS f(frequency)"
OBS_CTE = f"obs AS ({OBSERVATIONS})"
BOUNDS = "bounds AS (SELECT min(observation_date) AS mn, max(observation_date) AS mx FROM obs)"
CAT = "cat AS (SELECT DISTINCT series_id, frequency FROM obs)"
LANDED = f"landed AS (SELECT DISTINCT series_id, {_label('frequency', 'observation_date')} AS period_label FROM obs WHERE status_code = 'OK')"
AVAIL = f"avail AS (SELECT DISTINCT series_id, {_label('frequency', 'observation_date')} AS period_label FROM obs)"
PLAN = """plan AS (
  SELECT c.series_id, c.frequency, CAST(g.d AS DATE) AS first_date
  FROM cat c, bounds b,
       LATERAL (SELECT unnest(generate_series(
                  CASE c.frequency WHEN 'daily' THEN CAST(b.mn AS TIMESTAMP)
                                   WHEN 'monthly' THEN CAST(date_trunc('month', b.mn) AS TIMESTAMP)
                                   ELSE CAST(date_trunc('quarter', b.mn) AS TIMESTAMP) END,
                  CAST(b.mx AS TIMESTAMP),
                  CASE c.frequency WHEN 'daily' THEN INTERVAL 1 DAY WHEN 'monthly' THEN INTERVAL 1 MONTH
                                   ELSE INTERVAL 3 MONTH END)) AS d) g),
planned AS (
  SELECT series_id, frequency, first_date, """ + _label("frequency", "first_date") + """ AS period_label FROM plan),
planned_paths AS (
  SELECT *, 'raw/' || frequency || '/' || series_id || '/' || period_label || '.json' AS relative_path FROM planned)"""

PREV_WINDOW = """CASE frequency WHEN 'daily' THEN as_of - 1
            WHEN 'monthly' THEN CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE)
            ELSE CAST(date_trunc('quarter', as_of) - INTERVAL 3 MONTH AS DATE) END"""
PREV_LAST = """CASE frequency WHEN 'daily' THEN as_of - 1
            WHEN 'monthly' THEN CAST(date_trunc('month', as_of) AS DATE) - 1
            ELSE CAST(date_trunc('quarter', as_of) AS DATE) - 1 END"""

FAILING = """failing AS (SELECT day(ts) AS day, 'SourceError: ' || count(*) FILTER (WHERE event_type = 'error') || ' of ' || count(*) AS error
  FROM events GROUP BY 1 HAVING 5 * count(*) FILTER (WHERE event_type = 'error') > count(*))"""

_SEED = f"seed AS ({DIM_SEED_SQL})"
_DIMF = "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in DIM_FREQUENCY_ROWS) + ") AS t(frequency, description, schedule_cron)"
_CAD = "SELECT * FROM (VALUES " + ", ".join(f"({_lit(k)}, {v})" for k, v in CADENCE_DAYS.items()) + ") AS t(frequency, cadence_days)"


def _win_sql(obs: str, cols: str) -> str:
    return f"WITH obs AS ({obs}), base AS (SELECT series_id, observation_date, value AS v FROM obs WHERE {VALID})\nSELECT series_id, observation_date, v, {cols} FROM base"


_COVERAGE = f"""WITH {OBS_CTE}, {CAT}, {BOUNDS}, {FAILING},
n AS (SELECT series_id, count(*) AS observations FROM obs, bounds
      WHERE observation_date BETWEEN bounds.mx - 90 AND bounds.mx GROUP BY 1),
cov AS (SELECT c.series_id, c.frequency, CASE WHEN f.day IS NULL THEN coalesce(n.observations, 0) ELSE 0 END AS observations,
       CASE WHEN f.day IS NOT NULL THEN 'FAIL' WHEN n.observations > 0 THEN 'OK' ELSE 'EMPTY' END AS status, f.error
FROM cat c LEFT JOIN n USING (series_id) LEFT JOIN failing f ON f.day = (1 + length(c.series_id)) % 31)"""

_RUN_OUTCOMES = f"""WITH {OBS_CTE}, {CAT}, {LANDED}, {AVAIL}, {FAILING},
runs AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders),
rf AS (SELECT as_of, f.frequency FROM runs CROSS JOIN {FREQ_VALUES}),
w AS (SELECT as_of, frequency, {PREV_WINDOW} AS first_date FROM rf),
t AS (SELECT w.as_of, w.frequency, c.series_id, {_label('w.frequency', 'w.first_date')} AS period_label FROM w JOIN cat c ON c.frequency = w.frequency),
o AS (SELECT t.*, f.error, CASE WHEN l.series_id IS NOT NULL THEN 'skipped' WHEN f.day IS NOT NULL THEN 'error'
                       WHEN a.series_id IS NOT NULL THEN 'written' ELSE 'empty' END AS outcome
      FROM t LEFT JOIN landed l USING (series_id, period_label) LEFT JOIN avail a USING (series_id, period_label)
      LEFT JOIN failing f ON f.day = (day(t.as_of) + length(t.series_id)) % 31)"""

SQL.update(
    {
        "period_windows": f"""WITH runs AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders),
rf AS (SELECT as_of, f.frequency FROM runs CROSS JOIN {FREQ_VALUES}),
w AS (SELECT as_of, frequency, {PREV_WINDOW} AS first_date, {PREV_LAST} AS last_date FROM rf)
SELECT as_of, frequency, first_date, last_date, {_label('frequency', 'first_date')} AS period_label FROM w""",
        "calendar_days": f"""WITH q AS ({OBS_QUARTERLY}), b AS (SELECT series_id, min(observation_date) mn, max(observation_date) mx FROM q GROUP BY 1)
SELECT series_id, CAST(unnest(generate_series(CAST(mn AS TIMESTAMP), CAST(mx AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM b""",
        "calendar_months": f"""WITH q AS ({OBS_DAILY}), b AS (SELECT series_id, min(observation_date) mn, max(observation_date) mx FROM q GROUP BY 1),
m AS (SELECT series_id, CAST(unnest(generate_series(CAST(date_trunc('month', mn) AS TIMESTAMP), CAST(mx AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS first_date FROM b)
SELECT series_id, first_date, last_day(first_date) AS last_date, strftime(first_date, '%Y-%m') AS period_label FROM m""",
        "calendar_quarters": f"""WITH q AS ({OBS_DAILY}), b AS (SELECT series_id, min(observation_date) mn, max(observation_date) mx FROM q GROUP BY 1),
m AS (SELECT series_id, CAST(unnest(generate_series(CAST(date_trunc('quarter', mn) AS TIMESTAMP), CAST(mx AS TIMESTAMP), INTERVAL 3 MONTH)) AS DATE) AS first_date FROM b)
SELECT series_id, first_date, last_day(CAST(first_date + INTERVAL 2 MONTH AS DATE)) AS last_date,
       strftime(first_date, '%Y') || '-Q' || CAST(quarter(first_date) AS VARCHAR) AS period_label FROM m""",
        "calendar_year_chunks": f"""WITH q AS ({OBS_DAILY}), b AS (SELECT series_id, min(observation_date) mn, max(observation_date) mx FROM q GROUP BY 1),
y AS (SELECT series_id, mn, mx, CAST(unnest(generate_series(year(mn), year(mx))) AS INTEGER) AS year FROM b)
SELECT series_id, year, greatest(mn, make_date(year, 1, 1)) AS first_date, least(mx, make_date(year, 12, 31)) AS last_date FROM y""",
        "trailing_range": f"""WITH {OBS_CTE}, b AS (SELECT series_id, max(observation_date) mx FROM obs GROUP BY 1)
SELECT series_id, CAST(mx - INTERVAL 5 YEAR AS DATE) AS start_date, mx AS end_date FROM b""",
        "landing_paths": f"""WITH {OBS_CTE}
SELECT series_id, observation_date,
       'raw/' || frequency || '/' || series_id || '/' || ({_label('frequency', 'observation_date')}) || '.json' AS relative_path FROM obs""",
        "backfill_plan": f"""WITH {OBS_CTE}, {BOUNDS}, {CAT}, {LANDED}, {PLAN}
SELECT p.series_id, p.frequency, p.period_label, p.relative_path,
       CASE WHEN l.series_id IS NULL THEN 'missing' ELSE 'landed' END AS status
FROM planned_paths p LEFT JOIN landed l USING (series_id, period_label)""",
        "missing_periods": f"""WITH {OBS_CTE}, {BOUNDS}, {CAT}, {LANDED}, {PLAN}
SELECT series_id, frequency, period_label, relative_path FROM planned_paths p
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.series_id = p.series_id AND l.period_label = p.period_label)""",
        "landed_periods": f"""WITH {OBS_CTE}, {BOUNDS}, {CAT}, {LANDED}, {PLAN}
SELECT series_id, frequency, period_label, relative_path FROM planned_paths p
WHERE EXISTS (SELECT 1 FROM landed l WHERE l.series_id = p.series_id AND l.period_label = p.period_label)""",
        "backfill_dry_run": f"""WITH {OBS_CTE}, {BOUNDS}, {CAT}, {PLAN}
SELECT series_id, count(*) AS planned FROM planned GROUP BY 1""",
        "backfill_dry_run_counters": f"""WITH {OBS_CTE}, {BOUNDS}, {CAT}, {PLAN}, n AS (SELECT series_id, count(*) AS written FROM planned GROUP BY 1)
SELECT series_id, written, 0 * written AS skipped, 0 * written AS empty, 0 * written AS errors
FROM (SELECT * FROM n UNION ALL SELECT NULL, CAST(sum(written) AS BIGINT) FROM n) t""",
        "backfill_outcomes": f"""WITH {OBS_CTE}, {BOUNDS}, {CAT}, {LANDED}, {AVAIL}, {PLAN}, {FAILING},
s AS (SELECT p.*, CASE WHEN l.series_id IS NULL THEN 'missing' ELSE 'landed' END AS status,
             a.series_id IS NOT NULL AS has_data,
             CASE WHEN p.frequency = 'daily' THEN CAST(year(p.first_date) AS VARCHAR) ELSE p.period_label END AS chunk
      FROM planned p LEFT JOIN landed l USING (series_id, period_label) LEFT JOIN avail a USING (series_id, period_label)),
c AS (SELECT *, sum(CASE WHEN status = 'missing' THEN 1 ELSE 0 END) OVER (PARTITION BY series_id, chunk) AS chunk_missing,
             (length(series_id) + year(first_date) + CASE WHEN frequency = 'daily' THEN 0 ELSE month(first_date) END) % 31 IN (SELECT day FROM failing) AS failed FROM s),
o AS (SELECT series_id, chunk, CASE WHEN status = 'landed' AND (frequency <> 'daily' OR chunk_missing = 0) THEN 'skipped'
                             WHEN status = 'landed' THEN NULL WHEN failed THEN 'error'
                             WHEN has_data THEN 'written' ELSE 'empty' END AS outcome FROM c)
SELECT series_id, count(*) FILTER (WHERE outcome = 'written') AS written, count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
       count(*) FILTER (WHERE outcome = 'empty') AS empty, count(DISTINCT (series_id, chunk)) FILTER (WHERE outcome = 'error') AS errors
FROM o GROUP BY ROLLUP (series_id)""",
        "run_summary": f"""{_RUN_OUTCOMES}
SELECT as_of, frequency, max(period_label) AS period_label,
       count(*) FILTER (WHERE outcome = 'written') AS processed, count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
       coalesce(list_sort(list(series_id) FILTER (WHERE outcome = 'empty')), []) AS empty,
       coalesce(list(series_id || ': ' || error ORDER BY series_id) FILTER (WHERE outcome = 'error'), []) AS errors
FROM o GROUP BY as_of, frequency""",
        "run_lists": f"""{_RUN_OUTCOMES},
r AS (SELECT *, (row_number() OVER (PARTITION BY as_of, frequency, outcome ORDER BY series_id) - 1) // 4 AS chunk FROM o WHERE outcome IN ('empty', 'error'))
SELECT as_of, frequency, outcome, CAST(chunk AS BIGINT) AS chunk, list(series_id ORDER BY series_id) AS ids,
       list(CASE WHEN outcome = 'error' THEN error ELSE '' END ORDER BY series_id) AS errors FROM r GROUP BY 1, 2, 3, 4""",
        "catalog_flatten": f"""WITH {OBS_CTE}, {CAT}, {_SEED}
SELECT c.series_id, coalesce(s.name, c.series_id) AS name, coalesce(s.unit, 'USD') AS unit, c.frequency,
       coalesce(s.description, '') AS description
FROM cat c LEFT JOIN seed s USING (series_id)""",
        "catalog_by_frequency": f"""WITH {OBS_CTE}, {CAT}, {_SEED}
SELECT c.series_id, coalesce(s.name, c.series_id) AS name, coalesce(s.unit, 'USD') AS unit, c.frequency,
       coalesce(s.description, '') AS description
FROM cat c LEFT JOIN seed s USING (series_id) WHERE c.frequency = 'monthly'""",
        "dim_frequency": f"""WITH {OBS_CTE}, {CAT}, d AS ({_DIMF}), n AS (SELECT frequency, count(*) AS series FROM cat GROUP BY 1)
SELECT d.frequency, d.description, d.schedule_cron, coalesce(n.series, 0) AS series FROM d LEFT JOIN n USING (frequency)""",
        "load_inventory": f"""WITH {OBS_CTE}
SELECT frequency, count(*) AS rows, max(observation_date) AS latest, max(ingested_at) AS last_load FROM obs GROUP BY frequency""",
        "freshness_report": f"""WITH {OBS_CTE}, {_SEED}, {BOUNDS},
latest AS (SELECT series_id, max(observation_date) AS latest_obs FROM obs GROUP BY 1)
SELECT l.series_id, s.name, l.latest_obs, CAST(date_diff('day', l.latest_obs, (SELECT mx FROM bounds) + 1) AS INTEGER) AS days_stale
FROM latest l LEFT JOIN seed s USING (series_id)""",
        "series_coverage": f"{_COVERAGE} SELECT * FROM cov",
        "coverage_state": f"""{_COVERAGE}
SELECT count(*) AS series, count(*) FILTER (WHERE status = 'OK') AS ok, count(*) FILTER (WHERE status = 'EMPTY') AS empty,
       count(*) FILTER (WHERE status = 'FAIL') AS failed, count(*) FILTER (WHERE status = 'FAIL') = 0 AS passed FROM cov""",
        "error_counts": f"""WITH {LANDING_CTE}
SELECT regexp_extract(relative_path, '{_PATH_RE}', 2) AS series_id, count(*) AS errors
FROM reject_files WHERE reason IS NOT NULL GROUP BY 1""",
        "alert_error_rate": """WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS events,
                  count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, events, errors, errors / events AS error_rate
FROM w WHERE errors / events > 0.2""",
        "alert_silent_series": f"""WITH {OBS_CTE}, {BOUNDS}, {CAT},
checks AS (SELECT c.series_id, CAST(unnest(generate_series(CAST(b.mn AS TIMESTAMP), CAST(b.mx AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS check_date
           FROM cat c, bounds b WHERE c.frequency = 'daily'),
loads AS (SELECT DISTINCT series_id, CAST(ingested_at AS DATE) AS check_date FROM obs)
SELECT series_id, check_date FROM checks
WHERE NOT EXISTS (SELECT 1 FROM loads l WHERE l.series_id = checks.series_id AND l.check_date = checks.check_date)""",
        "alert_stale_series": f"""WITH {OBS_CTE}, {BOUNDS}, cad AS ({_CAD}),
latest AS (SELECT series_id, frequency, max(observation_date) AS latest_obs FROM obs GROUP BY 1, 2)
SELECT l.series_id, l.frequency, l.latest_obs,
       CAST(date_diff('day', l.latest_obs, (SELECT mx FROM bounds) + 1) AS INTEGER) AS days_since,
       CAST(c.cadence_days + 3 AS INTEGER) AS allowed_days,
       date_diff('day', l.latest_obs, (SELECT mx FROM bounds) + 1) > c.cadence_days + 3 AS stale
FROM latest l LEFT JOIN cad c USING (frequency)""",
        "win_abs_change": _win_sql(OBSERVATIONS, f"v - LAG(v) OVER ({W}) AS change, LAG(v) OVER ({W}) AS previous"),
        "win_pct_change": _win_sql(OBSERVATIONS, f"{_pct_sql('v', 1, 2)} AS pct_change"),
        "win_yoy_monthly": _win_sql(_fam("monthly_value"), f"{_pct_sql('v', 12, 2)} AS yoy_pct"),
        "win_yoy_quarterly": _win_sql(_fam("quarterly_value"), f"{_pct_sql('v', 4, 2)} AS yoy_pct"),
        "win_moving_avg": _win_sql(OBSERVATIONS, f"AVG(v) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7"),
        "win_compound": _win_sql(
            _fam("monthly_pct"),
            f"""CASE WHEN SUM(CASE WHEN 1 + v / 100 <= 0 THEN 1 ELSE 0 END) OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) > 0 THEN NULL
            ELSE ROUND((EXP(SUM(LN(GREATEST(1 + v / 100, 1e-300))) OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)) - 1) * 100, 4) END AS compound_12,
       COUNT(*) OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS rows_in_window""",
        ),
        "win_change_point": _win_sql(
            OBSERVATIONS, f"CASE sign(v - LAG(v) OVER ({W})) WHEN 1 THEN 'alza' WHEN -1 THEN 'baja' WHEN 0 THEN 'sin_cambio' END AS movement"
        ),
        "scalar_functions": f"""WITH d AS ({OBS_DAILY})
SELECT series_id, observation_date,
       value / NULLIF(day(observation_date) % 3 - 1, 0) AS safe_ratio,
       ROUND(value / 7.0, 3) AS rounded,
       ROUND(EXP(LN(value / 1e6)), 10) AS exp_ln,
       COALESCE(value, -1.0) AS value_or_default,
       CASE WHEN value > 200000 THEN 'high' WHEN value > 100000 THEN 'mid' ELSE 'low' END AS band,
       CAST(year(observation_date) AS INTEGER) AS y, CAST(month(observation_date) AS INTEGER) AS m,
       CAST(quarter(observation_date) AS INTEGER) AS q,
       CAST(date_diff('day', observation_date, last_day(observation_date)) AS INTEGER) AS days_to_month_end,
       upper(trim(status_code)) IN ('OK', 'ND') AS known_status,
       observation_date AS parsed_date, strftime(observation_date, '%d-%m-%Y') AS payload_date,
       regexp_extract(series_id, '^([0-9])-', 1) AS priority_digit,
       strftime(observation_date, '%Y') || '-Q' || CAST(quarter(observation_date) AS VARCHAR) AS quarter_label,
       last_day(observation_date) AS month_end
FROM d""",
    }
)

SQL.update(
    {
        "stream_incremental_load": f"WITH {LANDING_CTE} SELECT *, {LOAD_1} AS ingested_at FROM loaded",
        "stream_replay_idempotent": f"WITH {LANDING_CTE} SELECT *, {LOAD_2} AS ingested_at FROM loaded",
        "stream_poison_file": f"WITH {LANDING_CTE} SELECT relative_path, reason FROM reject_files WHERE reason IS NOT NULL",
    }
)

SQL["fact_scan"] = VALID_OBSERVATIONS

SQL["backfill_execute"] = f"""WITH ev AS ({OBS_EVENTS}), {FAILING},
b AS (SELECT min(observation_date) AS mn, max(observation_date) AS mx FROM ev),
s AS (SELECT DISTINCT series_id FROM ev),
days AS (SELECT s.series_id, CAST(unnest(generate_series(CAST(b.mn AS TIMESTAMP), CAST(b.mx + 6 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM s, b),
c AS (SELECT days.series_id, days.d,
             EXISTS (SELECT 1 FROM ev WHERE ev.series_id = days.series_id AND ev.observation_date = days.d AND day(days.d) <= 10) AS landed,
             EXISTS (SELECT 1 FROM ev WHERE ev.series_id = days.series_id AND ev.observation_date = days.d) AS has_data
      FROM days),
y AS (SELECT *, sum(CASE WHEN landed THEN 0 ELSE 1 END) OVER (PARTITION BY series_id, year(d)) AS chunk_missing,
             (length(series_id) + year(d)) % 31 IN (SELECT day FROM failing) AS failed FROM c),
o AS (SELECT series_id, year(d) AS chunk, CASE WHEN landed AND chunk_missing = 0 THEN 'skipped' WHEN landed THEN NULL WHEN failed THEN 'error'
                             WHEN has_data THEN 'written' ELSE 'empty' END AS outcome FROM y)
SELECT series_id, count(*) FILTER (WHERE outcome = 'written') AS written, count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
       count(*) FILTER (WHERE outcome = 'empty') AS empty, count(DISTINCT (series_id, chunk)) FILTER (WHERE outcome = 'error') AS errors
FROM o GROUP BY ROLLUP (series_id)"""

SQL["ingest_run"] = f"""WITH ev AS ({OBS_EVENTS}), {FAILING},
monthly AS (SELECT event_type || '.M' AS series_id, CAST(date_trunc('month', ts) AS DATE) AS observation_date FROM events GROUP BY 1, 2),
src AS (SELECT series_id, 'daily' AS frequency, observation_date FROM ev
        UNION ALL SELECT series_id, 'monthly', observation_date FROM monthly),
cat AS (SELECT DISTINCT series_id, frequency FROM src),
avail AS (SELECT DISTINCT series_id, {_label('frequency', 'observation_date')} AS period_label FROM src),
runs AS (SELECT DISTINCT observation_date + 1 AS as_of FROM ev),
rf AS (SELECT as_of, f.frequency FROM runs CROSS JOIN (VALUES ('daily'), ('monthly')) AS f(frequency)),
w AS (SELECT as_of, frequency, {PREV_WINDOW} AS first_date FROM rf),
t AS (SELECT w.as_of, w.frequency, c.series_id, {_label('w.frequency', 'w.first_date')} AS period_label
      FROM w JOIN cat c ON c.frequency = w.frequency),
x AS (SELECT t.*, f.error, CASE WHEN f.day IS NOT NULL THEN 'error' WHEN a.series_id IS NULL THEN 'empty' ELSE 'written' END AS outcome
      FROM t LEFT JOIN avail a USING (series_id, period_label) LEFT JOIN failing f ON f.day = (day(t.as_of) + length(t.series_id)) % 31),
o AS (SELECT * REPLACE (CASE WHEN outcome = 'written' AND row_number() OVER (PARTITION BY series_id, period_label, outcome ORDER BY as_of) > 1
                             THEN 'skipped' ELSE outcome END AS outcome) FROM x)
SELECT as_of, frequency, max(period_label) AS period_label,
       count(*) FILTER (WHERE outcome = 'written') AS processed, count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
       coalesce(list_sort(list(series_id) FILTER (WHERE outcome = 'empty')), []) AS empty,
       coalesce(list(series_id || ': ' || error ORDER BY series_id) FILTER (WHERE outcome = 'error'), []) AS errors
FROM o GROUP BY as_of, frequency"""
