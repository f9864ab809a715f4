"""Queries over the catalog's tables and views, and their oracle SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow import oracle as O
from obsflow.operators.upsert import ensure_table, read_observations
from obsflow.plans import backfill as B
from obsflow.plans import reports as R
from obsflow.plans.served import create_views
from obsflow.plans.views import ensure_namespaces
from obsflow.queries import LOAD_1, LOAD_2, _catalog, _fact, _plan_status, _seed, stored_observations
from obsflow.schema import DIM_FREQUENCY, DIM_SERIES, DIM_SERIES_COLUMNS, OBSERVATION_COLUMNS, OBSERVATIONS
from obsflow.session import configure, scratch_dir
from obsflow.sources import adapters as A
from obsflow.sources import catalog as CT
from obsflow.sources import landing_fixture as LF
from obsflow.sources.landing import rewrite, write_if_absent
from obsflow.sources.ledger import create_ledger, record
from obsflow.sources.observations import scan_observations
from obsflow.sources.tables import create_table, replace_table, upsert_table
from obsflow.streaming.incremental import start_incremental_load

_TABLES: dict[tuple[str, str], str] = {}
_PINNED = {"v_tipo_cambio": "frequency = 'daily' AND NOT endswith(series_id, '.N')", "v_tpm": "endswith(series_id, '.N')"}
_SCAN = {"series_ids": [row[0] for row in A.DIM_SEED], "first": "1994-03-01", "last": "2024-06-30"}


def _table(spark: SparkSession, kind: str, schema, granularity: str | None = None) -> str:
    """A new table in ``raw``, in a folder of its own."""
    folder = scratch_dir(spark, kind)
    ensure_namespaces(spark, ("raw",))
    name = f"raw.{kind}_{hashlib.sha1(folder.encode()).hexdigest()[:10]}"
    create_table(spark, name, schema, f"{folder}/table", granularity)
    return name


def _served(spark: SparkSession, sf_dir: str) -> None:
    """The consolidated fact and the series dimension as catalog tables, and the views on them."""
    configure(spark)
    key = (sf_dir, spark.sparkContext.applicationId)
    if key not in _TABLES:
        fact, dim = _table(spark, "observations", OBSERVATIONS, "year"), _table(spark, "dim_series", DIM_SERIES)
        upsert_table(spark, fact, A.observations(spark, sf_dir))
        upsert_table(spark, dim, _seed(spark), keys=["series_id"], columns=DIM_SERIES_COLUMNS, order_by=["updated_at"])
        _TABLES[key] = f"{fact},{dim}"
    fact, dim = _TABLES[key].split(",")
    create_views(spark, fact, dim, _PINNED)


def q_analytics_tipo_cambio(spark: SparkSession, sf_dir: str) -> DataFrame:
    _served(spark, sf_dir)
    return spark.sql("SELECT * FROM analytics.v_tipo_cambio")


def q_analytics_tpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    _served(spark, sf_dir)
    return spark.sql("SELECT * FROM analytics.v_tpm")


def q_analytics_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    _served(spark, sf_dir)
    return spark.sql("SELECT * FROM analytics.v_dashboard_consolidado")


def q_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping loads into a catalog table: the first days of every month, then the later ones."""
    configure(spark)
    ev = A.obs_events(spark, sf_dir)
    name = _table(spark, "events", OBSERVATIONS, "month")
    upsert_table(spark, name, ev.where(F.dayofmonth("observation_date") <= 20).withColumn("ingested_at", F.lit(LOAD_1).cast("timestamp")))
    later = ev.where(F.dayofmonth("observation_date") >= 15).withColumn("value", F.col("value") + 1.0)
    upsert_table(spark, name, later.withColumn("ingested_at", F.lit(LOAD_2).cast("timestamp")))
    return spark.table(name).select(*OBSERVATION_COLUMNS)


def q_dim_frequency_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequency dimension replaced twice; the fact's series are counted against the table."""
    configure(spark)
    name = _table(spark, "dim_frequency", DIM_FREQUENCY)
    replace_table(spark, name, CT.dim_frequency(spark).withColumn("description", F.lit("old")))
    replace_table(spark, name, CT.dim_frequency(spark))
    counts = _catalog(_fact(spark, sf_dir)).groupBy("frequency").agg(F.count(F.lit(1)).cast("long").alias("series"))
    return spark.table(name).join(counts, "frequency", "left").select("frequency", "description", "schedule_cron", F.coalesce("series", F.lit(0).cast("long")).alias("series"))


def q_fact_scan_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few series over a range of dates: pruned years, skipped row groups."""
    configure(spark)
    return scan_observations(spark, stored_observations(spark, sf_dir), **_SCAN)


def q_empty_table_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every catalog series against a table that was made but not loaded yet."""
    configure(spark)
    path = scratch_dir(spark, "empty-table")
    ensure_table(spark, path, OBSERVATIONS, granularity="year")
    return R.series_coverage(_catalog(_fact(spark, sf_dir)), scan_observations(spark, path), "1990-01-01", "2100-01-01")


def q_alert_error_rate_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that start every five minutes."""
    configure(spark)
    events = A.read_table(spark, sf_dir, "events")
    return R.alert_error_rate(events, "ts", F.col("event_type") == "error", 0.25, slide="5 minutes")


def q_silent_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as daily series, their events as load instants."""
    configure(spark)
    events = A.read_table(spark, sf_dir, "events")
    loads = events.select(F.col("event_type").alias("series_id"), F.col("ts").alias("loaded_at"))
    bounds = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    catalog = loads.select("series_id").distinct().withColumn("frequency", F.lit("daily"))
    return R.silent_intervals(catalog, loads, F.lit(bounds["a"]), F.lit(bounds["b"]), hours=2)


def q_stream_rewritten_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream drains the zone; a third of the payloads are rewritten in place with other values;
    the stream, restarted from its checkpoint, takes those again."""
    configure(spark)
    root, target, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "observations"), scratch_dir(spark, "checkpoint")
    write_if_absent(spark, LF.good_daily(spark, sf_dir), root)
    start_incremental_load(spark, root, target, checkpoint, ingested_at=LOAD_1).awaitTermination()
    mended = LF.good_daily(spark, sf_dir, divisor=2).where(F.regexp_extract("relative_path", r"-([0-9]{2})\.json$", 1).cast("int") % 3 == 0)
    rewrite(spark, mended, root)
    start_incremental_load(spark, root, target, checkpoint, ingested_at=LOAD_2).awaitTermination()
    return read_observations(spark, target)


def q_ledger_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill plan against a ledger made from the first half of every month's landed
    paths, with all of them recorded afterwards."""
    configure(spark)
    planned, landed, _ = _plan_status(spark, sf_dir)
    ensure_namespaces(spark, ("raw",))
    name = f"raw.ledger_{hashlib.sha1(scratch_dir(spark, 'ledger').encode()).hexdigest()[:10]}"
    create_ledger(spark, name, 8, landed.where(F.col("relative_path").rlike("-(0[0-9]|1[0-5])[.]json$")))
    record(spark, name, landed)
    return B.with_status(planned, spark.table(name)).select("series_id", "frequency", "period_label", "relative_path", "status")


QUERIES = {
    "ledger_status": q_ledger_status,
    "alert_error_rate_sliding": q_alert_error_rate_sliding,
    "silent_intervals": q_silent_intervals,
    "stream_rewritten_file": q_stream_rewritten_file,
    "analytics_tipo_cambio": q_analytics_tipo_cambio,
    "analytics_tpm": q_analytics_tpm,
    "analytics_dashboard": q_analytics_dashboard,
    "table_upsert": q_table_upsert,
    "dim_frequency_replaced": q_dim_frequency_replaced,
    "fact_scan_series": q_fact_scan_series,
    "empty_table_coverage": q_empty_table_coverage,
}

_IDS = ", ".join("'" + i + "'" for i in _SCAN["series_ids"])
SQL = {
    "ledger_status": O.SQL["backfill_plan"],
    "alert_error_rate_sliding": """WITH starts AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * unnest(range(12))) AS window_start, event_type FROM events
), w AS (SELECT window_start, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS errors FROM starts GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, events, errors, errors / events AS error_rate FROM w WHERE errors / events > 0.25""",
    "silent_intervals": """WITH b AS (SELECT min(ts) AS a, max(ts) AS b FROM events),
marks AS (SELECT event_type AS series_id, ts FROM events UNION ALL SELECT DISTINCT event_type, b.a FROM events, b),
spans AS (SELECT series_id, ts AS silent_from, coalesce(lead(ts) OVER (PARTITION BY series_id ORDER BY ts), (SELECT b FROM b)) AS silent_until FROM (SELECT DISTINCT series_id, ts FROM marks) m)
SELECT series_id, silent_from, silent_until FROM spans WHERE silent_until - silent_from > INTERVAL 2 HOUR""",
    "stream_rewritten_file": f"""SELECT series_id, observation_date, CASE WHEN day(observation_date) % 3 = 0 THEN value / 2 ELSE value END AS value, status_code, frequency,
  CASE WHEN day(observation_date) % 3 = 0 THEN TIMESTAMP '{LOAD_2}' ELSE TIMESTAMP '{LOAD_1}' END AS ingested_at FROM ({O.OBS_EVENTS}) e""",
    "analytics_tipo_cambio": O.SQL["view_tipo_cambio"],
    "analytics_tpm": O.SQL["view_tpm"],
    "analytics_dashboard": O.SQL["dashboard_long"],
    "table_upsert": O.SQL["upsert_observations"],
    "dim_frequency_replaced": O.SQL["dim_frequency"],
    "fact_scan_series": f"""SELECT series_id, observation_date, value, status_code, frequency, ingested_at FROM ({O.OBSERVATIONS}) o
WHERE series_id IN ({_IDS}) AND observation_date BETWEEN DATE '{_SCAN["first"]}' AND DATE '{_SCAN["last"]}'""",
    "empty_table_coverage": f"SELECT series_id, frequency, CAST(0 AS BIGINT) AS observations, 'EMPTY' AS status FROM (SELECT DISTINCT series_id, frequency FROM ({O.OBSERVATIONS}) o) c",
}
