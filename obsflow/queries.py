"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Each query derives its inputs from the driver's tables (see ``sources.adapters``) and
runs the library operator over them whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions import scalars as S
from obsflow.functions.scalars import coerce_value
from obsflow.operators import payload as P
from obsflow.operators import windows as Wn
from obsflow.operators.upsert import read_observations, upsert
from obsflow.plans import backfill as B
from obsflow.plans import calendar as C
from obsflow.plans import load as L
from obsflow.plans import reports as R
from obsflow.plans import views as V
from obsflow.session import _checkpoint_root, configure, scratch_dir
from obsflow.sources import adapters as A
from obsflow.sources import catalog as CT
from obsflow.sources import landing as LZ
from obsflow.sources import landing_fixture as LF
from obsflow.sources.catalog import dim_series_literal
from obsflow.sources.observations import scan_observations
from obsflow.streaming.incremental import read_quarantine, start_incremental_load

Query = Callable[[SparkSession, str], DataFrame]


def _seed(spark: SparkSession) -> DataFrame:
    return dim_series_literal(spark, A.DIM_SEED, A.SEED_UPDATED_AT)


def q_valid_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return Wn.valid_observations(A.observations(spark, sf_dir)).select("series_id", "observation_date", "value", "frequency")


def q_view_uf_diaria(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return V.view_uf_diaria(_fact(spark, sf_dir), A.family("daily_value"))


def q_view_tipo_cambio(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return V.view_tipo_cambio(_fact(spark, sf_dir), A.family("daily_value"))


def q_view_tpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return V.view_tpm(_fact(spark, sf_dir), A.family("daily_count"))


def q_view_ipc_mensual(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return V.view_ipc_mensual(_fact(spark, sf_dir), A.family("monthly_pct"))


def q_view_imacec(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return V.view_imacec(_fact(spark, sf_dir), A.family("monthly_value"))


def q_view_pib_trimestral(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return V.view_pib_trimestral(_fact(spark, sf_dir), A.family("quarterly_value"))


def q_dashboard_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return V.dashboard_long(_fact(spark, sf_dir), _seed(spark))


QUERIES: dict[str, Query] = {
    "valid_observations": q_valid_observations,
    "view_uf_diaria": q_view_uf_diaria,
    "view_tipo_cambio": q_view_tipo_cambio,
    "view_tpm": q_view_tpm,
    "view_ipc_mensual": q_view_ipc_mensual,
    "view_imacec": q_view_imacec,
    "view_pib_trimestral": q_view_pib_trimestral,
    "dashboard_long": q_dashboard_long,
}


# ---------------------------------------------------------------- landing and payloads


ROW_COLUMNS = ["series_id", "observation_date", "value", "status_code", "frequency", "ingested_at"]
LOAD_1 = "2026-01-01 00:00:00"
LOAD_2 = "2026-02-01 00:00:00"


def _landing(spark: SparkSession, sf_dir: str) -> str:
    configure(spark)
    return LF.build_landing(spark, sf_dir)


def q_landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LZ.read_landing(spark, _landing(spark, sf_dir)).select("relative_path")


def q_landing_prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LZ.read_landing(spark, _landing(spark, sf_dir), "raw/monthly/").select("relative_path")


def q_landing_path_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = LZ.read_landing(spark, _landing(spark, sf_dir)).select("relative_path")
    return LZ.decode_path(scan)


def q_payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = L.parsed_files(spark, _landing(spark, sf_dir))
    return L.load_rows(files, LOAD_1).select(*ROW_COLUMNS)


def q_payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.rejects(L.parsed_files(spark, _landing(spark, sf_dir)))


def q_unparseable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = L.parsed_files(spark, _landing(spark, sf_dir))
    return L.unparseable_counts(L.load_rows(files, LOAD_1))


def q_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.load_summary(L.parsed_files(spark, _landing(spark, sf_dir)))


def q_bulk_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landing(spark, sf_dir)
    target = scratch_dir(spark, "observations")
    # a stale copy of the first days, which the reload must overwrite
    stale = A.obs_events(spark, sf_dir).where(F.dayofmonth("observation_date") <= 20)
    stale = stale.withColumn("value", F.col("value") + 1000.0).withColumn("ingested_at", F.lit(LOAD_1).cast("timestamp"))
    upsert(spark, target, stale)
    L.bulk_reload(spark, root, target, ingested_at=LOAD_2)
    return read_observations(spark, target).select(*ROW_COLUMNS)


def q_payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    files = LZ.decode_path(LF.good_daily(spark, sf_dir, divisor=7))  # values of many decimals
    return P.flatten_payloads(P.parse_payloads(files), LOAD_1).select(*ROW_COLUMNS)


def q_value_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    o = A.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    k = F.col("o_orderkey") % 12
    raw = (
        F.when(k == 0, F.lit("NA"))
        .when(k == 1, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(k == 2, F.lit("nan"))
        .when(k == 3, F.lit(""))
        .when(k == 4, F.lit("NULL"))
        .when(k == 5, F.concat(price, F.lit("x")))
        .when(k == 6, F.concat(F.lit("+"), price))
        .when(k == 7, F.regexp_replace(price, "[.]", ","))
        .when(k == 8, F.concat(price, F.lit("e2")))
        .when(k == 9, F.concat(F.lit("1_"), price))
        .when(k == 10, F.lit("-inf"))
        .otherwise(price)
    )
    return o.select("o_orderkey", raw.alias("raw")).select("o_orderkey", "raw", coerce_value(F.col("raw")).alias("value"))


def q_upsert_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that overlap: the first days of every month, then the later ones."""
    configure(spark)
    ev = A.obs_events(spark, sf_dir)
    target = scratch_dir(spark, "observations")
    first = ev.where(F.dayofmonth("observation_date") <= 20).withColumn("ingested_at", F.lit(LOAD_1).cast("timestamp"))
    upsert(spark, target, first)
    second = (
        ev.where(F.dayofmonth("observation_date") >= 15)
        .withColumn("value", F.col("value") + 1.0)
        .withColumn("ingested_at", F.lit(LOAD_2).cast("timestamp"))
    )
    upsert(spark, target, second)
    return read_observations(spark, target)


def q_upsert_empty_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    ev = A.obs_events(spark, sf_dir)
    target = scratch_dir(spark, "observations")
    upsert(spark, target, ev.withColumn("ingested_at", F.lit(LOAD_1).cast("timestamp")))
    nothing = ev.where(F.col("observation_date") > F.lit("2100-01-01").cast("date"))
    sent = upsert(spark, target, nothing)
    return read_observations(spark, target).withColumn("rows_sent", F.lit(sent).cast("long"))


def q_landing_write_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    root = scratch_dir(spark, "landing-write")
    daily = LF.good_daily(spark, sf_dir)
    first = daily.where(F.regexp_extract("relative_path", r"-([0-9]{2})\.json$", 1).cast("int") <= 10)
    LZ.write_if_absent(spark, first, root)
    return LZ.write_if_absent(spark, daily, root)


def q_upsert_dim_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    target = scratch_dir(spark, "dim_series")
    upsert(spark, target, _seed(spark), keys=["series_id"], columns=A.DIM_COLUMNS, order_by=["updated_at"], partition_by_year=False, cluster_by=None)
    source = _fact(spark, sf_dir).select("series_id", "frequency").distinct().select(
        "series_id",
        F.concat(F.lit("Serie "), "series_id").alias("name"),
        F.lit("USD").alias("unit"),
        "frequency",
        F.lit(None).cast("string").alias("description"),
        F.lit(LOAD_2).cast("timestamp").alias("updated_at"),
    )
    upsert(spark, target, source, keys=["series_id"], columns=A.DIM_COLUMNS, order_by=["updated_at"], partition_by_year=False, cluster_by=None)
    return spark.read.parquet(target).select(*A.DIM_COLUMNS)


def q_split_payload_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    d = A.obs_daily(spark, sf_dir).withColumn("_year", F.year("observation_date"))
    text = P.value_text(F.col("value") / 7)
    el = P.obs_element(F.col("observation_date"), text, F.col("status_code"))
    per_year = d.groupBy("series_id", "_year").agg(F.sort_array(F.collect_list(F.struct("observation_date", el.alias("e")))).alias("xs"))
    ordered = F.transform("xs", lambda x: x["e"])
    first = F.element_at(ordered, 1)
    dup = F.struct(first["indexDateString"].alias("indexDateString"), F.lit("ND").alias("statusCode"), F.lit("dup").alias("value"))
    bad = F.struct(F.concat(F.lit("30-02-"), F.col("_year").cast("string")).alias("indexDateString"), F.lit("OK").alias("statusCode"), F.lit("1.00").alias("value"))
    outside = F.struct(
        F.concat(F.lit("31-12-"), (F.col("_year") - 1).cast("string")).alias("indexDateString"),
        F.lit("OK").alias("statusCode"),
        F.lit("9.99").alias("value"),
    )
    obs = F.concat(F.array(dup), ordered, F.array(bad, outside))
    body = P.payload_body(F.lit(0), F.lit(LF.DESCRIPTION), F.col("series_id"), F.lit(None).cast("string"), obs)
    yearly = P.parse_payloads(per_year.select("series_id", "_year", body.alias("body")))
    days = P.split_by_day(yearly, "_year")
    back = P.parse_payloads(days).select("series_id", "period_label", F.explode("payload.Series.Obs").alias("o"))
    return back.select(
        "series_id",
        "period_label",
        S.parse_payload_date(F.col("o.indexDateString")).alias("observation_date"),
        coerce_value(F.col("o.value")).alias("value"),
        F.col("o.statusCode").alias("status_code"),
    )


QUERIES.update(
    {
        "landing_scan": q_landing_scan,
        "landing_prefix_scan": q_landing_prefix_scan,
        "landing_path_decode": q_landing_path_decode,
        "payload_flatten": q_payload_flatten,
        "payload_rejects": q_payload_rejects,
        "unparseable_counts": q_unparseable_counts,
        "load_summary": q_load_summary,
        "bulk_reload": q_bulk_reload,
        "payload_roundtrip": q_payload_roundtrip,
        "value_coercion": q_value_coercion,
        "upsert_observations": q_upsert_observations,
        "upsert_empty_noop": q_upsert_empty_noop,
        "landing_write_if_absent": q_landing_write_if_absent,
        "upsert_dim_series": q_upsert_dim_series,
        "split_payload_by_day": q_split_payload_by_day,
    }
)


# ---------------------------------------------------------------- calendars, plans, reports

def _freqs():
    return F.array(F.lit("daily"), F.lit("monthly"), F.lit("quarterly"))


def _bounds(df: DataFrame) -> tuple:
    """(min, max) observation date — two scalars from a one-row aggregate."""
    r = df.agg(F.min("observation_date"), F.max("observation_date")).first()
    return r[0], r[1]


def _catalog(obs: DataFrame) -> DataFrame:
    return obs.select("series_id", "frequency").distinct()


def _landed_paths(obs: DataFrame) -> DataFrame:
    ok = obs.where(F.col("status_code") == "OK")
    return ok.select(LZ.landing_path("frequency", "series_id", S.period_label("frequency", "observation_date")).alias("relative_path"))


def _per_series_bounds(obs: DataFrame) -> DataFrame:
    return obs.groupBy("series_id").agg(F.min("observation_date").alias("mn"), F.max("observation_date").alias("mx"))


def q_period_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    runs = A.read_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("as_of")).distinct()
    w = runs.select("as_of", F.explode(_freqs()).alias("frequency")).withColumn("w", C.period_window("frequency", "as_of"))
    return w.select("as_of", "frequency", "w.first_date", "w.last_date", "w.period_label")


def q_calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    b = _per_series_bounds(A.obs_quarterly(spark, sf_dir))
    return b.select("series_id", F.explode(C.days("mn", "mx")).alias("day"))


def q_calendar_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    b = _per_series_bounds(A.obs_daily(spark, sf_dir))
    return b.select("series_id", F.inline(C.months("mn", "mx")))


def q_calendar_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    b = _per_series_bounds(A.obs_daily(spark, sf_dir))
    return b.select("series_id", F.inline(C.quarters("mn", "mx")))


def q_calendar_year_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    b = _per_series_bounds(A.obs_daily(spark, sf_dir))
    return b.select("series_id", F.inline(C.year_chunks("mn", "mx")))


def q_trailing_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    b = _per_series_bounds(_fact(spark, sf_dir))
    r = C.trailing_years(F.date_add("mx", 1), 5)
    return b.select("series_id", r["start_date"].alias("start_date"), r["end_date"].alias("end_date"))


def q_landing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    obs = _fact(spark, sf_dir)
    label = S.period_label("frequency", "observation_date")
    return obs.select("series_id", "observation_date", LZ.landing_path("frequency", "series_id", label).alias("relative_path"))


def _plan_status(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    obs = _fact(spark, sf_dir)
    start, end = _bounds(obs)
    planned = B.plan(_catalog(obs), start, end)
    return planned, _landed_paths(obs), obs


def q_backfill_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    planned, landed, _ = _plan_status(spark, sf_dir)
    return B.with_status(planned, landed).select("series_id", "frequency", "period_label", "relative_path", "status")


def q_missing_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    planned, landed, _ = _plan_status(spark, sf_dir)
    return B.missing_periods(planned, landed).select("series_id", "frequency", "period_label", "relative_path")


def q_landed_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    planned, landed, _ = _plan_status(spark, sf_dir)
    return B.landed_periods(planned, landed).select("series_id", "frequency", "period_label", "relative_path")


def q_backfill_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    planned, _, _ = _plan_status(spark, sf_dir)
    return B.dry_run_counts(planned)


def q_backfill_dry_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    planned, _, _ = _plan_status(spark, sf_dir)
    return B.dry_run_counters(planned)


def q_backfill_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    planned, landed, obs = _plan_status(spark, sf_dir)
    return B.counters(B.outcomes(B.with_status(planned, landed), obs, _failed_chunks(spark, sf_dir, planned)))


def _failed_chunks(spark: SparkSession, sf_dir: str, planned: DataFrame) -> DataFrame:
    """The fetches of a backfill that fail: a year of a daily series, a period of another."""
    chunk = F.when(F.col("frequency") == "daily", F.year("first_date").cast("string")).otherwise(F.col("period_label"))
    year_and_month = F.year("first_date") + F.when(F.col("frequency") == "daily", 0).otherwise(F.month("first_date"))
    asked = planned.select("series_id", chunk.alias("chunk"), year_and_month.alias("n")).distinct()
    return A.failed_requests(spark, sf_dir, asked, F.col("n")).select("series_id", "chunk")


def _failed_runs(spark: SparkSession, sf_dir: str, runs: DataFrame, catalog: DataFrame) -> DataFrame:
    """The requests of scheduled runs that fail, ``(as_of, series_id, error)``."""
    asked = B.run_requests(runs, catalog).select("as_of", "series_id")
    return A.failed_requests(spark, sf_dir, asked, F.dayofmonth("as_of"))


def _run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    obs = _fact(spark, sf_dir)
    runs = A.read_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("as_of")).distinct()
    runs = runs.select("as_of", F.explode(_freqs()).alias("frequency"))
    errors = _failed_runs(spark, sf_dir, runs, _catalog(obs))
    return B.ingest_outcomes(runs, _catalog(obs), _landed_paths(obs), obs, errors)


def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(B.run_summary(_run_outcomes(spark, sf_dir)))


def _told(summary: DataFrame) -> DataFrame:
    """Failed series as text, ``id: error``."""
    return summary.withColumn("errors", F.transform("errors", lambda e: F.concat(e["series_id"], F.lit(": "), e["error"])))


def q_run_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of ``run_summary`` in chunks of four series."""
    lists = B.run_lists(spark, _run_outcomes(spark, sf_dir), size=4)
    ids, errors = F.transform("series", lambda s: s["series_id"]), F.transform("series", lambda s: F.coalesce(s["error"], F.lit("")))
    return lists.select("as_of", "frequency", "outcome", "chunk", ids.alias("ids"), errors.alias("errors"))


def _catalog_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog documents derived from the fact: one per series, names from the seed, plus
    one document per frequency whose list is null (tolerated)."""
    obs = _fact(spark, sf_dir)
    series = _catalog(obs)
    named = series.join(F.broadcast(_seed(spark).select("series_id", "name", "unit", "description")), "series_id", "left")
    entry = F.struct(
        F.col("series_id").alias("id"),
        F.coalesce("name", "series_id").alias("name"),
        F.coalesce("unit", F.lit("USD")).alias("unit"),
        F.col("description").alias("description"),
    )
    docs = named.select(F.create_map(F.col("frequency"), F.array(entry)).alias("series"))
    nulls = series.select("frequency").distinct().select(
        F.create_map(F.col("frequency"), F.lit(None).cast("array<struct<id:string,name:string,unit:string,description:string>>")).alias("series")
    )
    return docs.unionByName(nulls)


def q_catalog_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return CT.flatten_catalog(_catalog_docs(spark, sf_dir))


def q_catalog_by_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return CT.catalog_by_frequency(CT.flatten_catalog(_catalog_docs(spark, sf_dir)), "monthly")


def q_dim_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    obs = _fact(spark, sf_dir)
    counts = _catalog(obs).groupBy("frequency").agg(F.count(F.lit(1)).cast("long").alias("series"))
    return CT.dim_frequency(spark).join(counts, "frequency", "left").select(
        "frequency", "description", "schedule_cron", F.coalesce("series", F.lit(0).cast("long")).alias("series")
    )


def q_load_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return R.load_inventory(_fact(spark, sf_dir))


def q_freshness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    obs = _fact(spark, sf_dir)
    _, end = _bounds(obs)
    return R.freshness_report(obs, _seed(spark), F.date_add(F.lit(end), 1))


def q_series_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    obs = _fact(spark, sf_dir)
    _, end = _bounds(obs)
    return R.series_coverage(_catalog(obs), obs, F.date_sub(F.lit(end), 90), F.lit(end), _failed_series(spark, sf_dir, obs))


def _failed_series(spark: SparkSession, sf_dir: str, obs: DataFrame) -> DataFrame:
    """The requests of a validation that fail: one a series, numbered by the id's length."""
    return A.failed_requests(spark, sf_dir, _catalog(obs).select("series_id"), F.lit(1))


def q_coverage_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.coverage_state(q_series_coverage(spark, sf_dir))


def q_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = L.parsed_files(spark, _landing(spark, sf_dir))
    outcomes = files.where("on_pattern").select("series_id", F.col("reject_reason").isNotNull().alias("failed"))
    return R.error_counts(outcomes)


def q_alert_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    ev = A.read_table(spark, sf_dir, "events")
    return R.alert_error_rate(ev, "ts", F.col("event_type") == "error", 0.2)


def q_alert_silent_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    obs = _fact(spark, sf_dir)
    start, end = _bounds(obs)
    return R.alert_silent_series(_catalog(obs), obs, start, end)


def q_alert_stale_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    obs = _fact(spark, sf_dir)
    _, end = _bounds(obs)
    return R.alert_stale_series(spark, obs, F.date_add(F.lit(end), 1))


def _win(obs: DataFrame, alias: str, *cols) -> DataFrame:
    base = Wn.valid_observations(obs).select("series_id", "observation_date", F.col("value").alias(alias))
    return base.select("series_id", "observation_date", alias, *cols)


def q_win_abs_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    w = Wn.series_window()
    return _win(_fact(spark, sf_dir), "v", Wn.abs_change("v", w).alias("change"), Wn.previous("v", w).alias("previous"))


def q_win_pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    w = Wn.series_window()
    return _win(_fact(spark, sf_dir), "v", Wn.pct_change_over("v", w, 1, 2).alias("pct_change"))


def q_win_yoy_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    w = Wn.series_window()
    return _win(_fact(spark, sf_dir).where(A.family("monthly_value")), "v", Wn.pct_change_over("v", w, 12, 2).alias("yoy_pct"))


def q_win_yoy_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    w = Wn.series_window()
    return _win(_fact(spark, sf_dir).where(A.family("quarterly_value")), "v", Wn.pct_change_over("v", w, 4, 2).alias("yoy_pct"))


def q_win_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    w = Wn.series_window()
    return _win(_fact(spark, sf_dir), "v", Wn.moving_avg("v", w, 7).alias("moving_avg_7"))


def q_win_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    w = Wn.series_window()
    return _win(
        _fact(spark, sf_dir).where(A.family("monthly_pct")),
        "v",
        Wn.compounded_growth("v", w, 12, 4).alias("compound_12"),
        Wn.frame_rows(w, 12).alias("rows_in_window"),
    )


def q_win_change_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    w = Wn.series_window()
    return _win(_fact(spark, sf_dir), "v", Wn.change_label("v", w).alias("movement"))


def q_scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    d = A.obs_daily(spark, sf_dir)
    v, day = F.col("value"), F.col("observation_date")
    text = S.format_payload_date(day)
    return d.select(
        "series_id",
        "observation_date",
        S.safe_div(v, F.dayofmonth(day) % 3 - 1).alias("safe_ratio"),
        F.round(v / 7.0, 3).alias("rounded"),
        F.round(F.exp(F.ln(v / 1e6)), 10).alias("exp_ln"),
        F.coalesce(v, F.lit(-1.0)).alias("value_or_default"),
        F.when(v > 200000, "high").when(v > 100000, "mid").otherwise("low").alias("band"),
        F.year(day).cast("int").alias("y"),
        F.month(day).cast("int").alias("m"),
        F.quarter(day).cast("int").alias("q"),
        F.date_diff(F.last_day(day), day).cast("int").alias("days_to_month_end"),
        F.upper(F.trim(F.col("status_code"))).isin("OK", "ND").alias("known_status"),
        S.parse_payload_date(text).alias("parsed_date"),
        text.alias("payload_date"),
        F.regexp_extract(F.col("series_id"), r"^([0-9])-", 1).alias("priority_digit"),
        S.quarter_label(day).alias("quarter_label"),
        F.last_day(day).alias("month_end"),
    )


QUERIES.update(
    {
        "period_windows": q_period_windows,
        "calendar_days": q_calendar_days,
        "calendar_months": q_calendar_months,
        "calendar_quarters": q_calendar_quarters,
        "calendar_year_chunks": q_calendar_year_chunks,
        "trailing_range": q_trailing_range,
        "landing_paths": q_landing_paths,
        "backfill_plan": q_backfill_plan,
        "missing_periods": q_missing_periods,
        "landed_periods": q_landed_periods,
        "backfill_dry_run": q_backfill_dry_run,
        "backfill_outcomes": q_backfill_outcomes,
        "run_summary": q_run_summary,
        "run_lists": q_run_lists,
        "backfill_dry_run_counters": q_backfill_dry_run_counters,
        "catalog_flatten": q_catalog_flatten,
        "catalog_by_frequency": q_catalog_by_frequency,
        "dim_frequency": q_dim_frequency,
        "load_inventory": q_load_inventory,
        "freshness_report": q_freshness_report,
        "series_coverage": q_series_coverage,
        "coverage_state": q_coverage_state,
        "error_counts": q_error_counts,
        "alert_error_rate": q_alert_error_rate,
        "alert_silent_series": q_alert_silent_series,
        "alert_stale_series": q_alert_stale_series,
        "win_abs_change": q_win_abs_change,
        "win_pct_change": q_win_pct_change,
        "win_yoy_monthly": q_win_yoy_monthly,
        "win_yoy_quarterly": q_win_yoy_quarterly,
        "win_moving_avg": q_win_moving_avg,
        "win_compound": q_win_compound,
        "win_change_point": q_win_change_point,
        "scalar_functions": q_scalar_functions,
    }
)


# ---------------------------------------------------------------- streaming


def _stream_into(spark: SparkSession, root: str, target: str, quarantine: str, ingested_at: str) -> None:
    q = start_incremental_load(spark, root, target, scratch_dir(spark, "stream-checkpoint"), quarantine, ingested_at)
    q.awaitTermination()


def q_stream_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landing(spark, sf_dir)
    target, quarantine = scratch_dir(spark, "observations"), scratch_dir(spark, "quarantine")
    _stream_into(spark, root, target, quarantine, LOAD_1)
    return read_observations(spark, target).select(*ROW_COLUMNS)


def q_stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landing(spark, sf_dir)
    target, quarantine = scratch_dir(spark, "observations"), scratch_dir(spark, "quarantine")
    _stream_into(spark, root, target, quarantine, LOAD_1)
    # a full replay under a fresh checkpoint: every file is delivered again
    _stream_into(spark, root, target, quarantine, LOAD_2)
    return read_observations(spark, target).select(*ROW_COLUMNS)


def q_stream_poison_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landing(spark, sf_dir)
    target, quarantine = scratch_dir(spark, "observations"), scratch_dir(spark, "quarantine")
    _stream_into(spark, root, target, quarantine, LOAD_1)
    return read_quarantine(spark, quarantine).select("relative_path", "reason")


QUERIES.update(
    {
        "stream_incremental_load": q_stream_incremental_load,
        "stream_replay_idempotent": q_stream_replay_idempotent,
        "stream_poison_file": q_stream_poison_file,
    }
)


# ---------------------------------------------------------------- stored fact table

_STORED: dict[tuple[str, str], str] = {}


def stored_observations(spark: SparkSession, sf_dir: str) -> str:
    """The consolidated fact written once (per folder and session) as the year-partitioned
    observation table, through the upsert path."""
    key = (sf_dir.rstrip("/"), _checkpoint_root(spark))
    if key not in _STORED:
        path = scratch_dir(spark, "observations-table")
        upsert(spark, path, A.observations(spark, sf_dir))
        _STORED[key] = path
    return _STORED[key]


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored observation table (built from the driver's tables on first use)."""
    return scan_observations(spark, stored_observations(spark, sf_dir))


def q_fact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    path = stored_observations(spark, sf_dir)
    return scan_observations(spark, path, valid_only=True).select("series_id", "observation_date", "value", "frequency")


QUERIES["fact_scan"] = q_fact_scan


def q_backfill_execute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill over the event series: the first ten days are already landed, the rest of
    the data range and six days beyond it are backfilled from the event observations."""
    configure(spark)
    ev = A.obs_events(spark, sf_dir)
    start, end = _bounds(ev)
    root = scratch_dir(spark, "backfill-landing")
    pre = ev.where(F.dayofmonth("observation_date") <= 10)
    LZ.write_if_absent(spark, LF.good_daily(spark, sf_dir).join(
        pre.select(LZ.landing_path(F.lit("daily"), "series_id", F.date_format("observation_date", "yyyy-MM-dd")).alias("relative_path")),
        "relative_path", "left_semi"), root)
    planned = B.plan(ev.select("series_id", "frequency").distinct(), start, end + dt.timedelta(days=6))
    status = B.with_status(planned, LZ.list_landed(spark, root))
    return B.counters(B.execute_backfill(spark, status, ev, root, _failed_chunks(spark, sf_dir, planned)))


QUERIES["backfill_execute"] = q_backfill_execute


def q_ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled ingests for every day of the event data (as of the next day), daily and
    monthly, over the event series and their monthly totals, into a fresh landing zone."""
    configure(spark)
    daily = A.obs_events(spark, sf_dir).select("series_id", "frequency", "observation_date", "value", "status_code")
    monthly = LF.monthly_rows(spark, sf_dir).select(
        "series_id", F.lit("monthly").alias("frequency"), "observation_date", "value", F.lit("OK").alias("status_code")
    )
    source = daily.unionByName(monthly)
    runs = daily.select(F.date_add("observation_date", 1).alias("as_of")).distinct()
    runs = runs.select("as_of", F.explode(F.array(F.lit("daily"), F.lit("monthly"))).alias("frequency"))
    catalog = source.select("series_id", "frequency").distinct()
    errors = _failed_runs(spark, sf_dir, runs, catalog)
    return _told(B.execute_ingest(spark, runs, catalog, scratch_dir(spark, "ingest-landing"), source, errors))


QUERIES["ingest_run"] = q_ingest_run
