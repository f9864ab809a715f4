"""Health reports over the observation table and the load outcomes.

All are single aggregations (partial aggregation map-side, one shuffle on the group key)
or anti-joins against small, size-checked dimensions; dates of reference (``as_of``)
are parameters so the reports are deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.operators.joins import bounded_broadcast, lookup_join
from obsflow.plans.calendar import days

# --- fixed values: expected publication cadence in days, per frequency -------------------
CADENCE_DAYS = {"daily": 1, "monthly": 31, "quarterly": 92}
# ------------------------------------------------------------------------------------------


def _date(v: dt.date | str | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("date")


def load_inventory(obs: DataFrame) -> DataFrame:
    """AGG-1 + SRT-1: rows, latest observation and latest load per frequency."""
    return (
        obs.groupBy("frequency")
        .agg(
            F.count(F.lit(1)).cast("long").alias("rows"),
            F.max("observation_date").alias("latest"),
            F.max("ingested_at").alias("last_load"),
        )
        .orderBy("frequency")
    )


def latest_per_series(obs: DataFrame) -> DataFrame:
    """AGG-2: latest observation date and latest load per series."""
    return obs.groupBy("series_id").agg(
        F.max("observation_date").alias("latest_obs"), F.max("ingested_at").alias("last_load")
    )


def freshness_report(obs: DataFrame, dim_series: DataFrame, as_of: dt.date | str | Column) -> DataFrame:
    """JN-2 + SRT-2 + SCL-7: days since each series' latest observation, most stale first."""
    latest = latest_per_series(obs)
    joined = lookup_join(latest, dim_series.select("series_id", "name"), "series_id")
    return joined.select(
        "series_id",
        "name",
        "latest_obs",
        F.date_diff(_date(as_of), F.col("latest_obs")).cast("int").alias("days_stale"),
    ).orderBy(F.col("days_stale").desc(), F.col("series_id"))


def series_coverage(
    catalog: DataFrame, obs: DataFrame, first: dt.date | str | Column, last: dt.date | str | Column, fetch_errors: DataFrame | None = None
) -> DataFrame:
    """AGG-5: per catalog series, observations in [first, last] → OK (some) / EMPTY (none) /
    FAIL: its request failed, or it has no frequency. ``fetch_errors(series_id, error)`` are
    the failed requests; with them each row carries ``error``, the least of a series' errors.
    A failed series returned nothing, so it counts no observations."""
    window_obs = obs.where(F.col("observation_date").between(_date(first), _date(last)))
    counts = window_obs.groupBy("series_id").agg(F.count(F.lit(1)).cast("long").alias("observations"))
    joined = catalog.select("series_id", "frequency").join(counts, "series_id", "left")
    failed, n = F.col("frequency").isNull(), F.coalesce(F.col("observations"), F.lit(0).cast("long"))
    columns = []
    if fetch_errors is not None:
        told = F.coalesce(F.col("error").cast("string"), F.lit("unknown"))
        joined = joined.join(fetch_errors.groupBy("series_id").agg(F.min(told).alias("error")), "series_id", "left")
        failed, columns = failed | F.col("error").isNotNull(), [F.col("error")]
        n = F.when(F.col("error").isNull(), n).otherwise(F.lit(0).cast("long"))
    status = F.when(failed, F.lit("FAIL")).when(n > 0, F.lit("OK")).otherwise(F.lit("EMPTY"))
    return joined.select("series_id", "frequency", n.alias("observations"), status.alias("status"), *columns)


def coverage_state(coverage: DataFrame) -> DataFrame:
    """AGG-5, the overall state of a validation: one row with the number of series, of each
    status, and ``passed`` (no series failed; an empty series passes, as does an empty catalog).
    The failed series themselves are the FAIL rows of ``coverage``."""
    status = F.col("status")
    failed = F.count_if(status == "FAIL")
    return coverage.agg(
        F.count(F.lit(1)).cast("long").alias("series"),
        F.count_if(status == "OK").cast("long").alias("ok"),
        F.count_if(status == "EMPTY").cast("long").alias("empty"),
        failed.cast("long").alias("failed"),
        (failed == 0).alias("passed"),
    )


def error_counts(load_outcomes: DataFrame) -> DataFrame:
    """AGG-6: failed loads per series (outcome rows carry ``series_id`` and ``failed``)."""
    return load_outcomes.where(F.col("failed")).groupBy("series_id").agg(F.count(F.lit(1)).cast("long").alias("errors"))


def alert_error_rate(events: DataFrame, ts: str, is_error: Column, threshold: float = 0.2, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """AGG-7: windows of ``width`` whose error share exceeds ``threshold``. With ``slide`` the
    windows start every ``slide``, so a burst across a full hour is seen as well; each event
    counts in width / slide windows, before any exchange. On a stream with a watermark on
    ``ts`` (append or update mode) a window is told once its time has passed."""
    per = events.groupBy(F.window(ts, width, slide or width).alias("w")).agg(
        F.count(F.lit(1)).cast("long").alias("events"), F.count_if(is_error).cast("long").alias("errors")
    )
    rate = F.col("errors") / F.col("events")
    return per.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events", "errors", rate.alias("error_rate")
    ).where(rate > threshold)


def silent_intervals(catalog: DataFrame, loads: DataFrame, since: dt.datetime | str | Column, until: dt.datetime | str | Column, hours: int = 24) -> DataFrame:
    """AGG-8: the spans of more than ``hours`` hours in [since, until] in which a daily series
    received no load. ``loads(series_id, loaded_at)`` are the load instants; each is compared
    with the next one of its series (``lead``), so the rows are loads and never series x days.
    A daily series without any load is silent throughout."""
    start, end = (v if isinstance(v, Column) else F.lit(str(v)).cast("timestamp") for v in (since, until))
    daily = catalog.where(F.col("frequency") == "daily").select("series_id").distinct()
    seen = loads.select("series_id", F.col("loaded_at").cast("timestamp").alias("loaded_at")).where(F.col("loaded_at").between(start, end)).distinct()
    marks = seen.join(daily, "series_id", "left_semi").unionByName(daily.select("series_id", start.alias("loaded_at")))
    following = F.lead("loaded_at").over(Window.partitionBy("series_id").orderBy("loaded_at"))
    spans = marks.select("series_id", F.col("loaded_at").alias("silent_from"), F.coalesce(following, end).alias("silent_until"))
    return spans.where(F.unix_micros("silent_until") - F.unix_micros("silent_from") > hours * 3_600_000_000)


def alert_silent_series(catalog: DataFrame, obs: DataFrame, start: dt.date | str | Column, end: dt.date | str | Column) -> DataFrame:
    """AGG-8: for each day of [start, end], the daily series that received no load that
    day. Days are generated per series (``explode``), then anti-joined with the loads."""
    daily = catalog.where(F.col("frequency") == "daily").select("series_id")
    checks = daily.select("series_id", F.explode(days(_date(start), _date(end))).alias("check_date"))
    loads = obs.select("series_id", F.to_date("ingested_at").alias("check_date")).distinct()
    return checks.join(loads, ["series_id", "check_date"], "left_anti")


def alert_stale_series(
    spark: SparkSession, obs: DataFrame, as_of: dt.date | str | Column, grace_days: int = 3
) -> DataFrame:
    """AGG-9: series with no new observation past their cadence plus a grace period."""
    cadence = spark.createDataFrame(list(CADENCE_DAYS.items()), "frequency string, cadence_days int")
    latest = obs.groupBy("series_id", "frequency").agg(F.max("observation_date").alias("latest_obs"))
    joined = latest.join(bounded_broadcast(cadence, 100), "frequency", "left")
    age = F.date_diff(_date(as_of), F.col("latest_obs")).cast("int")
    limit = F.col("cadence_days") + F.lit(grace_days)
    return joined.select(
        "series_id", "frequency", "latest_obs", age.alias("days_since"), limit.alias("allowed_days"), (age > limit).alias("stale")
    )
