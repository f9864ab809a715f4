"""Backfill and ingest planning over a series catalog.

* ``plan``: catalog × periods of each series' own frequency → landing path, generated
  per catalog row with ``explode`` (no join, so no skew on the frequency key).
* ``with_status``: planned paths against the landing listing in one left join →
  ``landed`` / ``missing`` (set difference and intersection come from the same pass).
* ``outcomes``: what a backfill run does with each planned period — ``skipped`` when
  landed, ``written`` when the source has data, ``empty`` when it has none, ``error`` when
  the fetch for that chunk failed — and the additive counters per series plus a total.
* ``ingest_outcomes`` / ``run_summary``: the scheduled ingest (previous period per
  run date) and its summary with the sorted lists of empty and failed series;
  ``run_lists`` gives the lists in bounded chunks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.operators.joins import MAX_BROADCAST_ROWS
from obsflow.functions.scalars import period_label
from obsflow.plans.calendar import period_window, periods
from obsflow.session import materialize
from obsflow.sources.landing import landing_path


FREQUENCIES = ("daily", "monthly", "quarterly")


def _date(v: dt.date | str | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("date")


def plan(
    catalog: DataFrame, start: dt.date | str | Column, end: dt.date | str | Column, frequency: str | None = None
) -> DataFrame:
    """CAL-11: one row per (series, period of its frequency) within [start, end], for the
    series of one ``frequency`` only if given. Fixed dates in the wrong order and an unknown
    frequency are errors."""
    if not isinstance(start, Column) and not isinstance(end, Column) and str(start) > str(end):
        raise ValueError(f"the range starts on {start}, after its end {end}")
    if frequency is not None:
        if frequency not in FREQUENCIES:
            raise ValueError(f"frequency must be one of {FREQUENCIES}")
        catalog = catalog.where(F.col("frequency") == frequency)
    p = catalog.select("series_id", "frequency", F.explode(periods("frequency", _date(start), _date(end))).alias("p"))
    return p.select(
        "series_id",
        "frequency",
        F.col("p.period_label").alias("period_label"),
        F.col("p.first_date").alias("first_date"),
        F.col("p.last_date").alias("last_date"),
        landing_path("frequency", "series_id", F.col("p.period_label")).alias("relative_path"),
    )


def dry_run_counts(planned: DataFrame) -> DataFrame:
    """CAL-12: planned work per series; the landing zone is not consulted."""
    return planned.groupBy("series_id").agg(F.count(F.lit(1)).cast("long").alias("planned"))


def dry_run_counters(planned: DataFrame) -> DataFrame:
    """CAL-12 in the shape of ``counters``, with the total row (series_id NULL): a dry run counts
    every planned period as one it would write, and nothing as skipped, empty or failed."""
    nothing = F.lit(0).cast("long")
    return planned.rollup("series_id").agg(
        F.count(F.lit(1)).cast("long").alias("written"), nothing.alias("skipped"), nothing.alias("empty"), nothing.alias("errors")
    )


def with_status(planned: DataFrame, landed: DataFrame) -> DataFrame:
    """JN-5/JN-6: mark each planned path ``landed`` or ``missing``."""
    seen = landed.select("relative_path").distinct().withColumn("_landed", F.lit(True))
    return planned.join(seen, "relative_path", "left").select(
        *planned.columns, F.when(F.col("_landed"), F.lit("landed")).otherwise(F.lit("missing")).alias("status")
    )


def missing_periods(planned: DataFrame, landed: DataFrame) -> DataFrame:
    """JN-5 / SET-2: planned minus landed."""
    return planned.join(landed.select("relative_path").distinct(), "relative_path", "left_anti")


def landed_periods(planned: DataFrame, landed: DataFrame) -> DataFrame:
    """JN-6: planned and already landed (counted as skipped)."""
    return planned.join(landed.select("relative_path").distinct(), "relative_path", "left_semi")


def _periods_with_data(available: DataFrame) -> DataFrame:
    """``(series_id, period_label)`` for which the source has at least one observation;
    the label is that of the period holding the date, at the series' own frequency."""
    return (
        available.select("series_id", period_label("frequency", "observation_date").alias("period_label"))
        .distinct()
        .withColumn("has_data", F.lit(True))
    )


def outcomes(status: DataFrame, available: DataFrame, fetch_errors: DataFrame | None = None) -> DataFrame:
    """JN-7: per planned period, what the backfill does.

    ``available``: ``(series_id, frequency, observation_date)`` the source returns.
    ``fetch_errors``: ``(series_id, chunk)`` whose fetch fails; a chunk is the calendar year
    for daily series (fetched a year at a time) and the period label otherwise. For daily
    series a fully landed year counts all its days as skipped; in a partly landed year only
    the missing days are handled and the landed ones are not counted.
    """
    daily = F.col("frequency") == "daily"
    s = status.withColumn("chunk", F.when(daily, F.year("first_date").cast("string")).otherwise(F.col("period_label")))
    s = s.join(_periods_with_data(available), ["series_id", "period_label"], "left")
    if fetch_errors is not None:
        errs = fetch_errors.select("series_id", F.col("chunk").cast("string").alias("chunk")).distinct().withColumn("_err", F.lit(True))
        s = s.join(errs, ["series_id", "chunk"], "left")
    else:
        s = s.withColumn("_err", F.lit(None).cast("boolean"))
    chunk_w = Window.partitionBy("series_id", "chunk")
    missing = F.col("status") == "missing"
    chunk_missing = F.sum(F.when(missing, 1).otherwise(0)).over(chunk_w)
    outcome = (
        F.when(~missing & (~daily | (chunk_missing == 0)), F.lit("skipped"))
        .when(~missing, F.lit(None).cast("string"))
        .when(F.coalesce(F.col("_err"), F.lit(False)), F.lit("error"))
        .when(F.coalesce(F.col("has_data"), F.lit(False)), F.lit("written"))
        .otherwise(F.lit("empty"))
    )
    return s.withColumn("outcome", outcome).drop("_err", "has_data")


def counters(outs: DataFrame) -> DataFrame:
    """AGG-3: written / skipped / empty / errors per series, plus a total row (series_id
    NULL). A failed chunk counts one error however many periods it holds."""
    err_chunk = F.when(F.col("outcome") == "error", F.concat_ws("|", "series_id", "chunk"))
    return outs.rollup("series_id").agg(
        F.count_if(F.col("outcome") == "written").cast("long").alias("written"),
        F.count_if(F.col("outcome") == "skipped").cast("long").alias("skipped"),
        F.count_if(F.col("outcome") == "empty").cast("long").alias("empty"),
        F.count_distinct(err_chunk).cast("long").alias("errors"),
    )


SALT_BUCKETS = 64


def _runs_by_catalog(runs: DataFrame, catalog: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Every run paired with every catalog series of its frequency.

    The join key has three values, so a shuffle join would send all daily pairs to one
    task. A catalog within the broadcast bound is broadcast (no shuffle at all); a larger
    one is salted: catalog rows get a bucket from their id, runs are replicated into every
    bucket, and the join runs on (frequency, bucket).
    """
    if catalog.limit(max_rows + 1).count() <= max_rows:
        return runs.join(F.broadcast(catalog), "frequency")
    salted_cat = catalog.withColumn("_salt", F.pmod(F.xxhash64("series_id"), F.lit(SALT_BUCKETS)))
    salted_runs = runs.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT_BUCKETS - 1).cast("long"))))
    return salted_runs.join(salted_cat, ["frequency", "_salt"]).drop("_salt")


def run_requests(runs: DataFrame, catalog: DataFrame) -> DataFrame:
    """What scheduled runs ask for: ``(as_of, frequency, series_id)``."""
    pairs = _runs_by_catalog(runs.select("as_of", "frequency"), catalog.select("series_id", "frequency"))
    return pairs.select("as_of", "frequency", "series_id")


def ingest_outcomes(runs: DataFrame, catalog: DataFrame, landed: DataFrame, available: DataFrame, fetch_errors: DataFrame | None = None) -> DataFrame:
    """The scheduled ingest: for each run ``(as_of, frequency)``, every catalog series of
    that frequency targets the previous period; landed → skipped, else written when the
    source has data, empty when not, error when the fetch fails."""
    w = runs.select("as_of", "frequency", period_window("frequency", "as_of").alias("w"))
    targets = _runs_by_catalog(w, catalog.select("series_id", "frequency")).select(
        "as_of",
        "frequency",
        "series_id",
        F.col("w.first_date").alias("first_date"),
        F.col("w.last_date").alias("last_date"),
        F.col("w.period_label").alias("period_label"),
        landing_path("frequency", "series_id", F.col("w.period_label")).alias("relative_path"),
    )
    seen = landed.select("relative_path").distinct().withColumn("_landed", F.lit(True))
    t = targets.join(seen, "relative_path", "left").join(_periods_with_data(available), ["series_id", "period_label"], "left")
    if fetch_errors is not None:
        t = t.join(fetch_errors.select("as_of", "series_id", "error").distinct(), ["as_of", "series_id"], "left")
    else:
        t = t.withColumn("error", F.lit(None).cast("string"))
    outcome = (
        F.when(F.col("_landed"), F.lit("skipped"))
        .when(F.col("error").isNotNull(), F.lit("error"))
        .when(F.coalesce(F.col("has_data"), F.lit(False)), F.lit("written"))
        .otherwise(F.lit("empty"))
    )
    return t.select("as_of", "frequency", "series_id", "period_label", "relative_path", outcome.alias("outcome"), "error")


def run_summary(outs: DataFrame) -> DataFrame:
    """AGG-4: per run — processed and skipped counts, sorted ids of empty series, sorted
    (id, error) pairs of failed series, and the period label."""
    o = F.col("outcome")
    return outs.groupBy("as_of", "frequency").agg(
        F.max("period_label").alias("period_label"),
        F.count_if(o == "written").cast("long").alias("processed"),
        F.count_if(o == "skipped").cast("long").alias("skipped"),
        F.sort_array(F.collect_list(F.when(o == "empty", F.col("series_id")))).alias("empty"),
        F.sort_array(
            F.collect_list(F.when(o == "error", F.struct(F.col("series_id"), F.col("error"))))
        ).alias("errors"),
    )


LIST_CHUNK = 10_000


def run_lists(spark: SparkSession, outs: DataFrame, size: int = LIST_CHUNK) -> DataFrame:
    """AGG-4 for catalogs of any size: the empty and failed series of each run as chunks of at
    most ``size`` series, ``(as_of, frequency, outcome, chunk, series)``, each series with its
    error. Chunk k of a run and outcome holds its series k * size to (k + 1) * size - 1 in id
    order, so the chunks laid end to end are the lists of ``run_summary``.

    Rows are dealt to ranges of (run, outcome, id), and a row's rank is its place in its
    range plus what earlier ranges hold of its list; no task takes a run's catalog."""
    told = outs.where(F.col("outcome").isin("empty", "error")).select("as_of", "frequency", "outcome", "series_id", "error")
    whole = ["as_of", "frequency", "outcome"]
    placed = told.repartitionByRange(*whole, "series_id", "error").withColumn("part", F.spark_partition_id())
    placed = materialize(spark, placed, "run-lists")
    per = placed.groupBy(*whole, "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*whole).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = F.row_number().over(Window.partitionBy(*whole, "part").orderBy("series_id", "error")) - 1
    ranked = placed.withColumn("local", local).join(per.select(*whole, "part", before.alias("before")), [*whole, "part"])
    rank = F.col("before") + F.col("local")
    chunked = ranked.withColumn("chunk", F.floor(rank / size).cast("long"))
    series = F.sort_array(F.collect_list(F.struct("series_id", "error"))).alias("series")
    return chunked.groupBy(*whole, "chunk").agg(series)


def payloads_for_periods(source_obs: DataFrame, targets: DataFrame, description: str = "Success") -> DataFrame:
    """One payload per target period holding the source's observations of that period
    (one for a day, a month's for a month...), in date order: ``(relative_path, body)``.
    A group is one series-period, so its size is bounded by the period length. Of several
    source rows of one series and date the last wins: by ``ingested_at``, ``modified_at`` and
    ``position`` as far as the source has them (equal ones by their content)."""
    from obsflow.operators.payload import obs_element, payload_body, value_text

    keys = ["series_id", "period_label"]
    order = [c for c in ("ingested_at", "modified_at", "position") if c in source_obs.columns]
    wanted = source_obs.withColumn("period_label", period_label("frequency", "observation_date"))
    wanted = wanted.join(targets.select(*keys).distinct(), keys, "left_semi")
    # one observation per series and date first (an aggregate, pre-aggregated map-side), so
    # a period group holds at most one row per day whatever copies the source carries
    row = F.struct("value", "status_code")
    unique = wanted.groupBy(*keys, "observation_date").agg(F.max_by(row, F.struct(*order, "value", "status_code")).alias("o"))
    unique = unique.select(*keys, "observation_date", "o.value", "o.status_code")
    labeled = unique.select(
        *keys,
        F.struct(
            F.col("observation_date").alias("d"),
            obs_element(F.col("observation_date"), value_text(F.col("value")), F.col("status_code")).alias("e"),
        ).alias("x"),
    )
    per_period = labeled.groupBy(*keys).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    joined = targets.select(*keys, "relative_path").join(per_period, keys)
    body = payload_body(F.lit(0), F.lit(description), F.col("series_id"), F.lit(None).cast("string"), F.transform("xs", lambda x: x["e"]))
    return joined.select("relative_path", body.alias("body"))


def execute_backfill(spark, status: DataFrame, source_obs: DataFrame, landing_root: str, fetch_errors: DataFrame | None = None) -> DataFrame:
    """Run a backfill: every missing period for which the source has data is written
    create-only into the landing zone; the outcome rows are returned (a period whose file
    appeared meanwhile becomes ``skipped``)."""
    from obsflow.sources.landing import write_if_absent

    # decided once, before any file is written (re-evaluating after the write would see them)
    outs = materialize(spark, outcomes(status, source_obs, fetch_errors), "backfill-outcomes")
    to_write = outs.where(F.col("outcome") == "written")
    written = write_if_absent(spark, payloads_for_periods(source_obs, to_write), landing_root)
    result = outs.join(written.withColumnRenamed("outcome", "_written"), "relative_path", "left")
    return result.withColumn("outcome", F.coalesce(F.col("_written"), F.col("outcome"))).drop("_written")


def execute_ingest(
    spark, runs: DataFrame, catalog: DataFrame, landing_root: str, source_obs: DataFrame, fetch_errors: DataFrame | None = None
) -> DataFrame:
    """Run scheduled ingests for every ``(as_of, frequency)`` in ``runs`` in one job: each
    catalog series of the run's frequency gets the previous period's payload written
    create-only when the source has data. Runs are settled in date order: when several
    runs target one period, the earliest writes it and the later ones find it (``skipped``),
    as consecutive scheduled runs would. Returns the per-run summary (``run_summary``)."""
    from obsflow.sources.landing import existing_paths, write_if_absent

    # which targets are landed already: checked target by target, not by listing the zone
    w = runs.select("as_of", "frequency", period_window("frequency", "as_of").alias("w"))
    targets = _runs_by_catalog(w, catalog.select("series_id", "frequency")).select(
        landing_path("frequency", "series_id", F.col("w.period_label")).alias("relative_path")
    )
    landed = existing_paths(spark, targets, landing_root)
    outs = ingest_outcomes(runs, catalog, landed, source_obs, fetch_errors)
    # a failed request writes nothing, so the first run that does write comes first
    first = Window.partitionBy("relative_path", "outcome").orderBy("as_of")
    outs = outs.withColumn(
        "outcome",
        F.when((F.col("outcome") == "written") & (F.row_number().over(first) > 1), F.lit("skipped")).otherwise(F.col("outcome")),
    )
    # decided once, before any file is written (re-evaluating after the write would see them)
    outs = materialize(spark, outs, "ingest-outcomes")
    to_write = outs.where(F.col("outcome") == "written").select("series_id", "period_label", "relative_path")
    written = write_if_absent(spark, payloads_for_periods(source_obs, to_write), landing_root)
    settled = outs.join(written.withColumnRenamed("outcome", "_written"), "relative_path", "left")
    settled = settled.withColumn(
        "outcome", F.when(F.col("outcome") == "written", F.coalesce(F.col("_written"), F.col("outcome"))).otherwise(F.col("outcome"))
    )
    return run_summary(settled.drop("_written"))
