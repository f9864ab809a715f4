"""Landing zone → observation table: scan, decode, validate, flatten, report, upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.operators.payload import flatten_payloads, parse_payloads
from obsflow.operators.upsert import upsert
from obsflow.schema import OBSERVATION_COLUMNS
from obsflow.sources.landing import decode_path, read_landing


def parsed_files(spark: SparkSession, root: str, prefix: str | None = None) -> DataFrame:
    """Every scanned file with its decoded path; payloads parsed only for on-pattern files."""
    files = decode_path(read_landing(spark, root, prefix))
    parsed = parse_payloads(files.withColumn("_document", F.when(F.col("on_pattern"), F.col("body"))), "_document")
    return parsed.withColumn("reject_reason", F.when(F.col("on_pattern"), F.col("reject_reason"))).drop("_document")


def load_rows(files: DataFrame, ingested_at: dt.datetime | str | Column | None = None) -> DataFrame:
    """Accepted on-pattern files flattened to observation rows (with lineage columns)."""
    return flatten_payloads(files.where(F.col("on_pattern")), ingested_at)


def rejects(files: DataFrame) -> DataFrame:
    """SNK-12: rejected files with their reason (the quarantine listing)."""
    return files.where(F.col("on_pattern") & F.col("reject_reason").isNotNull()).select(
        "relative_path", F.col("reject_reason").alias("reason")
    )


def load_summary(files: DataFrame) -> DataFrame:
    """ETL-10/12: files scanned (accepted), skipped (off-pattern), failed (rejected), and
    observation rows extracted — one aggregate pass, no write."""
    on = F.col("on_pattern")
    accepted = on & F.col("reject_reason").isNull()
    return files.agg(
        F.count_if(accepted).cast("long").alias("files_scanned"),
        F.count_if(~on).cast("long").alias("files_skipped"),
        F.count_if(on & F.col("reject_reason").isNotNull()).cast("long").alias("files_failed"),
        F.coalesce(F.sum(F.when(accepted, F.coalesce(F.size("payload.Series.Obs"), F.lit(0)))), F.lit(0))
        .cast("long")
        .alias("rows_extracted"),
    )


def unparseable_counts(rows: DataFrame) -> DataFrame:
    """ETL-9: per series, values that were present yet became NULL."""
    return rows.groupBy("series_id").agg(F.count_if("unparseable").cast("long").alias("unparseable_values"))


def bulk_reload(
    spark: SparkSession,
    root: str,
    target: str,
    prefix: str | None = None,
    ingested_at: dt.datetime | str | None = None,
    dry_run: bool = False,
    granularity: str | None = "year",
) -> int:
    """ETL-11 / SET-1: every file under the root in one scan, one upsert.

    Returns rows sent to the upsert (0 when nothing was extracted); a dry run transforms
    everything and returns the row count without writing. ``granularity`` lays out a new
    table; an existing one keeps its layout.
    """
    rows = load_rows(parsed_files(spark, root, prefix), ingested_at)
    if dry_run:
        return rows.count()
    rows = rows.select(*OBSERVATION_COLUMNS, "modified_at", "period_label", "position")
    return upsert(spark, target, rows, granularity=granularity)
