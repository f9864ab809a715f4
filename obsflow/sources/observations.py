"""Scan of the stored observation table with selection (SRC-7).

The table is Parquet, partitioned by ``obs_year`` (or ``obs_month`` / ``obs_day``) and
sorted by series and date inside files. A date range becomes a partition filter on that
column (directories are pruned
before any file is opened) plus a row filter on the date; series and status selections
reach the Parquet reader as pushed filters and are checked against row-group statistics.
Files are ranges of series with several row groups each, so a series selection opens the
row groups of that series and skips the rest. A table that was made but not loaded yet
gives no rows, with the same schema.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.operators.upsert import DAY, MONTH, YEAR
from obsflow.schema import OBSERVATION_COLUMNS, OBSERVATIONS
from obsflow.session import has_data_files, path_exists


def scan_observations(
    spark: SparkSession,
    path: str,
    series_ids: Sequence[str] | None = None,
    first: dt.date | str | None = None,
    last: dt.date | str | None = None,
    valid_only: bool = False,
) -> DataFrame:
    if path_exists(path) and not has_data_files(path, marker_counts=False):
        return spark.createDataFrame([], OBSERVATIONS)  # a table that was made but not loaded yet
    df = spark.read.schema(OBSERVATIONS).parquet(path)  # partition columns are added from the folders
    pcol = next((c for c in (YEAR, MONTH, DAY) if c in df.columns), None)

    def part_value(d):
        return {YEAR: F.year(d), MONTH: F.year(d) * 100 + F.month(d), DAY: d}[pcol]

    if first is not None:
        d = F.lit(str(first)).cast("date")
        if pcol:
            df = df.where(F.col(pcol) >= part_value(d))
        df = df.where(F.col("observation_date") >= d)
    if last is not None:
        d = F.lit(str(last)).cast("date")
        if pcol:
            df = df.where(F.col(pcol) <= part_value(d))
        df = df.where(F.col("observation_date") <= d)
    if series_ids is not None:
        df = df.where(F.col("series_id").isin(list(series_ids)))
    if valid_only:
        df = df.where((F.col("status_code") == "OK") & F.col("value").isNotNull())
    return df.select(*OBSERVATION_COLUMNS)
