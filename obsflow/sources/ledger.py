"""The ledger of landed paths: a table bucketed by path, for planning against zones of any size.

A zone of 10^9 objects is neither listed nor shuffled for every backfill. Whoever lands objects
also records their paths here; planning then joins its planned paths with the ledger, which
is dealt by path already. Only the plan is exchanged, to the ledger's buckets, and each task
reads one bucket. ``plans.backfill.with_status``, ``missing_periods`` and ``landed_periods``
take a ledger as they take a listing: their distinct of its paths needs no exchange either.

Paths may be recorded again (a retried job, a rewritten object); readers see each once. A
ledger follows the zone: record after landing, so a job that dies between leaves paths
missing in it, which the create-only writer then skips; it never names an object that
is not there. Rebuild it from a listing with ``create_ledger`` under a new name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsflow.session import scratch_dir

PATH = "relative_path"


def create_ledger(spark: SparkSession, name: str, buckets: int, landed: DataFrame | None = None, location: str | None = None) -> None:
    """A new ledger ``name`` of ``buckets`` buckets holding ``landed(relative_path)``, empty without
    it. Choose ``buckets`` so that one holds some 10^6 paths; it cannot change later. A table
    of that name is an error."""
    rows = spark.createDataFrame([], f"{PATH} string") if landed is None else _paths(landed)
    _bucketed(rows, buckets).option("path", location or scratch_dir(spark, "ledger")).saveAsTable(name)


def record(spark: SparkSession, name: str, landed: DataFrame) -> None:
    """Add the paths of ``landed``; rows without a path are left out."""
    _bucketed(_paths(landed), bucket_count(spark, name)).mode("append").saveAsTable(name)


def bucket_count(spark: SparkSession, name: str) -> int:
    row = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    if row is None:
        raise ValueError(f"{name} is not a ledger")
    return int(row["data_type"])


def _paths(landed: DataFrame) -> DataFrame:
    return landed.select(PATH).where(f"{PATH} is not null").distinct()


def _bucketed(rows: DataFrame, buckets: int):
    # dealt by the bucket function itself, so a task writes one file a bucket it holds
    return rows.repartition(buckets, PATH).write.format("parquet").bucketBy(buckets, PATH).sortBy(PATH)
