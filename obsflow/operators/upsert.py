"""Idempotent keyed upsert into a Parquet table, without a transactional table format.

Semantics (a MERGE on the key): a source row whose key exists replaces the target row, a
new key is inserted, target rows absent from the source are kept. Running the same
upsert twice leaves the table as running it once.

Plan, for a table partitioned by ``obs_year`` (or ``obs_month`` / ``obs_day``: the
``granularity`` parameter; a daily load at scale should rewrite a month or a day):

1. required-key guard (``raise_error`` inside the projection, no extra pass);
2. the source is staged once in the shared scratch folder — the only pass over it, which
   also cuts its lineage; an empty source stops here and leaves the target untouched;
3. one exchange to ranges of (partition, series) with sampled bounds finds the latest row of
   each key by the given order columns and lays the rows out; where one series' copies are
   counted to be too many for a task, they collapse below an exchange of their own first;
4. first load: the sorted ranges are written;
5. otherwise the target's touched partitions (partition-pruned scan) minus the source keys
   (``left_anti``; the keys are broadcast when their checked count is within the bound, so
   the large side is not shuffled), plus the clustered source, are staged;
6. the staged result replaces exactly those partitions (dynamic partition overwrite,
   applied at job commit). ``sources.tables`` holds the same upsert for catalog tables, which
   writes once and switches the partitions' locations.

The result never reads and overwrites one path in the same job. Concurrent writers to one
table are not supported. Returns the number of source rows sent (before dedupe).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.joins import MAX_BROADCAST_ROWS
from obsflow.schema import KEYS, OBSERVATION_COLUMNS, OBSERVATIONS
from obsflow.session import has_data_files, path_exists, scratch_dir

YEAR = "obs_year"
MONTH = "obs_month"
DAY = "obs_day"
# partition granularity → (partition column, its value from the observation date). Year
# partitions suit small tables; at scale a daily load should rewrite a month or a day, not
# a year (a day partition of a 100 TB table still holds gigabytes).
GRANULARITIES = {
    "year": (YEAR, lambda d: F.year(d)),
    "month": (MONTH, lambda d: F.year(d) * 100 + F.month(d)),
    "day": (DAY, lambda d: d),
}
PARTITION_COLUMNS = (YEAR, MONTH, DAY)


def partition_column(granularity: str | None) -> str | None:
    if granularity is None:
        return None
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {sorted(GRANULARITIES)} or None")
    return GRANULARITIES[granularity][0]


def with_partition(df: DataFrame, granularity: str | None) -> DataFrame:
    if granularity is None:
        return df
    name, expr = GRANULARITIES[granularity]
    return df.withColumn(name, expr(F.col("observation_date")))
DEFAULT_ORDER = ("ingested_at", "modified_at", "period_label", "position")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table at ``path`` holds data files (filesystem check, no Spark job); an
    empty table (only a commit marker) counts as absent, so the next upsert is a first load."""
    return has_data_files(path, marker_counts=False)


def stored_granularity(spark: SparkSession, path: str) -> str | None:
    """The granularity an existing table at ``path`` is partitioned by, if any."""
    if not table_exists(spark, path):
        return None
    columns = spark.read.parquet(path).columns
    return next((g for g, (name, _) in GRANULARITIES.items() if name in columns), None)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, granularity: str | None = None) -> None:
    """SNK-5: create an empty table at ``path`` if nothing is there yet."""
    if path_exists(path):
        return
    empty = with_partition(spark.createDataFrame([], schema), granularity)
    writer = empty.write.mode("overwrite")
    pcol = partition_column(granularity)
    if pcol:
        writer = writer.partitionBy(pcol)
    writer.parquet(path)


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-10: fail the load when a key column is NULL (checked while rows stream by)."""
    for k in keys:
        df = df.withColumn(
            k, F.when(F.col(k).isNull(), F.raise_error(F.lit(f"required column {k} is NULL"))).otherwise(F.col(k))
        )
    return df


def _order_columns(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    order = [c for c in order_by if c in df.columns]
    if not order:
        raise ValueError(f"none of the columns {list(order_by)} that tell the later row is there")
    return order


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str], partition: str | None = None
) -> DataFrame:
    """One row per key: the greatest ``order_by`` tuple wins (later load, later file, later
    position in the file; NULLs lose).

    ``row_number() = 1``: Spark puts a group limit below the exchange, so however many copies
    of one key a source holds (a re-delivered series, a duplicated file), each input task
    hands on one row of it, and no task receives a hot key's copies.
    """
    order = _order_columns(df, order_by)
    # rows are sorted by key below and above the exchange: a hash in front settles almost every
    # comparison by one number, where keys that begin alike would be compared byte by byte
    latest = Window.partitionBy("_hash", *keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    picked = df.withColumn("_hash", F.xxhash64(*keys)).withColumn("_copy", F.row_number().over(latest)).where(F.col("_copy") == 1)
    extra = [partition] if partition and partition not in keys and partition not in columns else []
    return picked.select(*extra, *keys, *[c for c in columns if c not in keys])


#: Several row groups a file, so that a series filter can skip some of them by their least and
#: greatest series, and Bloom filters for row groups whose series are not in a dictionary.
LAYOUT_OPTIONS = {
    "parquet.block.size": str(8 << 20),
    "parquet.bloom.filter.enabled#series_id": "true",
    "parquet.bloom.filter.expected.ndv#series_id": "50000",
}


def _layout_order(df: DataFrame, pcol: str | None) -> list[str]:
    return ([pcol] if pcol else []) + [c for c in ("series_id", "observation_date") if c in df.columns and c != pcol]


def _sorted_layout(df: DataFrame, pcol: str | None) -> DataFrame:
    """Rows sorted by (partition,) series and date inside each task."""
    order = _layout_order(df, pcol)
    return df.sortWithinPartitions(*order) if order else df


def clustered_layout(df: DataFrame, pcol: str | None) -> DataFrame:
    """SNK-4: rows dealt to ranges of (partition, series) with sampled bounds and sorted in them,
    so each file of a partition holds the rows of its own few series."""
    order = [c for c in _layout_order(df, pcol) if c != "observation_date" or pcol == DAY]
    return _sorted_layout(df.repartitionByRange(*order), pcol) if order else df


def _write(df: DataFrame, path: str, pcol: str | None, mode: str = "error", dynamic: bool = False) -> None:
    w = df.write.mode(mode)
    if "series_id" in df.columns:
        w = w.options(**LAYOUT_OPTIONS)
    if pcol:
        w = w.partitionBy(pcol)
    if dynamic:
        # only the partitions present in ``df`` are replaced, at job commit
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


class Staged(NamedTuple):
    """A source written once to the shared scratch folder: the only pass over it, which also
    cuts its lineage (the landing scan or the adapters never re-run)."""

    rows: DataFrame
    rows_sent: int
    partitions: list
    latest: DataFrame  # one row a key, in clustered files' order


#: Rows of one series and partition that a task may sort; beyond it copies are collapsed first.
HOT_ROWS = 4_000_000


def stage_source(
    spark: SparkSession, source: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str], granularity: str | None
) -> Staged | None:
    """Stage the source with its required keys; None if it is empty (SNK-11).

    The latest row of each key is found where the clustered layout puts it: one exchange to
    ranges of (partition, series) serves both. Rows of one series and partition are counted
    first; where copies make them more than a task should hold, they are collapsed by
    ``dedupe_latest``, below its exchange, before the ranges are dealt.
    """
    pcol = partition_column(granularity)
    sent = Observation("upsert_source")
    wanted = [*keys, *[c for c in columns if c not in keys], *[c for c in order_by if c in source.columns and c not in columns and c not in keys]]
    src = require_keys(source.observe(sent, F.count(F.lit(1)).alias("rows")), keys).select(*wanted)
    path = scratch_dir(spark, "upsert-source")
    with_partition(src, granularity).write.parquet(path)
    staged = spark.read.parquet(path)
    near = [*([pcol] if pcol else []), *[k for k in keys if k != "observation_date"]]
    part = F.collect_set(pcol) if pcol else F.array()
    # a plan that is found empty at run time reports no count, so the staged rows are asked
    held = staged.groupBy(*near).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), part.alias("partitions")).first()
    if held["most"] is None:
        return None
    if held["most"] > HOT_ROWS:
        collapsed = scratch_dir(spark, "upsert-collapsed")
        dedupe_latest(staged, keys, columns, order_by, pcol).write.parquet(collapsed)
        latest = clustered_layout(spark.read.parquet(collapsed), pcol)
    else:
        order = _order_columns(staged, order_by)
        first = Window.partitionBy(*near, *[k for k in keys if k not in near]).orderBy(*(F.col(c).desc_nulls_last() for c in order))
        ranges = staged.repartitionByRange(*near) if near else staged
        # a row without an earlier one of its key
        latest = ranges.withColumn("_earlier", F.lag(F.lit(1)).over(first)).where("_earlier IS NULL")
        extra = [pcol] if pcol and pcol not in columns else []
        latest = _sorted_layout(latest.select(*extra, *keys, *[c for c in columns if c not in keys]), pcol)
    return Staged(staged, int(sent.get["rows"]), sorted(held["partitions"]), latest)


def without_keys(old: DataFrame, src: Staged, keys: Sequence[str], max_broadcast_keys: int) -> DataFrame:
    """The rows of ``old`` whose key ``src`` does not hold. The batch's keys are broadcast when
    their checked count is within the bound: target rows stream through a map-side
    anti-join, and the large side is not shuffled."""
    src_keys = src.rows.select(*keys)
    return old.join(F.broadcast(src_keys) if src.rows_sent <= max_broadcast_keys else src_keys, list(keys), "left_anti")


def upsert(
    spark: SparkSession,
    target: str,
    source: DataFrame,
    keys: Sequence[str] = tuple(KEYS),
    columns: Sequence[str] = tuple(OBSERVATION_COLUMNS),
    order_by: Sequence[str] = DEFAULT_ORDER,
    partition_by_year: bool = True,
    cluster_by: str | None = "series_id",
    granularity: str | None = "year",
    compact: bool = False,
    max_broadcast_keys: int = MAX_BROADCAST_ROWS,
) -> int:
    """SNK-1/SNK-2: keyed upsert of ``source`` into the Parquet table at ``target``.

    ``granularity`` lays out a new table; an existing partitioned table keeps its layout.

    ``compact=True`` re-clusters the rewritten partitions with a shuffle by series (fewer,
    larger files); by default rewritten files keep their ranges and no target row is
    shuffled when the source keys fit the broadcast bound. One of the ``order_by`` columns
    must be there to tell the later of two rows of a key.
    """
    keys, columns = list(keys), list(columns)
    gran = (stored_granularity(spark, target) or granularity) if partition_by_year else None
    pcol = partition_column(gran)
    src = stage_source(spark, source, keys, columns, order_by, gran)
    if src is None:
        return 0

    if not table_exists(spark, target):
        _write(src.latest, target, pcol, mode="overwrite")
        return src.rows_sent

    old = spark.read.parquet(target)
    if pcol:
        old = old.where(F.col(pcol).isin(src.partitions))  # partition pruning
    keep_cols = columns + ([pcol] if pcol and pcol not in columns else [])
    kept = without_keys(old.select(*keep_cols), src, keys, max_broadcast_keys)
    merged = kept.unionByName(src.latest.select(*keep_cols))
    # rows of the target stay in the ranges that their files hold, unless they are dealt anew
    merged = clustered_layout(merged, pcol) if compact and cluster_by else _sorted_layout(merged, pcol)

    staged_merge = scratch_dir(spark, "upsert-merged")
    _write(merged, staged_merge, pcol)
    # the target is never read and overwritten by one job: replace from the staged copy
    _write(_sorted_layout(spark.read.parquet(staged_merge), pcol), target, pcol, mode="overwrite", dynamic=pcol is not None)
    return src.rows_sent


def read_observations(spark: SparkSession, target: str) -> DataFrame:
    """The observation table without its partition column (empty when it holds no data)."""
    if not has_data_files(target, marker_counts=False):
        return spark.createDataFrame([], OBSERVATIONS)
    return spark.read.parquet(target).select(*OBSERVATION_COLUMNS)
