"""Catalog tables: explicit schema, readable while empty, replaced by a switch of location.

A table or partition is never rewritten in place. New rows go to a new folder beside the
table, and one catalog statement makes that folder the table's (or the partition's)
location: readers see the old rows until then and the new ones after, and a job that dies
before the switch leaves the table as it was. Folders that no table points at any more
are left to the store's retention policy.

Tables live in the session's catalog. Without a metastore that is Spark's own in-process
catalog: every session of the application sees them, another application does not, and
has to make them anew at their present locations (``location``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.joins import MAX_BROADCAST_ROWS
from obsflow.operators.upsert import (
    DAY,
    DEFAULT_ORDER,
    LAYOUT_OPTIONS,
    PARTITION_COLUMNS,
    clustered_layout,
    partition_column,
    stage_source,
    without_keys,
)
from obsflow.schema import KEYS, OBSERVATION_COLUMNS

_GRANULARITY = dict(zip(PARTITION_COLUMNS, ("year", "month", "day"), strict=True))


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str, granularity: str | None = None) -> None:
    """SNK-4/5: ``CREATE TABLE IF NOT EXISTS`` with the columns of ``schema`` and, for fact tables,
    a partition column. A table that exists keeps its rows and its layout."""
    pcol = partition_column(granularity)
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    if pcol:
        columns.append(f"`{pcol}` {'date' if pcol == DAY else 'int'}")
    partitioned = f"PARTITIONED BY (`{pcol}`)" if pcol else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet {partitioned} LOCATION '{location}'")


def location(spark: SparkSession, name: str) -> str:
    """Where the table's folder lies now."""
    return spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]


def _granularity(spark: SparkSession, name: str) -> str | None:
    return next((_GRANULARITY[c.name] for c in spark.catalog.listColumns(name) if c.isPartition), None)


def _fresh(spark: SparkSession, name: str) -> str:
    """A new folder beside the table's present one."""
    return f"{location(spark, name).rstrip('/').rpartition('/')[0]}/{name.replace('.', '-')}-{uuid.uuid4().hex[:12]}"


def replace_table(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """SNK-3: the table's rows become ``rows``, at once. The table must not be partitioned."""
    if _granularity(spark, name):
        raise ValueError("a partitioned table is replaced partition by partition")
    folder = _fresh(spark, name)
    rows.select(*spark.table(name).columns).write.parquet(folder)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.sql(f"REFRESH TABLE {name}")


def _switch_partitions(spark: SparkSession, name: str, pcol: str, folder: str, values: Sequence) -> None:
    """Point partitions at their folders below ``folder``, one statement each."""
    for v in values:
        told = v.isoformat() if isinstance(v, dt.date) else str(v)
        spec, at = (f"`{pcol}` = DATE '{told}'" if pcol == DAY else f"`{pcol}` = {told}"), f"{folder}/{pcol}={told}"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{at}'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{at}'")
    spark.sql(f"REFRESH TABLE {name}")


def upsert_table(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str] = tuple(KEYS),
    columns: Sequence[str] = tuple(OBSERVATION_COLUMNS),
    order_by: Sequence[str] = DEFAULT_ORDER,
    max_broadcast_keys: int = MAX_BROADCAST_ROWS,
) -> int:
    """SNK-1/SNK-2: the keyed upsert of ``operators.upsert`` into a catalog table. What is kept of
    the touched partitions (or of the whole unpartitioned table) and the source are written
    once, clustered by series, and the catalog then switches to them. A partition changes
    as a whole; partitions switch one after another. Concurrent writers are not supported.
    Returns the number of source rows sent."""
    keys, columns = list(keys), list(columns)
    gran = _granularity(spark, name)
    pcol = partition_column(gran)
    src = stage_source(spark, source, keys, columns, order_by, gran)
    if src is None:
        return 0
    cols = columns + ([pcol] if pcol else [])
    old = spark.table(name).select(*cols)
    if pcol:
        old = old.where(F.col(pcol).isin(src.partitions))
    merged = without_keys(old, src, keys, max_broadcast_keys).unionByName(src.latest.select(*cols))
    folder = _fresh(spark, name)
    writer = clustered_layout(merged, pcol).write
    if "series_id" in columns:
        writer = writer.options(**LAYOUT_OPTIONS)
    if pcol:
        writer.partitionBy(pcol).parquet(folder)
        _switch_partitions(spark, name, pcol, folder, src.partitions)
    else:
        writer.parquet(folder)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"REFRESH TABLE {name}")
    return src.rows_sent
