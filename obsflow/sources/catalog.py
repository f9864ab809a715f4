"""Series catalog and dimension sources.

The catalog document maps each frequency to a list of series entries. Flattening is
``explode(map)`` then ``explode(array)``: a null list is tolerated, a missing root or an
unknown frequency fails the job (``raise_error``), a missing description becomes "".
Catalog documents are read as JSON (one document per file, or many per file as lines);
any number of documents can be flattened at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.schema import CATALOG, DIM_FREQUENCY, DIM_FREQUENCY_ROWS, DIM_SERIES, FREQUENCIES


def read_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Catalog documents from JSON files (a YAML catalog maps one-to-one onto this shape)."""
    return spark.read.schema(CATALOG).option("multiLine", multi_line).json(path)


def flatten_catalog(docs: DataFrame) -> DataFrame:
    """SRC-5: ``series: map<frequency, array<entry>>`` → one row per series."""
    root = F.when(F.col("series").isNull(), F.raise_error(F.lit("catalog document has no top-level 'series' key"))).otherwise(
        F.col("series")
    )
    per_freq = docs.select(F.explode(root).alias("frequency", "entries"))
    freq = F.col("frequency")
    checked = F.when(freq.isin(*FREQUENCIES), freq).otherwise(
        F.raise_error(F.concat(F.lit("invalid frequency '"), F.coalesce(freq, F.lit("null")), F.lit("' in catalog")))
    )
    entries = per_freq.select(checked.alias("frequency"), F.explode("entries").alias("e"))
    series_id = F.when(F.col("e.id").isNull(), F.raise_error(F.lit("catalog entry without id"))).otherwise(F.col("e.id"))
    return entries.select(
        series_id.alias("series_id"),
        F.col("e.name").alias("name"),
        F.col("e.unit").alias("unit"),
        "frequency",
        F.coalesce(F.col("e.description"), F.lit("")).alias("description"),
    )


def catalog_by_frequency(catalog: DataFrame, frequency: str) -> DataFrame:
    """FLT-3: the series of one frequency; an unknown frequency is an error."""
    if frequency not in FREQUENCIES:
        raise ValueError(f"unknown frequency {frequency!r}; expected one of {FREQUENCIES}")
    return catalog.where(F.col("frequency") == frequency)


def dim_frequency(spark: SparkSession) -> DataFrame:
    """SRC-6 / SNK-3: the static frequency dimension, wholly defined by literals."""
    return spark.createDataFrame(DIM_FREQUENCY_ROWS, DIM_FREQUENCY)


def dim_series_from_catalog(catalog: DataFrame, updated_at) -> DataFrame:
    """Dimension rows from a flattened catalog, stamped with ``updated_at``."""
    return catalog.select(
        "series_id",
        "name",
        "unit",
        "frequency",
        "description",
        F.lit(updated_at).cast("timestamp").alias("updated_at"),
    )


def dim_series_literal(spark: SparkSession, rows, updated_at=None) -> DataFrame:
    """A dimension seed given inline as ``(series_id, name, unit, frequency, description)``."""
    df = spark.createDataFrame([(*r, None) for r in rows], DIM_SERIES)
    if updated_at is not None:
        df = df.withColumn("updated_at", F.lit(updated_at).cast("timestamp"))
    return df
