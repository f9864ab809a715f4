"""Schemas, domains and fixed values of the observation store."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the served contract) -------------------------------------
FREQUENCIES = ("daily", "monthly", "quarterly")
VALID_STATUS = "OK"
CHANGE_LABELS = {"up": "alza", "down": "baja", "same": "sin_cambio"}
NULL_VALUE_WORDS = ("NA", "NAN", "NULL")
LANDING_PATH_PATTERN = r"^raw/(daily|monthly|quarterly)/([^/]+)/([^/]+)\.json$"
DIM_FREQUENCY_ROWS = [
    ("daily", "Series published on business days", "0 9 * * 1-5"),
    ("monthly", "Series published monthly", "0 10 5 * *"),
    ("quarterly", "Series published quarterly (Jan/Apr/Jul/Oct)", "0 10 15 1,4,7,10 *"),
]
# ---------------------------------------------------------------------------------------

KEYS = ["series_id", "observation_date"]

OBSERVATIONS = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("observation_date", T.DateType(), False),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("status_code", T.StringType(), True),
        T.StructField("frequency", T.StringType(), True),
        T.StructField("ingested_at", T.TimestampType(), True),
    ]
)
OBSERVATION_COLUMNS = [f.name for f in OBSERVATIONS.fields]

DIM_SERIES = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("unit", T.StringType(), True),
        T.StructField("frequency", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("updated_at", T.TimestampType(), True),
    ]
)
DIM_SERIES_COLUMNS = [f.name for f in DIM_SERIES.fields]

DIM_FREQUENCY = T.StructType(
    [
        T.StructField("frequency", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("schedule_cron", T.StringType(), True),
    ]
)

# One observation inside a payload; ``value`` is kept as text and coerced later because
# it arrives as a string, a number or null.
PAYLOAD_OBS = T.StructType(
    [
        T.StructField("indexDateString", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField("statusCode", T.StringType(), True),
    ]
)
PAYLOAD = T.StructType(
    [
        T.StructField("Codigo", T.DoubleType(), True),
        T.StructField("Descripcion", T.StringType(), True),
        T.StructField(
            "Series",
            T.StructType(
                [
                    T.StructField("seriesId", T.StringType(), True),
                    T.StructField("descripEsp", T.StringType(), True),
                    T.StructField("Obs", T.ArrayType(PAYLOAD_OBS, True), True),
                ]
            ),
            True,
        ),
        T.StructField("_corrupt", T.StringType(), True),
    ]
)

CATALOG_ENTRY = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("unit", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
    ]
)
CATALOG = T.StructType(
    [T.StructField("series", T.MapType(T.StringType(), T.ArrayType(CATALOG_ENTRY, True), True), True)]
)
