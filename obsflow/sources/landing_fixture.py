"""A landing zone derived from the ``events`` table, for queries and tests.

Per event type (a daily series) it holds:

* one good payload per day of data, value text chosen by day: a decimal, ``"NaN"`` or ``""``
  for missing values (the latter two coerce to NULL, only ``"NaN"`` counts as unparseable);
* one monthly payload per month under ``<type>.M`` (monthly total);
* one file per reject case, dated after the series' last day;
* one file per ignored path shape (unknown frequency, other extension, other root folder,
  missing segment, extra segment).

Everything is generated with DataFrame operations (one row per file, ``explode`` over the
case list, no join) and written with the create-only landing writer. The zone is built
once per scale-factor folder and session, then reused read-only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.operators.payload import obs_element, payload_body, value_text
from obsflow.session import _checkpoint_root, scratch_dir
from obsflow.sources import adapters as A
from obsflow.sources.landing import landing_path, write_if_absent

# --- fixture: reject cases (offset in days after the series' last day, expected reason) ----
REJECT_CASES = [
    (1, "invalid_json"),
    (2, "bad_codigo"),
    (3, "not_object"),
    (4, "bad_date"),
    (5, None),  # empty observation list: accepted, no rows
    (6, "missing_date"),
    (7, "invalid_json"),  # valid object followed by trailing text
    (8, "bad_structure"),
    (9, "invalid_json"),  # a zero-length object
    (10, "invalid_json"),  # an object whose name starts with _
    (11, "invalid_json"),  # and one whose name starts with .
]
NAME_PREFIX = {10: "_", 11: "."}
IGNORED_SHAPES = [
    "raw/weekly/{s}/{d}.json",
    "raw/daily/{s}/{d}.txt",
    "dead_letter/raw/daily/{s}/{d}.json",
    "raw/daily/{s}.json",
    "raw/daily/{s}/extra/{d}.json",
]
DESCRIPTION = "Success"
# ---------------------------------------------------------------------------------------------

_BUILT: dict[tuple[str, str], str] = {}


def _daily_value_text() -> Column:
    day = F.dayofmonth("observation_date")
    return (
        F.when(F.col("value").isNotNull(), value_text(F.col("value")))
        .when(day % 14 == 0, F.lit(""))
        .otherwise(F.lit("NaN"))
    )


def _body(series: Column, obs: Column, codigo: Column | None = None) -> Column:
    return payload_body(
        codigo if codigo is not None else F.lit(0),
        F.lit(DESCRIPTION),
        series,
        F.concat(F.lit("Serie "), series),
        obs,
    )


def good_daily(spark: SparkSession, sf_dir: str, divisor: int = 1) -> DataFrame:
    ev = A.obs_events(spark, sf_dir).withColumn("value", F.col("value") / divisor)
    el = obs_element(F.col("observation_date"), _daily_value_text(), F.col("status_code"))
    return ev.select(
        landing_path(F.lit("daily"), F.col("series_id"), F.date_format("observation_date", "yyyy-MM-dd")).alias(
            "relative_path"
        ),
        _body(F.col("series_id"), F.array(el)).alias("body"),
    )


def monthly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.read_table(spark, sf_dir, "events")
    return e.groupBy(
        F.concat(F.col("event_type"), F.lit(".M")).alias("series_id"),
        F.trunc(F.to_date("ts"), "month").alias("observation_date"),
    ).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))


def good_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = monthly_rows(spark, sf_dir)
    el = obs_element(F.col("observation_date"), value_text(F.col("value")), F.lit("OK"))
    return m.select(
        landing_path(F.lit("monthly"), F.col("series_id"), F.date_format("observation_date", "yyyy-MM")).alias(
            "relative_path"
        ),
        _body(F.col("series_id"), F.array(el)).alias("body"),
    )


def _last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = A.obs_events(spark, sf_dir)
    return ev.groupBy("series_id").agg(F.max("observation_date").alias("last_day"))


def reject_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(r).cast("string").alias("reason")) for k, r in REJECT_CASES])
    per = _last_days(spark, sf_dir).select("series_id", "last_day", F.explode(cases).alias("c"))
    day = F.date_add("last_day", F.col("c.k"))
    s = F.col("series_id")
    good_el = obs_element(day, F.lit("1.00"), F.lit("OK"))
    iso_el = F.struct(F.date_format(day, "yyyy-MM-dd").alias("indexDateString"), F.lit("OK").alias("statusCode"), F.lit("2.00").alias("value"))
    no_date = F.struct(F.lit(None).cast("string").alias("indexDateString"), F.lit("OK").alias("statusCode"), F.lit("3.00").alias("value"))
    empty = F.array().cast("array<struct<indexDateString:string,statusCode:string,value:string>>")
    k = F.col("c.k")
    body = (
        F.when(k == 1, F.lit("<html><body>Service unavailable</body></html>"))
        .when(k == 2, payload_body(F.lit(-5), F.lit("Invalid series"), s, F.lit(None).cast("string"), empty))
        .when(k == 3, F.concat(F.lit("["), _body(s, F.array(good_el)), F.lit("]")))
        .when(k == 4, _body(s, F.array(good_el, iso_el)))
        .when(k == 5, _body(s, empty))
        .when(k == 6, _body(s, F.array(good_el, no_date)))
        .when(k == 7, F.concat(_body(s, F.array(good_el)), F.lit(" trailing")))
        .when(k == 8, F.lit('{"Codigo": 0, "Descripcion": "Success", "Series": "unavailable"}'))
        .when(k == 9, F.lit(""))
        .otherwise(F.lit("{"))
    )
    mark = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in NAME_PREFIX.items() for x in kv]), k), F.lit(""))
    return per.select(
        landing_path(F.lit("daily"), s, F.concat(mark, F.date_format(day, "yyyy-MM-dd"))).alias("relative_path"),
        body.alias("body"),
        F.col("c.reason").alias("reason"),
    )


def ignored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = _last_days(spark, sf_dir)
    d = F.date_format("last_day", "yyyy-MM-dd")
    s = F.col("series_id")

    def shape(t: str) -> Column:
        parts = []
        for chunk in t.replace("{d}", "\0d\0").replace("{s}", "\0s\0").split("\0"):
            if chunk == "d":
                parts.append(d)
            elif chunk == "s":
                parts.append(s)
            elif chunk:
                parts.append(F.lit(chunk))
        return F.concat(*parts)

    paths = F.array(*[shape(t) for t in IGNORED_SHAPES])
    el = obs_element(F.col("last_day"), F.lit("1.00"), F.lit("OK"))
    return per.select(F.explode(paths).alias("relative_path"), _body(s, F.array(el)).alias("body"))


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of the derived landing zone as ``(relative_path, body)``."""
    rejects = reject_files(spark, sf_dir).select("relative_path", "body")
    return (
        good_daily(spark, sf_dir)
        .unionByName(good_monthly(spark, sf_dir))
        .unionByName(rejects)
        .unionByName(ignored_files(spark, sf_dir))
    )


def build_landing(spark: SparkSession, sf_dir: str) -> str:
    """Materialise the derived landing zone once (per folder and checkpoint root); return its root."""
    key = (sf_dir.rstrip("/"), _checkpoint_root(spark))
    root = _BUILT.get(key)
    if root is None:
        root = scratch_dir(spark, "landing")
        write_if_absent(spark, landing_files(spark, sf_dir), root)
        _BUILT[key] = root
    return root
