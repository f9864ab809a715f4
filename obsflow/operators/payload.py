"""Payload parsing, validation, flattening and serialisation.

A payload is one JSON document per landing file::

    {"Codigo": 0, "Descripcion": ..., "Series": {"seriesId": ..., "descripEsp": ...,
     "Obs": [{"indexDateString": "DD-MM-YYYY", "value": "950.25", "statusCode": "OK"}]}}

Validation is file-level and happens *before* the explode: one bad date rejects every
row of that file, one bad file never blocks the others. Series and frequency come from
the landing path, not from the payload. Rows with a non-OK status are kept (views filter
them). All of it is ``from_json`` + higher-order functions + ``explode``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.functions.scalars import coerce_value, format_payload_date, parse_payload_date, value_unparseable
from obsflow.schema import PAYLOAD

# --- fixed values: reject reasons --------------------------------------------------------
INVALID_JSON = "invalid_json"
NOT_OBJECT = "not_object"
BAD_STRUCTURE = "bad_structure"
BAD_CODIGO = "bad_codigo"
MISSING_DATE = "missing_date"
BAD_DATE = "bad_date"
# -------------------------------------------------------------------------------------------

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
_EMPTY = ("[]", "{}", "")
_SCALAR_OR_ARRAY = r"^(\[.*\]|\".*\"|true|false|null|-?[0-9][0-9.eE+-]*)$"


def _date_missing(o: Column) -> Column:
    d = o["indexDateString"]
    return d.isNull() | (d == "")


def _date_bad(o: Column) -> Column:
    return parse_payload_date(o["indexDateString"]).isNull()


def _document(body: Column) -> Column:
    """The body without a byte order mark and blank ends, which are no error."""
    return F.regexp_replace(body, r"^[\s\uFEFF]+|\s+$", "")


def parse_payloads(files: DataFrame, body: str = "body") -> DataFrame:
    """ETL-1/2/6: add ``payload`` (parsed struct) and ``reject_reason`` (NULL = accepted)."""
    text = _document(F.col(body))
    # inside brackets a second document or junk after the first one is an error, not a tail left unread
    inside = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>", {"allowSingleQuotes": "false"})
    as_object = F.when(F.size(inside) == 1, F.get(inside, 0))
    parsed = F.from_json(text, PAYLOAD, _JSON_OPTIONS)
    df = files.withColumn("payload", parsed).withColumn("_object", as_object)
    obs = F.col("payload.Series.Obs")
    # an empty list, object or text in place of the series or its observations holds no rows
    empty_series = F.try_element_at("_object", F.lit("Series")).isin(*_EMPTY)
    no_rows = F.coalesce(empty_series, F.lit(False)) | F.coalesce(F.get_json_object(text, "$.Series.Obs").isin(*_EMPTY), F.lit(False))
    reason = (
        F.when(F.col("_object").isNull() & F.regexp_replace(text, r"\s+", " ").rlike(_SCALAR_OR_ARRAY), F.lit(NOT_OBJECT))
        .when(F.col("_object").isNull() | ~text.endswith("}"), F.lit(INVALID_JSON))
        .when(F.col("payload._corrupt").isNotNull() & ~no_rows, F.lit(BAD_STRUCTURE))
        .when(F.coalesce(F.col("payload.Codigo") != 0, F.lit(True)), F.lit(BAD_CODIGO))
        .when(F.coalesce(F.exists(obs, _date_missing), F.lit(False)), F.lit(MISSING_DATE))
        .when(F.coalesce(F.exists(obs, _date_bad), F.lit(False)), F.lit(BAD_DATE))
    )
    return df.withColumn("reject_reason", reason).drop("_object")


def flatten_payloads(parsed: DataFrame, ingested_at: dt.datetime | str | Column | None = None) -> DataFrame:
    """ETL-3/4/5/7/8: accepted files → one row per observation.

    ``parsed`` carries ``series_id`` and ``frequency`` decoded from the path. A null or
    empty ``Obs`` yields no rows. ``ingested_at`` is one instant for the whole load
    (default: the query's current timestamp, which Spark evaluates once per query).
    """
    if ingested_at is None:
        stamp = F.current_timestamp()
    elif isinstance(ingested_at, Column):
        stamp = ingested_at
    else:
        stamp = F.lit(ingested_at).cast("timestamp")
    keep = [c for c in ("relative_path", "modified_at", "period_label") if c in parsed.columns]
    exploded = parsed.where(F.col("reject_reason").isNull()).select(
        "series_id", "frequency", *keep, F.posexplode(F.col("payload.Series.Obs")).alias("position", "o")
    )
    raw = F.col("o.value")
    value = coerce_value(raw)
    return exploded.select(
        "series_id",
        parse_payload_date(F.col("o.indexDateString")).alias("observation_date"),
        value.alias("value"),
        F.col("o.statusCode").alias("status_code"),
        "frequency",
        stamp.alias("ingested_at"),
        *keep,
        "position",
        value_unparseable(raw, value).alias("unparseable"),
    )


def payload_body(codigo: Column, descripcion: Column, series_id: Column, descrip: Column, obs: Column) -> Column:
    """SNK-9: canonical serialisation — keys in sorted order at every level, nulls kept,
    non-ASCII text kept as is (UTF-8)."""
    envelope = F.struct(
        codigo.alias("Codigo"),
        descripcion.alias("Descripcion"),
        F.struct(obs.alias("Obs"), descrip.alias("descripEsp"), series_id.alias("seriesId")).alias("Series"),
    )
    return F.to_json(envelope, {"ignoreNullFields": "false"})


def obs_element(observation_date: Column, value_text: Column, status: Column) -> Column:
    """One payload observation, fields in sorted key order."""
    return F.struct(
        format_payload_date(observation_date).alias("indexDateString"),
        status.alias("statusCode"),
        value_text.alias("value"),
    )


def value_text(value: Column) -> Column:
    """A double as the shortest payload text that reads back as the same double (NULL stays NULL)."""
    return value.cast("double").cast("string")


def split_by_day(payloads: DataFrame, year: Column | str, body: str = "body") -> DataFrame:
    """CAL-10: a payload spanning a year → one payload per day with the same envelope.

    The split works on the document itself, so every field of the envelope and of the
    observation, known or not, keeps its value and type; keys are sorted at every level.
    Rows whose date does not parse are dropped (not the file, FLT-5); days outside
    ``year`` are dropped (FLT-4); for a date listed twice the last one wins. Input rows are
    ``(series_id, <year>, body)``; a body that is no JSON document yields no rows.
    """
    y = F.col(year) if isinstance(year, str) else year
    doc = F.try_parse_json(_document(F.col(body)))
    exploded = payloads.select("series_id", y.alias("_year"), doc.alias("_doc")).select(
        "series_id",
        "_year",
        F.try_variant_get("_doc", "$", "map<string,variant>").alias("_top"),
        F.try_variant_get("_doc", "$.Series", "map<string,variant>").alias("_series"),
        F.posexplode(F.try_variant_get("_doc", "$.Series.Obs", "array<variant>")).alias("_pos", "_obs"),
    )
    dated = exploded.withColumn("_day", parse_payload_date(F.try_variant_get("_obs", "$.indexDateString", "string")))
    kept = dated.where(F.col("_day").isNotNull() & (F.year("_day") == F.col("_year")))
    last = kept.groupBy("series_id", "_year", "_day").agg(F.max_by(_one_day(), F.col("_pos")).alias("body"))
    return last.select(
        "series_id", F.date_format("_day", "yyyy-MM-dd").alias("period_label"), F.col("_day").alias("observation_date"), "body"
    )


def _one_day() -> Column:
    """The document around one observation."""

    def replaced(fields: str, name: str, value: Column) -> Column:
        others = F.map_filter(fields, lambda k, _: k != name)
        return F.to_variant_object(F.map_concat(others, F.create_map(F.lit(name), value)))

    return F.to_json(replaced("_top", "Series", replaced("_series", "Obs", F.to_variant_object(F.array("_obs")))))
