"""Payload validation (file-level rejects), flattening, serialisation and the day splitter."""

import datetime as dt
import json

from pyspark.sql import functions as F

from obsflow.operators import payload as P
from obsflow.plans import load as L
from obsflow.sources.landing import decode_path

GOOD = {
    "Codigo": 0,
    "Descripcion": "Success",
    "Series": {
        "seriesId": "ignored-in-favour-of-path",
        "descripEsp": "Serie de prueba",
        "Obs": [
            {"indexDateString": "23-03-2031", "value": "61.5", "statusCode": "OK"},
            {"indexDateString": "24-03-2031", "value": 951, "statusCode": "OK"},
            {"indexDateString": "25-03-2031", "value": "NaN", "statusCode": "ND"},
        ],
    },
}


def _files(spark, bodies):
    rows = [(f"raw/daily/S{i}/2026-07-{14 + i:02d}.json", b) for i, b in enumerate(bodies)]
    return decode_path(spark.createDataFrame(rows, "relative_path string, body string"))


def test_flatten_good_payload(spark):
    parsed = P.parse_payloads(_files(spark, [json.dumps(GOOD, ensure_ascii=False)]))
    rows = P.flatten_payloads(parsed, "2026-07-17 09:00:00").orderBy("observation_date").collect()
    assert [(r.series_id, r.observation_date, r.value, r.status_code, r.frequency) for r in rows] == [
        ("S0", dt.date(2031, 3, 23), 61.5, "OK", "daily"),
        ("S0", dt.date(2031, 3, 24), 951.0, "OK", "daily"),
        ("S0", dt.date(2031, 3, 25), None, "ND", "daily"),
    ]
    assert {r.ingested_at for r in rows} == {dt.datetime(2026, 7, 17, 9, 0)}
    assert [r.unparseable for r in rows] == [False, False, True]


REJECTS = [
    ("not json", "invalid_json"),
    ('{"Codigo": 0} trailing', "invalid_json"),
    ('{"Codigo": 0}{"Codigo": 0}', "invalid_json"),
    ('{"Codigo": 0}, {"Codigo": 0}', "invalid_json"),
    ('{"Codigo": 0} junk }', "invalid_json"),
    ("{'Codigo': 0}", "invalid_json"),
    ("[1, 2]", "not_object"),
    ('"text"', "not_object"),
    ('{"Codigo": -5, "Descripcion": "bad"}', "bad_codigo"),
    ('{"Codigo": "0"}', "bad_structure"),
    ("{}", "bad_codigo"),
    ('{"Codigo": 0, "Series": {"Obs": [{"indexDateString": "23-03-2031", "value": "1"}, {"indexDateString": "2031-03-24"}]}}', "bad_date"),
    ('{"Codigo": 0, "Series": {"Obs": [{"value": "1"}]}}', "missing_date"),
    ('{"Codigo": 0, "Series": {"Obs": [{"indexDateString": "", "value": "1"}]}}', "missing_date"),
    ('{"Codigo": 0, "Series": {"Obs": [1, 2]}}', "bad_structure"),
    ('{"Codigo": 0, "Series": "x"}', "bad_structure"),
]


def test_reject_reasons_are_file_level(spark):
    parsed = P.parse_payloads(_files(spark, [b for b, _ in REJECTS]))
    got = {r.relative_path: r.reject_reason for r in parsed.collect()}
    for i, (body, want) in enumerate(REJECTS):
        assert got[f"raw/daily/S{i}/2026-07-{14 + i:02d}.json"] == want, body
    # one bad date rejects every row of its file
    assert P.flatten_payloads(parsed).count() == 0


def test_empty_or_missing_obs_is_accepted_without_rows(spark):
    bodies = ['{"Codigo": 0, "Series": {"Obs": []}}', '{"Codigo": 0, "Series": null}', '{"Codigo": 0.0}']
    parsed = P.parse_payloads(_files(spark, bodies))
    assert [r.reject_reason for r in parsed.collect()] == [None, None, None]
    assert P.flatten_payloads(parsed).count() == 0
    bodies = ['{"Codigo": 0, "Series": []}', '{"Codigo": 0, "Series": ""}', '{"Codigo": 0, "Series": {"Obs": {}}}', '{"Codigo": 7, "Series": []}']
    parsed = P.parse_payloads(_files(spark, bodies))
    assert [r.reject_reason for r in parsed.collect()] == [None, None, None, "bad_codigo"]
    assert P.flatten_payloads(parsed).count() == 0


def test_blank_ends_and_byte_order_mark_are_accepted(spark):
    body = json.dumps(GOOD)
    parsed = P.parse_payloads(_files(spark, [body + "\n", body + "\r\n\t", "\ufeff" + body]))
    assert [r.reject_reason for r in parsed.collect()] == [None, None, None]
    assert P.flatten_payloads(parsed).count() == 9


def test_value_text_is_lossless(spark):
    values = [1.23456, 0.0049, 1e17, float("inf"), -2.5e-7, 0.1 + 0.2]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [float(r.t) for r in df.select(P.value_text(df.v).alias("t")).collect()] == values


def test_serialise_then_flatten_round_trip(spark):
    df = spark.createDataFrame(
        [("S1", dt.date(2031, 3, 23), 61.5, "OK"), ("S1", dt.date(2031, 3, 24), None, "ND")],
        "series_id string, observation_date date, value double, status_code string",
    )
    el = P.obs_element(F.col("observation_date"), P.value_text(F.col("value")), F.col("status_code"))
    body = P.payload_body(F.lit(0), F.lit("Success"), F.col("series_id"), F.lit("Ñandú"), F.array(el))
    files = df.select(
        F.concat(F.lit("raw/daily/"), "series_id", F.lit("/"), F.col("observation_date").cast("string"), F.lit(".json")).alias("relative_path"),
        body.alias("body"),
    )
    text = files.first().body
    assert list(json.loads(text)) == sorted(json.loads(text))  # keys in sorted order
    assert "Ñandú" in text  # non-ASCII kept
    back = P.flatten_payloads(P.parse_payloads(decode_path(files))).select("series_id", "observation_date", "value", "status_code")
    assert sorted(back.collect()) == sorted(df.collect())


def test_split_by_day(spark):
    yearly = dict(GOOD)
    yearly["Series"] = dict(GOOD["Series"])
    yearly["Series"]["Obs"] = [
        {"indexDateString": "01-02-2026", "value": "1", "statusCode": "OK"},
        {"indexDateString": "02-02-2026", "value": "2", "statusCode": "OK"},
        {"indexDateString": "31-12-2025", "value": "9", "statusCode": "OK"},  # other year
        {"indexDateString": "bad", "value": "9", "statusCode": "OK"},  # tolerated, dropped
        {"indexDateString": "01-02-2026", "value": "3", "statusCode": "OK"},  # last duplicate wins
    ]
    df = spark.createDataFrame([("S1", 2026, json.dumps(yearly))], "series_id string, y int, body string")
    out = P.split_by_day(P.parse_payloads(df), "y").orderBy("period_label").collect()
    assert [r.period_label for r in out] == ["2026-02-01", "2026-02-02"]
    first = json.loads(out[0].body)
    assert first["Series"]["Obs"] == [{"indexDateString": "01-02-2026", "statusCode": "OK", "value": "3"}]
    assert first["Descripcion"] == "Success" and first["Series"]["descripEsp"] == "Serie de prueba"
    # fields the engine does not know, numbers and nulls come through as they are
    yearly["Extra"], yearly["Nada"], yearly["Series"]["escala"] = {"b": [1, 2.5], "a": True}, None, 3
    yearly["Series"]["Obs"] = [{"indexDateString": "01-02-2026", "value": 1.23456, "statusCode": "OK", "nota": "x"}]
    df = spark.createDataFrame([("S1", 2026, json.dumps(yearly)), ("S2", 2026, "oops")], "series_id string, y int, body string")
    assert [json.loads(r.body) for r in P.split_by_day(df, "y").collect()] == [yearly]
    empty = spark.createDataFrame([("S1", 2026, '{"Codigo": 0, "Series": {"Obs": []}}')], "series_id string, y int, body string")
    assert P.split_by_day(P.parse_payloads(empty), "y").count() == 0


def test_load_summary_counts(spark):
    rows = [
        ("raw/daily/A/2031-03-23.json", json.dumps(GOOD)),
        ("raw/daily/A/2031-03-24.json", "oops"),
        ("raw/weekly/A/2031-03-24.json", json.dumps(GOOD)),
    ]
    files = decode_path(spark.createDataFrame(rows, "relative_path string, body string"))
    parsed = P.parse_payloads(files.where("on_pattern")).unionByName(files.where("not on_pattern"), allowMissingColumns=True)
    r = L.load_summary(parsed).first()
    assert (r.files_scanned, r.files_skipped, r.files_failed, r.rows_extracted) == (1, 1, 1, 3)
