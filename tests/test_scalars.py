"""Value coercion, payload date grammar, path decoding, labels (table-driven)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from obsflow.functions.scalars import coerce_value, parse_payload_date, quarter_label, safe_div, value_unparseable
from obsflow.sources.landing import decode_path, landing_path

VALUE_CASES = [
    ("950.25", 950.25),
    ("0", 0.0),
    ("-1.5", -1.5),
    ("", None),
    (None, None),
    ("NA", None),
    ("NaN", None),
    ("nan", None),
    ("null", None),
    ("NULL", None),
    ("not-a-number", None),
    ("42", 42.0),  # a JSON number arrives as its literal text
    ("3.14", 3.14),
    ("1d", None),
    ("1.5f", None),
    ("0x1p3", None),
    ("950,25", None),
    ("+1", 1.0),
    (".5", 0.5),
    ("5.", 5.0),
    ("1E-3", 0.001),
    (" 1 ", 1.0),
    ("\t2.5\n", 2.5),
    ("1_000", 1000.0),
    ("1__000", None),
    ("_1", None),
    ("inf", math.inf),
    ("-Infinity", -math.inf),
]


def test_value_coercion_table(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(VALUE_CASES)], "i int, raw string")
    got = {r.i: r.v for r in df.select("i", coerce_value(F.col("raw")).alias("v")).collect()}
    for i, (raw, want) in enumerate(VALUE_CASES):
        assert got[i] == want, (raw, got[i], want)


def test_signed_nan_is_a_value(spark):
    r = spark.createDataFrame([("+nan",)], "raw string").select(coerce_value(F.col("raw")).alias("v")).first()
    assert r.v is not None and math.isnan(r.v)


def test_unparseable_counts_present_values_only(spark):
    rows = [("NA", True), ("", False), (None, False), ("1.0", False), ("  ", True), ("junk", True)]
    df = spark.createDataFrame([(r,) for r, _ in rows], "raw string")
    got = [r.u for r in df.select(value_unparseable(F.col("raw"), coerce_value(F.col("raw"))).alias("u")).collect()]
    assert got == [w for _, w in rows]


DATE_CASES = [
    ("14-07-2026", dt.date(2026, 7, 14)),
    ("1-7-2026", dt.date(2026, 7, 1)),
    ("01-02-2024", dt.date(2024, 2, 1)),
    ("29-02-2024", dt.date(2024, 2, 29)),
    (" 1-07-2026", dt.date(2026, 7, 1)),
    ("2026-07-14", None),  # ISO is not the payload format
    ("31-02-2026", None),
    ("29-02-2023", None),
    ("14-07-26", None),
    ("014-07-2026", None),
    ("14-07-2026 ", None),
    ("14/07/2026", None),
    ("01-01-0000", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("text,want", DATE_CASES)
def test_payload_date(spark, text, want):
    r = spark.createDataFrame([(text,)], "t string").select(parse_payload_date(F.col("t")).alias("d")).first()
    assert r.d == want


PATH_CASES = [
    ("raw/daily/USD.OBS.D/2026-07-14.json", True, ("daily", "USD.OBS.D", "2026-07-14")),
    ("raw/monthly/CPI.VAR.M/2026-06.json", True, ("monthly", "CPI.VAR.M", "2026-06")),
    ("raw/quarterly/GDP.Q/2026-Q2.json", True, ("quarterly", "GDP.Q", "2026-Q2")),
    ("raw/weekly/X/2026-07-14.json", False, None),
    ("raw/daily/X/2026-07-14.txt", False, None),
    ("dead_letter/raw/daily/X/2026-07-14.json", False, None),
    ("raw/daily/2026-07-14.json", False, None),
    ("raw/daily/X/extra/2026-07-14.json", False, None),
]


def test_path_decode(spark):
    df = spark.createDataFrame([(p,) for p, _, _ in PATH_CASES], "relative_path string")
    got = {r.relative_path: r for r in decode_path(df).collect()}
    for path, on, parts in PATH_CASES:
        r = got[path]
        assert r.on_pattern is on
        if parts:
            assert (r.frequency, r.series_id, r.period_label) == parts
        else:
            assert r.frequency is None and r.series_id is None


def test_landing_path_builder(spark):
    df = spark.createDataFrame([("daily", "S1", "2026-07-14")], "f string, s string, p string")
    assert df.select(landing_path("f", "s", "p").alias("x")).first().x == "raw/daily/S1/2026-07-14.json"
    for bad in [("", "S1", "x"), ("daily", None, "x"), ("daily", "S1", "")]:
        df = spark.createDataFrame([bad], "f string, s string, p string")
        with pytest.raises(Exception, match="needs a frequency, a series id and a period label"):
            df.select(landing_path("f", "s", "p")).collect()


def test_safe_div_and_quarter_label(spark):
    r = spark.sql("select 1.0d as a, 0.0d as z, date'2026-04-15' as d").select(
        safe_div(F.col("a"), F.col("z")).alias("q"), quarter_label(F.col("d")).alias("lab")
    ).first()
    assert r.q is None and r.lab == "2026-Q2"
