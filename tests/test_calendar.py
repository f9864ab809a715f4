"""Period windows, sequences, year chunks, trailing range (cases of the reference tests)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obsflow.plans import calendar as C

D = dt.date

WINDOW_CASES = [
    ("2026-07-14", "daily", D(2026, 7, 13), D(2026, 7, 13), "2026-07-13"),
    ("2026-01-01", "daily", D(2025, 12, 31), D(2025, 12, 31), "2025-12-31"),
    ("2026-07-05", "monthly", D(2026, 6, 1), D(2026, 6, 30), "2026-06"),
    ("2026-03-01", "monthly", D(2026, 2, 1), D(2026, 2, 28), "2026-02"),
    ("2024-03-05", "monthly", D(2024, 2, 1), D(2024, 2, 29), "2024-02"),
    ("2026-01-05", "monthly", D(2025, 12, 1), D(2025, 12, 31), "2025-12"),
    ("2026-04-15", "quarterly", D(2026, 1, 1), D(2026, 3, 31), "2026-Q1"),
    ("2026-01-15", "quarterly", D(2025, 10, 1), D(2025, 12, 31), "2025-Q4"),
    ("2026-12-31", "quarterly", D(2026, 7, 1), D(2026, 9, 30), "2026-Q3"),
]


@pytest.mark.parametrize("as_of,freq,first,last,label", WINDOW_CASES)
def test_period_window(spark, as_of, freq, first, last, label):
    df = spark.createDataFrame([(as_of, freq)], "a string, f string").select(F.col("a").cast("date").alias("a"), "f")
    r = df.select(C.period_window("f", "a").alias("w")).first().w
    assert (r.first_date, r.last_date, r.period_label) == (first, last, label)


def test_unknown_frequency_raises(spark):
    df = spark.createDataFrame([("2026-07-14", "weekly")], "a string, f string").select(F.col("a").cast("date").alias("a"), "f")
    with pytest.raises(Exception, match="unknown frequency"):
        df.select(C.period_window("f", "a")).collect()


def _one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_months_cover_whole_months(spark):
    got = _one(spark, C.months(F.lit(D(2023, 11, 15)), F.lit(D(2024, 2, 5))))
    assert [(m.first_date, m.last_date, m.period_label) for m in got] == [
        (D(2023, 11, 1), D(2023, 11, 30), "2023-11"),
        (D(2023, 12, 1), D(2023, 12, 31), "2023-12"),
        (D(2024, 1, 1), D(2024, 1, 31), "2024-01"),
        (D(2024, 2, 1), D(2024, 2, 29), "2024-02"),
    ]


def test_quarters_with_labels(spark):
    got = _one(spark, C.quarters(F.lit(D(2023, 11, 15)), F.lit(D(2024, 4, 5))))
    assert [(q.first_date, q.last_date, q.period_label) for q in got] == [
        (D(2023, 10, 1), D(2023, 12, 31), "2023-Q4"),
        (D(2024, 1, 1), D(2024, 3, 31), "2024-Q1"),
        (D(2024, 4, 1), D(2024, 6, 30), "2024-Q2"),
    ]


def test_days_inclusive_and_empty(spark):
    assert len(_one(spark, C.days(F.lit(D(2024, 2, 27)), F.lit(D(2024, 3, 1))))) == 4
    assert _one(spark, C.days(F.lit(D(2024, 3, 2)), F.lit(D(2024, 3, 1)))) == []


def test_year_chunks_clipped(spark):
    got = _one(spark, C.year_chunks(F.lit(D(2022, 6, 15)), F.lit(D(2024, 2, 3))))
    assert [(c.year, c.first_date, c.last_date) for c in got] == [
        (2022, D(2022, 6, 15), D(2022, 12, 31)),
        (2023, D(2023, 1, 1), D(2023, 12, 31)),
        (2024, D(2024, 1, 1), D(2024, 2, 3)),
    ]


def test_trailing_years_clamps_leap_day(spark):
    r = _one(spark, C.trailing_years(F.lit(D(2024, 3, 1)), 5))
    assert (r.start_date, r.end_date) == (D(2019, 2, 28), D(2024, 2, 29))
