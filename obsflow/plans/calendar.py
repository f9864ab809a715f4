"""Calendar operators as column expressions.

Period windows, day/month/quarter sequences and year chunks are computed per row with
``sequence``/``trunc``/``add_months``/``last_day``; expanding them is an ``explode``
(a generator inside the task), never a join against a calendar table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsflow.functions.scalars import day_label, month_label, quarter_label

_PERIOD = "struct<first_date:date,last_date:date,period_label:string>"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_window(frequency: Column | str, as_of: Column | str) -> Column:
    """CAL-1..4: the previous full period relative to ``as_of`` → struct(first, last, label).

    daily: the previous day; monthly: the previous calendar month; quarterly: the previous
    calendar quarter (with year rollover). An unknown frequency is an error.
    """
    f, d = _c(frequency), _c(as_of)
    prev_day = F.date_sub(d, 1)
    month_start = F.add_months(F.trunc(d, "month"), -1)
    quarter_start = F.add_months(F.trunc(d, "quarter"), -3)
    return (
        F.when(f == "daily", F.struct(prev_day.alias("first_date"), prev_day.alias("last_date"), day_label(prev_day).alias("period_label")))
        .when(
            f == "monthly",
            F.struct(
                month_start.alias("first_date"),
                F.date_sub(F.trunc(d, "month"), 1).alias("last_date"),
                month_label(month_start).alias("period_label"),
            ),
        )
        .when(
            f == "quarterly",
            F.struct(
                quarter_start.alias("first_date"),
                F.date_sub(F.trunc(d, "quarter"), 1).alias("last_date"),
                quarter_label(quarter_start).alias("period_label"),
            ),
        )
        .otherwise(F.raise_error(F.concat(F.lit("unknown frequency: "), F.coalesce(f, F.lit("null")))).cast(_PERIOD))
    )


def _seq(start: Column, end: Column, step: str) -> Column:
    empty = F.array().cast("array<date>")
    return F.when(start <= end, F.sequence(start, end, F.expr(f"INTERVAL {step}"))).otherwise(empty)


def days(start: Column | str, end: Column | str) -> Column:
    """CAL-5: every day of [start, end] (empty when start > end)."""
    return _seq(_c(start), _c(end), "1 DAY")


def months(start: Column | str, end: Column | str) -> Column:
    """CAL-6: (first, last, 'YYYY-MM') of every month touched by [start, end]; months
    start on the first even when the bounds fall mid-month."""
    s, e = _c(start), _c(end)
    firsts = F.when(s <= e, F.sequence(F.trunc(s, "month"), e, F.expr("INTERVAL 1 MONTH"))).otherwise(F.array().cast("array<date>"))
    return F.transform(
        firsts, lambda m: F.struct(m.alias("first_date"), F.last_day(m).alias("last_date"), month_label(m).alias("period_label"))
    )


def quarters(start: Column | str, end: Column | str) -> Column:
    """CAL-7: (first, last, 'YYYY-Qn') of every quarter touched by [start, end]."""
    s, e = _c(start), _c(end)
    firsts = F.when(s <= e, F.sequence(F.trunc(s, "quarter"), e, F.expr("INTERVAL 3 MONTHS"))).otherwise(F.array().cast("array<date>"))
    return F.transform(
        firsts,
        lambda q: F.struct(
            q.alias("first_date"), F.last_day(F.add_months(q, 2)).alias("last_date"), quarter_label(q).alias("period_label")
        ),
    )


def periods(frequency: Column | str, start: Column | str, end: Column | str) -> Column:
    """The periods of a series' own frequency within [start, end]."""
    f = _c(frequency)
    daily = F.transform(days(start, end), lambda d: F.struct(d.alias("first_date"), d.alias("last_date"), day_label(d).alias("period_label")))
    return (
        F.when(f == "daily", daily)
        .when(f == "monthly", months(start, end))
        .when(f == "quarterly", quarters(start, end))
        .otherwise(F.raise_error(F.concat(F.lit("unknown frequency: "), F.coalesce(f, F.lit("null")))).cast(f"array<{_PERIOD}>"))
    )


def year_chunks(start: Column | str, end: Column | str) -> Column:
    """CAL-8: one (year, first, last) per calendar year of [start, end], clipped to it."""
    s, e = _c(start), _c(end)
    years = F.when(s <= e, F.sequence(F.year(s), F.year(e))).otherwise(F.array().cast("array<int>"))
    return F.transform(
        years,
        lambda y: F.struct(
            y.alias("year"),
            F.greatest(s, F.make_date(y, F.lit(1), F.lit(1))).alias("first_date"),
            F.least(e, F.make_date(y, F.lit(12), F.lit(31))).alias("last_date"),
        ),
    )


def trailing_years(as_of: Column | str, years: int) -> Column:
    """CAL-13: (start, end) with end = as_of - 1 day and start = end - ``years`` years
    (a 29 February end maps to 28 February)."""
    end = F.date_sub(_c(as_of), 1)
    return F.struct(F.add_months(end, -12 * years).alias("start_date"), end.alias("end_date"))
