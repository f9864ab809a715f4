"""Column expressions shared by every layer (all JVM-side, codegen-friendly).

Nothing here is a UDF: value coercion, the payload date grammar, safe division and the
period labels are built from ``regexp``/``try_cast``/``try_to_date``/``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsflow.schema import NULL_VALUE_WORDS

# --- fixed values: text grammars the loader accepts -------------------------------------
# whitespace removed around a value, as a general-purpose text strip does
_WS = r"[\p{javaWhitespace}\x85\xa0\x{2007}\x{202f}]"
# decimal float grammar: digits may be grouped with single underscores, optional exponent
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER_TEXT = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
INFINITY_TEXT = r"^[+-]?(?i:inf|infinity)$"
NAN_TEXT = r"^[+-]?(?i:nan)$"
# payload dates are day-month-year; day and month may have one digit (a day may also be a
# blank followed by one digit), the year has exactly four
PAYLOAD_DATE_TEXT = r"^(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])-(1[0-2]|0[1-9]|[1-9])-([0-9]{4})$"
# -----------------------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_text(col: Column | str) -> Column:
    """Remove leading/trailing whitespace of every kind (``trim`` only removes blanks)."""
    return F.regexp_replace(_c(col), rf"^{_WS}+|{_WS}+$", "")


def coerce_value(raw: Column | str) -> Column:
    """Payload value text → double; null, blank, NA/NaN/NULL (any case) and junk → NULL.

    Numbers arriving as JSON numbers are read as their literal text, so one grammar covers
    both shapes. Signed ``inf``/``nan`` forms keep their IEEE meaning; the bare word
    ``nan`` is one of the null words and becomes NULL.
    """
    s = strip_text(raw)
    is_null_word = F.upper(s).isin(*NULL_VALUE_WORDS)
    numeric = F.regexp_replace(s, "_", "").try_cast("double")
    return (
        F.when(_c(raw).isNull() | (s == "") | is_null_word, F.lit(None).cast("double"))
        .when(s.rlike(NUMBER_TEXT), numeric)
        .when(s.rlike(INFINITY_TEXT), F.when(s.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .when(s.rlike(NAN_TEXT), F.lit(float("nan")))
        .otherwise(F.lit(None).cast("double"))
    )


def value_unparseable(raw: Column | str, value: Column | str) -> Column:
    """A value that was present (not null, not the empty string) yet coerced to NULL."""
    return _c(value).isNull() & _c(raw).isNotNull() & (_c(raw) != "")


def parse_payload_date(text: Column | str) -> Column:
    """``DD-MM-YYYY`` text → date; wrong shape, impossible day or year 0 → NULL."""
    t = _c(text)
    day = F.regexp_extract(t, PAYLOAD_DATE_TEXT, 1)
    month = F.regexp_extract(t, PAYLOAD_DATE_TEXT, 2)
    year = F.regexp_extract(t, PAYLOAD_DATE_TEXT, 3)
    iso = F.concat_ws("-", year, month, F.trim(day))
    return F.when(t.rlike(PAYLOAD_DATE_TEXT) & (year != "0000"), F.try_to_date(iso, "yyyy-M-d"))


def format_payload_date(d: Column | str) -> Column:
    return F.date_format(_c(d), "dd-MM-yyyy")


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero (or NULL) divisor."""
    return F.try_divide(num, den)


def pct_change(value: Column, previous: Column, digits: int) -> Column:
    """round((v - prev) / prev * 100, digits), NULL when prev is NULL or zero."""
    return F.round(safe_div(value - previous, previous) * F.lit(100.0), digits)


def day_label(d: Column | str) -> Column:
    return F.date_format(_c(d), "yyyy-MM-dd")


def month_label(d: Column | str) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def quarter_label(d: Column | str) -> Column:
    d = _c(d)
    return F.concat(F.lpad(F.year(d).cast("string"), 4, "0"), F.lit("-Q"), F.quarter(d).cast("string"))


def period_label(frequency: Column | str, first_day: Column | str) -> Column:
    f = _c(frequency)
    return (
        F.when(f == "daily", day_label(first_day))
        .when(f == "monthly", month_label(first_day))
        .when(f == "quarterly", quarter_label(first_day))
    )
