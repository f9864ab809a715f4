"""Per-series window analytics.

Every window is partitioned by the series key and ordered by date, so the work is spread
over series (one hash exchange on ``series_id``, one sort, one ``Window`` node for all
expressions that share a spec). Windows count *rows*, not days: a gap or a filtered row
shifts the comparison period, exactly as in the served views. Filtering on valid
observations happens before any window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from obsflow.functions.scalars import pct_change
from obsflow.schema import CHANGE_LABELS, VALID_STATUS


def valid_observations(obs: DataFrame) -> DataFrame:
    """FLT-1: keep rows with status OK and a value; must precede every window."""
    return obs.where((F.col("status_code") == VALID_STATUS) & F.col("value").isNotNull())


def select_series(obs: DataFrame, series_ids: Sequence[str] | str | Column | None) -> DataFrame:
    """FLT-2: optional series selection — ids, or a predicate on the series (a
    partition-key filter, so it is safe before windows and Catalyst pushes it down)."""
    if series_ids is None:
        return obs
    if isinstance(series_ids, Column):
        return obs.where(series_ids)
    ids = [series_ids] if isinstance(series_ids, str) else list(series_ids)
    return obs.where(F.col("series_id").isin(ids))


def series_window(keys: Sequence[str] = ("series_id",), order: str = "observation_date") -> WindowSpec:
    """WIN-9: the one named window every expression of a view reuses."""
    return Window.partitionBy(*keys).orderBy(F.col(order).asc())


def rows_frame(w: WindowSpec, preceding: int) -> WindowSpec:
    return w.rowsBetween(-preceding, Window.currentRow)


def previous(value: str, w: WindowSpec, n: int = 1) -> Column:
    return F.lag(F.col(value), n).over(w)


def abs_change(value: str, w: WindowSpec, n: int = 1) -> Column:
    """WIN-1: v - lag(v, n)."""
    return F.col(value) - previous(value, w, n)


def pct_change_over(value: str, w: WindowSpec, n: int, digits: int) -> Column:
    """WIN-2/3/4: round(safe_div(v - lag(v,n), lag(v,n)) * 100, digits)."""
    return pct_change(F.col(value), previous(value, w, n), digits)


def moving_avg(value: str, w: WindowSpec, rows: int) -> Column:
    """WIN-5: mean of the current and ``rows-1`` preceding rows (fewer at the start)."""
    return F.avg(F.col(value)).over(rows_frame(w, rows - 1))


def compounded_growth(pct_value: str, w: WindowSpec, rows: int, digits: int) -> Column:
    """WIN-6: round((prod(1 + p/100) - 1) * 100, digits) over ``rows`` rows, computed as
    exp(sum(ln(.))). A frame holding a rate of -100 % or below has no logarithm; the
    whole frame then yields NULL instead of silently skipping that month."""
    growth = F.lit(1.0) + F.col(pct_value) / F.lit(100.0)
    frame = rows_frame(w, rows - 1)
    log_growth = F.ln(F.when(growth > 0, growth))
    broken = F.sum(F.when(growth <= 0, F.lit(1)).otherwise(F.lit(0))).over(frame)
    compounded = F.round((F.exp(F.sum(log_growth).over(frame)) - F.lit(1.0)) * F.lit(100.0), digits)
    return F.when(broken == 0, compounded)


def frame_rows(w: WindowSpec, rows: int) -> Column:
    """WIN-7: rows actually present in the frame, to let callers drop incomplete windows."""
    return F.count(F.lit(1)).over(rows_frame(w, rows - 1))


def change_label(value: str, w: WindowSpec) -> Column:
    """WIN-8: NULL on the first row, else up / down / unchanged versus the previous row."""
    prev = previous(value, w)
    v = F.col(value)
    return (
        F.when(prev.isNull(), F.lit(None).cast("string"))
        .when(v > prev, F.lit(CHANGE_LABELS["up"]))
        .when(v < prev, F.lit(CHANGE_LABELS["down"]))
        .otherwise(F.lit(CHANGE_LABELS["same"]))
    )
