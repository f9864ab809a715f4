"""Total orders over whole tables without one task that holds them.

Rows are dealt to ranges of the order, sorted in their range and written once with a
position; sums over all earlier rows come from a sum for each range, a sum over the
ranges' totals, and a sum within the range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.session import materialize

RANGE_BITS = 33


def ordered(spark: SparkSession, rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` written in the given order with ``pos``, which increases with it. End the
    order with a key of each row, so that no run of equal rows falls to one range."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(spark, dealt.withColumn("pos", F.monotonically_increasing_id()), name)


def range_of(pos: str) -> Column:
    """The range that a position lies in; ranges hold consecutive positions."""
    return F.shiftright(pos, RANGE_BITS)


def running_totals(spark: SparkSession, placed: DataFrame, values: dict[str, str]) -> DataFrame:
    """``placed`` (of ``ordered``) with, for each ``value: name``, the sum of ``value`` over
    all earlier rows as ``name``. The window over ranges holds one row a range."""
    part = range_of("pos")
    sums = placed.select(part.alias("range"), *values).groupBy("range").agg(*(F.sum(v).alias(v) for v in values))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("range", *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_base_{n}") for v, n in values.items()))
    bases = materialize(spark, bases, "range-totals")
    inside = Window.partitionBy("range").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.withColumn("range", part).join(F.broadcast(bases), "range")  # one row a range
    totals = joined.withColumns({n: F.col(f"_base_{n}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v, n in values.items()})
    return totals.drop("range", *(f"_base_{n}" for n in values.values()))
