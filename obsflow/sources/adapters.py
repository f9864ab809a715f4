"""Observation tables derived from the driver's test tables.

Each adapter turns a relational table into the tall observation shape
``(series_id, observation_date, value, status_code, frequency, ingested_at)`` so that
every operator runs over data that grows with the scale factor. Sums go through
``DECIMAL(18,2)`` so that any SQL engine adds them exactly. NULL values and non-OK
statuses do not occur in the tables, so they are synthesised from the day of month.
The load stamp is the day after the observation, at midnight UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.schema import OBSERVATION_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _exact_sum(col: str) -> Column:
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


def load_stamp(date_col: Column | str = "observation_date") -> Column:
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return d.cast("timestamp") + F.expr("INTERVAL 1 DAY")


def _finish(df: DataFrame, frequency: str) -> DataFrame:
    return df.withColumn("frequency", F.lit(frequency)).withColumn("ingested_at", load_stamp()).select(
        *OBSERVATION_COLUMNS
    )


def _with_gaps(df: DataFrame, null_every: int, nd_every: int) -> DataFrame:
    day = F.dayofmonth("observation_date")
    return df.withColumn("value", F.when(day % null_every == 0, F.lit(None).cast("double")).otherwise(F.col("v"))).withColumn(
        "status_code", F.when(day % nd_every == 0, F.lit("ND")).otherwise(F.lit("OK"))
    )


def order_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact order value and order count per priority and order date: the one aggregate
    every order-based adapter derives from. (Each branch still scans ``orders``: pushed
    filters and pruned columns make the branches differ, so Spark does not share the
    exchange; the consolidated fact is built once and stored.)"""
    o = read_table(spark, sf_dir, "orders")
    return o.groupBy(
        F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("observation_date")
    ).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"), F.count(F.lit(1)).alias("orders"))


def obs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series per order priority: total order value per order date (natural gaps)."""
    q = order_sums(spark, sf_dir).select("series_id", "observation_date", F.col("total").cast("double").alias("v"))
    return _finish(_with_gaps(q, 13, 10), "daily")


def obs_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plateau-shaped daily series: number of orders per priority and date."""
    q = order_sums(spark, sf_dir).select("series_id", "observation_date", F.col("orders").cast("double").alias("v"))
    return _finish(_with_gaps(q, 13, 10), "daily")


def _orders_by(spark: SparkSession, sf_dir: str, unit: str, frequency: str) -> DataFrame:
    # re-aggregating exact daily decimal sums gives exactly the monthly/quarterly sums
    q = order_sums(spark, sf_dir).groupBy(
        "series_id", F.trunc("observation_date", unit).alias("observation_date")
    ).agg(F.sum("total").cast("double").alias("value"))
    return _finish(q.withColumn("status_code", F.lit("OK")), frequency)


def obs_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly index per order priority: total order value per month."""
    return _orders_by(spark, sf_dir, "month", "monthly")


def obs_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly aggregate per order priority: total order value per quarter."""
    return _orders_by(spark, sf_dir, "quarter", "quarterly")


def obs_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly percentage per return flag: 100 x mean discount of items shipped that month."""
    li = read_table(spark, sf_dir, "lineitem")
    q = li.groupBy(
        F.col("l_returnflag").alias("series_id"),
        F.trunc(F.to_date("l_shipdate"), "month").alias("observation_date"),
    ).agg((_exact_sum("l_discount") / F.count(F.lit(1)).cast("double") * F.lit(100.0)).alias("value"))
    return _finish(q.withColumn("status_code", F.lit("OK")), "monthly")


def obs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series per event type: total event value per day (the landing fixture)."""
    e = read_table(spark, sf_dir, "events")
    q = e.groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("observation_date")).agg(
        _exact_sum("value").alias("v")
    )
    return _finish(_with_gaps(q, 7, 10), "daily")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated fact: daily order value and order count series, monthly and
    quarterly order value series, and the monthly percentage series, with ids made unique
    across families (suffix ``.N`` for counts, ``.M`` monthly, ``.Q`` quarterly, prefix
    ``RF-`` for percentages)."""
    daily = obs_daily(spark, sf_dir)
    rate = obs_rate(spark, sf_dir).withColumn("series_id", F.concat("series_id", F.lit(".N")))
    monthly = obs_monthly(spark, sf_dir).withColumn("series_id", F.concat("series_id", F.lit(".M")))
    quarterly = obs_quarterly(spark, sf_dir).withColumn("series_id", F.concat("series_id", F.lit(".Q")))
    pct = obs_pct(spark, sf_dir).withColumn("series_id", F.concat(F.lit("RF-"), "series_id"))
    return daily.unionByName(rate).unionByName(monthly).unionByName(quarterly).unionByName(pct)


# --- fixed values: series families of the consolidated fact, one per served view --------
def family(name: str) -> Column:
    """Selection predicate of a series family (on the series key, plus frequency)."""
    sid = F.col("series_id")
    return {
        "daily_value": (F.col("frequency") == "daily") & ~sid.endswith(".N"),
        "daily_count": sid.endswith(".N"),
        "monthly_value": sid.endswith(".M"),
        "quarterly_value": sid.endswith(".Q"),
        "monthly_pct": sid.startswith("RF-"),
    }[name]


# --- fixture: dimension seed --------------------------------------------------------------
# Names for some of the derived series; the rest stay unmatched so that the dashboard's
# left join and its id fallback are exercised.
DIM_SEED = [
    ("1-URGENT", "Pedidos urgentes", "USD", "daily", "Valor diario de pedidos urgentes."),
    ("2-HIGH", "Pedidos prioridad alta", "USD", "daily", "Valor diario de pedidos de prioridad alta."),
    ("3-MEDIUM", "Pedidos prioridad media", "USD", "daily", None),
    ("4-NOT SPECIFIED", "Pedidos sin prioridad", "USD", "daily", "Valor diario de pedidos sin prioridad."),
    ("1-URGENT.M", "Pedidos urgentes (mes)", "USD", "monthly", "Valor mensual de pedidos urgentes."),
    ("3-MEDIUM.Q", "Pedidos prioridad media (trimestre)", "USD", "quarterly", None),
    ("RF-A", "Descuento medio, devueltos", "porcentaje", "monthly", "Descuento medio de partidas devueltas."),
]
SEED_UPDATED_AT = "2026-01-01 00:00:00"
DIM_COLUMNS = ["series_id", "name", "unit", "frequency", "description", "updated_at"]


def failing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the month on which more than a fifth of the events are errors, with both counts:
    ``(day, errors, events)``, at most 31 rows. The source's requests fail on such days."""
    per = read_table(spark, sf_dir, "events").groupBy(F.dayofmonth("ts").alias("day"))
    counts = per.agg(F.count_if(F.col("event_type") == "error").alias("errors"), F.count(F.lit(1)).alias("events"))
    return counts.where(F.col("errors") * 5 > F.col("events"))


def failed_requests(spark: SparkSession, sf_dir: str, requests: DataFrame, day: Column) -> DataFrame:
    """The rows of ``requests`` (with a ``series_id``) that fail, with their ``error``. A request's
    day moves with its series: the remainder of ``day`` and the length of the series' id by 31."""
    failing = failing_days(spark, sf_dir)
    error = F.concat(F.lit("SourceError: "), F.col("errors").cast("string"), F.lit(" of "), F.col("events").cast("string"))
    asked = requests.withColumn("day", F.pmod(day + F.length("series_id"), F.lit(31)).cast("int"))
    return asked.join(failing, "day").select(*requests.columns, error.alias("error"))
