"""Keyed upsert: MERGE semantics, idempotence, touched partitions only, guards."""

import datetime as dt
import os

import pytest

from obsflow.operators.upsert import read_observations, upsert
from obsflow.schema import OBSERVATIONS

T1 = dt.datetime(2026, 1, 1)
T2 = dt.datetime(2026, 2, 1)


def _obs(spark, rows):
    return spark.createDataFrame(rows, OBSERVATIONS)


def _table(spark, path):
    return {(r.series_id, r.observation_date): (r.value, r.ingested_at) for r in read_observations(spark, path).collect()}


def test_merge_semantics_and_idempotence(spark, tmp_root):
    d = dt.date
    target = [
        ("A", d(2024, 1, 1), 1.0, "OK", "daily", T1),
        ("A", d(2024, 1, 2), 2.0, "OK", "daily", T1),
        ("B", d(2023, 6, 1), 5.0, "OK", "daily", T1),
    ]
    source = [
        ("A", d(2024, 1, 2), 20.0, "OK", "daily", T2),  # update
        ("A", d(2024, 1, 3), 30.0, "ND", "daily", T2),  # insert
    ]
    assert upsert(spark, tmp_root, _obs(spark, target)) == 3
    assert upsert(spark, tmp_root, _obs(spark, source)) == 2
    once = _table(spark, tmp_root)
    assert once == {
        ("A", d(2024, 1, 1)): (1.0, T1),
        ("A", d(2024, 1, 2)): (20.0, T2),
        ("A", d(2024, 1, 3)): (30.0, T2),
        ("B", d(2023, 6, 1)): (5.0, T1),
    }
    upsert(spark, tmp_root, _obs(spark, source))
    assert _table(spark, tmp_root) == once


def test_only_touched_year_partitions_are_rewritten(spark, tmp_root):
    d = dt.date
    upsert(spark, tmp_root, _obs(spark, [("A", d(2023, 1, 1), 1.0, "OK", "daily", T1), ("A", d(2024, 1, 1), 1.0, "OK", "daily", T1)]))
    untouched = os.path.join(tmp_root, "obs_year=2023")
    before = sorted(os.listdir(untouched))
    mtimes = {f: os.path.getmtime(os.path.join(untouched, f)) for f in before}
    upsert(spark, tmp_root, _obs(spark, [("A", d(2024, 1, 1), 2.0, "OK", "daily", T2)]))
    assert sorted(os.listdir(untouched)) == before
    assert {f: os.path.getmtime(os.path.join(untouched, f)) for f in before} == mtimes


def test_duplicate_keys_in_source_keep_latest(spark, tmp_root):
    d = dt.date
    src = _obs(spark, [("A", d(2024, 1, 1), 1.0, "OK", "daily", T1), ("A", d(2024, 1, 1), 2.0, "OK", "daily", T2)])
    assert upsert(spark, tmp_root, src) == 2  # rows sent, not rows changed
    assert _table(spark, tmp_root) == {("A", d(2024, 1, 1)): (2.0, T2)}


def test_empty_source_is_a_no_op(spark, tmp_root):
    assert upsert(spark, tmp_root, _obs(spark, [])) == 0
    assert not os.path.exists(tmp_root)


def test_null_key_fails_the_load(spark, tmp_root):
    from pyspark.sql import types as T

    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in OBSERVATIONS.fields])
    src = spark.createDataFrame([(None, dt.date(2024, 1, 1), 1.0, "OK", "daily", T1)], loose)
    with pytest.raises(Exception, match="required column series_id"):
        upsert(spark, tmp_root, src)


def test_dimension_upsert_unpartitioned(spark, tmp_root):
    cols = ["series_id", "name", "unit", "frequency", "description", "updated_at"]
    seed = spark.createDataFrame([("A", "a", "u", "daily", None, T1), ("B", "b", "u", "daily", "x", T1)], "series_id string, name string, unit string, frequency string, description string, updated_at timestamp")
    upsert(spark, tmp_root, seed, keys=["series_id"], columns=cols, order_by=["updated_at"], partition_by_year=False, cluster_by=None)
    new = spark.createDataFrame([("B", "b2", "u", "daily", None, T2), ("C", "c", None, "monthly", None, T2)], seed.schema)
    upsert(spark, tmp_root, new, keys=["series_id"], columns=cols, order_by=["updated_at"], partition_by_year=False, cluster_by=None)
    got = {r.series_id: (r.name, r.updated_at) for r in spark.read.parquet(tmp_root).collect()}
    assert got == {"A": ("a", T1), "B": ("b2", T2), "C": ("c", T2)}


def test_stored_scan_prunes_partitions_and_pushes_filters(spark, tmp_root):
    from obsflow.sources.observations import scan_observations

    d = dt.date
    rows = [("A", d(2023, 1, 1), 1.0, "OK", "daily", T1), ("A", d(2024, 1, 1), 2.0, "OK", "daily", T1), ("B", d(2024, 2, 1), None, "OK", "daily", T1)]
    upsert(spark, tmp_root, _obs(spark, rows))
    df = scan_observations(spark, tmp_root, series_ids=["A", "B"], first="2024-01-01", valid_only=True)
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(obs_year" in plan and "(obs_year#" in plan
    assert "In(series_id, [A,B])" in plan and "EqualTo(status_code,OK)" in plan and "IsNotNull(value)" in plan
    assert [(r.series_id, r.value) for r in df.collect()] == [("A", 2.0)]


def test_hot_duplicated_key_collapses_before_the_shuffle(spark, tmp_root):
    import contextlib
    import io

    from pyspark.sql import functions as F

    from obsflow.operators.upsert import dedupe_latest
    from obsflow.schema import KEYS, OBSERVATION_COLUMNS

    # one key delivered 200,000 times (far more than all other keys together)
    hot = spark.range(200_000).select(
        F.lit("HOT").alias("series_id"), F.lit(dt.date(2024, 1, 1)).alias("observation_date"),
        F.col("id").cast("double").alias("value"), F.lit("OK").alias("status_code"), F.lit("daily").alias("frequency"),
        (F.lit(T1).cast("timestamp") + F.make_interval(secs=F.col("id").cast("int"))).alias("ingested_at"),
    )
    cold = spark.range(1000).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("series_id"), F.lit(dt.date(2024, 1, 1)).alias("observation_date"),
        F.lit(1.0).alias("value"), F.lit("OK").alias("status_code"), F.lit("daily").alias("frequency"), F.lit(T1).cast("timestamp").alias("ingested_at"),
    )
    src = hot.unionByName(cold)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        dedupe_latest(src, KEYS, OBSERVATION_COLUMNS, ["ingested_at"]).explain()
    plan = buf.getvalue()  # the group limit below the exchange leaves one row a key and input task
    assert "Partial" in plan[plan.index("Exchange hashpartitioning") :] and "WindowGroupLimit" in plan
    assert upsert(spark, tmp_root, src) == 201_000
    got = read_observations(spark, tmp_root)
    assert got.count() == 1001
    assert got.where("series_id = 'HOT'").first().value == 199_999.0  # latest load wins


@pytest.mark.parametrize("granularity,column,untouched", [("month", "obs_month", "obs_month=202401"), ("day", "obs_day", "obs_day=2024-01-01")])
def test_finer_partitions_rewrite_only_touched_ones(spark, tmp_root, granularity, column, untouched):
    import contextlib
    import io

    from obsflow.sources.observations import scan_observations

    d = dt.date
    first = [("A", d(2024, 1, 1), 1.0, "OK", "daily", T1), ("A", d(2024, 2, 1), 1.0, "OK", "daily", T1)]
    upsert(spark, tmp_root, _obs(spark, first), granularity=granularity)
    folder = os.path.join(tmp_root, untouched)
    before = {f: os.path.getmtime(os.path.join(folder, f)) for f in os.listdir(folder)}
    upsert(spark, tmp_root, _obs(spark, [("A", d(2024, 2, 1), 2.0, "OK", "daily", T2), ("B", d(2024, 2, 2), 3.0, "OK", "daily", T2)]), granularity=granularity)
    assert {f: os.path.getmtime(os.path.join(folder, f)) for f in os.listdir(folder)} == before
    assert _table(spark, tmp_root) == {("A", d(2024, 1, 1)): (1.0, T1), ("A", d(2024, 2, 1)): (2.0, T2), ("B", d(2024, 2, 2)): (3.0, T2)}
    df = scan_observations(spark, tmp_root, first="2024-02-01")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    assert f"PartitionFilters: [isnotnull({column}" in buf.getvalue()
    assert df.count() == 2


def test_ensure_table_creates_once(spark, tmp_root):
    from obsflow.operators.upsert import ensure_table

    ensure_table(spark, tmp_root, OBSERVATIONS, granularity="year")
    assert os.path.isdir(tmp_root)
    assert read_observations(spark, tmp_root).count() == 0
    upsert(spark, tmp_root, _obs(spark, [("A", dt.date(2024, 1, 1), 1.0, "OK", "daily", T1)]))
    ensure_table(spark, tmp_root, OBSERVATIONS, granularity="year")  # existing table left alone
    assert read_observations(spark, tmp_root).count() == 1
