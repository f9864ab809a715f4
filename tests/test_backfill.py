"""Backfill plan, status, outcomes and counters; ingest run summary; catalog flatten."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obsflow.plans import backfill as B
from obsflow.plans import reports as R
from obsflow.sources import adapters as A
from obsflow.sources import catalog as CT
from obsflow.sources import landing as LZ
from tests.conftest import SF_SMALL

D = dt.date


def _catalog(spark):
    return spark.createDataFrame([("S1", "daily"), ("M1", "monthly"), ("Q1", "quarterly")], "series_id string, frequency string")


def test_plan_is_landed_plus_missing_and_disjoint(spark):
    obs = A.observations(spark, SF_SMALL)
    cat = obs.select("series_id", "frequency").distinct()
    planned = B.plan(cat, "1996-01-01", "1996-12-31")
    landed = obs.where("status_code = 'OK'").select(
        F.concat(F.lit("raw/"), "frequency", F.lit("/"), "series_id", F.lit("/"),
                 F.when(F.col("frequency") == "daily", F.date_format("observation_date", "yyyy-MM-dd"))
                 .when(F.col("frequency") == "monthly", F.date_format("observation_date", "yyyy-MM"))
                 .otherwise(F.concat(F.year("observation_date").cast("string"), F.lit("-Q"), F.quarter("observation_date").cast("string"))),
                 F.lit(".json")).alias("relative_path"))
    miss = B.missing_periods(planned, landed)
    have = B.landed_periods(planned, landed)
    assert miss.count() + have.count() == planned.count()
    assert miss.join(have, "relative_path").count() == 0
    status = B.with_status(planned, landed).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in status} == {"missing": miss.count(), "landed": have.count()}


def test_plan_generates_own_frequency_periods(spark):
    p = B.plan(_catalog(spark), "2023-11-15", "2024-02-05")
    got = {s: sorted(r.period_label for r in p.where(F.col("series_id") == s).collect()) for s in ("M1", "Q1")}
    assert got["M1"] == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert got["Q1"] == ["2023-Q4", "2024-Q1"]
    assert p.where(F.col("series_id") == "S1").count() == 83
    assert B.dry_run_counts(p).where("series_id = 'S1'").first().planned == 83


def test_outcomes_and_counters(spark):
    cat = spark.createDataFrame([("S1", "daily"), ("M1", "monthly")], "series_id string, frequency string")
    planned = B.plan(cat, "2023-12-30", "2024-01-03")  # days 30, 31 of 2023 and 1..3 of 2024; months 12, 01
    landed = spark.createDataFrame(
        [("raw/daily/S1/2023-12-30.json",), ("raw/daily/S1/2023-12-31.json",), ("raw/daily/S1/2024-01-01.json",), ("raw/monthly/M1/2023-12.json",)],
        "relative_path string",
    )
    available = spark.createDataFrame(
        [("S1", "daily", D(2024, 1, 2)), ("M1", "monthly", D(2024, 1, 15))], "series_id string, frequency string, observation_date date"
    )
    errors = spark.createDataFrame([("M1", "2024-01")], "series_id string, chunk string")
    outs = B.outcomes(B.with_status(planned, landed), available, errors)
    got = {r.series_id: (r.written, r.skipped, r.empty, r.errors) for r in B.counters(outs).collect()}
    # S1: 2023 fully landed → 2 skipped; 2024 partly landed → day 1 not counted, day 2 written, day 3 empty
    assert got["S1"] == (1, 2, 1, 0)
    assert got["M1"] == (0, 1, 0, 1)
    assert got[None] == (1, 3, 1, 1)


def test_run_summary_lists(spark):
    runs = spark.createDataFrame([(D(2026, 7, 14), "daily")], "as_of date, frequency string")
    cat = spark.createDataFrame([("A", "daily"), ("B", "daily"), ("C", "daily"), ("D", "daily"), ("M", "monthly")], "series_id string, frequency string")
    landed = spark.createDataFrame([("raw/daily/A/2026-07-13.json",)], "relative_path string")
    available = spark.createDataFrame([("B", "daily", D(2026, 7, 13)), ("D", "daily", D(2026, 7, 13))], "series_id string, frequency string, observation_date date")
    errors = spark.createDataFrame([(D(2026, 7, 14), "D", "SourceError: -50")], "as_of date, series_id string, error string")
    r = B.run_summary(B.ingest_outcomes(runs, cat, landed, available, errors)).first()
    assert (r.period_label, r.processed, r.skipped, r.empty) == ("2026-07-13", 1, 1, ["C"])
    assert [(e.series_id, e.error) for e in r.errors] == [("D", "SourceError: -50")]


def test_catalog_flatten_rules(spark):
    entry = "struct<id:string,name:string,unit:string,description:string>"
    docs = spark.sql(
        f"""select map('daily', array(named_struct('id','A','name','a','unit','u','description',cast(null as string))),
                       'monthly', cast(null as array<{entry}>)) as series"""
    )
    rows = CT.flatten_catalog(docs).collect()
    assert [(r.series_id, r.frequency, r.description) for r in rows] == [("A", "daily", "")]
    bad = spark.sql(f"select map('weekly', array(named_struct('id','A','name','a','unit','u','description','x'))) as series")
    with pytest.raises(Exception, match="invalid frequency"):
        CT.flatten_catalog(bad).collect()
    missing = spark.sql(f"select cast(null as map<string, array<{entry}>>) as series")
    with pytest.raises(Exception, match="no top-level"):
        CT.flatten_catalog(missing).collect()
    with pytest.raises(ValueError):
        CT.catalog_by_frequency(CT.flatten_catalog(docs), "weekly")


def test_read_catalog_json(spark, tmp_path):
    p = tmp_path / "series.json"
    p.write_text('{"series": {"daily": [{"id": "A", "name": "Dólar", "unit": "CLP"}], "quarterly": null}}', encoding="utf-8")
    rows = CT.flatten_catalog(CT.read_catalog(spark, str(p))).collect()
    assert [(r.series_id, r.name, r.description) for r in rows] == [("A", "Dólar", "")]


def test_salted_run_pairing_equals_broadcast(spark):
    runs = spark.createDataFrame([(D(2026, 7, 14), "daily"), (D(2026, 7, 14), "monthly"), (D(2026, 7, 15), "daily")], "as_of date, frequency string")
    cat = spark.createDataFrame([(f"S{i}", "daily" if i % 3 else "monthly") for i in range(50)], "series_id string, frequency string")
    plain = B._runs_by_catalog(runs, cat)
    salted = B._runs_by_catalog(runs, cat, max_rows=0)  # forces the salted shuffle join
    assert "BroadcastHashJoin" not in salted._jdf.queryExecution().executedPlan().toString()
    assert sorted(plain.collect()) == sorted(salted.collect())
    assert salted.count() == 2 * 33 + 17


def test_execute_backfill_lands_the_missing_periods(spark, tmp_root):
    from obsflow.plans import load as L
    from obsflow.sources import landing as LZ

    src = spark.createDataFrame(
        [("S1", "daily", D(2024, 1, 1), 1.0, "OK"), ("S1", "daily", D(2024, 1, 2), 2.0, "OK"), ("S1", "daily", D(2024, 1, 4), None, "ND"),
         ("M1", "monthly", D(2024, 1, 1), 5.0, "OK")],
        "series_id string, frequency string, observation_date date, value double, status_code string",
    )
    cat = src.select("series_id", "frequency").distinct()
    planned = B.plan(cat, "2024-01-01", "2024-01-05")
    first = B.counters(B.execute_backfill(spark, B.with_status(planned, spark.createDataFrame([], "relative_path string")), src, tmp_root))
    assert {r.series_id: (r.written, r.skipped, r.empty) for r in first.collect()}[None] == (4, 0, 2)
    rows = L.load_rows(L.parsed_files(spark, tmp_root)).select("series_id", "observation_date", "value", "status_code")
    assert sorted(rows.collect()) == sorted(src.select("series_id", "observation_date", "value", "status_code").collect())
    # a second run finds everything with data landed: nothing is written again
    again = B.counters(B.execute_backfill(spark, B.with_status(planned, LZ.list_landed(spark, tmp_root)), src, tmp_root))
    assert {r.series_id: (r.written, r.empty) for r in again.collect()}[None] == (0, 2)


def test_execute_ingest_writes_then_skips(spark, tmp_root):
    runs = spark.createDataFrame([(D(2026, 7, 14), "daily"), (D(2026, 7, 15), "daily")], "as_of date, frequency string")
    cat = spark.createDataFrame([("A", "daily"), ("B", "daily")], "series_id string, frequency string")
    src = spark.createDataFrame(
        [("A", "daily", D(2026, 7, 13), 1.5, "OK"), ("A", "daily", D(2026, 7, 14), 2.5, "OK")],
        "series_id string, frequency string, observation_date date, value double, status_code string",
    )
    first = {r.as_of: (r.processed, r.skipped, r.empty) for r in B.execute_ingest(spark, runs, cat, tmp_root, src).collect()}
    assert first == {D(2026, 7, 14): (1, 0, ["B"]), D(2026, 7, 15): (1, 0, ["B"])}
    again = {r.as_of: (r.processed, r.skipped, r.empty) for r in B.execute_ingest(spark, runs, cat, tmp_root, src).collect()}
    assert again == {D(2026, 7, 14): (0, 1, ["B"]), D(2026, 7, 15): (0, 1, ["B"])}


def test_payloads_keep_the_last_duplicate_and_every_decimal(spark):
    rows = [("S", "daily", dt.date(2026, 7, 14), 9.0, "ND", 1), ("S", "daily", dt.date(2026, 7, 14), 1.23456, "OK", 2), ("T", "daily", dt.date(2026, 7, 14), 5.0, "OK", 1)]
    source = spark.createDataFrame(rows, "series_id string, frequency string, observation_date date, value double, status_code string, position int")
    targets = spark.createDataFrame([("S", "2026-07-14", "raw/daily/S/2026-07-14.json")], "series_id string, period_label string, relative_path string")
    out = B.payloads_for_periods(source, targets).collect()
    assert len(out) == 1 and '"statusCode":"OK","value":"1.23456"' in out[0].body


def test_plan_refuses_a_reversed_range_and_takes_one_frequency(spark):
    catalog = spark.createDataFrame([("S", "daily"), ("M", "monthly")], "series_id string, frequency string")
    with pytest.raises(ValueError):
        B.plan(catalog, dt.date(2026, 2, 1), dt.date(2026, 1, 1))
    with pytest.raises(ValueError):
        B.plan(catalog, dt.date(2026, 1, 1), dt.date(2026, 2, 1), "weekly")
    rows = B.plan(catalog, dt.date(2026, 1, 1), dt.date(2026, 2, 1), "monthly").collect()
    assert {r.series_id for r in rows} == {"M"}


def test_dry_run_has_the_shape_of_the_counters(spark):
    planned = B.plan(_catalog(spark), "2023-11-15", "2024-02-05")
    got = {r.series_id: (r.written, r.skipped, r.empty, r.errors) for r in B.dry_run_counters(planned).collect()}
    assert got["S1"] == (83, 0, 0, 0) and got["M1"] == (4, 0, 0, 0)
    assert got[None] == (planned.count(), 0, 0, 0)
    none = B.dry_run_counters(planned.where("false")).collect()
    assert sum(r.written for r in none) == 0


def _outcome_rows(spark, n=1000):
    # one run with half its series empty, one where all fail, an id that repeats
    ids = F.concat(F.lit("S"), F.lpad(F.col("id").cast("string"), 5, "0"))
    base = spark.range(n).select(F.lit("daily").alias("frequency"), ids.alias("series_id"), F.lit("2026-07-13").alias("period_label"), F.col("id"))
    one = base.withColumn("as_of", F.lit("2026-07-14").cast("date")).withColumn("outcome", F.when(F.col("id") % 2 == 0, "empty").otherwise("written"))
    two = base.withColumn("as_of", F.lit("2026-07-15").cast("date")).withColumn("outcome", F.lit("error"))
    both = one.unionByName(two).withColumn("error", F.when(F.col("outcome") == "error", F.concat(F.lit("E"), "series_id")))
    return both.unionByName(both.where("series_id = 'S00007'")).drop("id")


def test_run_lists_are_the_summary_in_chunks(spark):
    outs = _outcome_rows(spark)
    whole = {r.as_of: r for r in B.run_summary(outs).collect()}
    got = B.run_lists(spark, outs, size=64).collect()
    assert all(len(r.series) <= 64 for r in got)
    for as_of, kind in ((D(2026, 7, 14), "empty"), (D(2026, 7, 15), "error")):
        chunks = sorted((r for r in got if (r.as_of, r.outcome) == (as_of, kind)), key=lambda r: r.chunk)
        assert [r.chunk for r in chunks] == list(range(len(chunks))) and all(len(r.series) == 64 for r in chunks[:-1])
        series = [(s.series_id, s.error) for r in chunks for s in r.series]
        if kind == "empty":
            assert [s for s, _ in series] == whole[as_of].empty
        else:
            assert series == [(e.series_id, e.error) for e in whole[as_of].errors]
    assert B.run_lists(spark, outs.where("false")).count() == 0


def test_a_failed_request_leaves_the_period_to_a_later_run(spark, tmp_root):
    cat = spark.createDataFrame([("M", "monthly")], "series_id string, frequency string")
    runs = spark.createDataFrame([(D(2026, 7, d), "monthly") for d in (1, 2, 3)], "as_of date, frequency string")
    src = spark.createDataFrame([("M", "monthly", D(2026, 6, 1), 1.0, "OK")], "series_id string, frequency string, observation_date date, value double, status_code string")
    errors = spark.createDataFrame([(D(2026, 7, 1), "M", "timeout")], "as_of date, series_id string, error string")
    got = {r.as_of.day: r for r in B.execute_ingest(spark, runs, cat, tmp_root, src, errors).collect()}
    assert [(got[d].processed, got[d].skipped, len(got[d].errors)) for d in (1, 2, 3)] == [(0, 0, 1), (1, 0, 0), (0, 1, 0)]
    assert LZ.list_landed(spark, tmp_root).count() == 1


def test_coverage_fails_by_fetch_errors(spark):
    cat = spark.createDataFrame([("A", "daily"), ("B", "daily"), ("C", "daily"), ("D", None)], "series_id string, frequency string")
    obs = spark.createDataFrame([("A", D(2026, 7, 1)), ("B", D(2026, 7, 1))], "series_id string, observation_date date")
    errors = spark.createDataFrame([("B", "timeout"), ("B", "refused"), ("X", "unasked")], "series_id string, error string")
    cov = R.series_coverage(cat, obs, "2026-07-01", "2026-07-31", errors)
    assert {r.series_id: (r.observations, r.status, r.error) for r in cov.collect()} == {
        "A": (1, "OK", None), "B": (0, "FAIL", "refused"), "C": (0, "EMPTY", None), "D": (0, "FAIL", None)
    }
    assert R.coverage_state(cov).first().asDict() == {"series": 4, "ok": 1, "empty": 1, "failed": 2, "passed": False}
    assert R.coverage_state(R.series_coverage(cat.limit(0), obs, "2026-07-01", "2026-07-31")).first().passed
    nameless = spark.createDataFrame([("A", None)], "series_id string, error string")
    assert R.series_coverage(cat, obs, "2026-07-01", "2026-07-31", nameless).where("series_id = 'A'").first().status == "FAIL"


def test_ledger_joins_without_exchange_of_its_paths(spark):
    from obsflow.sources.ledger import bucket_count, create_ledger, record

    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    planned = B.plan(_catalog(spark), "2023-11-15", "2024-02-05")
    landed = planned.where("pmod(hash(relative_path), 3) > 0").select("relative_path")
    name = "raw.ledger_test"
    create_ledger(spark, name, 4)
    assert spark.table(name).count() == 0 and bucket_count(spark, name) == 4
    record(spark, name, landed.where("relative_path like '%daily%'"))
    record(spark, name, landed.unionByName(landed).unionByName(spark.createDataFrame([(None,)], "relative_path string")))
    ledger = spark.table(name)
    with pytest.raises(ValueError, match="not a ledger"):
        spark.range(1).createOrReplaceTempView("no_ledger")
        bucket_count(spark, "no_ledger")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for fn in (B.missing_periods, B.landed_periods, B.with_status):
            mine, plain = fn(planned, ledger), fn(planned, landed)
            text = mine._jdf.queryExecution().executedPlan().toString()
            scan = text.index("FileScan parquet spark_catalog.raw.ledger_test")
            side = text[text.index("SortMergeJoin"):scan].split("Exchange")
            # the one exchange before the ledger's scan is the plan's own: its subtree comes first
            assert len(side) == 2 and "Scan" in side[1], text
            assert sorted(mine.collect()) == sorted(plain.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql(f"DROP TABLE {name}")
