"""Landing zone (native layout), create-only writes, bulk reload and the file stream."""

import json
import os

import pytest

from pyspark.sql import functions as F

from obsflow.operators.upsert import read_observations
from obsflow.plans import load as L
from obsflow.session import scratch_dir
from obsflow.sources import landing as LZ
from obsflow.streaming.incremental import read_quarantine, start_incremental_load


def _payload(date_text, value):
    return json.dumps({"Codigo": 0, "Descripcion": "Success", "Series": {"Obs": [{"indexDateString": date_text, "value": value, "statusCode": "OK"}]}})


def _write(root, rel, body):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(body)


def _zone(root):
    _write(root, "raw/daily/A B/2026-07-14.json", _payload("14-07-2026", "1.5"))  # blank in the id
    _write(root, "raw/daily/A+B/2026-07-14.json", _payload("14-07-2026", "2.5"))  # plus in the id
    _write(root, "raw/monthly/M/2026-06.json", _payload("01-06-2026", "3"))
    _write(root, "raw/daily/A B/2026-07-15.json", "<html>")  # poison
    _write(root, "dead_letter/raw/daily/A B/2026-07-16.json", _payload("16-07-2026", "9"))  # ignored


def test_scan_decodes_paths_relative_to_root(spark, tmp_root):
    _zone(tmp_root)
    files = LZ.decode_path(LZ.read_landing(spark, tmp_root)).collect()
    got = {r.relative_path: (r.on_pattern, r.series_id) for r in files}
    assert got["raw/daily/A B/2026-07-14.json"] == (True, "A B")
    assert got["raw/daily/A+B/2026-07-14.json"] == (True, "A+B")
    assert got["dead_letter/raw/daily/A B/2026-07-16.json"] == (False, None)
    monthly = LZ.read_landing(spark, tmp_root, "raw/monthly/").collect()
    assert [r.relative_path for r in monthly] == ["raw/monthly/M/2026-06.json"]
    partial = LZ.read_landing(spark, tmp_root, "raw/mon").collect()
    assert [r.relative_path for r in partial] == ["raw/monthly/M/2026-06.json"]


def test_write_if_absent_skips_existing(spark, tmp_root):
    df = spark.createDataFrame([("raw/daily/X/2026-07-14.json", "{}"), ("raw/daily/X/2026-07-15.json", "{}")], "relative_path string, body string")
    first = {r.relative_path: r.outcome for r in LZ.write_if_absent(spark, df.limit(1), tmp_root).collect()}
    assert list(first.values()) == ["written"]
    second = {r.relative_path: r.outcome for r in LZ.write_if_absent(spark, df, tmp_root).collect()}
    assert sorted(second.values()) == ["skipped", "written"]
    assert sorted(r.relative_path for r in LZ.list_landed(spark, tmp_root).collect()) == sorted(second)


def test_bulk_reload_and_dry_run(spark, tmp_root):
    _zone(tmp_root)
    target = scratch_dir(spark, "obs")
    assert L.bulk_reload(spark, tmp_root, target, dry_run=True) == 3
    assert L.bulk_reload(spark, tmp_root, target, ingested_at="2026-07-17 00:00:00") == 3
    got = {(r.series_id, r.value) for r in read_observations(spark, target).collect()}
    assert got == {("A B", 1.5), ("A+B", 2.5), ("M", 3.0)}
    assert L.bulk_reload(spark, tmp_root, target, prefix="raw/monthly/", ingested_at="2026-07-18 00:00:00") == 1


def test_stream_replay_and_poison(spark, tmp_root):
    _zone(tmp_root)
    target, quarantine = scratch_dir(spark, "obs"), scratch_dir(spark, "q")
    start_incremental_load(spark, tmp_root, target, scratch_dir(spark, "ck"), quarantine, "2026-07-17 00:00:00", max_files_per_trigger=2).awaitTermination()
    once = sorted((r.series_id, r.observation_date, r.value) for r in read_observations(spark, target).collect())
    assert len(once) == 3
    assert [(r.relative_path, r.reason) for r in read_quarantine(spark, quarantine).select("relative_path", "reason").collect()] == [("raw/daily/A B/2026-07-15.json", "invalid_json")]
    # a new arrival is picked up by the same checkpoint; a full replay changes nothing
    ck = scratch_dir(spark, "ck2")
    start_incremental_load(spark, tmp_root, target, ck, None, "2026-07-18 00:00:00").awaitTermination()
    assert sorted((r.series_id, r.observation_date, r.value) for r in read_observations(spark, target).collect()) == once
    _write(tmp_root, "raw/daily/A B/2026-07-20.json", _payload("20-07-2026", "7"))
    start_incremental_load(spark, tmp_root, target, ck, None, "2026-07-19 00:00:00").awaitTermination()
    assert read_observations(spark, target).where(F.col("value") == 7.0).count() == 1


def test_zero_length_and_hidden_objects_are_objects(spark, tmp_root):
    _zone(tmp_root)
    _write(tmp_root, "raw/daily/A B/2026-07-17.json", "")
    _write(tmp_root, "raw/daily/A B/_2026-07-18.json", _payload("18-07-2026", "4"))
    _write(tmp_root, "raw/daily/.hidden/2026-07-19.json", _payload("19-07-2026", "5"))
    _write(tmp_root, "_SUCCESS", "")
    _write(tmp_root, "raw/daily/A B/.x.json." + "0" * 32 + ".tmp", "half a payl")  # of a writer at work: not there yet
    files = L.parsed_files(spark, tmp_root)
    bad = ["raw/daily/A B/2026-07-15.json", "raw/daily/A B/2026-07-17.json"]
    assert sorted((r.relative_path, r.reason) for r in L.rejects(files).collect()) == [(p, "invalid_json") for p in bad]
    r = L.load_summary(files).first()
    assert (r.files_scanned, r.files_skipped, r.files_failed, r.rows_extracted) == (5, 2, 2, 5)
    target, quarantine = scratch_dir(spark, "obs"), scratch_dir(spark, "q")
    start_incremental_load(spark, tmp_root, target, scratch_dir(spark, "ck"), quarantine).awaitTermination()
    assert read_observations(spark, target).count() == 5
    assert sorted(r.relative_path for r in read_quarantine(spark, quarantine).collect()) == bad


@pytest.mark.parametrize("shares", [1, 3, 16])
def test_every_object_is_listed_in_one_share(tmp_path, shares):
    from obsflow.sources.objects import _lister

    listed, _, _ = _lister()
    names = ["a.json", "raw/b", "raw/daily/c.json", "raw/daily/S/1.json", "raw/daily/S/x/y/2.json", "raw/daily/T/_3", "raw/weekly/.h/4", "raw/daily/[S]*/5 ä+%20.json"]
    for n in names:
        _write(str(tmp_path), n, n)
    os.makedirs(tmp_path / "raw/empty/folder")
    for prefix in ("", "raw/", "raw/daily/S", "raw/daily/S/", "raw/daily/[", "nothing/", "raw/daily/S/1.json"):
        got = sorted(path for i in range(shares) for path, *_ in listed(str(tmp_path), prefix, i, shares))
        assert got == sorted(n for n in names if n.startswith(prefix))


def test_a_rewritten_object_comes_again_after_a_restart(spark, tmp_root):
    _zone(tmp_root)
    target, checkpoint = scratch_dir(spark, "obs"), scratch_dir(spark, "ck")
    load = lambda stamp: start_incremental_load(spark, tmp_root, target, checkpoint, None, stamp).awaitTermination()
    load("2026-07-17 00:00:00")
    before = {(r.series_id, r.observation_date): (r.value, str(r.ingested_at)) for r in read_observations(spark, target).collect()}
    load("2026-07-18 00:00:00")  # nothing new: nothing is loaded again
    assert {(r.series_id, r.observation_date): (r.value, str(r.ingested_at)) for r in read_observations(spark, target).collect()} == before
    body = spark.createDataFrame([("raw/daily/A B/2026-07-14.json", _payload("14-07-2026", "41"))], "relative_path string, body string")
    assert [r.outcome for r in LZ.rewrite(spark, body, tmp_root).collect()] == ["rewritten"]
    load("2026-07-19 00:00:00")
    after = {(r.series_id, r.observation_date): (r.value, str(r.ingested_at)) for r in read_observations(spark, target).collect()}
    changed = {k for k in after if after[k] != before.get(k)}
    assert len(changed) == 1 and after[changed.pop()] == (41.0, "2026-07-19 00:00:00") and len(after) == len(before)


def test_a_backlog_of_years_rewrites_each_partition_once(spark, tmp_root):
    for year in range(2020, 2026):
        for month in range(1, 13):
            _write(tmp_root, f"raw/daily/S/{year}-{month:02d}-03.json", _payload(f"03-{month:02d}-{year}", "1"))
    target, checkpoint = scratch_dir(spark, "obs"), scratch_dir(spark, "ck")
    start_incremental_load(spark, tmp_root, target, checkpoint, max_files_per_trigger=8).awaitTermination()
    local = target.removeprefix("file:")
    files = [f for _, _, names in os.walk(local) for f in names if f.endswith(".parquet")]
    assert len(files) == 6 and len({f.split("-", 2)[2].split(".")[0] for f in files}) == 1  # one write job made them all
    assert read_observations(spark, target).count() == 72


def test_silent_intervals_and_sliding_error_rate(spark):
    import datetime as dt

    from obsflow.plans import reports as R

    t = lambda h, m=0: dt.datetime(2026, 1, 1) + dt.timedelta(hours=h, minutes=m)
    loads = spark.createDataFrame([("A", t(1)), ("A", t(1)), ("A", t(30)), ("B", t(0)), ("B", t(24)), ("B", t(48)), ("X", t(5)), ("M", t(3))], "series_id string, loaded_at timestamp")
    catalog = spark.createDataFrame([("A", "daily"), ("B", "daily"), ("C", "daily"), ("M", "monthly"), ("A", "daily")], "series_id string, frequency string")
    got = {(r.series_id, r.silent_from, r.silent_until) for r in R.silent_intervals(catalog, loads, t(0), t(48)).collect()}
    assert got == {("A", t(1), t(30)), ("C", t(0), t(48))}
    # nothing but errors from 00:30 to 01:30: each full hour stays at the threshold, the hour between does not
    rows = [(t(0, m), m >= 30) for m in range(0, 60, 5)] + [(t(1, m), m < 30) for m in range(0, 60, 5)]
    events = spark.createDataFrame(rows, "ts timestamp, bad boolean")
    assert R.alert_error_rate(events, "ts", F.col("bad"), 0.5).count() == 0
    sliding = R.alert_error_rate(events, "ts", F.col("bad"), 0.9, slide="5 minutes").collect()
    assert (t(0, 30), 1.0) in {(r.window_start, r.error_rate) for r in sliding}


def test_sliding_error_rate_on_a_stream(spark, tmp_root):
    import datetime as dt

    from obsflow.plans import reports as R

    t = lambda m: dt.datetime(2026, 1, 1) + dt.timedelta(minutes=m)
    spark.createDataFrame([(t(m), 30 <= m < 90) for m in range(0, 300, 5)], "ts timestamp, bad boolean").write.parquet(tmp_root)
    stream = spark.readStream.schema("ts timestamp, bad boolean").parquet(tmp_root).withWatermark("ts", "10 minutes")
    out = R.alert_error_rate(stream, "ts", F.col("bad"), 0.9, slide="5 minutes")
    q = out.writeStream.format("memory").queryName("late_alerts").outputMode("append").option("checkpointLocation", scratch_dir(spark, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.window_start for r in spark.table("late_alerts").collect()} >= {t(30)}


def test_stream_batch_with_only_ignored_files(spark, tmp_root):
    _write(tmp_root, "dead_letter/raw/daily/X/2026-07-14.json", _payload("14-07-2026", "1"))
    _write(tmp_root, "raw/weekly/X/2026-07-14.json", _payload("14-07-2026", "1"))
    target, quarantine = scratch_dir(spark, "obs"), scratch_dir(spark, "q")
    start_incremental_load(spark, tmp_root, target, scratch_dir(spark, "ck"), quarantine, "2026-07-17 00:00:00").awaitTermination()
    assert not os.path.exists(target)  # nothing loaded, table untouched
    assert read_quarantine(spark, quarantine).count() == 0


def test_live_stream_picks_up_new_arrivals(spark, tmp_root):
    _zone(tmp_root)
    target = scratch_dir(spark, "obs")
    q = start_incremental_load(
        spark, tmp_root, target, scratch_dir(spark, "ck"), None, "2026-07-17 00:00:00", available_now=False, processing_time="1 second"
    )
    try:
        q.processAllAvailable()
        assert read_observations(spark, target).count() == 3
        _write(tmp_root, "raw/daily/A B/2026-07-21.json", _payload("21-07-2026", "8"))
        q.processAllAvailable()
        assert read_observations(spark, target).where(F.col("value") == 8.0).count() == 1
    finally:
        q.stop()


def test_quarantine_forgets_a_mended_file_and_keeps_other_streams(spark, tmp_root):
    good = '{"Codigo": 0, "Series": {"Obs": [{"indexDateString": "14-07-2026", "value": "1", "statusCode": "OK"}]}}'
    write = lambda name, body: (os.makedirs(f"{tmp_root}/raw/daily/{name}", exist_ok=True), open(f"{tmp_root}/raw/daily/{name}/2026-07-14.json", "w").write(body))
    target, quarantine = scratch_dir(spark, "obs"), scratch_dir(spark, "q")
    write("A", "oops")
    write("B", "oops")
    start_incremental_load(spark, tmp_root, target, scratch_dir(spark, "ck"), quarantine).awaitTermination()
    listed = lambda: sorted(r.relative_path for r in read_quarantine(spark, quarantine).collect())
    assert listed() == ["raw/daily/A/2026-07-14.json", "raw/daily/B/2026-07-14.json"]
    write("A", good)
    start_incremental_load(spark, tmp_root, target, scratch_dir(spark, "ck"), quarantine, granularity="day").awaitTermination()
    assert listed() == ["raw/daily/B/2026-07-14.json"]
    # the new table took the day layout, and a later load of another setting keeps it
    assert "obs_day" in spark.read.parquet(target).columns
    assert L.bulk_reload(spark, tmp_root, target, prefix="raw/daily/A/") == 1
    assert "obs_day" in spark.read.parquet(target).columns and read_observations(spark, target).count() == 1


def test_prefix_without_objects_and_with_glob_characters(spark, tmp_root):
    os.makedirs(f"{tmp_root}/raw/daily/A", exist_ok=True)
    open(f"{tmp_root}/raw/daily/A/2026-07-14.json", "w").write("{}")
    assert LZ.read_landing(spark, tmp_root, "raw/weekly/").count() == 0
    assert LZ.read_landing(spark, tmp_root, "raw/daily/[A]/").count() == 0
    assert LZ.read_landing(spark, tmp_root, "raw/daily/A").count() == 1
