"""Clustered files, catalog tables and served views."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from obsflow.operators import upsert as U
from obsflow.plans import views as V
from obsflow.plans.served import create_views
from obsflow.schema import DIM_FREQUENCY, DIM_SERIES, DIM_SERIES_COLUMNS, OBSERVATION_COLUMNS, OBSERVATIONS
from obsflow.sources import catalog as CT
from obsflow.sources import tables as TB
from obsflow.sources.observations import scan_observations

T1, T2 = "2026-01-01 00:00:00", "2026-02-01 00:00:00"


def _many(spark, series, days, value=1.0, stamp=T1):
    rows = spark.range(series).select(F.concat(F.lit("S"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("series_id"))
    rows = rows.select("series_id", F.explode(F.sequence(F.lit(dt.date(2023, 12, 1)), F.date_add(F.lit(dt.date(2023, 12, 1)), days - 1))).alias("observation_date"))
    return rows.select(
        "series_id", "observation_date", (F.lit(value) + F.rand(3)).alias("value"), F.lit("OK").alias("status_code"), F.lit("daily").alias("frequency"),
        F.lit(stamp).cast("timestamp").alias("ingested_at"),
    )


def _row_groups(path):
    """(row groups, those whose range of series holds one), by their statistics."""
    def held(series):
        n = wanted = 0
        for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(f).metadata
            at = meta.schema.names.index("series_id")
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                n, wanted = n + 1, wanted + (stats.min <= series <= stats.max)
        return n, wanted
    return held


def _local(uri):
    return uri.removeprefix("file:")


def test_files_are_ranges_of_series_and_scans_skip_the_rest(spark, tmp_root, monkeypatch):
    monkeypatch.setitem(U.LAYOUT_OPTIONS, "parquet.block.size", "60000")
    monkeypatch.setitem(U.LAYOUT_OPTIONS, "parquet.page.size.row.check.min", "100")
    monkeypatch.setitem(U.LAYOUT_OPTIONS, "parquet.block.size.row.check.min", "100")
    U.upsert(spark, tmp_root, _many(spark, 600, 60))
    n, wanted = _row_groups(_local(tmp_root))("S000321")
    files = len(glob.glob(f"{_local(tmp_root)}/**/*.parquet", recursive=True))
    assert n > files >= 2 and wanted <= 4 < n / 3  # two years, a group or two in each
    got = scan_observations(spark, tmp_root, series_ids=["S000321"], first="2024-01-05", last="2024-01-09")
    assert sorted(str(r["observation_date"]) for r in got.collect()) == [f"2024-01-0{d}" for d in range(5, 10)]
    # a later load leaves the ranges narrow
    U.upsert(spark, tmp_root, _many(spark, 600, 40, value=5.0, stamp=T2))
    n, wanted = _row_groups(_local(tmp_root))("S000321")
    assert wanted < n / 3
    assert scan_observations(spark, tmp_root).where("value >= 5").count() == 600 * 40


@pytest.mark.parametrize("hot", [4_000_000, 50])
def test_copies_of_a_series_collapse_to_the_latest_rows(spark, tmp_root, monkeypatch, hot):
    monkeypatch.setattr(U, "HOT_ROWS", hot)
    rows = _many(spark, 5, 40)
    copies = rows.where("series_id = 'S000003'").select(*rows.columns, F.explode(F.sequence(F.lit(1), F.lit(300))).alias("c"))
    late = copies.withColumn("ingested_at", F.col("ingested_at") + F.make_interval(secs="c")).withColumn("value", F.col("c").cast("double")).drop("c")
    gone = copies.withColumn("ingested_at", F.lit(None).cast("timestamp")).withColumn("value", F.lit(-1.0)).drop("c")
    assert U.upsert(spark, tmp_root, rows.unionByName(late).unionByName(gone)) == 5 * 40 + 2 * 300 * 40
    got = scan_observations(spark, tmp_root)
    assert got.count() == 200 and {r["value"] for r in got.where("series_id = 'S000003'").collect()} == {300.0}


def test_a_table_without_rows_is_readable(spark, tmp_root):
    for gran in (None, "year", "day"):
        path = f"{tmp_root}-{gran}"
        U.ensure_table(spark, path, OBSERVATIONS, granularity=gran)
        empty = scan_observations(spark, path, series_ids=["A"], first="2024-01-01")
        assert empty.columns == OBSERVATION_COLUMNS and empty.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_observations(spark, f"{tmp_root}-nowhere").count()


@pytest.fixture
def named(spark, tmp_root):
    V.ensure_namespaces(spark)
    suffix = os.path.basename(tmp_root).replace("-", "_")
    yield lambda kind: (f"raw.{kind}_{suffix}", f"{tmp_root}/{kind}/table")


def test_empty_catalog_tables_have_their_schema(spark, named):
    for kind, schema, gran in (("fact", OBSERVATIONS, "month"), ("dim", DIM_SERIES, None)):
        name, folder = named(kind)
        TB.create_table(spark, name, schema, folder, gran)
        TB.create_table(spark, name, schema, folder, gran)  # a second time: left alone
        assert spark.table(name).select(*schema.names).dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields]
        assert spark.table(name).count() == 0


@pytest.mark.parametrize("granularity", ["year", "month", "day"])
def test_catalog_upsert_switches_only_touched_partitions(spark, named, granularity):
    name, folder = named("fact")
    TB.create_table(spark, name, OBSERVATIONS, folder, granularity)
    first = _many(spark, 4, 62)
    assert TB.upsert_table(spark, name, first) == 4 * 62
    before = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    files = set(spark.table(name).inputFiles())
    second = _many(spark, 5, 3, value=9.0, stamp=T2)
    assert TB.upsert_table(spark, name, second) == 15
    rows = {(r["series_id"], r["observation_date"]): r["value"] for r in spark.table(name).collect()}
    assert len(rows) == 4 * 62 + 3 and sum(v >= 9 for v in rows.values()) == 15
    assert {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == before
    kept = files & set(spark.table(name).inputFiles())
    touched = {"year": ["obs_year=2023"], "month": ["obs_month=202312"], "day": [f"obs_day=2023-12-0{d}" for d in (1, 2, 3)]}[granularity]
    assert kept == {f for f in files if not any(f"/{t}/" in f for t in touched)} and kept
    assert TB.upsert_table(spark, name, first.limit(0)) == 0
    assert spark.table(name).where(f"observation_date = DATE '2023-12-02' AND series_id = 'S000004'").count() == 1


def test_a_job_killed_before_the_switch_leaves_the_old_rows(spark, named, monkeypatch):
    name, folder = named("dim")
    TB.create_table(spark, name, DIM_FREQUENCY, folder)
    TB.replace_table(spark, name, CT.dim_frequency(spark).withColumn("description", F.lit("old")))
    at = TB.location(spark, name)
    run = type(spark).sql

    def killed(self, text, *a, **b):
        if text.startswith("ALTER TABLE"):
            raise KeyboardInterrupt
        return run(self, text, *a, **b)

    monkeypatch.setattr(type(spark), "sql", killed)
    with pytest.raises(KeyboardInterrupt):  # the new folder is written, the table is not switched
        TB.replace_table(spark, name, CT.dim_frequency(spark))
    monkeypatch.undo()
    assert TB.location(spark, name) == at and {r["description"] for r in spark.table(name).collect()} == {"old"}
    bad = CT.dim_frequency(spark).withColumn("description", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        TB.replace_table(spark, name, bad)
    assert spark.table(name).where("description = 'old'").count() == 3
    TB.replace_table(spark, name, CT.dim_frequency(spark))
    TB.replace_table(spark, name, CT.dim_frequency(spark))
    assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, CT.dim_frequency(spark).collect()))


def test_served_views_are_catalog_views(spark, named):
    fact, folder = named("fact")
    dim, dim_folder = named("dim")
    TB.create_table(spark, fact, OBSERVATIONS, folder, "year")
    TB.create_table(spark, dim, DIM_SERIES, dim_folder)
    names = create_views(spark, fact, dim, {"v_tpm": ["S000001"], "v_imacec": "series_id > 'S000001'", "v_pib_trimestral": []})
    assert len(names) == 7 and all(spark.table(n).count() == 0 for n in names)  # made on empty tables
    rows = _many(spark, 3, 40).withColumn("value", F.when(F.dayofmonth("observation_date") == 7, None).when(F.dayofmonth("observation_date") == 9, 0.0).when(F.dayofmonth("observation_date") == 20, -100.0).otherwise(F.round("value", 1)))
    rows = spark.createDataFrame(rows.collect(), OBSERVATIONS)
    TB.upsert_table(spark, fact, rows)
    seed = spark.createDataFrame([("S000001", "One", "CLP", "daily", None, dt.datetime(2026, 1, 1))], DIM_SERIES)
    TB.upsert_table(spark, dim, seed, keys=["series_id"], columns=DIM_SERIES_COLUMNS, order_by=["updated_at"])
    another = spark.newSession()  # another session of the application sees the views, and the rows of after the switch
    same = lambda a, b: sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))
    pins = {"v_tpm": ["S000001"], "v_imacec": F.col("series_id") > "S000001", "v_pib_trimestral": []}
    for name, build in V.VIEW_BUILDERS.items():
        want = build(rows, pins.get(name))
        assert another.table(f"analytics.{name}").columns == want.columns
        assert same(another.sql(f"SELECT * FROM analytics.{name}"), want), name
    assert same(spark.table("analytics.v_dashboard_consolidado"), V.dashboard_long(rows, seed))
    create_views(spark, fact, dim)  # replaced: no longer pinned
    assert same(another.table("analytics.v_tpm"), V.view_tpm(rows))
