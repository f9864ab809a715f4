"""Landing-path throughput on a replicated landing zone.

    python tools/scale_landing.py [--sf /root/testdata/sf0.1] [--copies 400]

The daily payloads derived from ``events`` are replicated under ``copies`` series-id
suffixes, written create-only, then loaded with one bulk reload and with the file stream.
Prints one JSON line with times and files/s.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=400)
    ap.add_argument("--cpus", default="8")
    args = ap.parse_args()
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from obsflow.operators.upsert import read_observations
    from obsflow.plans.load import bulk_reload
    from obsflow.session import configure, scratch_dir
    from obsflow.sources import landing as LZ
    from obsflow.sources.landing_fixture import good_daily
    from obsflow.streaming.incremental import start_incremental_load

    spark = (
        SparkSession.builder.master(f"local[{args.cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(int(args.cpus) * 2))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    base = good_daily(spark, args.sf)
    rep = base.select(F.explode(F.sequence(F.lit(0), F.lit(args.copies - 1))).alias("r"), "relative_path", "body")
    files = rep.select(
        F.regexp_replace("relative_path", r"^raw/daily/([^/]+)/", F.concat(F.lit("raw/daily/$1~"), F.col("r").cast("string"), F.lit("/"))).alias("relative_path"),
        "body",
    )
    root = scratch_dir(spark, "scale-landing")
    out = {}
    t0 = time.perf_counter()
    outcome = LZ.write_if_absent(spark, files, root, partitions=int(args.cpus) * 4)
    n = outcome.where("outcome = 'written'").count()
    out["write_sec"] = round(time.perf_counter() - t0, 2)
    out["files"] = n

    target = scratch_dir(spark, "scale-obs")
    t0 = time.perf_counter()
    rows = bulk_reload(spark, root, target, ingested_at="2026-01-01 00:00:00")
    out["bulk_reload_sec"] = round(time.perf_counter() - t0, 2)
    out["rows"] = rows

    target2 = scratch_dir(spark, "scale-obs-stream")
    t0 = time.perf_counter()
    start_incremental_load(spark, root, target2, scratch_dir(spark, "scale-ck"), scratch_dir(spark, "scale-q"), "2026-01-01 00:00:00").awaitTermination()
    out["stream_sec"] = round(time.perf_counter() - t0, 2)
    out["stream_rows"] = read_observations(spark, target2).count()
    for k in ("write", "bulk_reload", "stream"):
        out[f"{k}_files_per_sec"] = round(n / out[f"{k}_sec"], 1)
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
