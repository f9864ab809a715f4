"""Session settings and the shared scratch area.

The observation store keeps calendar dates and UTC load instants, so every job runs with
the session zone pinned to UTC. Scratch output (staging for upserts, materialised
outcomes, stream checkpoints, derived landing zones) lives under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``); a local temporary folder is created only when
that setting is absent, as in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # runtime re-planning: coalesce small shuffle partitions, split skewed ones,
    # turn sort-merge joins into broadcast joins when a side turns out small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Landing payloads are KB-sized. With Spark's default open cost (4 MB) a 128 MB split packs
# only 32 files, i.e. hundreds of thousands of tasks for millions of payloads; at 256 KB a
# split packs about 500. Large Parquet files are unaffected. Applied only while the
# setting still has Spark's default, so an explicit choice is kept.
_DEFAULT_OPEN_COST = "4194304"
_SMALL_FILE_OPEN_COST = "262144"
_LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the engine relies on (idempotent)."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    # Listing many explicit paths (a stream micro-batch names every new file) runs as a
    # job with up to this many tasks; Spark's default of 10,000 turns a 20k-file batch into
    # 10,000 two-path tasks. Two tasks per core lists the same paths in a fraction of the time.
    if spark.conf.get(_LISTING_PARALLELISM, "10000") == "10000":
        spark.conf.set(_LISTING_PARALLELISM, str(min(10000, max(16, 2 * spark.sparkContext.defaultParallelism))))
    if spark.conf.get("spark.sql.files.openCostInBytes", _DEFAULT_OPEN_COST) in (_DEFAULT_OPEN_COST, _DEFAULT_OPEN_COST + "b", "4MB", "4m"):
        spark.conf.set("spark.sql.files.openCostInBytes", _SMALL_FILE_OPEN_COST)
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        # unset (unit tests, ad-hoc local sessions): make a private folder once
        root = tempfile.mkdtemp(prefix="obsflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{_checkpoint_root(spark)}/obsflow/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(path: str) -> bool:
    """Whether a file or folder exists at ``path`` (local path or filesystem URI)."""
    import os
    from urllib.parse import urlparse

    parsed = urlparse(path)
    if not (parsed.scheme and len(parsed.scheme) > 1) or parsed.scheme == "file":
        return os.path.exists(parsed.path if parsed.scheme == "file" else path)
    import pyarrow.fs as pafs

    fs, p = pafs.FileSystem.from_uri(path)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


def has_data_files(path: str, marker_counts: bool = True) -> bool:
    """Whether ``path`` holds a written table: any visible data file or partition folder,
    or (when ``marker_counts``) a commit marker of an empty table."""
    import os
    from urllib.parse import urlparse

    if not path_exists(path):
        return False
    parsed = urlparse(path)
    if not (parsed.scheme and len(parsed.scheme) > 1) or parsed.scheme == "file":
        local = parsed.path if parsed.scheme == "file" else path
        return any(not n.startswith((".", "_")) or (marker_counts and n == "_SUCCESS") for n in os.listdir(local))
    import pyarrow.fs as pafs

    fs, p = pafs.FileSystem.from_uri(path)
    infos = fs.get_file_info(pafs.FileSelector(p, recursive=False))
    return any(not i.base_name.startswith((".", "_")) or (marker_counts and i.base_name == "_SUCCESS") for i in infos)


def materialize(spark: SparkSession, df, name: str):
    """Write ``df`` once to a fresh scratch folder and read it back: fixes decisions that
    later side effects would change on re-evaluation, and cuts the lineage."""
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
