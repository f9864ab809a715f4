"""The landing zone: immutable, path-addressed payload files ``raw/{frequency}/{series}/{period}.json``.

* ``read_landing`` scans every object under a root (or a sub-prefix) with one row per
  file (its bytes decoded as UTF-8), keeping the path relative to the root.
* ``decode_path`` splits a relative path into ``(frequency, series_id, period_label)``;
  anything off the anchored pattern is flagged and later ignored.
* ``list_landed`` lists paths without reading bodies; both list in tasks (``sources.objects``).
* ``existing_paths`` checks given paths one by one inside tasks (cost follows the targets).
* ``write_if_absent`` writes payloads create-only: a path that already exists is skipped
  (as is the loser of a concurrent create). A payload is written to a hidden temporary
  name and published in one step, so readers never see a partial file. Spark's writers cannot choose file names, so
  this one step runs Python inside tasks: payloads are hash-partitioned by path and each
  task creates its own files. Outcomes are materialised once in the shared scratch area so
  that re-reading them never re-runs the writes.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.schema import LANDING_PATH_PATTERN
from obsflow.session import path_exists, scratch_dir
from obsflow.sources.objects import list_objects, read_bodies

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _root_path(root: str) -> str:
    """The path component of a root URI (or an absolute local path), without a trailing /."""
    parsed = urlparse(root)
    if parsed.scheme and len(parsed.scheme) > 1:
        return parsed.path.rstrip("/")
    return os.path.abspath(root).rstrip("/")


def relative_path(file_uri: Column, root: str) -> Column:
    """File URI reported by the scan → path relative to ``root`` (NULL if outside it)."""
    path = F.regexp_replace(file_uri, _SCHEME, "")
    prefix = _root_path(root) + "/"
    decoded = F.try_url_decode(F.regexp_replace(path, "[+]", "%2B"))
    return F.when(decoded.startswith(prefix), decoded.substr(F.lit(len(prefix) + 1), F.length(decoded)))


def landing_path(frequency: Column | str, series_id: Column | str, period_label: Column | str) -> Column:
    """CAL-9: ``raw/{frequency}/{series_id}/{period_label}.json``; an empty part is an error."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (frequency, series_id, period_label)]
    missing = None
    for p in parts:
        cond = p.isNull() | (p == "")
        missing = cond if missing is None else (missing | cond)
    path = F.concat(F.lit("raw/"), parts[0], F.lit("/"), parts[1], F.lit("/"), parts[2], F.lit(".json"))
    return F.when(missing, F.raise_error(F.lit("a landing path needs a frequency, a series id and a period label"))).otherwise(path)


def read_landing(spark: SparkSession, root: str, prefix: str | None = None) -> DataFrame:
    """SRC-1/SRC-2: one row per object under ``root`` (optionally under ``root/prefix``).

    A prefix ending in ``/`` names a folder; otherwise it matches names that start with it,
    like an object-store key prefix. A prefix without objects gives no rows. Zero-length objects
    and names that start with ``_`` or ``.`` are objects like any other.
    """
    if not prefix and not path_exists(root):
        raise FileNotFoundError(f"no landing zone at {root}")
    return read_bodies(spark, list_objects(spark, root, prefix), root)


def decode_path(df: DataFrame, col: str = "relative_path") -> DataFrame:
    """SRC-3: add ``on_pattern``, ``frequency``, ``series_id``, ``period_label``."""
    p = F.col(col)
    on = F.coalesce(p.rlike(LANDING_PATH_PATTERN), F.lit(False))
    return df.withColumns(
        {
            "on_pattern": on,
            "frequency": F.when(on, F.regexp_extract(p, LANDING_PATH_PATTERN, 1)),
            "series_id": F.when(on, F.regexp_extract(p, LANDING_PATH_PATTERN, 2)),
            "period_label": F.when(on, F.regexp_extract(p, LANDING_PATH_PATTERN, 3)),
        }
    )


def list_landed(spark: SparkSession, root: str) -> DataFrame:
    """Relative paths of every object under ``root``, without reading their bodies."""
    return list_objects(spark, root).select("relative_path")


def _writer(root: str, replace: bool = False):
    parsed = urlparse(root)
    local = not (parsed.scheme and len(parsed.scheme) > 1) or parsed.scheme == "file"
    base = _root_path(root) if local else root.rstrip("/")

    def write(batches):
        import pandas as pd

        fs = None
        if not local:
            import pyarrow.fs as pafs

            fs, base_path = pafs.FileSystem.from_uri(base)
        for pdf in batches:
            outcomes = []
            for rel, body in zip(pdf["relative_path"], pdf["body"]):
                data = body.encode("utf-8")
                if local:
                    full = f"{base}/{rel}"
                    folder, name = os.path.split(full)
                    os.makedirs(folder, exist_ok=True)
                    # write a hidden temporary file, then publish it with a hard link: the
                    # link is atomic and fails if the name exists, so a concurrent writer or a
                    # retried task never sees, nor leaves, a half-written payload
                    tmp = os.path.join(folder, f".{name}.{uuid.uuid4().hex}.tmp")
                    with open(tmp, "wb") as fh:
                        fh.write(data)
                    if replace:
                        os.replace(tmp, full)
                        outcomes.append("rewritten")
                        continue
                    try:
                        os.link(tmp, full)
                        outcomes.append("written")
                    except FileExistsError:
                        outcomes.append("skipped")
                    finally:
                        os.unlink(tmp)
                else:
                    full = f"{base_path}/{rel}"
                    if not replace and fs.get_file_info(full).type != pafs.FileType.NotFound:
                        outcomes.append("skipped")
                        continue
                    folder, name = full.rsplit("/", 1)
                    fs.create_dir(folder, recursive=True)
                    tmp = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
                    with fs.open_output_stream(tmp) as fh:
                        fh.write(data)
                    fs.move(tmp, full)
                    outcomes.append("rewritten" if replace else "written")
            yield pd.DataFrame({"relative_path": pdf["relative_path"], "outcome": outcomes})

    return write


_OUTCOME = T.StructType([T.StructField("relative_path", T.StringType()), T.StructField("outcome", T.StringType())])


def write_if_absent(spark: SparkSession, payloads: DataFrame, root: str, partitions: int | None = None) -> DataFrame:
    """SNK-8: create-only write of ``(relative_path, body)`` rows under ``root``.

    Returns ``(relative_path, outcome)`` with outcome ``written`` or ``skipped``, read back
    from a materialised table. Existence is decided by the writer itself, file by file, so
    the cost follows the batch, never the size of the landing zone.
    """
    # copies of one path collapse map-side (an aggregate) before the one exchange on the
    # path; the smallest body of a path is the one offered to the writer
    unique = payloads.groupBy("relative_path").agg(F.min("body").alias("body"))
    if partitions:
        unique = unique.repartition(partitions, "relative_path")
    written = unique.mapInPandas(_writer(root), _OUTCOME)
    out = scratch_dir(spark, "landing-outcomes")
    written.write.parquet(out)
    return spark.read.parquet(out)


def rewrite(spark: SparkSession, payloads: DataFrame, root: str) -> DataFrame:
    """Correct landed objects in place: ``(relative_path, body)`` rows replace what their paths
    hold, each at once. A stream of the zone takes the new generation again."""
    unique = payloads.groupBy("relative_path").agg(F.min("body").alias("body"))
    out = scratch_dir(spark, "landing-rewrites")
    unique.mapInPandas(_writer(root, replace=True), _OUTCOME).write.parquet(out)
    return spark.read.parquet(out)


def _exists_check(root: str):
    parsed = urlparse(root)
    local = not (parsed.scheme and len(parsed.scheme) > 1) or parsed.scheme == "file"
    base = _root_path(root) if local else root.rstrip("/")

    def check(batches):
        fs = None
        if not local:
            import pyarrow.fs as pafs

            fs, base_path = pafs.FileSystem.from_uri(base)
        for pdf in batches:
            if local:
                found = [os.path.isfile(f"{base}/{rel}") for rel in pdf["relative_path"]]
            else:
                infos = fs.get_file_info([f"{base_path}/{rel}" for rel in pdf["relative_path"]])
                found = [i.type == pafs.FileType.File for i in infos]
            yield pdf.assign(exists=found)

    return check


def existing_paths(spark: SparkSession, paths: DataFrame, root: str, partitions: int | None = None) -> DataFrame:
    """The subset of ``paths`` (``relative_path``) present under ``root``, checked path by
    path inside tasks: for a handful of targets against a large landing zone this costs far
    less than listing the zone."""
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = paths.select("relative_path").distinct().repartition(n, "relative_path")
    checked = distinct.mapInPandas(_exists_check(root), "relative_path string, exists boolean")
    return checked.where(F.col("exists")).select("relative_path")
