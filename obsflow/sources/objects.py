"""Every object of a landing zone: a Spark data source that lists in tasks.

Spark's file sources leave out zero-length files and names that start with ``_`` or ``.``,
and list on the driver. Here each task lists the upper folders of the zone and, of the
folders below them, its own share (by a hash of the path), so the listing is spread and
nothing of it is held. The rows are names, times and lengths; bodies are read in a second
step, dealt evenly whatever the folders hold.

As a stream the source tells objects by their generation, the time at which they were
finalised or rewritten: an object rewritten in place comes again, and a batch is all that
lies between two generations, so neither the driver nor the checkpoint keeps paths.

The classes are made inside functions, so tasks need no copy of this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED = "relative_path string, modified_us long, generation long, length long"
_BODIES = "relative_path string, modified_us long, body string"
_BATCH_BYTES = 8 << 20


def _lister():
    """(list a share of the objects below a root, open a store): plain functions for tasks."""
    import os
    import re
    import zlib
    from urllib.parse import unquote, urlparse

    unpublished = re.compile(r"^\..*\.[0-9a-f]{32}\.tmp$")  # bodies that the landing writer has not published yet

    def is_local(root: str) -> bool:
        parsed = urlparse(root)
        return not (parsed.scheme and len(parsed.scheme) > 1) or parsed.scheme == "file"

    def local_path(root: str) -> str:
        parsed = urlparse(root)
        return (unquote(parsed.path) if parsed.scheme == "file" else os.path.abspath(root)).rstrip("/")

    def entries(root: str, folder: str):
        """(name, is a folder, modified ns, generation ns, length) of a folder; none if it is gone."""
        if is_local(root):
            try:
                with os.scandir(f"{local_path(root)}/{folder}") as found:
                    for e in found:
                        if e.is_dir():
                            yield e.name, True, 0, 0, 0
                            continue
                        try:
                            s = e.stat()
                        except FileNotFoundError:
                            continue
                        yield e.name, False, s.st_mtime_ns, max(s.st_mtime_ns, s.st_ctime_ns), s.st_size
            except (FileNotFoundError, NotADirectoryError):
                return
        else:
            import pyarrow.fs as pafs

            fs, base = pafs.FileSystem.from_uri(root)
            for i in fs.get_file_info(pafs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True)):
                if i.type == pafs.FileType.Directory:
                    yield i.base_name, True, 0, 0, 0
                elif i.type == pafs.FileType.File:
                    yield i.base_name, False, i.mtime_ns or 0, i.mtime_ns or 0, i.size

    def listed(root: str, prefix: str, share: int = 0, shares: int = 1, depth: int = 2):
        """(relative path, modified ns, generation ns, length) of the share's objects whose path
        starts with ``prefix``. Folders above ``depth`` are listed by every share."""
        own = lambda path: zlib.crc32(path.encode("utf-8", "surrogateescape")) % shares == share
        start, _, first = prefix.rpartition("/")
        stack = [(f"{start}/" if start else "", first, 0, False)]
        while stack:
            folder, begins, level, mine = stack.pop()
            for name, is_folder, modified, generation, length in entries(root, folder):
                if not name.startswith(begins):
                    continue
                path = folder + name
                if is_folder:
                    whole = mine or (level >= depth and own(path))
                    if whole or level < depth:
                        stack.append((f"{path}/", "", level + 1, whole))
                elif (mine or own(path)) and not unpublished.match(name):
                    yield path, modified, generation, length

    return listed, is_local, local_path


def _source_class():
    from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

    listed, is_local, _ = _lister()
    fields = LISTED

    def batches(rows):
        import pyarrow as pa

        names = [f.strip().split(" ")[0] for f in fields.split(",")]
        held = [[], [], [], []]
        for path, modified, generation, length in rows:
            for column, value in zip(held, (path, modified // 1000, generation, length), strict=True):
                column.append(value)
            if len(held[0]) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.string()), *(pa.array(c, pa.int64()) for c in held[1:])], names=names)
                held = [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.string()), *(pa.array(c, pa.int64()) for c in held[1:])], names=names)

    class Share(InputPartition):
        def __init__(self, share: int, start: int = -1, end: int = 1 << 62) -> None:
            super().__init__(share)
            self.share, self.start, self.end = share, start, end

    class Read:
        def __init__(self, options) -> None:
            self.root, self.prefix = options["path"], options.get("prefix", "")
            self.shares, self.settle = int(options.get("shares", "16")), float(options.get("settle", "0"))

        def read(self, partition):
            found = listed(self.root, self.prefix, partition.share, self.shares)
            return batches(x for x in found if partition.start < x[2] <= partition.end)

    class Reader(Read, DataSourceReader):
        def partitions(self):
            return [Share(i) for i in range(self.shares)]

    class StreamReader(Read, DataSourceStreamReader):
        """Offsets are generations in nanoseconds."""

        def __init__(self, options) -> None:
            super().__init__(options)
            self.newest = -1

        def initialOffset(self) -> dict:
            return {"generation": -1}

        def latestOffset(self) -> dict:
            import time

            limit = time.time_ns() - int(self.settle * 1e9)
            seen = max((g for _, _, g, _ in listed(self.root, self.prefix) if g <= limit or is_local(self.root)), default=-1)
            self.newest = max(self.newest, seen)
            return {"generation": self.newest}

        def partitions(self, start: dict, end: dict):
            a, b = start["generation"], end["generation"]
            return [Share(i, a, b) for i in range(self.shares)] if a < b else []

    class LandingObjects(DataSource):
        @classmethod
        def name(cls) -> str:
            return "landing_objects"

        def schema(self) -> str:
            return fields

        def reader(self, schema):
            return Reader(self.options)

        def streamReader(self, schema):
            return StreamReader(self.options)

    return LandingObjects


def _shares(spark: SparkSession) -> int:
    return max(2, 2 * spark.sparkContext.defaultParallelism)


def list_objects(spark: SparkSession, root: str, prefix: str | None = None) -> DataFrame:
    """``relative_path, modified_us, generation, length`` of every object below ``root`` whose path
    starts with ``prefix`` (text, not a glob); hidden and zero-length ones included. A prefix
    or root without objects gives no rows."""
    spark.dataSource.register(_source_class())
    return spark.read.format("landing_objects").option("shares", _shares(spark)).option("prefix", prefix or "").load(root.rstrip("/"))


def object_stream(spark: SparkSession, root: str, settle: float = 2.0) -> DataFrame:
    """The same as a stream: each object once for each generation. On stores that tell time in
    whole seconds, generations younger than ``settle`` seconds wait for the next batch."""
    spark.dataSource.register(_source_class())
    return spark.readStream.format("landing_objects").option("shares", _shares(spark)).option("settle", settle).load(root.rstrip("/"))


def _reader(root: str, limit: int):
    _, is_local, local_path = _lister()
    local = is_local(root)
    base = local_path(root) if local else root.rstrip("/")

    def read(batches):
        import pyarrow as pa

        if not local:
            import pyarrow.fs as pafs

            fs, base_path = pafs.FileSystem.from_uri(base)

        def body(path: str) -> bytes | None:
            try:
                if local:
                    with open(f"{base}/{path}", "rb") as f:
                        return f.read()
                with fs.open_input_stream(f"{base_path}/{path}") as f:
                    return f.read()
            except FileNotFoundError:  # gone since it was listed
                return None

        def batch(rows):
            paths, times, bodies = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [])
            # text that is no UTF-8 keeps its readable part, as a cast of the bytes would
            text = [b.decode("utf-8", "replace") for b in bodies]
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(times, pa.int64()), pa.array(text, pa.string())], names=["relative_path", "modified_us", "body"])

        for given in batches:
            rows, size = [], 0
            for path, time in zip(given.column("relative_path").to_pylist(), given.column("modified_us").to_pylist(), strict=True):
                got = body(path)
                if got is not None:
                    rows.append((path, time, got))
                    size += len(got)
                if size > limit:
                    yield batch(rows)
                    rows, size = [], 0
            yield batch(rows)

    return read


def read_bodies(spark: SparkSession, objects: DataFrame, root: str) -> DataFrame:
    """``relative_path, body, modified_at`` of listed objects; objects that are gone since give no row."""
    names = objects.select("relative_path", "modified_us").repartition(_shares(spark))  # even, whatever the folders hold
    read = names.mapInArrow(_reader(root, _BATCH_BYTES), _BODIES)
    return read.select("relative_path", "body", F.timestamp_micros("modified_us").alias("modified_at"))
