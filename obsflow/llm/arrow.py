"""Arrow batch limits, by bytes: rows are texts, whose count says little about their size."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession, limit: int = 16 << 20) -> None:
    """Ready a session for Arrow functions of this package: batches are closed at ``limit``
    bytes, unless the session sets a limit of its own, and workers started by the session
    look for the package where the driver found it (on a cluster it is installed or given
    with ``--py-files`` and this path is simply absent)."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, root]))
    if spark.conf.get(_BYTES, None) != spark.conf.get(_BYTES):
        spark.conf.set(_BYTES, str(limit))


def _trimmed(batches: Iterator[pa.RecordBatch], fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    try:
        yield from fn(batches)
    finally:
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # the C library of most Linux systems; others give memory back by themselves
            ctypes.CDLL(None).malloc_trim(0)


def tidy(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn``, giving freed memory back to the system at the end of a task: workers are reused,
    and what each operator's largest task once took would add up in them."""
    return partial(_trimmed, fn=fn)


def filter_rows(docs: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of ``docs``, all columns, where ``keep`` gives true; nothing is shuffled."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch)))

    return docs.mapInArrow(tidy(apply), docs.schema)


def whole_runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Regroup sorted batches so that no run of equal values of ``names`` is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if all(held[0].column(c)[0] == batch.column(c)[-1] for c in names):
            continue  # one run so far
        table = pa.Table.from_batches(held).combine_chunks()
        last = np.logical_and.reduce([table.column(c).to_numpy() == table.column(c)[-1].as_py() for c in names])
        cut = int(np.argmax(last))
        yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
