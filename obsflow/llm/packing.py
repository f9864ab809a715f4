"""Harmonic packing of token ids into sequences of a fixed capacity.

A document is cut into pieces whose lengths are capacity / k for k a power of two: as
many whole sequences as fit, then the binary digits of the rest. Pieces of length
capacity / k form the class of k, and a sequence of that class takes exactly k of them, so
it is full without any search. Every task packs its own rows in one pass and holds at most
k - 1 waiting pieces a class (under one sequence of ids). What waits at the end is
closed in sequences of a power of two of pieces, whose total length is a power of two too.
Nothing is shuffled and no task needs another's state; a task that is run again gives the
same sequences as long as its input split lists its rows in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.arrow import prepare, tidy
from obsflow.llm.tokens import UnitTokenizer, ids_array

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def cut_lengths(n: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece lengths, pieces per document) of documents of ``n`` ids, in order."""
    sizes = capacity >> np.arange(capacity.bit_length())
    rest = n % capacity
    count = np.stack([n // capacity, *[(rest // s) % 2 for s in sizes[1:]]], axis=1)
    return np.repeat(np.tile(sizes, len(n)), count.ravel()), count.sum(axis=1)


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    with UnitTokenizer.for_task(path) as tokenizer:
        yield from _packed(batches, tokenizer, capacity, end_id)


def _packed(batches: Iterator[pa.RecordBatch], tokenizer: UnitTokenizer, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    sequence = TaskContext.get().partitionId() << 36
    waiting: pa.Table | None = None

    def numbered(table: pa.Table, sequences: np.ndarray, offsets: np.ndarray) -> Iterator[pa.RecordBatch]:
        full = table.append_column("sequence_id", pa.array(sequences)).append_column("offset", pa.array(offsets))
        yield from full.select(["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]).combine_chunks().to_batches()

    for batch in batches:
        doc_ids = batch.column("doc_id")
        for first, last, ids, off in tokenizer.encode(batch.column("text"), end_id):
            n = np.diff(off)
            length, pieces = cut_lengths(n, capacity)
            at = np.concatenate([[0], np.cumsum(length)])
            doc = np.repeat(np.arange(last - first), pieces)
            table = pa.table({
                "doc_id": doc_ids.slice(first, last - first).take(pa.array(doc)),
                "start": at[:-1] - off[doc],
                "length": length,
                "doc_tokens": n[doc],
                "ids": ids_array(ids, at),
            })
            if waiting is not None:
                table = pa.concat_tables([waiting, table]).combine_chunks()
            length = table.column("length").to_numpy()
            order = np.argsort(-length, kind="stable")
            length = length[order]
            k = capacity // length
            new = np.r_[True, length[1:] != length[:-1]]
            head = np.flatnonzero(new)
            size = np.diff(np.r_[head, len(length)])
            rank = np.arange(len(length)) - np.repeat(head, size)
            full = np.repeat(size - size % k[head], size)
            done = rank < full
            bins = np.concatenate([[0], np.cumsum(size // k[head])])
            number = sequence + np.repeat(bins[:-1], size) + rank // k
            yield from numbered(table.take(pa.array(order[done])), number[done], ((rank % k) * length)[done])
            sequence += int(bins[-1])
            waiting = table.take(pa.array(order[~done])).combine_chunks()
    if waiting is not None and len(waiting):
        length = waiting.column("length").to_numpy()
        numbers, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for size in np.unique(length):
            own = np.flatnonzero(length == size)
            while len(own):
                take = 1 << (len(own).bit_length() - 1)
                numbers[own[:take]], offsets[own[:take]] = sequence, np.arange(take) * size
                sequence += 1
                own = own[take:]
        yield from numbered(waiting, numbers, offsets)


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``
    (little-endian unsigned 32-bit ids).

    Only ``doc_id`` and ``text`` are read. Null and empty texts are the end id alone; ids
    may be null or repeat (each row is packed by itself); an empty table gives an empty
    result. ``capacity`` must be a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    prepare(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(tidy(partial(_pack, path=tokenizer, capacity=capacity, end_id=end_id)), SCHEMA)
