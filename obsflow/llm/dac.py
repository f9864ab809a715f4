"""Token ids in directly addressable codes.

An id is split into chunks of eight bits, lowest first. Level 0 holds the first chunk of
every id and one continuation bit each; level l + 1 holds the next chunk of only those ids
whose bit at level l is set. A rank directory (set bits before every 512th) turns a
position at one level into the position at the next, so any id is read with a few lookups
and no block is decoded.

A segment is one binary image of about ``SEGMENT_IDS`` ids of whole documents:

    magic "DAC1", then unsigned 64-bit: documents d, ids n, levels
    d document ids (int64), d null marks (bytes), d + 1 document offsets (int64)
    for each level: entries m (uint64), m chunks (bytes), ceil(m / 8) bitmap bytes (lowest
    bit first), ceil(m / 512) + 1 directory entries (uint32)

A store is a folder of Parquet files of rows ``(part, number, first, n_docs, n_ids,
image)``; ``part`` follows the ascending ids, ``first`` counts the ids of the part before
the segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.llm.arrow import prepare, tidy
from obsflow.llm.tokens import UnitTokenizer, ids_array

MAGIC = b"DAC1"
SEGMENT_IDS = 1 << 20
_RUN = 512
_POP = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint32)


def encode_segment(doc_ids: np.ndarray, nulls: np.ndarray, off: np.ndarray, ids: np.ndarray) -> bytes:
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        runs = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(more), _RUN)) if len(more) else np.zeros(0, np.uint32)
        directory = np.concatenate([[0], np.cumsum(runs)]).astype("<u4")
        levels += [np.array([len(rest)], "<u8").tobytes(), rest.astype(np.uint8).tobytes(), bitmap.tobytes(), directory.tobytes()]
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    head = np.array([len(doc_ids), len(ids), len(levels) // 4], "<u8").tobytes()
    return b"".join([MAGIC, head, doc_ids.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(), off.astype("<i8").tobytes(), *levels])


class Segment:
    """A read-only view of one image."""

    def __init__(self, image: bytes) -> None:
        if bytes(image[:4]) != MAGIC:
            raise ValueError("not a DAC1 image")
        self._image, self._at = image, 4
        docs, self.n_ids, count = (int(x) for x in self._take("<u8", 3))
        self.doc_ids, self.nulls, self.offsets = self._take("<i8", docs), self._take("u1", docs), self._take("<i8", docs + 1)
        self.levels = []
        for _ in range(count):
            m = int(self._take("<u8", 1)[0])
            self.levels.append((self._take("u1", m), self._take("u1", -(-m // 8)), self._take("<u4", -(-m // _RUN) + 1)))

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self._image, kind, n, self._at)
        self._at += out.nbytes
        return out

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at positions ``at`` of the segment, through the rank directories alone."""
        value, live, at = np.zeros(len(at), np.uint32), np.arange(len(at)), np.asarray(at, np.int64)
        for depth, (chunk, bitmap, directory) in enumerate(self.levels):
            value[live] |= chunk[at].astype(np.uint32) << np.uint32(8 * depth)
            more = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            live, at = live[more], at[more]
            if not len(live):
                break
            run = at // _RUN
            rank = directory[run].astype(np.int64)
            for k in range(_RUN // 8):
                byte = run * (_RUN // 8) + k
                rank += np.where(byte < at >> 3, _POP[bitmap[np.minimum(byte, len(bitmap) - 1)]], 0)
            at = rank + _POP[bitmap[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8)]
        return value

    def decode(self) -> np.ndarray:
        """All ids."""
        out = None
        for depth in range(len(self.levels) - 1, -1, -1):
            chunk, bitmap, _ = self.levels[depth]
            value = chunk.astype(np.uint32)
            if out is not None:
                value[np.unpackbits(bitmap, count=len(chunk), bitorder="little").astype(bool)] |= out << np.uint32(8)
            out = value
        return out


_STORED = "part long, number long, first long, n_docs long, n_ids long, image binary"


def _write(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    with UnitTokenizer.for_task(path) as tokenizer:
        yield from _written(batches, tokenizer, end_id)


def _written(batches: Iterator[pa.RecordBatch], tokenizer: UnitTokenizer, end_id: int) -> Iterator[pa.RecordBatch]:
    part, number, before = TaskContext.get().partitionId(), 0, 0
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def close() -> pa.RecordBatch:
        nonlocal number, before, size, held
        doc_ids, nulls, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        image = encode_segment(doc_ids, nulls, np.concatenate([[0], np.cumsum(counts)]), ids)
        row = [[part], [number], [before], [len(doc_ids)], [len(ids)], [image]]
        number, before, size, held = number + 1, before + len(ids), 0, []
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in row[:5]), pa.array(row[5], pa.binary())], names=["part", "number", "first", "n_docs", "n_ids", "image"])

    for batch in batches:
        nulls = np.asarray(batch.column("doc_id").is_null())
        doc_ids = np.asarray(batch.column("doc_id").fill_null(0)).astype(np.int64)
        for first, last, ids, off in tokenizer.encode(batch.column("text"), end_id):
            a = first
            while a < last:
                b = max(a + 1, first + int(np.searchsorted(off, off[a - first] + SEGMENT_IDS - size, "right")) - 1)
                part_ids = ids[off[a - first] : off[b - first]]
                held.append((doc_ids[a:b], nulls[a:b], np.diff(off[a - first : b - first + 1]), part_ids))
                size += len(part_ids)
                if size >= SEGMENT_IDS or b < last:
                    yield close()
                a = b
    if held:
        yield close()


def write_store(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode whole texts and write their ids in ascending ``doc_id`` order.

    Only ``doc_id`` and ``text`` are read. Null and empty texts are the end id alone; null
    ids come first, rows of one id are ordered by their text (null first); an empty table
    gives an empty store.
    """
    prepare(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(tidy(partial(_write, path=tokenizer, end_id=end_id)), _STORED).write.parquet(path)


def _bases(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part: one row a part, of which there are no more than shuffle partitions."""
    size = spark.read.schema(_STORED).parquet(path).groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return size.select("part", F.coalesce(before, F.lit(0)).alias("base"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, image in zip(batch.column("begin").to_pylist(), batch.column("image"), strict=True):
            seg = Segment(image.as_buffer())
            doc_ids = pa.array(seg.doc_ids, mask=seg.nulls.astype(bool))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(begin + seg.offsets[:-1]), pa.array(np.diff(seg.offsets)), ids_array(seg.decode(), seg.offsets)],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of a store; ``start`` counts the ids of all rows before."""
    prepare(spark)
    stored = spark.read.schema(_STORED).parquet(path).select("part", "first", "image")
    placed = stored.join(F.broadcast(_bases(spark, path)), "part").select((F.col("base") + F.col("first")).alias("begin"), "image")
    return placed.mapInArrow(tidy(_read), "doc_id long, start long, n_tokens long, ids binary")


def _lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, begin, image in zip(batch.column("at"), batch.column("begin").to_pylist(), batch.column("image"), strict=True):
            at = np.asarray(at.values, np.int64)
            got = Segment(image.as_buffer()).access(at - begin)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(got.astype(np.int64))], names=["position", "token_id"])


def random_access(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """``(position, token_id)`` for ``positions(position)`` counted over the whole store;
    repeats are answered once, positions outside it and nulls not at all. Positions are
    matched to segments by 2**16-id pages, so neither side is broadcast."""
    page = 1 << 16
    bases = F.broadcast(_bases(spark, path))
    meta = spark.read.schema(_STORED).parquet(path).select("part", "number", "first", "n_ids").join(bases, "part")
    meta = meta.select("part", "number", (F.col("base") + F.col("first")).alias("begin"), (F.col("base") + F.col("first") + F.col("n_ids")).alias("end"))
    pages = meta.where("end > begin").withColumn("page", F.explode(F.sequence(F.floor(F.col("begin") / page), F.floor((F.col("end") - 1) / page))))
    asked = positions.select(F.col("position").cast("long").alias("position")).distinct().withColumn("page", F.floor(F.col("position") / page))
    hits = asked.join(pages, "page").where("position >= begin and position < end")
    grouped = hits.groupBy("part", "number", "begin", "page").agg(F.collect_list("position").alias("at"))  # at most 2**16 a group
    images = spark.read.schema(_STORED).parquet(path).select("part", "number", "image")
    return grouped.join(images, ["part", "number"]).select("at", "begin", "image").mapInArrow(tidy(_lookup), "position long, token_id long")
