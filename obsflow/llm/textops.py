"""Whole-column text helpers shared by the operators of this subpackage.

Everything works on the raw UTF-8 bytes of an Arrow string column with numpy, a slice of
at most ``SLICE_BYTES`` at a time (one longer text makes a slice of its own), so the
memory of a task is bounded by the longest text, not by the size of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)
_S32 = np.uint64(32)
_S29 = np.uint64(29)

#: ASCII A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Word bytes of `[^\x20\x09-\x0D]+`.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (digits, a-z after lowering, every non-ASCII byte).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive slices; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, "right")) - 1)
        yield first, last, data[off[first] : off[last]], off[first : last + 1] - off[first]
        first = last


def words(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word offsets per text) of the maximal runs of word bytes; no run crosses texts."""
    inside = table[data]
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(off), np.int64)
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    tail = inside.copy()
    tail[:-1] &= ~inside[1:]
    edge = off[(off > 0) & (off < len(data))]
    head[edge] = inside[edge]
    tail[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return start, end, np.searchsorted(start, off)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler."""
    h = h * _M1
    h ^= h >> _S32
    h *= _M2
    h ^= h >> _S29
    return h


_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: eight bytes at a time over all spans together."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    h = mix((end - start).astype(np.uint64) + _M2)
    at, left = start, end - start
    live = np.flatnonzero(left > 0)
    while len(live):
        take = np.minimum(left[live], 8)
        h[live] = mix(h[live] ^ (lanes[at[live]] & _KEEP[take]))
        at, left = at + 8, left - 8
        live = live[left[live] > 0]
    return h


def shingles(h: np.ndarray, word_off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per text) of all k-word shingles; a text of fewer words, but not
    none, gives its whole sequence as one."""
    n = np.diff(word_off)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    off = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(word_off[:-1], count) + (np.arange(off[-1]) - np.repeat(off[:-1], count))
    size = np.repeat(np.minimum(n, k), count)
    out = mix(size.astype(np.uint64) + _M1)
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    for j in range(k):
        step = mix(out + padded[first + j])
        out = np.where(j < size, step, out)
    return out, off
