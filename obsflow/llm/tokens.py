"""Whole-column encoding with a word-level BPE of the ``tokenizers`` library.

The file's own rules drop white space and never merge across it, nor across the border
between a letter or digit and an ASCII sign other than ``'`` (contractions) and ``<|>``
(special tokens). So a text is cut at these borders,
each distinct unit of a slice is encoded once by the library, and a text's ids are the
concatenation of its units' ids. Encoded units stay in a cache of ``CACHE_BYTES`` until the task ends.
Units of ASCII and Latin-1 letters alone are lower-cased first, as the file's normaliser does;
others are left as they are, since it composes marks before it lower-cases (``T`` and U+0308
stay two characters, ``t`` and U+0308 become one), and so are units with a ``|``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa

from obsflow.llm.textops import LOWER, NOT_BLANK, span_hash, text_slices

CACHE_BYTES = 24 << 20
TEXT_BYTES = 3 << 20
_JOIN = 100

_ALNUM = np.zeros(256, bool)
_ALNUM[ord("0") : ord("9") + 1] = _ALNUM[ord("a") : ord("z") + 1] = _ALNUM[ord("A") : ord("Z") + 1] = True
_STOP = np.zeros(256, bool)
_STOP[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = True
_LATIN = np.zeros(256, bool)  # second bytes of U+00C0 to U+00FF, all letters but two signs
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False

_SMALL = np.zeros(256, bool)
_SMALL[ord("a") : ord("z") + 1] = True
_SMALL_LATIN = np.zeros(256, bool)  # second bytes of U+00DF to U+00FF, lower-case letters but one sign
_SMALL_LATIN[0x9F:0xC0] = True
_SMALL_LATIN[0xB7] = False


def _plain(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which spans are made of the letters a-z, ß-ö and ø-ÿ."""
    found = np.append(_SMALL[data], False)
    lead = np.flatnonzero((data[:-1] == 0xC3) & _SMALL_LATIN[data[1:]])
    found[lead] = found[lead + 1] = True
    whole = np.logical_and.reduceat(found, np.stack([start, end], axis=1).ravel())[::2]
    return whole & (data[start] & 0xC0 != 0x80) & (data[end - 1] != 0xC3)  # no letter begins or ends outside


def _lowered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``data`` with the units at ``start`` to ``end`` in lower case, where that is safe."""
    low = LOWER[data]
    if low.max(initial=0) >= 0x80:
        lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] & 0xC0 == 0x80))
        second = data[lead + 1]
        low[lead + 1] = second + 0x20 * ((second < 0x9F) & (second != 0x97))
        odd = data >= 0x80
        odd[lead] = odd[lead + 1] = False
        odd |= data == ord("|")
    else:
        odd = data == ord("|")
    if odd.any():
        units = np.logical_or.reduceat(np.append(odd, False), np.stack([start, end], axis=1).ravel())[::2]
        step = np.zeros(len(data) + 1, np.int8)
        step[start[units]] = 1
        step[end[units]] -= 1
        low = np.where(np.cumsum(step[:-1], dtype=np.int8) > 0, data, low)
    return low


def _units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, unit offsets per text)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(off), np.int64)
    inside = NOT_BLANK[data]
    alnum, stop = _ALNUM[data], _STOP[data]
    letter_end = alnum.copy()
    letter_end[1:] |= (data[:-1] == 0xC3) & _LATIN[data[1:]]
    first = off[off < n]  # a text's first byte ends no letter of the text before
    letter_end[first] = alnum[first]
    border = np.zeros(n + 1, bool)
    border[1:-1] = (inside[1:] != inside[:-1]) | (letter_end[:-1] & stop[1:]) | (stop[:-1] & alnum[1:])
    border[off] = True
    border[0] = border[n] = True
    cut = np.flatnonzero(border)
    start, end = cut[:-1], cut[1:]
    real = inside[start]
    start, end = start[real], end[real]
    return start, end, np.searchsorted(start, off)


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, where each one is, its number for each of ``h``), by hashing."""
    found = pa.array(h).dictionary_encode()
    each = found.indices.to_numpy()
    where = np.empty(len(found.dictionary), np.int64)
    where[each] = np.arange(len(h))
    return found.dictionary.to_numpy(), where, each


class UnitTokenizer:
    """Ids of whole texts; one instance a worker process and file."""

    _open: dict[str, UnitTokenizer] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        # the same merges without normaliser and pattern, for units that both leave as they are
        self.merges = Tokenizer(self.model.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.model.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocab.values(), default=0) + 1, bool)
        for token, i in vocab.items():
            self.closes[i] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.at = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)

    @classmethod
    @contextmanager
    def for_task(cls, path: str) -> Iterator[UnitTokenizer]:
        """The worker's instance; what it has cached goes when the task is done."""
        tokenizer = cls.of(path)
        try:
            yield tokenizer
        finally:
            tokenizer._forget()

    @classmethod
    def of(cls, path: str) -> UnitTokenizer:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _encode_units(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(units in the order they were encoded, ids of each, all ids). Units of lower-case
        Latin letters alone become one pretoken each, so they are encoded many to a text and
        told apart by the closing mark of their last id, all at once."""
        plain = _plain(data, start, end)
        raw = data.tobytes()
        units, rest = np.flatnonzero(plain), np.flatnonzero(~plain).tolist()
        words = [raw[a:b] for a, b in zip(start[units].tolist(), end[units].tolist(), strict=True)]
        texts = [b" ".join(words[i : i + _JOIN]).decode() for i in range(0, len(words), _JOIN)]
        order: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        for k, encoded in enumerate(self.merges.encode_batch_fast(texts, add_special_tokens=False)):
            chunk = units[k * _JOIN : (k + 1) * _JOIN]
            got = np.array(encoded.ids, np.uint32)
            last = np.flatnonzero(self.closes[got]) + 1
            if len(last) == len(chunk) and last[-1] == len(got):
                order.append(chunk)
                sizes.append(np.diff(last, prepend=0))
                ids.append(got)
            else:
                rest += chunk.tolist()
        singly = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[rest].tolist(), end[rest].tolist(), strict=True)]
        for encoded in self.model.encode_batch_fast(singly, add_special_tokens=False):
            ids.append(np.array(encoded.ids, np.uint32))
            sizes.append(np.array([len(ids[-1])]))
        return np.concatenate([*order, np.array(rest, np.int64)]), np.concatenate(sizes), np.concatenate(ids)

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The new units' cache slots."""
        order, size, ids = self._encode_units(data, start, end)
        slot = np.empty(len(keys), np.int64)
        slot[order] = len(self.at) - 1 + np.arange(len(keys))
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(size)])
        self.pool = np.concatenate([self.pool, ids])
        merged = np.concatenate([self.keys, keys])
        order = np.argsort(merged, kind="stable")
        self.keys, self.slot = merged[order], np.concatenate([self.slot, slot])[order]
        return slot

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Cache slots of keys, -1 where unknown."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slot[at], -1)

    def encode(self, column: pa.Array, end_id: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row + 1, ids, offsets per text): each text's ids and ``end_id``."""
        for first, last, data, off in text_slices(column, TEXT_BYTES):
            start, end, unit_off = _units(data, off)
            low = _lowered(data, start, end)
            keys, where, each = _distinct(span_hash(low, start, end))
            if 24 * (len(self.keys) + len(keys)) + self.pool.nbytes > CACHE_BYTES:
                self._forget()
            slot = self._slots(keys)
            new = np.flatnonzero(slot < 0)
            if len(new):
                slot[new] = self._learn(low, start[where[new]], end[where[new]], keys[new])
            slot = slot[each]
            size = self.at[slot + 1] - self.at[slot]
            unit_at = np.concatenate([[0], np.cumsum(size)])
            n = last - first
            text_end = unit_at[unit_off[1:]] + np.arange(n)  # where each text's end id goes
            total = int(unit_at[-1]) + n
            ids = np.empty(total, np.uint32)
            body = np.ones(total, bool)
            body[text_end] = False
            ids[body] = self.pool[np.repeat(self.at[slot] - unit_at[:-1], size) + np.arange(unit_at[-1])]
            ids[text_end] = end_id
            yield first, last, ids, np.concatenate([[0], text_end + 1])


def ids_array(ids: np.ndarray, off: np.ndarray) -> pa.Array:
    """A binary column of little-endian unsigned 32-bit ids, cut at ``off``."""
    buffers = [None, pa.py_buffer((off * 4).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))]
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, buffers)
