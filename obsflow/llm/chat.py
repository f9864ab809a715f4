"""Chat formatting by columnar byte assembly, with a loss mask over assistant texts.

Every turn is ``head text tail``:

    system     <<SYS>> ... <</SYS>>
    user       [INST] ... [/INST]
    assistant  <s> ... </s>
    any other  <|role|>NAME<|text|> ... <|end|>

Inside texts and names, each ``<``, ``[`` and backslash is followed by an inserted
backslash. So no control string can occur there, and deleting the byte after each of the
three restores the original.

A task assembles a batch of turns at once: segment lengths, their cumulative offsets and
scatter indices are computed in numpy, and heads, escaped bytes and tails are copied into
one preallocated buffer that becomes the Arrow column as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.arrow import prepare

HEADS = {"system": b"<<SYS>>", "user": b"[INST]", "assistant": b"<s>"}
TAILS = {"system": b"<</SYS>>", "user": b"[/INST]", "assistant": b"</s>"}
NAME_HEAD, NAME_TAIL, OTHER_TAIL = b"<|role|>", b"<|text|>", b"<|end|>"
_ROLES = list(HEADS)
_MARKED = np.zeros(256, bool)
_MARKED[[ord("<"), ord("["), ord("\\")]] = True
_TURN = re.compile(r"(?:(<<SYS>>)|(\[INST\])|(<s>)|<\|role\|>(.*?)<\|text\|>)(.*?)(?:<</SYS>>|\[/INST\]|</s>|<\|end\|>)", re.DOTALL)
_ESCAPED = re.compile(r"([<\[\\])\\")

FORMATTED = "conv_id long, n_turns long, formatted string, loss_start array<long>, loss_length array<long>"


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("stray text between turns")
        at = m.end()
        role = next((r for r, g in zip(_ROLES, m.group(1, 2, 3), strict=True) if g), None)
        out.append((unescape(m.group(4)) if role is None else role, unescape(m.group(5))))
    if at != len(formatted):
        raise ValueError("stray text after the last turn")
    return out


def _escaped(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column with the inserted backslashes."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]] if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    marked = _MARKED[data]
    before = np.concatenate([[0], np.cumsum(marked)])
    out = np.full(len(data) + int(before[-1]), ord("\\"), np.uint8)
    out[np.arange(len(data)) + before[:-1]] = data
    return out, off + before[off]


def _table(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def _scatter(out: np.ndarray, at: np.ndarray, source: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
    """Copy source[begin : begin + size] to out[at :] for all segments together."""
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + inner] = source[np.repeat(begin, size) + inner]


def _assemble(turns: pa.Table) -> pa.RecordBatch:
    """One row for each conversation of whole, ordered conversations."""
    conv = turns.column("conv_id").to_numpy()
    role = pc.fill_null(turns.column("role").combine_chunks(), "")
    kind = pc.fill_null(pc.index_in(role, pa.array(_ROLES)), len(_ROLES)).to_numpy(zero_copy_only=False).astype(np.int64)
    other = kind == len(_ROLES)
    text, text_off = _escaped(turns.column("text").combine_chunks())
    name, name_off = _escaped(pc.if_else(pa.array(other), role, ""))
    heads, head_off = _table([*HEADS.values(), NAME_HEAD])
    tails, tail_off = _table([*TAILS.values(), OTHER_TAIL])
    middle = np.frombuffer(NAME_TAIL, np.uint8)
    size = np.stack([np.diff(head_off)[kind], np.diff(name_off), np.where(other, len(middle), 0), np.diff(text_off), np.diff(tail_off)[kind]], axis=1)
    at = np.concatenate([[0], np.cumsum(size.ravel())])
    out = np.empty(int(at[-1]), np.uint8)
    begin = at[:-1].reshape(size.shape)
    zero = np.zeros(len(conv), np.int64)
    for k, (source, first) in enumerate(((heads, head_off[kind]), (name, name_off[:-1]), (middle, zero), (text, text_off[:-1]), (tails, tail_off[kind]))):
        _scatter(out, begin[:, k], source, first, size[:, k])
    new = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    n_turns = np.diff(np.r_[new, len(conv)])
    edge = np.r_[begin[new, 0], len(out)]
    chars = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    loss = kind == _ROLES.index("assistant")
    start = chars[begin[:, 3]] - chars[np.repeat(edge[:-1], n_turns)]
    length = chars[begin[:, 3] + size[:, 3]] - chars[begin[:, 3]]
    cut = np.concatenate([[0], np.cumsum(loss)])[np.r_[new, len(conv)]].astype(np.int32)
    formatted = pa.Array.from_buffers(pa.large_string(), len(new), [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(conv[new]), pa.array(n_turns), formatted, pa.ListArray.from_arrays(pa.array(cut), pa.array(start[loss])), pa.ListArray.from_arrays(pa.array(cut), pa.array(length[loss]))],
        names=["conv_id", "n_turns", "formatted", "loss_start", "loss_length"],
    )


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and held[-1].column("conv_id")[-1].as_py() == batch.column("conv_id")[-1].as_py():
            held.append(batch)  # the open conversation fills this batch to its end
            continue
        table = pa.Table.from_batches([*held, batch])
        conv = table.column("conv_id").to_numpy()
        cut = int(np.searchsorted(conv, conv[-1]))
        if cut:
            yield _assemble(table.slice(0, cut).combine_chunks())
        held = table.slice(cut).to_batches()
    if held:
        yield _assemble(pa.Table.from_batches(held).combine_chunks())


def format_conversations(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, formatted, loss_start, loss_length)``, one row a conversation; the
    loss spans are code points of ``formatted``, one for each assistant turn.

    Reads ``conv_id, turn, role, text`` only. Turns are ordered by ``turn`` (null first),
    ties by role, then text; repeated rows are turns of their own. A null role is an empty
    name, a null text empty. Rows without a conversation id belong to none and are left
    out. An empty table gives an empty result. A conversation is one output row, so it
    must fit into a task.
    """
    prepare(spark)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    dealt = rows.where("conv_id is not null").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = []
        for conv, formatted, starts, lengths in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_length")), strict=True):
            turns = parse(formatted)
            loss = "".join(unescape(formatted[a : a + n]) for a, n in zip(starts, lengths, strict=True))
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            rows.append([conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)])
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digest(spark: SparkSession, formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations back and digest their turns and the text under the loss mask."""
    prepare(spark)
    return formatted.select("conv_id", "formatted", "loss_start", "loss_length").mapInArrow(
        _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
