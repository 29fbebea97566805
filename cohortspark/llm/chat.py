"""Chat formatting by columnar byte assembly.

A turn is written as ``### role: text</turn>`` and a line end.  In roles and texts a backslash
precedes every backslash, ``#`` and ``<`` (in roles also ``:``), so no text can contain a header
or an end mark, and dropping the backslashes restores it.  A batch's turns are written at once:
segment lengths (header, role, separator, text, end) give cumulative offsets, the offsets give
the target index of every byte, and one scatter per segment kind fills one preallocated buffer,
which becomes the data buffer of the Arrow string column.

Rows are shuffled by conversation and sorted by turn; a conversation that runs over several
batches is gathered as finished byte blocks.  Its output is one row, so its size is bounded by
what one string can hold.

Cases: null or empty text is an empty turn; a null role is an empty role; null turns come first,
equal turns are ordered by role and text, and repeated rows are repeated turns; rows with a null
conv_id form one conversation; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnp import text_chunks

HEAD, SEPARATOR, END = (np.frombuffer(x, np.uint8) for x in (b"### ", b": ", b"</turn>\n"))
ESCAPE = 92
TRAINED_ROLE = b"assistant"
FORMATTED = "conv_id long, n_turns long, formatted string, loss_start array<long>, loss_bytes array<long>"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def _escape(data: np.ndarray, offs: np.ndarray, marks: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a backslash before every byte of ``marks``, and their new offsets."""
    hit = np.isin(data, np.frombuffer(marks, np.uint8))
    if not hit.any():
        return data, offs
    before = np.concatenate([[0], np.cumsum(hit)])
    out = np.full(len(data) + int(before[-1]), ESCAPE, np.uint8)
    out[np.arange(len(data)) + before[1:]] = data
    return out, offs + before[offs]


def _scatter(buf: np.ndarray, at: np.ndarray, data: np.ndarray, offs: np.ndarray) -> None:
    """Writes text k of (data, offs) to buf[at[k]:]."""
    buf[np.repeat(at - offs[:-1], np.diff(offs)) + np.arange(len(data))] = data


def assemble(roles: tuple, texts: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, offsets of the turns, offset of each turn's text, length of it)."""
    role, role_at = _escape(*roles, b"\\#<:")
    text, text_at = _escape(*texts, b"\\#<")
    n = len(role_at) - 1
    lens = np.stack([np.full(n, len(HEAD)), np.diff(role_at), np.full(n, len(SEPARATOR)), np.diff(text_at),
                     np.full(n, len(END))], axis=1)
    to = np.concatenate([[0], np.cumsum(lens)])
    buf = np.empty(int(to[-1]), np.uint8)
    at = to[:-1].reshape(n, 5)
    for k, fixed in ((0, HEAD), (2, SEPARATOR), (4, END)):
        buf[at[:, k, None] + np.arange(len(fixed))] = fixed
    _scatter(buf, at[:, 1], role, role_at)
    _scatter(buf, at[:, 3], text, text_at)
    return buf, np.append(at[:, 0], len(buf)), at[:, 3], lens[:, 3]


def _rows(ids, counts, data: pa.Buffer, offsets, starts, sizes, spans) -> pa.RecordBatch:
    n = len(ids)
    lists = pa.array(np.asarray(spans, np.int32))
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(counts, pa.int64()),
        pa.StringArray.from_buffers(n, pa.py_buffer(np.asarray(offsets, np.int32)), data),
        pa.ListArray.from_arrays(lists, pa.array(starts, pa.int64())),
        pa.ListArray.from_arrays(lists, pa.array(sizes, pa.int64()))],
        names=["conv_id", "n_turns", "formatted", "loss_start", "loss_bytes"])


class _Open:
    """The conversation at the end of what has been read: blocks of bytes and its loss spans."""

    def __init__(self, conv_id):
        self.id, self.turns, self.blocks, self.size = conv_id, 0, [], 0
        self.starts, self.sizes = [], []

    def add(self, turns, block, starts, sizes) -> None:
        self.turns += turns
        self.starts.append(starts + self.size)
        self.sizes.append(sizes)
        self.blocks.append(block.tobytes())
        self.size += len(block)

    def row(self) -> pa.RecordBatch:
        starts = np.concatenate(self.starts)
        return _rows([self.id], [self.turns], pa.py_buffer(b"".join(self.blocks)), [0, self.size],
                     starts, np.concatenate(self.sizes), [0, len(starts)])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: _Open | None = None
    for batch in batches:
        for lo, hi, data, offs in text_chunks(batch.column(2)):
            ids = batch.column(0).slice(lo, hi - lo).to_pylist()
            role_col = batch.column(1).slice(lo, hi - lo)
            _, _, role, role_at = next(text_chunks(role_col, 1 << 62))
            buf, turn_at, text_at, text_len = assemble((role, role_at), (data, offs))
            trained = np.array([r == "assistant" for r in role_col.to_pylist()], bool)
            cuts = [0] + [k for k in range(1, len(ids)) if ids[k] != ids[k - 1]] + [len(ids)]
            done = []
            for a, b in zip(cuts, cuts[1:]):
                inner = a > 0 and b < len(ids)  # begins and ends in this chunk
                if inner:
                    done.append((a, b))
                    continue
                if last is not None and (a > 0 or last.id != ids[a]):
                    yield last.row()
                    last = None
                last = last or _Open(ids[a])
                own = np.flatnonzero(trained[a:b]) + a
                last.add(b - a, buf[turn_at[a]:turn_at[b]], text_at[own] - turn_at[a], text_len[own])
            if done:
                first, end = done[0][0], done[-1][1]
                heads = np.array([a for a, _ in done] + [end])
                own = np.flatnonzero(trained[first:end]) + first
                conv = np.searchsorted(heads, own, side="right") - 1
                yield _rows([ids[a] for a, _ in done], np.diff(heads),
                            pa.py_buffer(buf[turn_at[first]:turn_at[end]].tobytes()), turn_at[heads] - turn_at[first],
                            text_at[own] - turn_at[heads[conv]], text_len[own],
                            np.searchsorted(own, heads))
    if last is not None:
        yield last.row()


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, and the loss mask as UTF-8 byte
    spans of the assistant texts (loss_start, loss_bytes)."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED)


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    at = 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        yield ESCAPED.sub(r"\1", m[1]), ESCAPED.sub(r"\1", m[2])
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv_id, _, text, starts, sizes in zip(*(c.to_pylist() for c in batch.columns)):
            turns, n = hashlib.sha256(), 0
            for role, said in read_back(text):
                turns.update(f"{role}\n{said}\n".encode())
                n += 1
            raw, loss, chars = text.encode(), hashlib.sha256(), 0
            for a, size in zip(starts, sizes):
                said = ESCAPED.sub(r"\1", raw[a:a + size].decode())
                loss.update(said.encode())
                chars += len(said)
            out.append((conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), len(text)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*out)) if out else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=[x.split()[0] for x in DIGEST.split(", ")])


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what can be read back from formatted conversations."""
    return formatted.mapInArrow(_digest, DIGEST)
