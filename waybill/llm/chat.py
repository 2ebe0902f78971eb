"""Formats conversations by columnar byte assembly, and reads them back.

A turn is `### <role>: <text> </turn>` and a line feed. Inside, a backslash goes before every backslash, before each `###` and each `</turn>`, and in a role before
each colon too; so what is read after a backslash is always itself, and the marks that stand without one are the template's.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waybill.llm.text import raw

_OPEN, _MIDDLE, _CLOSE = b"### ", b": ", b" </turn>\n"
_SLASH = 0x5C
#: Bytes of turns that are put together at once.
_TOGETHER = 1 << 20
#: What a backslash goes before, wherever it begins in a role or text.
_CONTROL = (b"\\", b"###", b"</turn>")
_TURN = re.compile(rb"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(rb"\\(.)", re.DOTALL)


def _begins(data: np.ndarray, offsets: np.ndarray, mark: bytes) -> np.ndarray:
    """Where the mark begins, within a row."""
    at = np.flatnonzero(data[: max(0, len(data) - len(mark) + 1)] == mark[0])
    for k, b in enumerate(mark[1:], 1):
        at = at[data[at + k] == b]
    row = np.searchsorted(offsets, at, "right") - 1
    return at[at + len(mark) <= offsets[row + 1]]


def _escapes(data: np.ndarray, offsets: np.ndarray, marks: tuple[bytes, ...]) -> np.ndarray:
    return np.unique(np.concatenate([_begins(data, offsets, m) for m in marks]))


def _scatter(out: np.ndarray, data: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, to: np.ndarray) -> None:
    """Copies every row to its place, moved on by the backslashes before it."""
    row = np.repeat(np.arange(len(to)), np.diff(offsets))
    steps = np.zeros(len(data), np.int64)
    steps[escapes] = 1
    before = np.concatenate([[0], np.cumsum(steps)])
    place = to[row] + np.arange(len(data)) - offsets[row] + before[1:] - before[offsets[row]]
    out[place] = data
    out[place[escapes] - 1] = _SLASH


def _constant(out: np.ndarray, mark: bytes, to: np.ndarray) -> None:
    out[to[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns in order; where each turn begins (and the last one ends), and where its escaped text begins and ends."""
    parts = []
    for column, marks in ((roles, (*_CONTROL, b":")), (texts, _CONTROL)):
        data, offsets = raw(column)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        escapes = _escapes(data, offsets, marks)
        added = np.bincount(np.searchsorted(offsets, escapes, "right") - 1, minlength=len(column))
        parts.append((data, offsets, escapes, np.diff(offsets) + added))
    role_length, text_length = parts[0][3], parts[1][3]
    begins = np.concatenate([[0], np.cumsum(len(_OPEN) + role_length + len(_MIDDLE) + text_length + len(_CLOSE))])
    role_at = begins[:-1] + len(_OPEN)
    text_at = role_at + role_length + len(_MIDDLE)
    out = np.empty(begins[-1], np.uint8)
    _constant(out, _OPEN, begins[:-1])
    _constant(out, _MIDDLE, role_at + role_length)
    _constant(out, _CLOSE, text_at + text_length)
    _scatter(out, *parts[0][:3], role_at)
    _scatter(out, *parts[1][:3], text_at)
    return out, begins, text_at, text_at + text_length


def _formatted(loss_role: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = None, 0  # the conversation at hand and its number of parts so far
        for batch in batches:
            sizes = np.diff(raw(batch.column("text"))[1]) + np.diff(raw(batch.column("role"))[1]) + 32
            ends = np.cumsum(sizes)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _TOGETHER, "right")))
                rows = batch.slice(lo, hi - lo)
                data, begins, text_at, text_end = assemble(rows.column("role"), rows.column("text"))
                ids = rows.column("conv_id").to_pylist()
                first = [k for k in range(len(ids)) if k == 0 or ids[k] != ids[k - 1]]
                bounds = np.array([*first, len(ids)])
                number = []
                for k in first:
                    part = part + 1 if (ids[k],) == last else 0
                    last = (ids[k],)
                    number.append(part)
                offsets = begins[bounds]
                counted = np.array([r == loss_role for r in rows.column("role").to_pylist()])
                spans = [
                    [{"start": int(text_at[k] - offsets[j]), "end": int(text_end[k] - offsets[j])} for k in range(bounds[j], bounds[j + 1]) if counted[k]] for j in range(len(first))
                ]
                text = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[k] for k in first], pa.int64()), pa.array(number, pa.int64()), text, pa.array(np.diff(bounds), pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    ["conv_id", "part", "formatted", "n_turns", "loss"],
                )
                lo = hi

    return run


def format_chats(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Formatted conversations: conv_id, part, formatted, n_turns, loss (byte ranges of the texts whose role is `loss_role`).

    Rows are ordered by turn, equal turns by role and text. A conversation is one row, or several parts to be put together in order if it goes on beyond some
    megabytes or a batch; so no buffer grows with a conversation. Parts of one conversation follow each other within a partition.

    A null text or role is empty (an empty role has no loss unless asked for); null turns go first; rows without conv_id are one conversation;
    repeated rows are turns of their own; other columns are ignored; an empty table gives no rows.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    schema = "conv_id long, part long, formatted string, n_turns long, loss array<struct<start:long,end:long>>"
    return ordered.mapInArrow(_formatted(loss_role), schema)


def _plain(escaped: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", escaped)


def read_turns(formatted: bytes) -> list[tuple[str, str]]:
    """(role, text) of every turn; an error if anything stands between or beside turns."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at byte {at}")
        out.append((_plain(m[1]).decode(), _plain(m[2][:-1]).decode()))
        at = m.end()
    return out


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _DIGESTS.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in _DIGESTS.split(", ")]
    held, turns, loss, counts = None, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
    for batch in batches:
        done = []
        for conv, text, spans in zip(batch.column("conv_id").to_pylist(), batch.column("formatted"), batch.column("loss").to_pylist()):
            if held != (conv,):
                if held:
                    done.append((held[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
                held, turns, loss, counts = (conv,), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            whole = text.as_py()
            data = whole.encode()
            for role, said in read_turns(data):
                turns.update(f"{role}\n{said}\n".encode())
                counts[0] += 1
            for s in spans:
                under = _plain(data[s["start"] : s["end"]])
                loss.update(under)
                counts[1] += len(under.decode())
            counts[2] += len(whole)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else [()] * len(types), types)], names)
    if held:
        row = (held[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2])
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation of what `format_chats` made, read back: counts and digests of turns and of the text under the loss mask.

    Reads each partition in order, so it has to follow `format_chats` without a shuffle between.
    """
    return formatted.mapInArrow(_digested, _DIGESTS)
