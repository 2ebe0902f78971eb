"""Removes byte strings that occur more than once, by sorting suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waybill.llm import repeats as R
from waybill.llm.suffix_sort import Suffixes
from waybill.llm.text import BYTES, SYMBOLS, WORDS, blocks, mixed, raw
from waybill.storage import as_table, new_folder

#: Bytes of the runs that anchor strings.
_GRAM = 48
#: Strings whose distances from their anchor differ by less than this are sorted together.
_SLICE = 32
#: The same for strings of hot anchors, whose slices are counted whole before their strings are.
_BLOCK = 16
#: Bytes of slices that one sort takes at least, if there are more.
_SORT = 1 << 21
_SLICES = "doc_id long, text_hash long, start long, n int, first int, part binary, core long, alone boolean"


def _stretches(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in blocks(batch.column("text")):
                yield R.batch_of(batch, first, R.stretches(SYMBOLS.prefixes(BYTES[data]), offsets, length, min(_GRAM, length), SYMBOLS))

    return run


def _cut(data: np.ndarray, start: np.ndarray, n: np.ndarray, off: np.ndarray, length: int, width: int) -> R.Stretches:
    """A document's stretches cut by distance from the anchor; the slices' anchor is their core. All strings of a slice hold its core, so equal strings are in slices with one core."""
    sums = SYMBOLS.prefixes(BYTES[data])
    start, n, off = (x.astype(np.int64) for x in (start, n, off))
    anchor = start + off
    highest, lowest = off // width, (off - n + 1) // width
    many = highest - lowest + 1
    which = np.repeat(np.arange(len(start)), many)
    number = np.repeat(highest, many) - (np.arange(len(which)) - np.repeat(np.concatenate([[0], np.cumsum(many)[:-1]]), many))
    lo = np.maximum(start[which], anchor[which] - number * width - width + 1)
    hi = np.minimum(start[which] + n[which] - 1, anchor[which] - number * width)
    core = anchor[which] - number * width
    key = mixed(SYMBOLS.runs(sums, core, core + length - width + 1) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    whole = mixed(mixed(SYMBOLS.runs(sums, lo, hi + length)) + ((hi - lo + 1) * 1_000_003 + core - lo).astype(np.uint64))
    return R.Stretches(which, lo, hi - lo + 1, core - lo, key, whole)


def _slices(length: int):
    """Open stretches cut by distance from the anchor, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.once(batches):
            for k, (start, n, off, alone) in enumerate(R.spans_of(batch.column("spans"), "start", "n", "off", "alone")):
                row = batch.slice(k, 1)
                data, offsets = raw(row.column("text"))
                data = data[offsets[0] : offsets[1]]
                cut = _cut(data, start, n, off, length, _SLICE)
                parts = [data[a : a + m + length - 1].tobytes() for a, m in zip(cut.start.tolist(), cut.n.tolist())]
                take = pa.array(np.zeros(len(parts), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(c).take(take) for c in R.KEY), pa.array(cut.start), pa.array(cut.n.astype(np.int32)), pa.array(cut.off.astype(np.int32)),
                     pa.array(parts, pa.binary()), pa.array(cut.anchor.view(np.int64)), pa.array(alone[cut.document])],
                    ["doc_id", "text_hash", "start", "n", "first", "part", "core", "alone"],
                )

    return run


def _hot_slices(length: int):
    """Stretches of hot anchors cut by distance from the anchor, as stretches of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.once(batches):
            for k, spans in enumerate(R.spans_of(batch.column("spans"), "start", "n", "off")):
                row = batch.slice(k, 1)
                data, offsets = raw(row.column("text"))
                cut = _cut(data[offsets[0] : offsets[1]], *spans, length, _BLOCK)
                cut.document = np.zeros(len(cut.n), np.int64)
                yield R.batch_of(row, 0, cut)

    return run


def _strings(length: int):
    """Two hashes of every string of the open slices of hot anchors, which are counted and not sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.once(batches):
            for k, (start, n, alone) in enumerate(R.spans_of(batch.column("spans"), "start", "n", "alone")):
                row = batch.slice(k, 1)
                data, offsets = raw(row.column("text"))
                symbols = BYTES[data[offsets[0] : offsets[1]]]
                at = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                hashes = [mixed(p.windows(p.prefixes(symbols), length))[at].view(np.int64) for p in (SYMBOLS, WORDS)]
                take = pa.array(np.zeros(len(at), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(c).take(take) for c in R.KEY), pa.array(at), *map(pa.array, hashes), pa.array(np.repeat(alone, n))], [*R.KEY, "start", "hash", "check", "alone"]
                )

    return run


def _sorted_spans(length: int):
    """Runs that repeated strings cover, from slices in order of their core."""

    def spans(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        data, offsets = raw(rows.column("part").combine_chunks())
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        n, first, start = (rows.column(c).to_numpy().astype(np.int64) for c in ("n", "first", "start"))
        core, alone = rows.column("core").to_numpy(), rows.column("alone").to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        # Equal strings are as far from their core.
        group = np.unique(core, return_inverse=True)[1][row] * _SLICE + (first[row] - inside)
        found = Suffixes(data, length).repeated(offsets[row] + inside, group) & alone[row]
        new = found & ~(np.concatenate([[False], found[:-1]]) & (inside > 0))
        last = found & ~(np.concatenate([found[1:], [False]]) & np.concatenate([inside[1:] > 0, [False]]))
        a, b = np.flatnonzero(new), np.flatnonzero(last)
        whose = pa.array(row[a])
        return pa.RecordBatch.from_arrays(
            [*(rows.column(c).combine_chunks().take(whose) for c in R.KEY), pa.array(start[row[a]] + inside[a]), pa.array(start[row[b]] + inside[b] + length)], [*R.KEY, "start", "end"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                held.append(part)
                size += int(np.sum(part.column("n").to_numpy())) + length * part.num_rows
                if size < _SORT:
                    continue
                rows = pa.Table.from_batches(held)
                cores = rows.column("core").to_numpy()
                cut = int(np.flatnonzero(cores == cores[-1])[0])  # the last core may go on in the next batch
                if cut:
                    yield spans(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
                size = sum(int(np.sum(h.column("n").to_numpy())) + length * h.num_rows for h in held)
        if held:
            yield spans(pa.Table.from_batches(held))

    return run


def repeated_strings(docs: DataFrame, length: int) -> DataFrame:
    """KEY, start, end (in bytes) of runs that repeated strings cover; they may overlap.

    Suffixes are sorted where an anchor has few different surroundings. Where very many texts share a passage, slices with one core would meet in one place. So stretches
    are cut there into slices of _BLOCK strings, which are compared as stretches are: those inside the passage are repeated as a whole, one row each. Of the others
    each string is on its own, counted by 128 bits of hashes.
    """
    found = R.compare(docs.mapInArrow(_stretches(length), R.STRETCH), length)
    hot = R.by_document(docs, found.open.where("hot"), "inner", "start", "n", "off").select(*R.KEY, "text", "spans")
    hot = as_table(hot, new_folder(docs.sparkSession, "hot"))
    inside = R.compare(hot.mapInArrow(_hot_slices(length), R.STRETCH), length)
    edges = R.by_document(hot.select(*R.KEY, "text"), inside.open, "inner", "start", "n", "alone").select(*R.KEY, "text", "spans")
    frequent = R.counted(edges.mapInArrow(_strings(length), "doc_id long, text_hash long, start long, hash long, check long, alone boolean"), length, found.folders, "hash", "check")
    opened = R.by_document(docs, found.open.where("NOT hot"), "inner", "start", "n", "off", "alone")
    slices = opened.select(*R.KEY, "text", "spans").mapInArrow(_slices(length), _SLICES)
    sorted_ = slices.repartition("core").sortWithinPartitions("core").mapInArrow(_sorted_spans(length), "doc_id long, text_hash long, start long, end long")
    return found.covered.union(inside.covered).union(frequent).union(sorted_)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = R.spans_of(batch.column("spans"), "start", "end")
        for first, data, offsets in blocks(batch.column("text")):
            rows = []
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                starts, ends = next(spans)
                gone = R.covered_mask(hi - lo, starts, ends)
                kept = data[lo:hi][~gone].tobytes()
                rows.append((hi - lo, int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()), kept, hashlib.sha256(kept).hexdigest()))
            n, removed, n_spans, kept, digest = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, len(rows)), *(pa.array(x, pa.int64()) for x in (n, removed, n_spans)), pa.array(kept, pa.binary()), pa.array(digest, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_sha256"],
            )


def remove(docs: DataFrame, length: int = 200) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_bytes, kept_sha256. length: 64 bytes or more.

    A byte of the UTF-8 text goes if a string of `length` bytes covers it that starts anywhere else in the table too, in the same document or in another;
    overlaps count, and strings are judged on the input. n_spans counts the maximal removed runs. A cut may fall inside a character, so what stays is bytes.

    A null or empty text has no bytes; a text shorter than `length` loses none; a repeated row counts as one more document, so a long enough text that is
    there twice goes whole; null and repeated ids are fine; other columns are ignored; an empty table gives no rows.
    The result reads tables in the shared folder that stay until the session's folder is cleared.
    """
    docs = R.keyed(docs)
    merged = R.by_document(docs, R.widest(repeated_strings(docs, length)), "left", "start", "end")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary, kept_sha256 string"
    return merged.select("doc_id", "text", "spans").mapInArrow(_kept, schema)
