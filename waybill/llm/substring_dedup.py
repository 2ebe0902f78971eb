"""Removes word windows that occur more than once: Rabin-Karp hashes of token windows, counted in Spark."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waybill.llm import repeats as R
from waybill.llm.text import WORDS, blocks, mixed, words

#: Words of the runs that anchor windows. Shorter ones recur by chance, longer ones leave fewer places to choose from.
_GRAM = 8


def _stretches(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in blocks(batch.column("text")):
                found = words(data, offsets)
                sums = WORDS.prefixes(found.hashes(data))
                yield R.batch_of(batch, first, R.stretches(sums, found.offsets, window, min(_GRAM, window), WORDS))

    return run


def _window_hashes(window: int):
    """The Rabin-Karp hash of every window of the open stretches, with where it is if it may need a verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.once(batches):
            for k, (start, n, alone) in enumerate(R.spans_of(batch.column("spans"), "start", "n", "alone")):
                row = batch.slice(k, 1)
                for _, data, offsets in blocks(row.column("text")):
                    hashes = mixed(WORDS.windows(WORDS.prefixes(words(data, offsets).hashes(data)), window))
                at = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                take = pa.array(np.zeros(len(at), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(c).take(take) for c in R.KEY), pa.array(at), pa.array(hashes[at].view(np.int64)), pa.array(np.repeat(alone, n))],
                    [*R.KEY, "start", "hash", "alone"],
                )

    return run


def repeated_windows(docs: DataFrame, window: int) -> tuple[DataFrame, R.Found]:
    """KEY, start, end (in words) of runs that repeated windows cover; they may overlap. The tables below stay until clear()."""
    found = R.compare(docs.mapInArrow(_stretches(window), R.STRETCH), window)
    opened = R.by_document(docs, found.open, "inner", "start", "n", "alone")
    hashed = opened.select(*R.KEY, "text", "spans").mapInArrow(_window_hashes(window), "doc_id long, text_hash long, start long, hash long, alone boolean")
    return found.covered.union(R.counted(hashed, window, found.folders, "hash")), found


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = R.spans_of(batch.column("spans"), "start", "end")
        for first, data, offsets in blocks(batch.column("text")):
            found = words(data, offsets)
            n_words, n_removed, text, digest = [], [], [], []
            for d in range(len(offsets) - 1):
                lo, hi = found.offsets[d : d + 2]
                starts, ends = next(spans)
                gone = R.covered_mask(hi - lo, starts, ends)
                kept = lo + np.flatnonzero(~gone)
                n_words.append(hi - lo)
                n_removed.append(gone.sum())
                out = b""
                if len(kept):
                    begin, length = found.starts[kept], found.ends[kept] - found.starts[kept]
                    to = np.concatenate([[0], np.cumsum(length + 1)])
                    # Every kept word and the byte after it; that byte becomes the one space.
                    source = np.repeat(begin - to[:-1], length + 1) + np.arange(to[-1])
                    joined = data[np.minimum(source, len(data) - 1)]
                    joined[to[1:] - 1] = 0x20
                    out = joined[:-1].tobytes()
                text.append(out.decode())
                digest.append(hashlib.sha256(out).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, len(text)), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(text, pa.string()), pa.array(digest, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )


def remove(docs: DataFrame, window: int = 35) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text, kept_sha256.

    A word goes if a window of `window` words covers it whose words also start anywhere else in the table, in the same document or in another; overlaps
    count, and windows are judged on the input. Words are runs without ASCII white space; what stays is joined by single spaces.

    A null or empty text has no words and keeps an empty text; a text of fewer words than a window loses none; a repeated row counts as one more
    document, so a long enough text that is there twice goes whole; null and repeated ids are fine; other columns are ignored; an empty table gives no rows.
    The result reads tables in the shared folder that stay until the session's folder is cleared.
    """
    docs = R.keyed(docs)
    spans, _ = repeated_windows(docs, window)
    merged = R.by_document(docs, R.widest(spans), "left", "start", "end")
    return merged.select("doc_id", "text", "spans").mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
