"""Finds passages of a benchmark in documents: an FM-index for every shard of documents, searched for the benchmark's windows."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waybill.llm.fm_index import FMIndex
from waybill.llm.repeats import covered_mask
from waybill.llm.text import IN_PLAIN_WORD, LOWER, blocks, words
from waybill.storage import as_table, new_folder

#: Bytes of benchmark text that are searched for at once; a larger benchmark is searched for in as many passes as it takes.
BLOCK_BYTES = 16 << 20
#: Bytes of document text in a shard, which has an index of its own; a longer text is a shard.
SHARD_BYTES = 1 << 20


@dataclass
class Patterns:
    """Distinct windows of a block of a benchmark and the items that have each (`owners` between two `bounds`, numbers in `names`).

    Sent to tasks as the text's symbols (from 1, by place in the vocabulary; 0 fills short items up) and where the windows begin in it.
    """

    vocabulary: np.ndarray
    stream: np.ndarray
    first: np.ndarray
    window: int
    bounds: np.ndarray
    owners: np.ndarray
    names: list[str]

    @functools.cached_property
    def symbols(self) -> np.ndarray:
        """One row a window, right-aligned."""
        if not len(self.first):
            return np.zeros((0, self.window), np.int32)
        return np.lib.stride_tricks.sliding_window_view(self.stream, self.window)[self.first]

    @functools.cached_property
    def lengths(self) -> np.ndarray:
        return np.count_nonzero(self.symbols, axis=1)

    def items(self, patterns: np.ndarray) -> set[str]:
        n = self.bounds[patterns + 1] - self.bounds[patterns]
        at = np.repeat(self.bounds[patterns] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return {self.names[k] for k in np.unique(self.owners[at]).tolist()}


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both a and b are."""
    return np.unique(a.astype(np.int64) * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def _alike(stream: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """For every start a number that is equal for equal windows: numbers of runs of 1, 2, 4, ... symbols, then of two that cover the window."""
    runs, size = np.unique(stream, return_inverse=True)[1], 1
    while 2 * size <= window:
        runs = _paired(runs[: len(runs) - size], runs[size:])
        size *= 2
    return _paired(runs[starts], runs[starts + window - size])


def patterns_of(items: list[tuple[object, str | None]], window: int) -> Patterns:
    """Items without an id or without words have no windows. Arrays only: some forty bytes a word at a time."""
    named = [(str(i), t) for i, t in items if i is not None and t]
    names = sorted({i for i, _ in named})
    number = {i: k for k, i in enumerate(names)}
    hashes, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    if named:
        for _, data, offsets in blocks(pa.array([t for _, t in named], pa.string()), SHARD_BYTES):
            w = words(data, offsets, IN_PLAIN_WORD)
            hashes.append(w.hashes(data, LOWER))
            counts.append(np.diff(w.offsets))
    vocabulary, symbols = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = np.concatenate(counts)
    # Items shorter than a window are filled up in front by a symbol of no word.
    sizes = np.where(counts > 0, np.maximum(counts, window), 0)
    ends = np.cumsum(sizes)
    stream = np.zeros(int(sizes.sum()), np.int32)
    stream[np.repeat(ends - np.cumsum(counts), counts) + np.arange(len(symbols))] = symbols + 1
    windows = np.where(counts > 0, sizes - window + 1, 0)
    starts = np.repeat(ends - sizes - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
    whose = np.repeat(np.array([number[i] for i, _ in named], np.int64), windows)
    if not len(starts):
        return Patterns(vocabulary, stream, starts, window, np.zeros(1, np.int64), np.empty(0, np.int32), names)
    alike = _alike(stream, starts, window)
    of = np.unique(alike * len(names) + whose)
    first = starts[np.unique(alike, return_index=True)[1]]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(of // len(names), minlength=len(first)))])
    return Patterns(vocabulary, stream, first, window, bounds, (of % len(names)).astype(np.int32), names)


def search(hashes: np.ndarray, offsets: np.ndarray, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(first word, pattern) of every occurrence in a shard: hashes of its words, offsets of its documents.

    Words the benchmark doesn't have part the text; runs too short for any window can't hold one and aren't indexed.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(p.first) or not len(hashes):
        return none
    place = np.minimum(np.searchsorted(p.vocabulary, hashes), len(p.vocabulary) - 1)
    known = p.vocabulary[place] == hashes
    first = known.copy()
    first[1:] &= ~known[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = known[begins]
    starts = np.flatnonzero(first)
    run = np.cumsum(first) - 1
    lengths = np.bincount(run[known], minlength=len(starts)) if len(starts) else np.empty(0, np.int64)
    keep = lengths >= p.lengths.min()
    if not keep.any():
        return none
    starts, lengths = starts[keep], lengths[keep]
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    index = FMIndex(place[at] + 1, lengths, len(p.vocabulary))
    lo, hi = index.count(p.symbols, p.lengths)
    hit = np.flatnonzero(lo < hi)
    n = hi[hit] - lo[hit]
    rows = np.repeat(lo[hit] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return at[index.locate(rows)], np.repeat(hit, n)


_FOUND = "spans array<struct<start:long,end:long>>, items array<string>"
_RESULT = f"n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, {_FOUND}"


def _verdicts(column: pa.Array, p: Patterns, spans: pa.Array | None, items: pa.Array | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, set[str]]]:
    """For every row: number of words, starts and ends of occurrences, items; with what earlier passes found."""
    row = 0
    for _, data, offsets in blocks(column, SHARD_BYTES):
        w = words(data, offsets, IN_PLAIN_WORD)
        start, pattern = search(w.hashes(data, LOWER), w.offsets, p)
        order = np.argsort(start, kind="stable")
        start, pattern = start[order], pattern[order]
        parts = np.searchsorted(start, w.offsets)
        for d in range(len(offsets) - 1):
            lo, hi = parts[d : d + 2]
            own = np.unique(pattern[lo:hi])
            a = start[lo:hi] - w.offsets[d]
            b = a + p.lengths[pattern[lo:hi]]
            names = p.items(own)
            if spans is not None:
                earlier = spans[row].as_py()
                a, b = np.append(a, [s["start"] for s in earlier]).astype(np.int64), np.append(b, [s["end"] for s in earlier]).astype(np.int64)
                names |= set(items[row].as_py())
            yield int(w.offsets[d + 1] - w.offsets[d]), a, b, names
            row += 1


def _merged(n: int, a: np.ndarray, b: np.ndarray) -> tuple[int, list[dict[str, int]]]:
    if not len(a):
        return 0, []
    gone = np.concatenate([[False], covered_mask(n, a, b), [False]])
    starts, ends = np.flatnonzero(gone[1:] & ~gone[:-1]), np.flatnonzero(gone[:-1] & ~gone[1:])
    return int((ends - starts).sum()), [{"start": x, "end": y} for x, y in zip(starts.tolist(), ends.tolist())]


def _contaminated(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def _pass(load: Callable[[], Patterns], state: tuple[str, str], kind: str):
    """kind: `more` gives key, spans and items of the rows with hits, `last` the results, `clean` lets clean rows through as they are. state: columns with what earlier passes found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = load()
        for batch in batches:
            spans, items = (batch.column(c) if c in batch.schema.names else None for c in state)
            out = [(n, *_merged(n, a, b), sorted(names)) for n, a, b, names in _verdicts(batch.column("text"), p, spans, items)]
            n, hit, found, names = map(list, zip(*out)) if out else ([], [], [], [])
            own = [c for c in batch.schema.names if c not in state]
            if kind == "clean":
                keep = [not _contaminated(h, k) for h, k in zip(hit, n)]
                yield batch.select(own).filter(pa.array(keep, pa.bool_()))
                continue
            found = pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            listed = pa.array(names, pa.list_(pa.string()))
            if kind == "more":
                hits = pa.RecordBatch.from_arrays([batch.column("key"), found, listed], ["key", "spans", "items"])
                yield hits.filter(pa.array([h > 0 for h in hit], pa.bool_()))
                continue
            digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, hit, [len(x) for x in names])), pa.array(digests, pa.string()),
                 pa.array([_contaminated(h, k) for h, k in zip(hit, n)], pa.bool_()), found, listed],
                ["doc_id", *(c.split()[0] for c in _RESULT.split(", "))],
            )

    return run


def _searched(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, last: str, schema: str) -> DataFrame:
    spark = docs.sparkSession
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(total / block_bytes))
    mark = "_" * (1 + max(len(c) for c in docs.columns))  # longer than any name that is there
    state = (f"{mark}spans", f"{mark}items")
    if passes > 1:
        benchmark = benchmark.select("item_id", "text").distinct()
    key, earlier = F.md5(F.col("text").cast("binary")), []  # what is found depends on the text alone
    for k in range(passes):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) if passes > 1 else benchmark
        # About block_bytes of text, whatever the benchmark's size: a pass is over, its hits written and its patterns given up before the next one begins.
        held = spark.sparkContext.broadcast(patterns_of([(r.item_id, r.text) for r in part.select("item_id", "text").collect()], window))
        load = lambda held=held: held.value
        if k < passes - 1:
            hits = docs.select(key.alias("key"), "text").mapInArrow(_pass(load, state, "more"), f"key string, {_FOUND}")
            once = hits.groupBy("key").agg(F.first("spans").alias("spans"), F.first("items").alias("items"))
            earlier.append(as_table(once, new_folder(spark, "hits")))
            held.destroy()
    if earlier:
        hits = functools.reduce(DataFrame.union, earlier).groupBy("key").agg(*(F.flatten(F.collect_list(c)).alias(n) for c, n in zip(("spans", "items"), state)))
        found = docs.withColumn(f"{mark}key", key).join(hits.withColumnRenamed("key", f"{mark}key"), f"{mark}key", "left")
        docs = found.select(*(f"`{c}`" for c in docs.columns), *(F.coalesce(n, F.array().cast(hits.schema[n].dataType)).alias(n) for n in state))
    return docs.mapInArrow(_pass(load, state, last), schema)


def check(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (of words, merged), items (sorted).

    Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. A window is `window` consecutive words of a benchmark item, or all
    of an item with fewer. Every shard (a run of rows of a task) is indexed on its own and searched for all windows; nothing is shuffled if one pass does.
    Passes are jobs of their own, each over docs; the last one joins what the others found by a hash of the text, which shuffles docs once.
    The tables with that stay in the shared folder until the session's folder is cleared.

    A null or empty text has no words and no hits; an item without id or words has no windows; items with one id count once; repeated rows
    get equal results; other columns are ignored; empty tables are fine (no benchmark: no hits).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _searched(docs, benchmark, window, block_bytes, "last", f"doc_id long, {_RESULT}")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    return _searched(docs, benchmark, window, block_bytes, "clean", docs.schema)
