"""Windows that occur twice in a corpus, found through anchors.

Every window of `length` symbols (bytes, or words) holds an anchor: the run of `gram` symbols with the least hash in it, the leftmost of equals.
Equal windows have equal anchors at equal distances, so windows are only ever compared within an anchor. Windows in a row that share an anchor
form one stretch; a stretch with all its symbols is one 64-bit hash. Stretches are what Spark counts and joins: about one row for half a window of
text, in place of one for each symbol.

* An anchor that occurs once has no repeated window.
* A stretch that occurs twice has nothing but repeated windows.
* The other stretches of an anchor with two different ones are open: their windows are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waybill.llm.text import Polynomial, mixed
from waybill.storage import Folder, as_table, new_folder

#: What tells a document's rows: the id may be null or repeated, so a hash of the text goes with it. Equal rows share their spans.
KEY = ("doc_id", "text_hash")
#: Different stretches of an anchor from which on they are not brought together.
HOT = 1000
STRETCH = "doc_id long, text_hash long, start long, n int, off int, anchor long, whole long"


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


@dataclass
class Stretches:
    """document, first window, windows, anchor's distance from the first window, hash of the anchor, hash of the whole."""

    document: np.ndarray
    start: np.ndarray
    n: np.ndarray
    off: np.ndarray
    anchor: np.ndarray
    whole: np.ndarray


def stretches(prefixes: np.ndarray, offsets: np.ndarray, length: int, gram: int, poly: Polynomial) -> Stretches:
    """Of the documents of a block, from prefix hashes of its symbols. Windows do not cross documents."""
    grams = mixed(poly.windows(prefixes, gram))
    wide = length - gram + 1
    # High bits of the hash, then the place: the least of them is the leftmost least, and equal texts agree on it.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while reach < wide and len(least):
        step = min(reach, wide - reach)
        least = np.minimum(least[: len(least) - step], least[step:]) if len(least) > step else least[:0]
        reach += step
    ends = offsets[1:] - length  # the last window of each document
    n_windows = np.maximum(0, ends - offsets[:-1] + 1)
    keep = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(n_windows)[:-1]]), n_windows) + np.arange(n_windows.sum())
    at = (least[keep] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(at):
        return Stretches(*(np.empty(0, np.int64) for _ in range(4)), *(np.empty(0, np.uint64) for _ in range(2)))
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))  # another document has another anchor
    start, n = keep[new], np.diff(np.append(new, len(at)))
    anchor = at[new]
    document = np.searchsorted(offsets, start, "right") - 1
    off = anchor - start
    whole = poly.runs(prefixes, start, start + n - 1 + length)
    whole = mixed(mixed(whole) + (n * 1_000_003 + off).astype(np.uint64))
    return Stretches(document, start - offsets[document], n, off, grams[anchor], whole)


def batch_of(rows: pa.RecordBatch, first: int, found: Stretches) -> pa.RecordBatch:
    take = pa.array(first + found.document)
    columns = [rows.column("doc_id").take(take), rows.column("text_hash").take(take), found.start.astype(np.int64), found.n.astype(np.int32), found.off.astype(np.int32)]
    columns += [x.view(np.int64) for x in (found.anchor, found.whole)]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["doc_id", "text_hash", "start", "n", "off", "anchor", "whole"])


@dataclass
class Found:
    """covered: KEY, start, end of runs of symbols that are repeated as they are; open: KEY, start, n, off, anchor, alone, hot of stretches to look into.

    hot: the anchor has very many different stretches, as where many documents share a passage and go on in their own ways.
    """

    covered: DataFrame
    open: DataFrame
    folders: list[str]

    def clear(self) -> None:
        """Removes the tables in between. What was derived from them has to be written before."""
        for path in self.folders:
            Folder(self.open.sparkSession, path).remove()


def compare(found: DataFrame, length: int) -> Found:
    """found: stretches of all documents (STRETCH). Tables are written on the way, in the shared folder, so lost executors cost little.

    Joins are between plain exchanges, so that a key with very many rows is split; counting combines before it shuffles.
    """
    spark = found.sparkSession
    folders = [new_folder(spark, f"repeats-{k}") for k in ("stretches", "anchors", "candidates", "wholes", "varied")]
    rows = as_table(found, folders[0])
    anchors = as_table(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("anchor"), folders[1])
    candidates = as_table(rows.join(anchors.hint("merge"), "anchor", "left_semi"), folders[2])
    Folder(spark, folders[0]).remove()
    wholes = candidates.groupBy("anchor", "whole").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_hash", "start", "n", "off")).alias("one"),
    )
    wholes = as_table(wholes, folders[3])
    copied = wholes.where("copies > 1").select("anchor", "whole")
    covered = candidates.join(copied.hint("merge"), ["anchor", "whole"]).select(
        *KEY, "start", (F.col("start") + F.col("n") + (length - 1)).alias("end")
    )
    varied = wholes.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.min("copies").alias("least")).where("k > 1 AND least = 1")
    varied = as_table(varied.select("anchor", (F.col("k") > HOT).alias("hot")), folders[4])
    opened = wholes.join(varied.hint("merge"), "anchor").select("one.*", "anchor", (F.col("copies") == 1).alias("alone"), "hot")
    return Found(covered, opened, folders[1:])


def counted(hashed: DataFrame, window: int, folders: list[str], *hashes: str) -> DataFrame:
    """KEY, start, end of the lone windows of `hashed` whose hashes come up twice in it. Counting combines before it shuffles, so no window is too frequent.

    Of stretches that are there several times only one is in `hashed`: a count says whether a window is repeated, not how often.
    """
    folders += [new_folder(hashed.sparkSession, "windows"), new_folder(hashed.sparkSession, "repeated")]
    hashed = as_table(hashed, folders[-2])
    twice = as_table(hashed.groupBy(*hashes).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(*hashes), folders[-1])
    lone = hashed.where("alone").join(twice.hint("merge"), list(hashes), "left_semi")
    return lone.select(*KEY, "start", (F.col("start") + window).alias("end"))


def widest(spans: DataFrame) -> DataFrame:
    """Of the runs of a document that begin together the longest: of KEY, start, end. Copies of a row combine before they are shuffled."""
    return spans.groupBy(*KEY, "start").agg(F.max("end").alias("end"))


def by_document(docs: DataFrame, spans: DataFrame, how: str, *columns: str) -> DataFrame:
    """docs with an array of a document's rows of spans, which begin at different symbols: so there are no more of them than symbols, however many copies of a row there are."""
    grouped = spans.groupBy(*KEY).agg(F.collect_list(F.struct(*columns)).alias("spans"))
    grouped = grouped.withColumnsRenamed({k: f"_{k}" for k in KEY})
    return docs.join(grouped, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash")), how).drop(*(f"_{k}" for k in KEY))


def spans_of(column: pa.Array, *names: str) -> Iterator[list[np.ndarray]]:
    """For each row the fields of its spans, in document order of the first field; empty for null."""
    offsets = column.offsets.to_numpy()
    fields = [column.values.field(name).to_numpy(zero_copy_only=False) for name in names]
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for k in range(len(column)):
        part = [f[offsets[k] : offsets[k + 1] if valid[k] else offsets[k]] for f in fields]
        order = np.argsort(part[0], kind="stable")
        yield [p[order] for p in part]


def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows without those whose KEY was there before in this task: copies of a row have the same stretches, and one of them tells what there is to compare."""
    seen: set[tuple[int | None, int]] = set()
    for batch in batches:
        first = []
        for k, key in enumerate(zip(*(batch.column(c).to_pylist() for c in KEY))):
            if key not in seen:
                seen.add(key)
                first.append(k)
        if first:
            yield batch if len(first) == batch.num_rows else batch.take(pa.array(first))


def covered_mask(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n symbols lie in any of the runs."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0
