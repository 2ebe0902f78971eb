"""Packs token sequences by shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

import functools
import heapq
import os
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from waybill.storage import as_table, new_folder

END = 1
_END = END.to_bytes(4, "little")
#: Words whose ids a worker remembers, twice: those met lately, and those met before.
_REMEMBERED = 450_000
#: White space and letters that a tokenizer has to treat as `_Ids` does.
_PROBE = "Ab\u00a0c\u2003D\u0085e 'S 12\tIt's\n\u00c9\u0130 x-Y,"
#: Pieces of one length that are numbered in one place.
_RANKED = 50_000
#: Copies of one piece from which on they are ranked apart, in blocks of about so many. More of them where there are very many pieces, so that such pieces are 10,000 at most.
_COPIES = 1_000


class _Ids:
    """Ids of texts as bytes, for vocabularies that drop white space and case, so that words can be encoded once and looked up.

    One of these serves all tasks of a worker. Words are looked up in lower case, but for texts that may hold a special token's string.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self._tokenizer = Tokenizer.from_file(path)
        whole = self._tokenizer.encode(_PROBE, add_special_tokens=False).ids
        # White space is dropped when words are found; making it plain before that is half of the work for nothing.
        self._tokenizer.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self._lately: dict[bytes, bytes] = {}
        self._before: dict[bytes, bytes] = {}
        if self(_PROBE) != b"".join(i.to_bytes(4, "little") for i in whole) + _END:
            raise ValueError(f"{path} does not drop white space and case")

    def __call__(self, text: str | None) -> bytes:
        data = (text or "").encode()
        parts = (data if b"<|" in data else data.lower()).split()
        lately = self._lately
        new = {p for p in parts if p not in lately}
        if new:
            lately.update({p: self._before[p] for p in new if p in self._before})
            unknown = [p for p in new if p not in lately]
            found = self._tokenizer.encode_batch_fast([p.decode() for p in unknown], add_special_tokens=False)
            lately.update({p: array("I", e.ids).tobytes() for p, e in zip(unknown, found)})
        out = b"".join(map(lately.__getitem__, parts)) + _END
        if len(lately) > _REMEMBERED:
            self._lately, self._before = {}, lately
        return out


@functools.cache
def _ids(path: str) -> _Ids:
    return _Ids(path)


def _pieces(path: str, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for k, text in enumerate(part.column("text")):
                    data = ids_of(text.as_py())
                    for at in range(0, len(data), 4 * size):
                        piece = data[at : at + 4 * size]
                        row.append(k)
                        start.append(at // 4)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(len(data) // 4)
                        ids.append(piece if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
                )

    return run


def patterns(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack, how many such packs), by shortest-pack-first: lengths are placed longest first, each into the packs with the most room.

    Packs with equal content are one entry, so the work depends on the number of lengths, not of pieces. A length that does not fit into the
    emptiest pack opens new ones.
    """
    open_: list[tuple[int, int, tuple[int, ...], int]] = []  # (-room, order, lengths, count)
    order = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed = []
        while left and open_ and -open_[0][0] >= length:
            room, _, lengths, count = heapq.heappop(open_)
            n = min(left, count)
            left -= n
            if n < count:
                order += 1
                heapq.heappush(open_, (room, order, lengths, count - n))
            if -room - length >= length:  # what still has room for this length may take it again
                order += 1
                heapq.heappush(open_, (room + length, order, (*lengths, length), n))
            else:
                placed.append((room + length, (*lengths, length), n))
        while left:
            n, each = (left, 1) if size // length < 2 else (left // (size // length), size // length)
            if not n:
                n, each = 1, left
            left -= n * each
            placed.append((-(size - each * length), (length,) * each, n))
        for room, lengths, count in placed:
            order += 1
            heapq.heappush(open_, (room, order, lengths, count))
    merged: dict[tuple[int, ...], int] = {}
    for _, _, lengths, count in sorted(open_):
        merged[lengths] = merged.get(lengths, 0) + count
    return list(merged.items())


def slots(found: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset): which pieces of a length, by rank, take which place."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, count in found:
        offset = 0
        for length in lengths:
            first = taken.get(length, 0)
            out.append((length, first, first + count, sequence, offset))
            taken[length] = first + count
            offset += length
        sequence += count
    return out


def _blocked(pieces: DataFrame, total: int) -> DataFrame:
    """pieces, a written table, with the block in which a piece's rank within its length is counted, so that neither a length nor a piece very many documents have is numbered in one place.

    Blocks go by what a piece is; copies of a piece that is there very often have blocks of their own (`copied`), parted by their place in the table (`part`). Only copies change places by that.
    """
    kind = ("length", "doc_id", "start", "ids_crc32", "doc_tokens")
    many = max(_COPIES, total // 10_000)
    often = pieces.groupBy(*kind).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > many)
    parts = often.select(*(F.col(c).alias(f"_{c}") for c in kind), F.xxhash64(*kind).alias("_copied"), F.floor(F.col("n") / many + 1).alias("_parts"))
    same = functools.reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in kind))
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    block = F.pmod(F.xxhash64(*kind[1:]), F.lit(max(16, total // _RANKED)))
    found = pieces.select("*", place.alias("_place")).join(F.broadcast(parts), same, "left")
    return found.select(*pieces.columns, block.alias("block"), F.coalesce("_copied", F.lit(0)).alias("copied"), F.coalesce(F.pmod("_place", "_parts"), F.lit(0)).alias("part"))


_BLOCK = ("length", "block", "copied", "part")


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and with_ids: the ids, little-endian 32-bit).

    tokenizer: path of a vocabulary file of the tokenizers library, the same on all machines. A document is its ids and END. Documents are cut every `size` ids; what remains
    of each is packed whole. The driver sees the histogram of lengths (at most `size` numbers) and the patterns that come of it.

    A null or empty text is END alone; null and repeated ids and repeated rows are fine (equal rows are interchangeable); other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(tokenizer, size, with_ids), schema)
    pieces = as_table(made if with_ids else made.drop("ids"), new_folder(spark, "pieces"))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(slots(patterns(histogram, size)), "of long, lo long, hi long, first long, offset long")
    blocked = _blocked(pieces, sum(histogram.values()))
    sizes = blocked.groupBy(*_BLOCK).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy(*_BLOCK[1:]).rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(*_BLOCK, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    own = Window.partitionBy(*_BLOCK).orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = blocked.withColumn("nth", F.row_number().over(own) - 1).join(begins, list(_BLOCK)).withColumn("rank", F.col("nth") + F.col("begin"))
    # At most a few entries for each length: the table has a bound that comes of `size`.
    placed = ranked.join(F.broadcast(places), (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    extra = ["ids"] if with_ids else []
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset", *extra
    )
