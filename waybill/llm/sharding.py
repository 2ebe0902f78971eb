"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

#: Copies of one row that a single output array may hold while repeated rows are written out again.
_STEP = 1 << 16


def ring(spark: SparkSession, n_shards: int, nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise. Bounded by the parameters, whatever the input."""
    at = F.pmod(F.xxhash64(F.lit("node"), "id"), F.lit(cells))
    # A shard's nodes are where they are however many shards there are.
    found = spark.range(n_shards * nodes).select(at.alias("cell"), F.floor(F.col("id") / nodes).cast("int").alias("shard"))
    return sorted((r.cell, r.shard) for r in found.collect())


def allocate(demand: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, last rank + 1, shard, first slot): who takes which rows of each cell.

    Every cell first fills the shard of its own node (the next one clockwise); what finds no room goes on clockwise to
    the next node whose shard has some. The sum of room has to cover the sum of demand.
    """
    room, places = list(room), [c for c, _ in nodes]
    taken, out, over = [0] * len(room), [], []

    def give(cell: int, rank: int, n: int, shard: int) -> int:
        n = min(n, room[shard])
        if n:
            out.append((cell, rank, rank + n, shard, taken[shard]))
            taken[shard] += n
            room[shard] -= n
        return n

    for cell in sorted(demand):
        node = bisect.bisect_left(places, cell) % len(nodes)
        got = give(cell, 0, demand[cell], nodes[node][1])
        if got < demand[cell]:
            over.append((cell, got, node))
    for cell, rank, node in over:
        while rank < demand[cell]:
            node = (node + 1) % len(nodes)
            rank += give(cell, rank, demand[cell] - rank, nodes[node][1])
    return out


def _ranked(kinds: DataFrame) -> DataFrame:
    """kinds with `first`, the rows of the cell before them by doc_id, checksum and size. Rows are counted within 1,024 ranges of a document id's checksums first: an id may have very many texts."""
    kinds = kinds.withColumn("part", F.shiftright("text_crc32", 22))
    sums = kinds.groupBy("cell", "doc_id", "part").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("cell").orderBy("doc_id", "part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select(F.col("cell").alias("_cell"), F.col("doc_id").alias("_doc_id"), F.col("part").alias("_part"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("cell", "doc_id", "part").orderBy("text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    counted = kinds.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0)))
    own = (F.col("cell") == F.col("_cell")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("part") == F.col("_part"))
    return counted.join(begins, own).withColumn("first", F.col("first") + F.col("begin")).drop("part", "begin", "_cell", "_doc_id", "_part")


def shard(docs: DataFrame, n_shards: int = 16, nodes: int = 512, cells: int = 1 << 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law `rows`: every shard takes floor(n / shards) rows and the first n mod shards one more. A document's place on the
    ring depends on its doc_id alone; rows of a cell are ranked by doc_id, checksum and size, and the ranks that find
    their shard full go on clockwise. The driver sees one count per cell (at most `cells` numbers) and nothing else.

    A null text counts as empty, a null doc_id is a key like any other, repeated rows are counted before they are
    shuffled and each gets its own slot; an empty table gives no rows; other columns are ignored. Which of two equal
    rows takes which slot means nothing.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(cells)).alias("cell")
    demand = {r.cell: r.n for r in docs.groupBy(cell).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(demand.values())
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    parts = allocate(demand, ring(spark, n_shards, nodes, cells), room)
    places = spark.createDataFrame(parts, "cell long, lo long, hi long, shard int, base long")
    kinds = docs.groupBy(
        cell, "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32")
    ).agg(F.count(F.lit(1)).alias("n"))
    ranked = _ranked(kinds)
    end = F.col("first") + F.col("n") - 1
    # The few thousand ranges have a size fixed by cells and nodes; a row meets those of its own cell only.
    placed = ranked.join(F.broadcast(places), "cell").where("first < hi AND first + n > lo").withColumns({
        "from": F.greatest("first", "lo"), "to": F.least(end, F.col("hi") - 1),
    })
    blocks = placed.withColumn("from", F.explode(F.sequence("from", "to", F.lit(_STEP))))
    ranks = blocks.withColumn("rank", F.explode(F.sequence("from", F.least("to", F.col("from") + _STEP - 1))))
    return ranks.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
