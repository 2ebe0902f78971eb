"""Fingerprints of documents that can be subtracted: invertible Bloom lookup sketches of paragraph digests.

A sketch has CELLS cells in three parts. Every digest goes into one cell of each part, which adds up the number of its digests, the digests and checks of them.
Subtracting one sketch from another leaves the digests that only one of them has. A cell that holds one digest (its check is right) gives it away; taken out of its
other cells it uncovers more, until nothing is left. If something is left, the difference was too large for the sketch: the digests are then divided over more
sketches, and those that still fail over more again.

All of it is Spark's own functions on columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from waybill.storage import Folder, as_table, new_folder

#: Cells of a sketch, in three parts.
CELLS = 24
_PART = CELLS // 3
#: Digests that a sketch should have to tell apart when documents are divided.
_LOAD = 8
#: How many sketches a failed one is divided over.
_SPLIT = 4
#: Rounds of peeling before a sketch counts as failed. Each uncovers what the last one made bare; far fewer are needed.
_ROUNDS = 12
#: Bytes of text in one block of neighbours, about.
_BLOCK_BYTES = 64 << 20
_MOST_BLOCKS = 10_000

#: A line is a paragraph. A line of several sentences is cut before those that begin with a capital letter from A to E, so that a text without line feeds has paragraphs too.
_CUT = r"\n|(?<=[.!?]) (?=[A-E])"

_CELL = "struct<n:bigint,key:bigint,check:bigint>"
_ZERO = f"CAST(named_struct('n', 0L, 'key', 0L, 'check', 0L) AS {_CELL})"


def _digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's paragraphs; blank ones do not count."""
    paragraphs = F.filter(F.split(text, _CUT), lambda p: F.length(F.trim(p)) > 0)
    return F.array_distinct(F.transform(paragraphs, lambda p: F.xxhash64(p)))


def _placed(key: str, seed: int) -> str:
    """SQL for the fields of a digest: itself, its check, and its cell in each part. Another seed, other cells."""
    cells = ", ".join(f"{k * _PART} + CAST(pmod(xxhash64({key}, {k}, {seed}), {_PART}) AS INT)" for k in range(3))
    return f"'key', {key}, 'check', xxhash64({key}, 7) & 4294967295L, 'cells', array({cells})"


def _named(value: str, name: str, use: str) -> str:
    """SQL for `use`, in which `name` stands for a value that is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def _sketch(digests: str, seed: int = 0) -> str:
    """SQL for the cells of an array of digests. Keys and checks are combined by exclusive or, so nothing overflows."""
    add = f"(c, d) -> CAST(named_struct('n', c.n + 1, 'key', c.key ^ d.key, 'check', c.check ^ d.check) AS {_CELL})"
    cells = f"transform(sequence(0, {CELLS - 1}), i -> aggregate(filter(ds, d -> d.cells[i DIV {_PART}] = i), {_ZERO}, {add}))"
    return _named(f"transform({digests}, d -> named_struct({_placed('d', seed)}))", "ds", cells)


def _minus(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> CAST(named_struct('n', x.n - y.n, 'key', x.key ^ y.key, 'check', x.check ^ y.check) AS {_CELL}))"


def _peeled(cells: str, seed: int = 0) -> str:
    """SQL for struct<cells, found>: what is left of a difference, and the digests recovered from it, each with the side (1 or -1) that has it.

    A cell is bare if it holds one digest of either side and the check is right. A digest may be bare in several cells of a round and counts once.
    """
    bare = f"transform(filter(s.cells, c -> abs(c.n) = 1 AND c.check = (xxhash64(c.key, 7) & 4294967295L)), c -> named_struct('n', c.n, {_placed('c.key', seed)}))"
    take = f"(c, p) -> IF(p.cells[i DIV {_PART}] = i, CAST(named_struct('n', c.n - p.n, 'key', c.key ^ p.key, 'check', c.check ^ p.check) AS {_CELL}), c)"
    state = f"struct<cells:array<{_CELL}>,found:array<struct<key:bigint,n:bigint>>>"
    after = f"CAST(named_struct('cells', transform(s.cells, (cell, i) -> aggregate(t, cell, {take})), 'found', concat(s.found, transform(t, p -> named_struct('key', p.key, 'n', p.n)))) AS {state})"
    step = f"(s, r) -> {_named(f'array_distinct({bare})', 't', f'IF(size(t) = 0, s, {after})')}"
    return f"aggregate(sequence(1, {_ROUNDS}), CAST(named_struct('cells', {cells}, 'found', array()) AS {state}), {step})"


def _empty(cells: str) -> str:
    return f"forall({cells}, c -> c.n = 0 AND c.key = 0 AND c.check = 0)"


def _written(cells: str) -> str:
    """A sketch as text: for each cell its number, its digests and its checks in hexadecimal."""
    return f"array_join(transform({cells}, c -> concat(hex(c.n), ':', lpad(hex(c.key), 16, '0'), ':', lpad(hex(c.check), 8, '0'))), '.')"


def _likeness(size: Column, differing: Column) -> Column:
    """The share that two sets have in common of all they have, from the sum of their sizes; 1 for two empty ones."""
    return F.when(size == 0, 1.0).otherwise((size - differing) / (size + differing))


def _block_of(id_: Column, hash_: Column, bounds: list[int]) -> Column:
    """Blocks by descending id, found by halving the bounds. An id that is several bounds in one has as many blocks, by its hash."""
    limits = sorted(bounds, reverse=True)
    distinct = sorted(set(limits), reverse=True)
    share = hash_ / F.lit(float(1 << 64)) + 0.5

    def tree(lo: int, hi: int) -> Column:
        """Of ids below distinct[lo - 1], and not below distinct[hi]."""
        if lo == hi:
            at = limits.index(distinct[lo]) if lo < len(distinct) else len(limits)
            times = limits.count(distinct[lo]) if lo < len(distinct) else 1
            return F.lit(at) if times == 1 else F.when(id_ == distinct[lo], at + F.least(F.floor(share * times), F.lit(times - 1))).otherwise(F.lit(at))
        middle = (lo + hi) // 2
        return F.when(id_ >= distinct[middle], tree(lo, middle)).otherwise(tree(middle + 1, hi))

    return tree(0, len(distinct))


def neighbours(docs: DataFrame, folders: list[str]) -> DataFrame:
    """doc_id, n_chars, edited_sha256 and the digests of each text, of its edited version and of the next text, as a table.

    Documents go into blocks of neighbouring ids (an id with very many rows is divided by a hash of the text), within which the next one is looked up; the last of
    a block meets the first of the one after it in a small join. Texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "id": F.coalesce("doc_id", F.lit(-(1 << 63)))})
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = min(_MOST_BLOCKS, max(size // _BLOCK_BYTES + 1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    bounds = rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 10 * n).alias("b")).first().b if n > 1 else []
    block = _block_of(F.col("id"), F.col("hash"), bounds or [])
    rows = rows.select("doc_id", "id", "hash", "text", block.cast("long").alias("block"), _digests(F.col("text")).alias("own"))

    here = Window.partitionBy("block").orderBy(F.desc("id"), "hash")
    lead = rows.withColumns({"next": F.lead("text").over(here), "next_own": F.lead("own").over(here), "place": F.row_number().over(here)})
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, CAST(n_chars - floor(n_chars / 2) AS INT))"), F.substring("next", F.lit(1), half))
    pieces = lead.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", F.when(F.col("next").isNotNull(), edited))

    def finish(df: DataFrame) -> DataFrame:
        return df.select(
            "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "own", _digests(F.col("edited")).alias("edited_own"), "next_own",
            "block", "place", F.when(F.col("next").isNull() | (F.col("place") == 1), F.col("text")).alias("text"), F.col("next").isNull().alias("open"),
        )

    folders.append(new_folder(spark, "fingerprints-neighbours"))
    table = as_table(finish(pieces), folders[-1])
    # Two rows a block at most: its first and its last.
    heads = table.where("place = 1").select(F.col("block").alias("_block"), F.col("text").alias("next"), F.col("own").alias("next_own"))
    order = Window.orderBy("_block")
    known = table.where("place = 1").select(F.col("block").alias("_block"))
    after = known.select(F.col("_block").alias("block"), F.coalesce(F.lead("_block").over(order), F.first("_block").over(order)).alias("_block"))
    last = table.where("open").drop("next_own", "edited_sha256", "edited_own", "open").join(after, "block").join(heads, "_block").withColumn("edited", edited)
    joined = table.where("NOT open").select("doc_id", "n_chars", "edited_sha256", "own", "edited_own", "next_own").union(
        finish(last).select("doc_id", "n_chars", "edited_sha256", "own", "edited_own", "next_own"))
    folders.append(new_folder(spark, "fingerprints-pairs"))
    return as_table(joined.withColumn("row", F.monotonically_increasing_id()), folders[-1])


def _divided(failed: DataFrame, seed: int, folders: list[str]) -> tuple[DataFrame, DataFrame]:
    """(row, pair, differing) summed over sketches that gave all away, and the digests of those that did not.

    failed: row, pair, block, blocks, a, b (digests of either side that are to be told apart), each to be divided over `blocks` sketches.
    """
    spark = failed.sparkSession
    sides = failed.select("row", "pair", "block", "blocks", F.explode(F.concat(
        F.transform("a", lambda d: F.struct(d.alias("d"), F.lit(1).alias("side"))), F.transform("b", lambda d: F.struct(d.alias("d"), F.lit(-1).alias("side"))))).alias("e"))
    # A sketch's digests come together at random: about _LOAD of them, whatever the document.
    part = F.pmod(F.xxhash64("e.d", F.lit(seed)), F.col("blocks").cast("long"))
    grouped = sides.groupBy("row", "pair", "block", part.alias("part")).agg(
        F.collect_list(F.when(F.col("e.side") == 1, F.col("e.d"))).alias("a"), F.collect_list(F.when(F.col("e.side") == -1, F.col("e.d"))).alias("b"))
    peeled = grouped.withColumn("peel", F.expr(_peeled(_minus(_sketch("a", seed), _sketch("b", seed)), seed)))
    state = peeled.select("row", "pair", F.xxhash64("block", "part").alias("block"), "a", "b", F.expr(_empty("peel.cells")).alias("done"), F.expr("size(peel.found)").alias("found"))
    state = state.select("row", "pair", "block", "done", F.when(F.col("done"), F.col("found")).otherwise(0).alias("found"),
                         *(F.when(~F.col("done"), F.col(c)).alias(c) for c in ("a", "b")))
    folders.append(new_folder(spark, "fingerprints-peeled"))
    state = as_table(state, folders[-1])
    left = state.where("NOT done").select("row", "pair", "block", F.lit(_SPLIT).alias("blocks"), "a", "b")
    return state.groupBy("row", "pair").agg(F.sum("found").cast("long").alias("differing")), left


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next lesser id (rows of one id by a hash of the text; null ids last; after the last the first). A text is edited by putting the
    first floor(n_chars / 2) code points of the next one, or all if it has fewer, in place of its last ones. Likeness is the share of paragraph digests in
    common, from what is recovered of two sketches' difference.

    A null text is empty and like an empty one (1.0); repeated rows are documents of their own; a table of one row is its own next; other columns are ignored; an empty
    table gives no rows. A paragraph that is there twice in a text counts once.
    """
    spark, folders = docs.sparkSession, []
    table = neighbours(docs, folders)
    pairs = {"edited": "edited_own", "next": "next_own"}
    tried = table.withColumn("s", F.expr(_sketch("own")))
    tried = tried.withColumns({pair: F.expr(_peeled(_minus("s", _sketch(other)))) for pair, other in pairs.items()})
    states = [F.struct(F.lit(pair).alias("pair"), (F.size("own") + F.size(other)).alias("size"), F.expr(_empty(f"{pair}.cells")).alias("done"),
                       F.expr(f"size({pair}.found)").cast("long").alias("found"), F.col(other).alias("b")) for pair, other in pairs.items()]
    tried = tried.select("row", "own", F.explode(F.array(*states)).alias("p")).select(
        "row", "p.pair", "p.size", F.when(F.col("p.done"), F.col("p.found")).alias("found"), *(F.when(~F.col("p.done"), F.col(c)).alias(n) for c, n in (("own", "a"), ("p.b", "b"))))
    folders.append(new_folder(spark, "fingerprints-tried"))
    tried = as_table(tried, folders[-1])
    blocks = F.greatest(F.lit(_SPLIT), F.ceil(F.col("size") / _LOAD)).cast("int")
    left = tried.where("found IS NULL").select("row", "pair", F.lit(0).cast("long").alias("block"), blocks.alias("blocks"), "a", "b")
    found, seed = tried.select("row", "pair", "size", F.col("found").alias("differing")), 1
    while left.limit(1).count():
        some, left = _divided(left, seed, folders)
        found = found.union(some.select("row", "pair", F.lit(0).alias("size"), "differing"))
        seed += 1
    sums = found.groupBy("row").agg(*(
        _likeness(F.sum(F.when(F.col("pair") == pair, F.col("size"))), F.sum(F.when(F.col("pair") == pair, F.col("differing")))).alias(f"near_{pair}") for pair in pairs))
    # The sketches are made once more from the digests, which are shorter to carry through the join.
    rows = table.select("row", "doc_id", "n_chars", "edited_sha256", "own", "edited_own").join(sums.hint("merge"), "row")
    out = rows.select("doc_id", "n_chars", "edited_sha256", F.expr(_written(_sketch("own"))).alias("fingerprint"), F.expr(_written(_sketch("edited_own"))).alias("edited_fingerprint"), "near_edited", "near_next")
    out = as_table(out, new_folder(spark, "fingerprints"))
    for path in folders:
        Folder(spark, path).remove()
    return out
