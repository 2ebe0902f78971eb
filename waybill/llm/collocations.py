"""Phrases whose words come together more often than their parts would, language by language.

Words are numbered, and texts become rows of numbers in which whatever cannot be in a phrase is a break. Level by level, what continues a frequent phrase by a frequent
one is counted: these are the only candidates for the next length (Apriori). At last all candidates are one double-array trie, or a few in
turn, broadcast to the tasks: every place of a text walks on at the same time, states that accept are counted, and Spark adds up the tasks' counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from waybill.llm.double_array import BREAK, DoubleArray, TooLarge
from waybill.llm.text import blocks
from waybill.operators.lookup import join_config
from waybill.storage import Folder, as_table, new_folder

LONGEST = 5
#: Occurrences that a phrase needs.
LEAST = 100
#: Phrases returned for each language.
TOP = 2000
#: Bytes of words that a task holds at once while texts become numbers; more words take several readings.
VOCABULARY_BYTES = 64 << 20
#: Phrases in one trie, and bytes of its arrays; more take several readings.
TRIE_PHRASES = 1 << 20
TRIE_BYTES = 64 << 20
#: Numbers of words that are walked at once, and occurrences that a task adds up before it hands them on.
_TOGETHER, _HELD = 1 << 18, 1 << 22
#: Words that a task walks for each phrase it may hand on a count of.
_WORDS_EACH = 64

_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_ENDS_PIECE = np.isin(np.arange(256), list(_PIECE_ENDS))
_BETWEEN = _ENDS_PIECE | np.isin(np.arange(256), [0x20, 0x09])
_LOWER = np.where((np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A), np.arange(256) + 0x20, np.arange(256)).astype(np.uint8)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of a block of texts, how many begin before each text, and which are the first of their piece."""
    inside = ~_BETWEEN[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[filled] = inside[filled]
    starts = np.flatnonzero(first)
    kept = np.concatenate([[0], np.cumsum(inside)])
    ends = kept[np.append(starts, len(data))]
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(_LOWER[data[inside]])])
    piece = np.cumsum(_ENDS_PIECE[data])[starts] if len(starts) else np.empty(0, np.int64)
    text = np.searchsorted(offsets, starts, "right")
    opens = np.ones(len(starts), bool)
    opens[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    return array, np.searchsorted(starts, offsets), opens


def _language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("und"))


_COUNTED = "lang string, word binary, n long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each block of texts with their number, language by language."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang in dict.fromkeys(langs):
            own = batch.column("text").filter(pa.array([x == lang for x in langs]))
            for _, data, offsets in blocks(own, 1 << 22):
                counts = _words(data, offsets)[0].value_counts()
                if len(counts):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), counts.field(0).cast(pa.binary()), counts.field(1)], ["lang", "word", "n"])


def _numbered(rows: DataFrame, path: str, *order: Column) -> DataFrame:
    """rows with `id`, from 1 without gaps in the order given, as a table: places within file parts, moved on by the parts before."""
    spark = rows.sparkSession
    placed = as_table(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), f"{path}-parts")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    # One row a file part: as few as Spark's own list of tasks.
    numbered = placed.join(F.broadcast(before), part == F.col("_part"))
    numbered = as_table(numbered.select(*rows.columns, (F.col("_before") + (F.col("_at") - F.shiftleft(F.col("_part"), 33)) + 1).alias("id")), path)
    Folder(spark, f"{path}-parts").remove()
    return numbered


def _encoded(words: Broadcast, known: bool) -> Callable:
    """Adds the numbers of some words (by language: words, numbers) to texts; 0 goes before each piece and where a word is not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = words.value
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, data, offsets in blocks(batch.column("text"), 1 << 22):
                found, counts, opens = _words(data, offsets)
                numbers = np.zeros(len(found), np.int64)
                names = np.array(langs[at : at + len(offsets) - 1], object)
                for lang in dict.fromkeys(names.tolist()):
                    if lang not in tables:
                        continue
                    mine = np.repeat(names == lang, np.diff(counts))
                    place = pc.index_in(found.filter(pa.array(mine)), tables[lang][0])
                    ids = np.append(tables[lang][1], 0)
                    numbers[mine] = ids[place.fill_null(len(ids) - 1).to_numpy(zero_copy_only=False)]
                spots = np.arange(len(numbers)) + np.cumsum(opens)
                out = np.zeros(len(numbers) + int(opens.sum()), np.int32)
                out[spots] = numbers
                ends = np.concatenate([[0], np.cumsum(opens)])[counts] + counts
                if known:
                    before = batch.column("codes").slice(at, len(names)).flatten().to_numpy()
                    out = np.where(out == BREAK, before, out)
                codes = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out))
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(at, len(names)), batch.column("text").slice(at, len(names)), codes], ["lang", "text", "codes"])

    return run


def _by_language(vocabulary: DataFrame) -> dict[str, tuple[pa.Array, np.ndarray]]:
    part, held = vocabulary.select("lang", "word", "id").toArrow(), {}
    for lang in pc.unique(part.column("lang")).to_pylist():
        own = part.filter(pc.equal(part.column("lang"), lang))
        held[lang] = (own.column("word").combine_chunks().cast(pa.large_binary()), own.column("id").to_numpy().astype(np.int64))
    return held


def _encode(docs: DataFrame, vocabulary: DataFrame, folders: list[str]) -> DataFrame:
    """codes of every text, as a table. Words go to the tasks in blocks of a bounded number of bytes; texts are read again for each."""
    spark = docs.sparkSession
    size, last = vocabulary.agg(F.coalesce(F.sum(F.octet_length("word") + 16), F.lit(0)), F.coalesce(F.max("id"), F.lit(0))).first()
    passes = max(1, -(-size // VOCABULARY_BYTES))
    step = max(1, -(-last // passes))
    now, schema = docs, "lang string, text string, codes array<int>"
    for k in range(passes):
        words = spark.sparkContext.broadcast(_by_language(vocabulary.where(F.col("id").between(k * step + 1, (k + 1) * step))))
        done = now.mapInArrow(_encoded(words, k > 0), schema)
        now = as_table(done.select("codes") if k == passes - 1 else done, _new(spark, folders, "codes"))
        words.unpersist()
    return now


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The numbers of many texts in a row, each text begun by a break (as every piece is)."""
    for batch in batches:
        column = batch.column("codes")
        numbers, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        lo = 0
        while lo < len(column):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + _TOGETHER, "right")) - 1)
            yield numbers[ends[lo] : ends[hi]].astype(np.int64)
            lo = hi


_CONTINUED = "prefix long, word int, n long"


def _continued(tries: Broadcast, length: int, alone: bool) -> Callable:
    """How often frequent phrases of length - 1 words go on by a word. `alone`: all frequent phrases are in this trie, so what follows the first word is looked up too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, ids = tries.value
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(ids[keys >> 32]), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(counts.astype(np.int64))], ["prefix", "word", "n"])

        for numbers in _texts(batches):
            places = states = np.empty(0, np.int64)
            for places, states in trie.walk(numbers, length - 1):
                pass
            number = trie.accepts[states].astype(np.int64)
            frequent = np.zeros(len(numbers) + 1, bool)
            frequent[places[number >= 0]] = True
            inside = (number >= 0) & (places + length - 1 < len(numbers))
            places, number = places[inside], number[inside]
            follows = frequent[places + 1] if alone else numbers[places + length - 1] != BREAK
            places, number = places[follows], number[follows]
            held.append((number << 32) | numbers[places + length - 1])
            size += len(places)
            if size >= _HELD:
                yield summed()
                held, size = [], 0
        if size:
            yield summed()

    return run


def _accepted(tries: Broadcast) -> Callable:
    """How often each phrase of the trie occurs: one bin for each state that accepts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, ids = tries.value
        bins = np.zeros(len(ids), np.int64)
        for numbers in _texts(batches):
            for _, states in trie.walk(numbers, LONGEST):
                number = trie.accepts[states]
                bins += np.bincount(number[number >= 0], minlength=len(bins))
        some = np.flatnonzero(bins)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(bins[some])], ["id", "n"])

    return run


def _new(spark: SparkSession, folders: list[str], name: str) -> str:
    folders.append(new_folder(spark, f"phrases-{name}"))
    return folders[-1]


def _trie(phrases: DataFrame, length: int, most: int | None) -> tuple[DoubleArray, np.ndarray]:
    """A trie of phrases (id, codes) and the ids of what it accepts; what it is made of is given up on return."""
    rows = phrases.select("id", "codes").toArrow()
    codes, ids = rows.column("codes").combine_chunks(), rows.column("id").to_numpy().astype(np.int64)
    sizes = np.diff(codes.offsets.to_numpy())
    table = np.zeros((len(codes), length), np.int32)
    table[np.arange(length) < sizes[:, None]] = codes.flatten().to_numpy(zero_copy_only=False)
    del rows, codes
    order = np.lexsort(table.T[::-1])
    table = table[order]
    return DoubleArray.build(table, most), ids[order]


def _tries(phrases: DataFrame, length: int) -> Iterator[tuple[DoubleArray, np.ndarray, bool]]:
    """Tries of phrases (id, codes), the ids of what they accept, and whether there is only one. A trie that grows to its bound is given up there and made of half as many."""
    last = phrases.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    lo, step = 1, TRIE_PHRASES
    while lo <= last:
        try:
            made = _trie(phrases.where(F.col("id").between(lo, lo + step - 1)), length, TRIE_BYTES if step > 1 else None)
        except TooLarge:
            step //= 2
            continue
        yield *made, lo == 1 and lo + step > last
        del made
        lo += step


def _passes(codes: DataFrame, phrases: DataFrame, length: int, task: Callable[[Broadcast, bool], Callable], schema: str, folders: list[str]) -> DataFrame | None:
    """What tasks say of all texts, trie by trie, together."""
    spark, out = codes.sparkSession, None
    for trie, ids, alone in _tries(phrases, length):
        held = spark.sparkContext.broadcast((trie, ids))
        del trie, ids
        keys = [f.split()[0] for f in schema.split(", ")][:-1]
        rows = codes.mapInArrow(task(held, alone), schema).groupBy(*keys).agg(F.sum("n").alias("n"))
        rows = as_table(rows if keys == ["id"] else rows.where(F.col("n") >= LEAST), _new(spark, folders, "counts"))
        held.unpersist()
        out = rows if out is None else out.union(rows)
    return out


def _fewer_tasks(codes: DataFrame, words: int, phrases: int) -> DataFrame:
    """codes in so few parts that the tasks' counts, one a part and phrase, stay far below the number of words; no fewer than the cores."""
    return codes.coalesce(max(codes.sparkSession.sparkContext.defaultParallelism, words // (_WORDS_EACH * max(1, min(phrases, TRIE_PHRASES)))))


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, n of all words."""
    return docs.mapInArrow(_counted, _COUNTED).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _scored(phrases: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each phrase with its least cut; phrases: lang, phrase, words, a. A part of a frequent phrase is frequent, so it is found among them."""
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = phrases.where("words > 1").select("lang", "phrase", "a", cut, words.alias("w"))
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("_left"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("_right"))
    for side, name in (("_left", "l"), ("_right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("a").alias(name)).hint("merge"), ["lang", side])
    exact = F.expr("(CAST(1000 AS DECIMAL(4,0)) * (CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)))) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    scored = join_config(cuts, sizes, ["lang"], ["phrase", "k"], "inner").withColumn("score", exact.cast("long"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best"))
    return best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")


def _maximal(phrases: DataFrame) -> DataFrame:
    """Phrases without those that a phrase with one word more holds and that are there no more often. With what a still longer one holds it is so step by step."""
    words = F.split("phrase", " ")
    longer = phrases.where("words > 2").withColumn("w", words)
    parts = longer.select("lang", "a", F.explode(F.array(*(F.array_join(F.slice("w", start, F.size("w") - 1), " ") for start in (1, 2)))).alias("phrase"))
    held = parts.groupBy("lang", "phrase").agg(F.max("a").alias("_within"))
    return phrases.join(held.hint("merge"), ["lang", "phrase"], "left").where("_within IS NULL OR 100 * _within < 100 * a").drop("_within")


def collocations(docs: DataFrame) -> DataFrame:
    """The first TOP phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased, texts cut into pieces at . , ; : ! ? and line ends and these into words at blanks and tabs. A phrase has 2 to 5 words of one piece and occurs LEAST times, overlaps
    counted. It is scored by its worst cut: 1000 * a * n / (l * r), rounded down, with a, l and r the occurrences of the phrase and its two parts and n all words. Phrases that are only ever
    part of a longer one are left out.

    A null text is empty, a null language is `und`; a language without phrases has no rows; repeated rows count as often as they are there; ties of score go by
    occurrences, then by the phrase in byte order; other columns are ignored; an empty table gives no rows.
    """
    spark, folders = docs.sparkSession, []
    docs = docs.select(_language().alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = as_table(count_words(docs), _new(spark, folders, "words"))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    # Frequent words get small numbers, which keeps tries dense.
    vocabulary = _numbered(words.where(F.col("n") >= LEAST), _new(spark, folders, "vocabulary"), F.desc("n"), F.col("lang"), F.col("word"))
    codes = _encode(docs, vocabulary, folders)

    level = vocabulary.select("id", F.array(F.col("id").cast("int")).alias("codes"))
    levels = [level]
    for length in range(2, LONGEST + 1):
        found = _passes(codes, level, length - 1, lambda held, alone, length=length: _continued(held, length, alone), _CONTINUED, folders)
        if found is None:
            break
        longer = found.join(level.select(F.col("id").alias("prefix"), F.col("codes").alias("_codes")).hint("merge"), "prefix")
        longer = longer.select(F.concat("_codes", F.array("word")).alias("codes"))
        level = _numbered(longer, _new(spark, folders, f"level-{length}"), F.col("codes"))
        levels.append(level)

    together = levels[0].select("codes")
    for rows in levels[1:]:
        together = together.union(rows.select("codes"))
    candidates = _numbered(together, _new(spark, folders, "candidates"), F.col("codes"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = _passes(_fewer_tasks(codes, total, candidates.count()), candidates, LONGEST, lambda held, alone: _accepted(held), "id long, n long", folders)
    schema = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
    if counts is None:
        return spark.createDataFrame([], schema)
    spelled = candidates.select("id", F.size("codes").alias("words"), F.posexplode("codes").alias("at", "code"))
    spelled = spelled.join(vocabulary.select(F.col("id").cast("int").alias("code"), "lang", F.col("word").cast("string").alias("word")), "code")
    spelled = spelled.groupBy("id", "words", "lang").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    phrases = spelled.join(counts.hint("merge"), "id").select("lang", "phrase", "words", F.col("n").alias("a"))
    phrases = as_table(phrases, _new(spark, folders, "phrases"))
    chosen = _maximal(phrases.where("words > 1")).select("lang", "phrase")
    scored = _scored(phrases, sizes).join(chosen.hint("merge"), ["lang", "phrase"], "left_semi")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.col("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= TOP)
    out = as_table(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), new_folder(spark, "collocations"))
    for path in folders:
        Folder(spark, path).remove()
    return out
