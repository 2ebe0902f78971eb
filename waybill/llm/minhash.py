"""Near-duplicate documents by bottom-k sketches of one hash function."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from waybill.llm.components import components
from waybill.llm.repeats import KEY, keyed, once
from waybill.llm.text import LOWER, WORDS, blocks, mixed, words
from waybill.operators.lookup import join_config, join_unique
from waybill.storage import Folder, as_table, new_folder

#: Names a table in between, all of which go when the result is written.
Work = Callable[[str], str]

SHINGLE = 5
#: Retained values of a document: the least hashes of its set, or all of a smaller one.
K = 32
#: Values that sketches of linked documents share at least: of 32 values the mean is 24 at the threshold, and fewer than 8 come up 4.4 times in 10^10.
_SHARED = 8
#: The estimate below which a pair is dropped, in values of K: fewer than 10 of 32 come up 3.4 times in 10^8 at the threshold.
_ESTIMATE = 10
#: Members of either side, about, that meet in one place.
_MEMBERS = 500


def _sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a block, below 2^63 so that signed numbers keep their order."""
    w = words(data, offsets)
    sums = WORDS.prefixes(w.hashes(data, LOWER))
    windows = mixed(WORDS.windows(sums, SHINGLE)) >> np.uint64(1)
    for lo, hi in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist()):
        if hi - lo >= SHINGLE:
            yield np.unique(windows[lo : hi - SHINGLE + 1])
        elif hi > lo:
            one = WORDS.runs(sums, np.array([lo]), np.array([hi])) + np.uint64(hi - lo)
            yield mixed(mixed(one)) >> np.uint64(1)
        else:
            yield np.empty(0, np.uint64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in blocks(batch.column("text")):
            sets = list(_sets(data, offsets))
            # Sums over a set do not depend on order: equal sets, equal numbers.
            one = [int(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            values = np.concatenate([s[:K] for s in sets]).view(np.int64)
            ends = np.cumsum([0, *(min(K, len(s)) for s in sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(first, len(sets)) for k in KEY), pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                [*KEY, "n", "cid", "sketch"],
            )


def _posted(classes: DataFrame, work: Work) -> DataFrame:
    """key, cid: the inverted lists, of retained values that two classes have, the rarest of each class first.

    Two sketches that share s of their values share at least one among all but their s-1 most frequent, in one order for all. So the values that very many documents
    have (common passages) are left out wherever a class has enough others. Sets in a ratio beyond 4:3 cannot be linked: lists are parted by size.
    """
    values = classes.select("cid", "n", F.size("sketch").alias("kept"), F.explode("sketch").alias("v"))
    frequent = as_table(values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), work("frequent"))
    shared = values.join(frequent.hint("merge"), "v")
    own = Window.partitionBy("cid")
    needed = F.least(F.lit(_SHARED), F.ceil(F.col("n") * 0.75))
    ranked = shared.withColumns({"rank": F.row_number().over(own.orderBy("df", "v")), "found": F.count(F.lit(1)).over(own)})
    chosen = ranked.where(F.col("rank") + F.col("kept") - F.col("found") <= F.col("kept") - needed + 1)
    band = F.floor(F.log("n") / math.log(4 / 3) + 1e-9)
    return chosen.select("cid", F.explode(F.array(F.xxhash64("v", band), F.xxhash64("v", band + 1))).alias("key"))


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b), a table, whose overlap in the sketch of their union leaves a link possible."""
    side = classes.select("cid", "n", "sketch")
    left = side.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = side.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    # A leader may have very many pairs, any other class has a few lists' leaders only.
    near = join_unique(pairs, left, ["a"], ["b"]).join(right.hint("merge"), "b").where("4 * na >= 3 * nb AND 4 * nb >= 3 * na")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, K)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    return near.where(K * both >= _ESTIMATE * F.least(F.size(F.array_union("sa", "sb")), F.lit(K))).select("a", "b")


def _packed(members: np.ndarray) -> bytes:
    """Six bytes of each hash, which tell the members of two sets apart."""
    return np.unique(members & np.uint64((1 << 48) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


_PLACES = "array<struct<g:bigint,i:int,j:int,side:int>>"
_SETS = "g long, i int, j int, side int, c long, n long, members binary"
#: What a member of a place is compared as: one of those in the inverted list, one that is looked up in it, or both, which takes its set there once.
_LISTED, _BOTH, _LOOKED_UP = 0, 1, 2


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A class's whole set for every place that asks for it."""
    for batch in batches:
        for k in range(batch.num_rows):
            sides: dict[tuple[int, int, int], int] = {}
            for p in batch.column("places")[k].as_py():
                place = p["g"], p["i"], p["j"]
                sides[place] = p["side"] if sides.get(place, p["side"]) == p["side"] else _BOTH
            places = [(*place, side) for place, side in sides.items()]
            cid = batch.column("cid")[k].as_py()
            for _, data, offsets in blocks(batch.column("text").slice(k, 1)):
                whole = next(_sets(data, offsets))
            packed = _packed(whole)
            for at in range(0, len(places), 64):
                part = places[at : at + 64]
                columns = [pa.array(x, t) for x, t in zip(zip(*part), (pa.int64(), pa.int32(), pa.int32(), pa.int32()))]
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([cid] * n, pa.int64()), pa.array([len(whole)] * n, pa.int64()), pa.array([packed] * n, pa.binary())], ["g", "i", "j", "side", "c", "n", "members"]
                )


def _top(above: dict[int, int], x: int) -> int:
    """The member that stands for all that x is linked with so far."""
    while (y := above.get(x, x)) != x:
        above[x] = above.get(y, y)
        x = y
    return x


class _Place:
    """The sets that are listed in one place, as one inverted list, and what they have been linked with so far."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.sizes: list[int] = []
        self.held: list[np.ndarray] = []
        self.both: list[int] = []
        self._above: dict[int, int] = {}
        self._values: np.ndarray | None = None

    def add(self, side: int, c: int, n: int, members: np.ndarray) -> None:
        if side == _BOTH:
            self.both.append(len(self.ids))
        self.ids.append(c)
        self.sizes.append(n)
        self.held.append(members)

    def links(self, c: int, n: int, own: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links of a set with those listed, but none that would close a circle."""
        if not self.ids:
            return
        if self._values is None:
            together = np.concatenate(self.held)
            order = np.argsort(together, kind="stable")
            self._values, self._owners = together[order], np.repeat(np.arange(len(self.held)), [len(x) for x in self.held])[order]
            self._of = np.array(self.sizes)
        lo, hi = np.searchsorted(self._values, own, "left"), np.searchsorted(self._values, own, "right")
        count = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        shared = np.bincount(self._owners[at], minlength=len(self.ids))
        for k in np.flatnonzero(100 * shared >= 75 * (n + self._of - shared)).tolist():
            a, b = _top(self._above, self.ids[k]), _top(self._above, c)
            if a != b:
                self._above[a] = b
                yield self.ids[k], c

    def own_links(self) -> Iterator[tuple[int, int]]:
        """Links of those listed that are looked up too. To be asked for when all are listed."""
        for k in self.both:
            yield from self.links(self.ids[k], self.sizes[k], self.held[k])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the two sides of each place (g, i, j), whose rows follow each other, those listed first.

    Each set that is looked up counts through the inverted list what it has in common with all listed ones at once. Only links leave the task, and of
    those that would close a circle within the place none: it has fewer links than members.
    """
    at, place = None, _Place()
    for batch in batches:
        links = []
        for *key, side, c, n, members in zip(*(batch.column(x).to_pylist() for x in ("g", "i", "j", "side", "c", "n", "members"))):
            if key != at:
                links += place.own_links()
                at, place = key, _Place()
            if side == _LOOKED_UP:
                links += place.links(c, n, _unpacked(members))
            else:
                place.add(side, c, n, _unpacked(members))
        yield _linked(links)
    yield _linked(list(place.own_links()))


def _linked(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["u", "v"])


def _texts(pairs: DataFrame, docs: DataFrame, classes: DataFrame, work: Work) -> DataFrame:
    """cid, text, a table: a text of every class that is in a pair (a, b) of list members. No other is looked at again, so whole texts of the corpus are shuffled here only."""
    met = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
    wanted = met.join(classes.select("cid", "one").hint("merge"), "cid").select("cid", *(F.col(f"one.{k}").alias(f"_{k}") for k in KEY))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    found = docs.join(as_table(wanted, work("wanted")).hint("merge"), same).select(*KEY, "cid", "text")
    return as_table(found.mapInArrow(once, "doc_id long, text_hash long, cid long, text string").select("cid", "text"), work("texts"))


def _links_at(places: DataFrame, texts: DataFrame, work: Work) -> DataFrame:
    """The links, as a table (u, v), between the sides of every place; places: cid, g, i, j, side. A set is worked out once and copied to its places."""
    asked = places.groupBy("cid").agg(F.collect_list(F.struct("g", "i", "j", "side")).cast(_PLACES).alias("places"))
    found = texts.join(as_table(asked, work("asked")).hint("merge"), "cid")
    sets = found.select("cid", "text", "places").mapInArrow(_with_sets, _SETS)
    ordered = sets.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "side")
    return as_table(ordered.mapInArrow(_met, "u long, v long").distinct(), work("links"))


def _part(parts: str) -> Column:
    return F.pmod(F.xxhash64("cid"), F.col(parts)).cast("int")


def _links(pairs: DataFrame, texts: DataFrame, work: Work) -> DataFrame:
    """The pairs (a, b), a table, whose whole sets reach the threshold. A leader meets its members in parts of about _MEMBERS."""
    few = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / _MEMBERS).cast("int").alias("parts"))
    # Only leaders with several parts need to be looked up, and there are few of them.
    several = few.where("parts > 1")
    salted = join_config(pairs, several, ["a"], ["b"]).fillna(1, ["parts"]).withColumn("cid", F.col("b"))
    members = salted.select("cid", F.col("a").alias("g"), _part("parts").alias("i"), F.lit(0).alias("j"), F.lit(_LOOKED_UP).alias("side"))
    leaders = few.select(F.col("a").alias("cid"), F.col("a").alias("g"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.lit(0).alias("j"), F.lit(_LISTED).alias("side"))
    return _links_at(members.union(leaders), texts, work)


def _leaders(lists: DataFrame) -> DataFrame:
    """Every member of a list with the list's least: one pair a row."""
    least = lists.groupBy("key").agg(F.min("cid").alias("a"), F.count(F.lit(1)).alias("k")).where("k > 1").select("key", "a")
    return lists.join(least.hint("merge"), "key").where("cid <> a").select("a", F.col("cid").alias("b")).distinct()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every shingle of every class."""
    for batch in batches:
        for first, data, offsets in blocks(batch.column("text")):
            sets = list(_sets(data, offsets))
            whose = np.repeat(np.arange(first, first + len(sets)), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([batch.column("cid").take(pa.array(whose)), pa.array(np.concatenate(sets).view(np.int64))], ["cid", "shingle"])


def _held_in_common(few: DataFrame, texts: DataFrame, classes: DataFrame, work: Work) -> DataFrame:
    """cid, n, common: how many of a class's shingles any other of these classes (a table of cid) has too.

    No set shares more with one other set than it shares with all of them. So a much edited copy, most of whose partners share the same part of it, is known to have no
    link without looking at its partners one by one. Counting combines before it shuffles.
    """
    found = texts.join(few.hint("merge"), "cid", "left_semi")
    # A row that is there twice gives its shingles twice.
    members = as_table(found.mapInArrow(_members, "cid long, shingle long").distinct(), work("members"))
    twice = as_table(members.groupBy("shingle").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("shingle"), work("common"))
    common = members.join(twice.hint("merge"), "shingle", "left_semi").groupBy("cid").agg(F.count(F.lit(1)).alias("common"))
    return common.join(classes.select("cid", "n").hint("merge"), "cid")


def _once(lists: DataFrame) -> DataFrame:
    """lists, a table of key and cid among others, without those that have just the members of another.

    Copies share most of their values, so the same members meet in a list for each of them. Lists are told apart by how many members they have and by two sums
    of hashes, which combine before they are shuffled.
    """
    sums = [F.sum(F.xxhash64(*x).cast("decimal(38,0)")) for x in (["cid"], [F.lit(1), "cid"])]
    of = lists.groupBy("key").agg(F.count(F.lit(1)).alias("k"), sums[0].alias("x"), sums[1].alias("y"))
    stay = of.groupBy("k", "x", "y").agg(F.min("key").alias("key")).where("k > 1").select("key")
    return lists.join(stay.hint("merge"), "key", "left_semi")


def _rest(lists: DataFrame, labels: DataFrame, texts: DataFrame, classes: DataFrame, work: Work) -> DataFrame:
    """Links, as a table (u, v), among a list's members that are not in one component yet, and that have enough in common with others to be linked.

    Those outside the list's largest component meet all members, block by block of either side: no pair is a row, and each place holds _MEMBERS sets about. Of lists
    with the same members one is worked on.
    """
    labelled = lists.join(labels.hint("merge"), F.col("cid") == F.col("node"), "left").select("key", "cid", F.coalesce("label", "cid").alias("label"))
    sizes = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"))
    mixed_ = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("labels")).where("labels > 1").select("key")
    labelled = as_table(labelled.join(mixed_.hint("merge"), "key"), work("mixed"))
    common = _held_in_common(labelled.select("cid").distinct(), texts, classes, work).where("4 * common >= 3 * n").select("cid")
    able = as_table(labelled.join(as_table(common, work("able")).hint("merge"), "cid"), work("able"))
    able = as_table(_once(able), work("once"))
    left = able.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"))
    parts = [F.ceil(x / _MEMBERS).cast("int") for x in (F.sum("k") - F.max("k"), F.sum("k"))]
    blocks_ = left.groupBy("key").agg(F.max(F.struct("k", "label"))["label"].alias("most"), parts[0].alias("few"), parts[1].alias("all")).where("few > 0")
    placed = as_table(join_unique(able, as_table(blocks_, work("blocks")), ["key"], ["cid"]).where("few IS NOT NULL"), work("placed"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    listed = placed.select("cid", F.col("key").alias("g"), every("few").alias("i"), _part("all").alias("j"), F.lit(_LISTED).alias("side"))
    looked_up = placed.where("label <> most").select("cid", F.col("key").alias("g"), _part("few").alias("i"), every("all").alias("j"), F.lit(_LOOKED_UP).alias("side"))
    return _links_at(listed.union(looked_up), texts, work)


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct runs of five words (ASCII white space parts words, A-Z lower-cased), or the whole sequence if it is shorter.
    Documents are linked if their sets' Jaccard similarity is 0.75 or more, by exact count; component_id is the least doc_id that links lead to.

    Equal sets are one class from the start. Inverted lists of retained values give candidates: first every member with its list's least, which joins most copies of
    a group without making pairs of them all, and of which the sketch of a pair's union drops some; then members of one list that are still in different components meet in
    blocks. Whole sets confirm all links.

    A null, empty or blank text has an empty set and is linked with nothing; a null doc_id takes part in links, but a component is named by an id if it has one;
    rows with one doc_id are one document as to `kept`; other columns are ignored; an empty table gives no rows.
    """
    spark, numbers = docs.sparkSession, itertools.count()
    root = new_folder(spark, "minhash")

    def work(name: str) -> str:
        return f"{root}/{next(numbers)}-{name}"

    docs = keyed(docs)
    schema = "doc_id long, text_hash long, n long, cid long, sketch array<long>"
    sketched = as_table(docs.mapInArrow(_sketched, schema), work("sketches"))
    classes = sketched.where("n > 0").groupBy("cid").agg(
        F.min("n").alias("n"), F.any_value("sketch").alias("sketch"), F.min(F.struct(*KEY)).alias("one"), F.min("doc_id").alias("least")
    )
    classes = as_table(classes, work("classes"))
    lists = as_table(_posted(classes, work), work("lists"))
    pairs = as_table(_leaders(lists), work("pairs"))
    texts = _texts(pairs, docs, classes, work)
    links = _links(as_table(_estimated(pairs, classes), work("pairs")), texts, work)
    more = _rest(lists, as_table(components(links), work("labels")), texts, classes, work)
    labels = as_table(components(links.union(more)), work("labels"))
    named = classes.select("cid", "least").join(labels.hint("merge"), F.col("cid") == F.col("node"), "left").select("cid", "least", F.coalesce("label", "cid").alias("label"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = as_table(named.join(names.hint("merge"), "label").select("cid", "component_id"), work("names"))
    filled = sketched.where("n > 0").select("doc_id", "n", "cid").join(ids.hint("merge"), "cid")
    empty = sketched.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    rows = filled.select("doc_id", "n", "component_id").union(empty)
    kept: Column = F.col("doc_id").eqNullSafe(F.col("component_id"))
    out = as_table(rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept")), new_folder(spark, "groups"))
    Folder(spark, root).remove()
    return out


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay: of each group those with its least doc_id, with all columns."""
    kept = groups(docs).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    kept = as_table(kept, new_folder(docs.sparkSession, "kept"))
    return docs.join(kept.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")), "left_semi")
