"""The prefix trie of conversations that start with the head of another one, from fingerprints that are combined and never from rebuilt texts.

A sequence of turns has the element (v, n): n turns, and v = sum of digest * base^(turns behind it) modulo a prime. Elements of sequences that follow each
other combine to (v * base^m + w, n + m), so the element of a rebuilt conversation is put together from that of another one's head, those of its own runs of turns before,
and that of the run at hand. Two bases and 120 bits of SHA-256 a turn are kept apart, so a prefix has 122 bits. Groups of equal prefixes are verified: the turns that its
members refer to last and the groups they come from must be one each. If they are not, all is done again with other bases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from waybill.operators.lookup import join_unique
from waybill.storage import Folder, as_table, new_folder

PRIME = (1 << 61) - 1
#: Turns that a conversation may take over, less one: so many heads are told apart.
HEADS = 6
#: Conversations that share the head of one.
FAMILY = 100
#: Depths that are dealt with together, so that a very long conversation is in many places.
_DEPTHS = 4096
#: Conversation ids that are written into one piece of the list of a node's ends.
_ENDS = 4096
_NODE = ["depth", "f1", "f2"]
_MEMBER = "conv_id long, depth long, f1 long, f2 long, q1 long, q2 long, d1 long, d2 long, chars long, last boolean"

Bases = tuple[int, int]


def _bases(attempt: int) -> Bases:
    low, high = np.random.default_rng(61 + attempt).integers(1 << 40, PRIME, 2)
    return int(low), int(high)


def combine(left: tuple[int, int, int], right: tuple[int, int, int], bases: Bases) -> tuple[int, int, int]:
    """The element (v under the first base, v under the second, turns) of one sequence behind another."""
    (a, b, n), (c, d, m) = left, right
    return (a * pow(bases[0], m, PRIME) + c) % PRIME, (b * pow(bases[1], m, PRIME) + d) % PRIME, n + m


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, mid, d1, d2, chars: digests of turns in order; mid counts within the file part in its upper bits."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *(F.conv(F.substring(whole, at, 15), 16, 10).cast("long").alias(d) for d, at in (("d1", 1), ("d2", 16))),
        F.char_length(text).cast("long").alias("chars"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("d1"), F.col("d2")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("conv_id", F.monotonically_increasing_id().alias("mid"), "d1", "d2", "chars")


def _runs(turns: DataFrame) -> DataFrame:
    """conv_id, pid, first, before, turns, own: where a conversation's turns are in each file part, and how many there are before and altogether.

    A conversation that is in one part only is the rule; a very long one has as many rows as parts.
    """
    runs = turns.groupBy("conv_id", F.shiftright("mid", 33).alias("pid")).agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("n"))
    conv = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("n").over(conv.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return runs.select("conv_id", "pid", "first", before.alias("before"), F.sum("n").over(conv).alias("turns"), F.count(F.lit(1)).over(conv).alias("parts"), _head_of("conv_id").alias("h"))


def _head_of(conv: str) -> Column:
    return F.crc32(F.col(conv).cast("string")) % HEADS


def _placed(turns: DataFrame, runs: DataFrame) -> DataFrame:
    """Turns with their place in the conversation (from 1) and what is known of their run."""
    rows = turns.withColumn("pid", F.shiftright("mid", 33)).join(runs, ["conv_id", "pid"])
    return rows.withColumn("pos", F.col("mid") - F.col("first") + F.col("before") + 1).drop("mid", "first", "before")


def _by_run(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[tuple]]:
    for batch in batches:
        yield list(zip(*(batch.column(c).to_pylist() for c in columns)))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


_TOTAL = "conv_id long, pid long, v1 long, v2 long, n long"


def _totals(bases: Bases):
    """The element of each run's own turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, v1, v2, n = None, 0, 0, 0
        for rows in _by_run(batches, ["conv_id", "pid", "d1", "d2"]):
            done = []
            for conv, pid, d1, d2 in rows:
                if key != (conv, pid):
                    if key:
                        done.append((*key, v1, v2, n))
                    key, v1, v2, n = (conv, pid), 0, 0, 0
                v1, v2, n = (v1 * bases[0] + d1) % PRIME, (v2 * bases[1] + d2) % PRIME, n + 1
            yield _batch(done, _TOTAL)
        if key:
            yield _batch([(*key, v1, v2, n)], _TOTAL)

    return run


_START = "conv_id long, pid long, s1 long, s2 long, above long"


def _starts(bases: Bases):
    """What goes before each run's own turns in the rebuilt conversation: the head taken over, then the runs before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, element = None, (0, 0, 0)
        for rows in _by_run(batches, ["conv_id", "pid", "head", "v1", "v2", "n"]):
            done = []
            for conv, pid, head, v1, v2, n in rows:
                if conv != last:
                    last, element = conv, (0, 0, 0)
                    for turn in head or ():
                        element = combine(element, (turn["d1"], turn["d2"], 1), bases)
                done.append((conv, pid, *element))
                if n:
                    element = combine(element, (v1, v2, n), bases)
            yield _batch(done, _START)

    return run


def _heads(bases: Bases):
    """The root and the nodes of the head of each rebuilt conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_run(batches, ["conv_id", "head", "own"]):
            done = []
            for conv, head, own in rows:
                head = head or []
                done.append((conv, 0, 0, 0, 0, 0, 0, 0, 0, not head and not own))
                element = (0, 0, 0)
                for k, turn in enumerate(head, 1):
                    after = combine(element, (turn["d1"], turn["d2"], 1), bases)
                    done.append((conv, k, *after[:2], *element[:2], turn["d1"], turn["d2"], turn["chars"], k == len(head) and not own))
                    element = after
            yield _batch(done, _MEMBER)

    return run


def _tails(bases: Bases):
    """The nodes of each rebuilt conversation's own turns, run by run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, v1, v2, depth = None, 0, 0, 0
        for rows in _by_run(batches, ["conv_id", "pid", "d1", "d2", "chars", "last", "s1", "s2", "above"]):
            done = []
            for conv, pid, d1, d2, chars, last, s1, s2, above in rows:
                if key != (conv, pid):
                    key, v1, v2, depth = (conv, pid), s1, s2, above
                q1, q2 = v1, v2
                v1, v2, depth = (v1 * bases[0] + d1) % PRIME, (v2 * bases[1] + d2) % PRIME, depth + 1
                done.append((conv, depth, v1, v2, q1, q2, d1, d2, chars, last))
            yield _batch(done, _MEMBER)

    return run


def _members(turns: DataFrame, runs: DataFrame, bases: Bases, folders: list[str]) -> DataFrame:
    """One row for every rebuilt conversation and each of its prefixes."""
    spark = turns.sparkSession
    rows = _placed(turns, runs)
    taken = rows.where(f"conv_id % {FAMILY} = 0 AND pos < {HEADS}").groupBy(F.col("conv_id").alias("base"))
    taken = taken.agg(F.sort_array(F.collect_list(F.struct("pos", "d1", "d2", "chars"))).alias("head"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = runs.where("before = 0").select("conv_id", "turns", "h", base.alias("base")).join(taken, "base", "left")
    # slice() needs a positive length, so a head of none is no array.
    convs = convs.select("conv_id", F.when(F.col("h") > 0, F.slice("head", 1, F.greatest("h", F.lit(1)))).alias("head"), (F.col("turns") > F.col("h")).alias("own"))
    convs = as_table(convs, _new(spark, folders, "convs"))

    # Runs of conversations that go on over file parts are multiplied up first; there are few of them.
    split = rows.where("parts > 1 AND pos > h").select("conv_id", "pid", "pos", "d1", "d2")
    split = split.repartition("conv_id", "pid").sortWithinPartitions("conv_id", "pid", "pos").mapInArrow(_totals(bases), _TOTAL)
    known = runs.select("conv_id", "pid").join(split, ["conv_id", "pid"], "left").join(convs.select("conv_id", "head"), "conv_id")
    starts = known.repartition("conv_id").sortWithinPartitions("conv_id", "pid").mapInArrow(_starts(bases), _START)
    starts = as_table(starts, _new(spark, folders, "starts"))

    own = rows.where("pos > h").withColumn("last", F.col("pos") == F.col("turns")).join(starts, ["conv_id", "pid"])
    own = own.select("conv_id", "pid", "pos", "d1", "d2", "chars", "last", "s1", "s2", "above")
    tails = own.repartition("conv_id", "pid").sortWithinPartitions("conv_id", "pid", "pos").mapInArrow(_tails(bases), _MEMBER)
    return tails.union(convs.mapInArrow(_heads(bases), _MEMBER))


def _nodes(members: DataFrame) -> DataFrame:
    """Groups of equal prefixes, with the range of what has to be one."""
    ranges = [f(c).alias(f"{n}_{c}") for c in ("q1", "q2", "d1", "d2") for n, f in (("least", F.min), ("most", F.max))]
    return members.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), *ranges)


def _new(spark: SparkSession, folders: list[str], name: str) -> str:
    folders.append(new_folder(spark, f"trie-{name}"))
    return folders[-1]


def _verified(turns: DataFrame, runs: DataFrame, folders: list[str]) -> tuple[DataFrame, DataFrame]:
    """Members and nodes under the first bases that take no two prefixes for one."""
    spark = turns.sparkSession
    attempt = 0
    while True:
        members = as_table(_members(turns, runs, _bases(attempt), folders), _new(spark, folders, "members"))
        mixed, seen = [F.col(f"least_{c}") != F.col(f"most_{c}") for c in ("q1", "q2", "d1", "d2")], Observation()
        nodes = _nodes(members).observe(seen, F.count_if(mixed[0] | mixed[1] | mixed[2] | mixed[3]).alias("mixed"))
        nodes = nodes.select(*_NODE, "conv_id", "n_convs", "chars", F.col("least_q1").alias("q1"), F.col("least_q2").alias("q2"))
        nodes = as_table(nodes, _new(spark, folders, "nodes"))
        if not seen.get["mixed"]:
            return members, nodes
        attempt += 1


_PIECE = "depth long, f1 long, f2 long, first long, ids string"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of ordered rows in pieces, node by node."""
    for rows in _by_run(batches, [*_NODE, "conv_id"]):
        done, key, ids = [], None, []
        for *node, conv in rows:
            if node != key or len(ids) == _ENDS:
                if ids:
                    done.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids = node, []
            ids.append(conv)
        if ids:
            done.append((*key, ids[0], ",".join(map(str, ids))))
        yield _batch(done, _PIECE)


_ENDING = "depth long, f1 long, f2 long, ends_sha256 string"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, hashlib.sha256()
    for rows in _by_run(batches, [*_NODE, "ids"]):
        done = []
        for *node, ids in rows:
            if node != key:
                if key:
                    done.append((*key, digest.hexdigest()))
                key, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _batch(done, _ENDING)
    if key:
        yield _batch([(*key, digest.hexdigest())], _ENDING)


def _ends(members: DataFrame) -> DataFrame:
    """The digest of each node's list of conversations that end there. A digest is sequential: one task reads a node's list, in pieces of some thousand ids."""
    rows = members.where("last").select(*_NODE, "conv_id")
    pieces = rows.repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id").mapInArrow(_listed, _PIECE)
    return pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(_digested, _ENDING)


def _block(depth: str) -> Column:
    return F.floor(F.col(depth) / _DEPTHS)


def _saved_above(tree: DataFrame) -> DataFrame:
    """_NODE, above: what a node's conversation saves in its nodes of lesser depth, of those it is the least member of. Long conversations are summed up block by block."""
    conv = Window.partitionBy("conv_id")
    own = tree.where("n_convs > 1").withColumn("block", _block("depth"))
    sums = own.groupBy("conv_id", "block").agg(F.sum("saved").alias("s"))
    sums = sums.select("conv_id", "block", F.coalesce(F.sum("s").over(conv.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    here = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return own.join(sums, ["conv_id", "block"]).select(*_NODE, (F.col("before") + F.coalesce(F.sum("saved").over(here), F.lit(0))).alias("above"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation c is rebuilt as the first h turns of conversation c - c % 100 and its own turns after its first h, with h = crc32(decimal c) % 6. A node is a
    distinct sequence of first turns, its members are the conversations that start with it, conv_id is the least of them.

    Turns are in order of `turn`, nulls first, equal ones by a digest of role and text; null roles and texts are empty; repeated rows are turns of their own;
    rows without conv_id are of no conversation and left out; other columns are ignored; an empty table gives no rows.

    Sums over a subtree come from members, not from walking the tree: each node is charged to its least member, so a node's sum is what all its members were charged,
    less what the least one was charged above it.
    """
    spark, folders = conversations.sparkSession, []
    turns = as_table(_turns(conversations), _new(spark, folders, "turns"))
    runs = as_table(_runs(turns), _new(spark, folders, "runs"))
    members, nodes = _verified(turns, runs, folders)

    parents = F.col("depth") - 1
    kids = nodes.where("depth > 0").groupBy(parents.alias("depth"), F.col("q1").alias("f1"), F.col("q2").alias("f2")).agg(F.count(F.lit(1)).alias("n_children"))
    widest, saved = Observation(), F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)
    tree = nodes.join(kids.hint("merge"), _NODE, "left").fillna(0, ["n_children"]).withColumn("saved", saved)
    tree = as_table(tree.observe(widest, F.max("n_children").alias("most")), _new(spark, folders, "tree"))

    charged = tree.groupBy("conv_id").agg(F.sum("saved").alias("charge"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    deepest = members.where("last").select("conv_id", _block("depth").alias("deepest"))
    # One row for every few thousand depths of a conversation, so a very long one is joined in many places.
    charged = deepest.join(charged.select("conv_id", "charge", "leaf").hint("merge"), "conv_id", "left").fillna(0, ["charge", "leaf"])
    charged = charged.select("conv_id", "charge", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), "deepest")).alias("block"))
    sums = members.select(*_NODE, "conv_id", _block("depth").alias("block")).join(charged.hint("merge"), ["conv_id", "block"])
    sums = sums.groupBy(*_NODE).agg(F.sum("charge").alias("charge"), F.sum("leaf").alias("n_leaves"))
    sums = as_table(sums, _new(spark, folders, "sums"))

    owner = tree.select(F.col("depth").alias("_depth"), F.col("f1").alias("q1"), F.col("f2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    named = join_unique(tree.withColumn("_depth", parents), owner, ["_depth", "q1", "q2"], ["conv_id"], widest.get["most"] or 0)
    rows = named.join(sums.hint("merge"), _NODE).join(_saved_above(tree).hint("merge"), _NODE, "left").join(_ends(members).hint("merge"), _NODE, "left")
    result = rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.when(F.col("n_convs") > 1, F.col("charge") - F.col("above")).otherwise(0).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    out = as_table(result, new_folder(spark, "trie"))
    for path in folders:
        Folder(spark, path).remove()
    return out
