"""Phrases, fingerprints and the prefix trie against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from waybill.llm import collocations, fingerprints, prefix_trie
from waybill.llm.double_array import DoubleArray, TooLarge

# --- 11 phrases ------------------------------------------------------------------------------------------------


def plain_phrases(docs, least, top):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        frequent = {p: a for p, a in found.items() if a >= least and len(p) > 1}
        inner = set()
        for p, a in frequent.items():
            inner |= {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= 100 * found[p[i:j]]}
        scored = []
        for p, a in frequent.items():
            cuts = [(1000 * a * sizes[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in inner:
                scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, n, p.decode(), -a, left, right, sizes[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def phrase_docs():
    rng = random.Random(5)
    words = ["the", "The", "of", "new", "york", "city", "café", "x.y", "a", "b", "c", "q\x0br", "-"]
    docs = []
    for _ in range(150):
        text = "".join(rng.choice(["new york city hall ", "of the ", "a b a b a b ", rng.choice(words) + " ", ". ", ", ", "\t", "\n", "? "]) for _ in range(rng.randrange(60)))
        docs.append((text, rng.choice(["en", "en", "fr", None, "und", ""])))
    return docs + [(None, "en"), ("", None), ("word " * 300, "en"), (" \t.\n", "fr"), ("alone", "xx")] + [("same row again", "en")] * 30


@pytest.mark.parametrize("trie_phrases,vocabulary,held", [(1 << 20, 1 << 26, 1 << 22), (3, 60, 50)])
def test_phrases(spark, monkeypatch, trie_phrases, vocabulary, held):
    """Also with several tries, several blocks of words and sums handed on early."""
    monkeypatch.setattr(collocations, "LEAST", 12)
    monkeypatch.setattr(collocations, "TOP", 40)
    monkeypatch.setattr(collocations, "TRIE_PHRASES", trie_phrases)
    monkeypatch.setattr(collocations, "VOCABULARY_BYTES", vocabulary)
    monkeypatch.setattr(collocations, "_HELD", held)
    docs = phrase_docs()
    df = spark.createDataFrame(docs, "text string, lang string").selectExpr("*", "'x' AS n", "'y' AS word", "'z' AS codes", "0 AS id")
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = rows(collocations.collocations(df), *columns)
    assert got == plain_phrases(docs, 12, 40) and len({r[0] for r in got}) >= 3


def test_phrases_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert rows(collocations.collocations(none), "phrase") == []
    assert rows(collocations.collocations(spark.createDataFrame([("few words here", "en")], "text string, lang string")), "phrase") == []


def test_scores_beyond_64_bits(spark):
    big = 4 * 10**15
    phrases = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)], "lang string, phrase string, words int, a long")
    sizes = spark.createDataFrame([("en", 9 * 10**15)], "lang string, n long")
    row = collocations._scored(phrases, sizes).first()
    assert row.score == 1000 * (big - 1) * 9 * 10**15 // (big * big)


def test_double_array_accepts_what_it_was_made_of():
    rng = np.random.default_rng(3)
    made = {tuple(rng.integers(1, 60, rng.integers(1, 6)).tolist()) for _ in range(3000)} | {(1, k) for k in range(1, 5000, 7)}
    table = np.array(sorted(p + (0,) * (5 - len(p)) for p in made))
    trie = DoubleArray.build(table)
    text = rng.integers(0, 60, 4000)
    got = Counter()
    for _, states in trie.walk(text, 5):
        number = trie.accepts[states]
        got.update(number[number >= 0].tolist())
    want = Counter()
    places = {p: k for k, p in enumerate(map(tuple, table.tolist()))}
    for at in range(len(text)):
        for k in range(1, 6):
            p = tuple(text[at : at + k].tolist())
            if len(p) == k and p in made:
                want[places[p + (0,) * (5 - k)]] += 1
    assert got == want
    assert DoubleArray.build(np.zeros((0, 5), np.int64)).walk(text, 2) is not None


def wide_pairs():
    """40 nodes with 500 children each, far apart."""
    rng = np.random.default_rng(7)
    return np.array([(1 + p, c) for p in range(40) for c in np.sort(rng.choice(np.arange(1, 400_000), 500, replace=False))])


def test_double_array_of_children_far_apart_is_small():
    table = wide_pairs()
    trie = DoubleArray.build(table)
    assert trie.nbytes <= 64 * len(table)
    (_, _), (places, states) = trie.walk(table.flatten(), 2)
    assert trie.accepts[states][places % 2 == 0].tolist() == list(range(len(table)))


def test_double_array_is_given_up_where_it_grows_beyond_its_bytes():
    table = wide_pairs()
    whole = DoubleArray.build(table).nbytes
    assert DoubleArray.build(table, whole).nbytes == whole
    tracemalloc.start()
    with pytest.raises(TooLarge):
        DoubleArray.build(table, whole // 8)
    assert tracemalloc.get_traced_memory()[1] < 4 * whole
    tracemalloc.stop()


def test_tries_together_have_all_phrases(spark, monkeypatch):
    """Of a bound in bytes that only a part of the phrases keeps."""
    table = wide_pairs()[::4]
    monkeypatch.setattr(collocations, "TRIE_BYTES", 64 * len(table) // 4)
    phrases = spark.createDataFrame([(k, list(map(int, p))) for k, p in enumerate(table, 1)], "id long, codes array<int>")
    made = list(collocations._tries(phrases, 2))
    assert len(made) > 1 and max(trie.nbytes for trie, _, _ in made) <= collocations.TRIE_BYTES and not any(alone for _, _, alone in made)
    assert sorted(np.concatenate([ids for _, ids, _ in made]).tolist()) == list(range(1, len(table) + 1))
    for at, pair in list(enumerate(table, 1))[::200]:
        found = [ids[trie.accepts[states]].tolist() for trie, ids, _ in made for places, states in list(trie.walk(pair, 2))[1:] if len(places)]
        assert found == [[at]]
    assert [alone for *_, alone in collocations._tries(phrases.where("id <= 20"), 2)] == [True]


def test_counts_come_from_fewer_tasks_than_there_are_parts(spark):
    """A task hands on a count for each phrase, so there are fewer tasks where there are many phrases."""
    codes = spark.range(200, numPartitions=100)
    parts = lambda words, phrases: collocations._fewer_tasks(codes, words, phrases).rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    assert [parts(64 * 1000 * 50, n) for n in (0, 100, 1000, 2000, 10**9)] == [100, 100, 50, 25, cores]
    assert parts(0, 0) == cores


# --- 12 fingerprints -------------------------------------------------------------------------------------------


def paragraphs(text):
    return {p for p in re.split(r"\n|(?<=[.!?]) (?=[A-E])", text) if p.strip(" ")}


def jaccard(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def plain_fingerprints(docs):
    ordered = sorted(docs, key=lambda d: -d[0])
    out = {}
    for k, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        near = [round(jaccard(paragraphs(text), paragraphs(x)), 9) for x in (edited, following)]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), *near)
    return out


@pytest.mark.parametrize("block_bytes", [1 << 26, 2000])
def test_fingerprints(spark, corpus, monkeypatch, block_bytes):
    monkeypatch.setattr(fingerprints, "_BLOCK_BYTES", block_bytes)
    rng = random.Random(2)
    long = "\n".join(f"Line {rng.randrange(10**9)}. And more. Big {k}" for k in range(3000))
    docs = [*corpus, (900, long), (901, long), (902, "one\ntwo"), (-5, "negative")]
    got = fingerprints.fingerprints(frame(spark, docs)).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got} == plain_fingerprints(docs)
    texts, by_text = {i: t or "" for i, t in docs}, defaultdict(set)
    for r in got:
        by_text[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values()) and len({f for x in by_text.values() for f in x}) > 50


def test_ids_with_many_rows(spark, monkeypatch):
    """Null and repeated ids are divided over blocks by a hash of the text, and still every row has one successor: each text is edited once into another."""
    monkeypatch.setattr(fingerprints, "_BLOCK_BYTES", 500)
    docs = [(None, f"null {k}") for k in range(60)] + [(7, f"seven {k}") for k in range(60)] + [(k, f"own {k}") for k in range(20, 60)] + [(8, "same")] * 5
    got = fingerprints.fingerprints(frame(spark, docs)).collect()
    assert len(got) == len(docs)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in docs)
    # The last half comes from the next row, so all rows but copies are edited differently.
    assert sum(r.doc_id == 8 and r.near_next == 1.0 for r in got) == 4


def test_few_or_no_documents(spark):
    assert fingerprints.fingerprints(frame(spark, [])).collect() == []
    alone = fingerprints.fingerprints(frame(spark, [(1, "abc")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"aba").hexdigest() and alone.near_next == 1.0
    blank = fingerprints.fingerprints(frame(spark, [(1, None), (2, "")])).collect()
    assert [(r.near_edited, r.near_next) for r in blank] == [(1.0, 1.0)] * 2


def test_sketches_give_differences_away(spark):
    """Peeling against set differences; what is too large is left, not wrong."""
    rng = random.Random(9)
    cases = []
    for n in (0, 1, 2, 5, 9, 40):
        common, a, b = ([rng.getrandbits(63) for _ in range(k)] for k in (30, n, n // 2))
        cases.append((common + a, common + b, len(a) + len(b)))
    df = spark.createDataFrame(cases, "a array<bigint>, b array<bigint>, n int")
    peel = fingerprints._peeled(fingerprints._minus(fingerprints._sketch("a"), fingerprints._sketch("b")))
    for r in df.withColumn("peel", F.expr(peel)).withColumn("done", F.expr(fingerprints._empty("peel.cells"))).collect():
        found = {(f.key, f.n) for f in r.peel.found}
        assert found <= {(d, 1) for d in set(r.a) - set(r.b)} | {(d, -1) for d in set(r.b) - set(r.a)}
        assert r.done == (len(found) == r.n) and (r.done or r.n > 10)


# --- 13 prefix trie --------------------------------------------------------------------------------------------


def plain_trie(turns):
    own = defaultdict(list)
    order = sorted((t for t in turns if t[0] is not None), key=lambda t: (t[1] is not None, t[1] or 0))
    for conv, _, role, text in order:
        own[conv].append((role or "", text or ""))
    members = defaultdict(list)
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = tuple(own[base][:h] if base in own else []) + tuple(own[c][h:])
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)

    def below(node):
        leaves, saved = (0 if kids[node] else 1), (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for child in kids[node]:
            a, b = below(child)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for node, convs in members.items():
        leaves, saved = below(node)
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(kids[node]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def turns_of(seed, convs):
    rng = random.Random(seed)
    out = []
    for c in convs:
        same = rng.random() < 0.4
        for t in range(rng.randrange(9)):
            out.append((c, None if t == 0 and rng.random() < 0.2 else t, rng.choice(["user", "assistant", None]) if not same else "user", None if rng.random() < 0.1 else (f"t{t}" if same else rng.choice(["yes", "nö", "", "long " * 5]))))
    return out


def chats(spark, data):
    return spark.createDataFrame(data, TURNS).selectExpr("*", "'x' AS depth", "'y' AS head", "'z' AS f1", "0 AS pos")


@pytest.mark.parametrize("blocks", [4096, 2])
def test_trie(spark, monkeypatch, blocks):
    """With conversations that go on over file parts, blocks of two depths, and lists of ends in several pieces."""
    monkeypatch.setattr(prefix_trie, "_DEPTHS", blocks)
    data = turns_of(1, [*range(60), *range(100, 140), *range(-20, 0), 777, 10**12]) + [(300, t, "user", f"deep {t % 7}") for t in range(90)] + [(301, t, "user", f"deep {t % 7}") for t in range(80)]
    data += [(None, 0, "user", "nobody's"), (500, 1, "a", "x"), (500, 2, "a", "x"), (500, 3, "a", "x")]
    assert rows(prefix_trie.trie(chats(spark, data)), *NODE) == plain_trie(data)


def test_prefixes_taken_for_one_are_told_apart(spark, monkeypatch):
    """Bases of nought forget all turns but the last: the check of each group has to find that, and other bases are taken."""
    real, used = prefix_trie._bases, []
    monkeypatch.setattr(prefix_trie, "_bases", lambda attempt: used.append(attempt) or ((0, 0) if attempt < 2 else real(attempt)))
    data = turns_of(4, range(30))
    assert rows(prefix_trie.trie(chats(spark, data)), *NODE) == plain_trie(data)
    assert used == [0, 1, 2]


def test_no_conversations_and_many_equal_ones(spark):
    assert prefix_trie.trie(chats(spark, [])).collect() == []
    data = [(c, 0, "user", "hi") for c in range(200, 300)] + [(c, 1, "user", "again") for c in range(200, 300, 2)]
    assert rows(prefix_trie.trie(chats(spark, data)), *NODE) == plain_trie(data)


def test_fingerprints_combine(spark):
    bases = prefix_trie._bases(0)
    turns = [(k * 77 + 5, k * 31 + 2, 1) for k in range(7)]

    def together(parts):
        out = (0, 0, 0)
        for p in parts:
            out = prefix_trie.combine(out, p, bases)
        return out

    assert prefix_trie.combine(together(turns[:3]), together(turns[3:]), bases) == together(turns)
