from __future__ import annotations

import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from helpers import frame, rows, sentence

from waybill.llm import minhash, repeats, substring_dedup, suffix_dedup
from waybill.llm.components import components
from waybill.llm.suffix_sort import Suffixes

BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")
GROUPS = ("doc_id", "n_shingles", "component_id", "kept")


def same(got, want):
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("window", [12, 35])
def test_repeated_words_go(spark, corpus, window):
    same(rows(substring_dedup.remove(frame(spark, corpus), window), *WORDS), plain.word_dedup(corpus, window))


@pytest.mark.parametrize(("length", "hot"), [(64, 1000), (200, 1000), (64, 3), (200, 0)])
def test_repeated_bytes_go(spark, corpus, length, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    same(rows(suffix_dedup.remove(frame(spark, corpus), length), *BYTES), plain.byte_dedup(corpus, length))


def test_near_duplicates_are_grouped(spark, corpus):
    same(rows(minhash.groups(frame(spark, corpus)), *GROUPS), plain.near(corpus))


def test_chains_of_near_duplicates(spark):
    """Every text is linked with the next ones only, so a group holds together by many links of its own."""
    rng = random.Random(3)
    words = [f"c{rng.randrange(10**6)}" for _ in range(400)]
    docs = [(k, " ".join(words[4 * k : 4 * k + 100])) for k in range(60)] + [(100 + k, sentence(rng, 50)) for k in range(20)]
    same(rows(minhash.groups(frame(spark, docs)), *GROUPS), plain.near(docs))


def test_rows_that_repeat_or_lack_ids(spark):
    rng = random.Random(5)
    text = sentence(rng, 90)
    docs = [(1, text), (1, text), (None, text), (None, None), (2, sentence(rng, 90)), (2, sentence(rng, 90))]
    same(rows(substring_dedup.remove(frame(spark, docs)), *WORDS), plain.word_dedup(docs, 35))
    same(rows(suffix_dedup.remove(frame(spark, docs)), *BYTES), plain.byte_dedup(docs, 200))
    got = rows(minhash.groups(frame(spark, docs)), *GROUPS)
    assert got.count((1, 86, 1, True)) == 2 and (None, 86, 1, False) in got and (None, 0, None, True) in got


def test_a_row_that_is_there_very_often(spark, monkeypatch):
    """Its array of spans stays within its own symbols, and one copy a task is compared with other texts."""
    rng = random.Random(8)
    text, other = sentence(rng, 350), sentence(rng, 60)
    shared = " ".join(text.split()[100:180])
    docs = [(None, text)] * 300 + [(1, f"{other} {shared} {sentence(rng, 60)}"), (2, sentence(rng, 90))]
    made, compared, by_document = [], [], repeats.by_document
    monkeypatch.setattr(repeats, "by_document", lambda *a: made.append((a[2], by_document(*a))) or made[-1][1])
    same(rows(substring_dedup.remove(frame(spark, docs)), *WORDS), plain.word_dedup(docs, 35))
    same(rows(suffix_dedup.remove(frame(spark, docs)), *BYTES), plain.byte_dedup(docs, 200))
    sizes = [max(len(r.spans or ()) for r in table.select("spans").collect()) for how, table in made if how == "left"]
    assert len(sizes) == 2 and sizes[0] <= 350 and sizes[1] <= 350
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([None, 1, None, 1], pa.int64()), "text_hash": pa.array([5, 5, 5, 6], pa.int64())})
    for part in repeats.once(iter([batch, batch])):
        compared += zip(*(part.column(c).to_pylist() for c in repeats.KEY))
    assert compared == [(None, 5), (1, 5), (1, 6)]


def test_no_rows(spark):
    for op in (substring_dedup.remove, suffix_dedup.remove, minhash.groups, minhash.representatives):
        assert op(frame(spark, [])).count() == 0


def test_one_representative_stays_with_all_columns(spark, corpus):
    docs = frame(spark, corpus)
    kept = minhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, _, k in plain.near(corpus) if k)


def test_suffix_order_and_collisions(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    at, depth = np.arange(0, 2900), 20
    group = at % 3
    want = sorted(range(len(at)), key=lambda k: (group[k], data[at[k] : at[k] + depth].tobytes()))
    got = Suffixes(data, depth).sort(at, group)
    text = [(group[k], data[at[k] : at[k] + depth].tobytes()) for k in range(len(at))]
    assert [text[k] for k in got] == [text[k] for k in want]
    # With hashes that call everything equal, only the bytes decide.
    blind = Suffixes(data, depth)
    monkeypatch.setattr(blind, "common", lambda a, b: np.full(len(a), depth))
    seen = {}
    for k, t in enumerate(text):
        seen.setdefault(t, []).append(k)
    assert blind.repeated(at, group).tolist() == [len(seen[t]) > 1 for t in text]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + k, 1001 + k) for k in range(40)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    assert all(got.get(x, x) == y for x, y in label.items())


def test_a_hot_passage_is_not_gathered(spark):
    """Counting combines before it shuffles, and joins stay between plain exchanges, which Spark can split."""
    docs = repeats.keyed(frame(spark, [(k, "the same passage " * 30) for k in range(50)]))
    plan = docs.mapInArrow(suffix_dedup._stretches(200), repeats.STRETCH).groupBy("anchor").count()._jdf.queryExecution().toString()
    assert plan.count("partial_count") >= 1


def test_many_edited_copies_around_the_threshold(spark, monkeypatch):
    """Members of one list that are not linked with its least meet in blocks; no link is lost and none made up."""
    monkeypatch.setattr(minhash, "_MEMBERS", 40)
    rng = random.Random(17)
    base = sentence(rng, 150, 10**6).split()
    docs = []
    for k in range(400):
        own = list(base)
        for _ in range(rng.randrange(14)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(40)}"
        docs.append((k, " ".join(own)))
    same(rows(minhash.groups(frame(spark, docs)), *GROUPS), plain.near(docs))


def morse(n, a, b):
    """The Thue-Morse word of 2^n symbols: polynomials modulo a power of two take it and its complement for one, whatever the base."""
    return "".join(b if bin(k).count("1") % 2 else a for k in range(1 << n))


def test_texts_made_to_collide(spark):
    one, other = morse(11, "a", "b"), morse(11, "b", "a")
    docs = [(1, one), (2, other)]
    assert {r.component_id for r in minhash.groups(frame(spark, docs)).collect()} == {1, 2}
    same(rows(suffix_dedup.remove(frame(spark, docs), 1500), *BYTES), plain.byte_dedup(docs, 1500))
    rng = random.Random(1)
    lines = [sentence(rng, 34, 10**6) for _ in range(1)]
    docs = [(1, f"{lines[0]} {one}"), (2, f"{lines[0]} {other}")]
    same(rows(substring_dedup.remove(frame(spark, docs)), *WORDS), plain.word_dedup(docs, 35))
    # Words of the same pattern, too.
    docs = [(1, " ".join(morse(10, "a", "b"))), (2, " ".join(morse(10, "b", "a")))]
    same(rows(minhash.groups(frame(spark, docs)), *GROUPS), plain.near(docs))
    same(rows(substring_dedup.remove(frame(spark, docs), 600), *WORDS), plain.word_dedup(docs, 600))


def test_the_same_members_meet_once(spark, monkeypatch):
    """Copies that are alike share most of their values and so most of their lists; a set is not sent to each of these, nor twice to one place."""
    rng = random.Random(23)
    base = sentence(rng, 300, 10**6).split()
    # 0 and 1 are linked; 2 and 3 are with none, but share enough of their shingles with the others to be looked at.
    docs = [(0, " ".join(base)), (1, " ".join([*base[:-1], "x"])), (2, " ".join([*base[:250], *(f"y{k}" for k in range(60))])), (3, " ".join([*base[60:], *(f"z{k}" for k in range(60))]))]
    docs += [(10 + k, sentence(rng, 80, 10**6)) for k in range(20)]
    asked, links_at = [], minhash._links_at
    monkeypatch.setattr(minhash, "_links_at", lambda places, *a: asked.append(places) or links_at(places, *a))
    monkeypatch.setattr(minhash.Folder, "remove", lambda *a: None)
    same(rows(minhash.groups(frame(spark, docs)), *GROUPS), plain.near(docs))
    most = max(r["count"] for r in asked[1].groupBy("cid").count().collect())
    assert most <= 16


def test_a_place_compares_those_on_either_side_and_on_both():
    """Sets that are listed and looked up are sent once; the links are those of every listed set with every one looked up."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 47, 60)
    sets = [np.unique(np.concatenate([base[: 60 - k], rng.integers(0, 1 << 47, k)]).astype(np.uint64)) for k in (0, 2, 5, 9, 25, 30)]
    sides = [minhash._LISTED, minhash._BOTH, minhash._BOTH, minhash._LOOKED_UP, minhash._LISTED, minhash._LOOKED_UP]
    found = sorted((g, side, c, len(sets[c]), minhash._packed(sets[c])) for g in (1, 2) for c, side in enumerate(sides))
    names = ("g", "side", "c", "n", "members")
    columns = dict(zip(names, zip(*found))) | {"i": [0] * len(found), "j": [0] * len(found)}
    rows_ = pa.RecordBatch.from_pydict({k: list(v) for k, v in columns.items()})
    batches = minhash._met(iter([rows_.slice(0, 3), rows_.slice(3, 5), rows_.slice(8)]))
    got = [x for b in batches for x in zip(b.column("u").to_pylist(), b.column("v").to_pylist())]
    alike = lambda a, b: (k := len(np.intersect1d(sets[a], sets[b]))) * 100 >= 75 * (len(sets[a]) + len(sets[b]) - k)
    wanted = {(a, b) for a in range(6) for b in range(6) if a != b and sides[a] <= minhash._BOTH <= sides[b] and alike(a, b)}
    assert set(got) <= wanted and len(got) == 2 * len(set(got))
    label = list(range(6))
    for pairs in (got, wanted):
        of = list(range(6))
        for _ in range(6):
            for a, b in pairs:
                of[a] = of[b] = min(of[a], of[b])
        label = of if pairs is got else label
        assert pairs is got or of == label


def test_a_hot_passage_is_not_counted_string_by_string(spark, monkeypatch):
    """Strings inside a passage that many texts share go by slices; only those of slices at its ends are counted one by one."""
    rng = random.Random(31)
    passage = sentence(rng, 70, 10**6)
    docs = [(k, f"{sentence(rng, 40, 10**6)} {passage} {sentence(rng, 40, 10**6)}") for k in range(30)]
    monkeypatch.setattr(repeats, "HOT", 3)
    hashed, counted = [], repeats.counted
    monkeypatch.setattr(repeats, "counted", lambda of, *a: hashed.append(of) or counted(of, *a))
    want = plain.byte_dedup(docs, 200)
    same(rows(suffix_dedup.remove(frame(spark, docs), 200), *BYTES), want)
    assert 0 < hashed[0].count() <= 30 * 64
