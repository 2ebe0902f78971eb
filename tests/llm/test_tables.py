"""Operators over whole tables: shards, packs, and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import plain
import public_tokenizers
import pytest
from helpers import frame, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waybill.llm import packing, sharding

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- shards ---------------------------------------------------------------------------------------------------

def test_shards_are_balanced_and_gapless(spark, corpus):
    docs = [*corpus, (1, corpus[0][1]), (None, None), (None, None)]
    got = sharding.shard(frame(spark, docs), 7).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert {len(s) for s in slots.values()} <= {len(docs) // 7, len(docs) // 7 + 1}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sharding.shard(frame(spark, [])).count() == 0


def test_few_rows_move_when_a_shard_is_added(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    a, b = (sharding.shard(docs, n).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (16, 17))
    moved = a.join(b, "doc_id").where("s16 <> s17").count()
    assert moved < 0.2 * 20_000  # a new order of all rows would move 94 %, the least possible is 6 %


def test_one_hot_row(spark):
    docs = spark.range(30_000).select((F.col("id") % 100 * (F.col("id") % 3)).alias("doc_id"), F.lit("t").alias("text"))
    counts = {r.shard: (r.n, r.top) for r in sharding.shard(docs).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("top")).collect()}
    assert all(n == 1875 and top == 1874 for n, top in counts.values()) and len(counts) == 16


def test_an_id_with_very_many_texts(spark):
    """Its rows are ranked in parts, in the order that a sort gives, and no range of checksums has very many of them."""
    docs = spark.range(4_000).select(F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    kinds = docs.select(F.lit(3).alias("cell"), "doc_id", F.octet_length("text").alias("size"), F.crc32("text").alias("text_crc32"), F.lit(2).alias("n"))
    found = sorted(sharding._ranked(kinds).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"]))
    assert [r["first"] for r in found] == list(range(0, 8_000, 2))
    plan = sharding._ranked(kinds)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2 and max(Counter((r.doc_id, r.text_crc32 >> 22) for r in found).values()) < 20


def test_overflow_goes_on_clockwise():
    nodes = [(10, 0), (20, 1), (30, 2)]
    assert sharding.allocate({5: 6, 15: 1, 25: 2}, nodes, [3, 3, 3]) == [(5, 0, 3, 0, 0), (15, 0, 1, 1, 0), (25, 0, 2, 2, 0), (5, 3, 5, 1, 1), (5, 5, 6, 2, 2)]


# --- packs ----------------------------------------------------------------------------------------------------

def test_a_piece_that_is_there_very_often(spark, monkeypatch):
    """Its copies are ranked in several places, and every place of a sequence is still taken once."""
    monkeypatch.setattr(packing, "_COPIES", 50)
    most, blocked = [], packing._blocked

    def seen(pieces, total):
        out = blocked(pieces, total)
        most.append(max(r["count"] for r in out.groupBy(*packing._BLOCK).count().collect()))
        return out

    monkeypatch.setattr(packing, "_blocked", seen)
    docs = [(None, None)] * 600 + [(k % 7, f"word {k % 40}") for k in range(300)]
    got = packing.pack(frame(spark, docs), TOKENIZER, 64, with_ids=True).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in docs) and most[0] < 150
    taken = sorted((r.sequence_id, r.offset, r.length) for r in got)
    assert all(a[0] < b[0] or a[1] + a[2] == b[1] for a, b in zip(taken, taken[1:])) and len({t[:2] for t in taken}) == len(docs)


@pytest.mark.parametrize("size", [64, 2048])
def test_packing(spark, corpus, size):
    docs = [*corpus, (None, "none"), (500, "<|endoftext|> a\u00a0b\u2003c 'S 12 Σς"), (501, "two\x0brows"), (501, "two\x0brows")]
    got = packing.pack(frame(spark, docs), TOKENIZER, size, with_ids=True).collect()
    tokenizer, pieces = Tokenizer.from_file(TOKENIZER), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
    want = Counter()
    for i, t in docs:
        want[i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    for (i, data), n in want.items():
        for at in range(0, len(data) // 4, size):
            own = [r for r in pieces[i] if r.start == at and bytes(r.ids) == data[4 * at : 4 * (at + size)] and r.doc_tokens == len(data) // 4]
            assert len(own) == n
    assert sum(map(len, pieces.values())) == sum(-(-len(d) // 4 // size) * n for (_, d), n in want.items())
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert packing.pack(frame(spark, []), TOKENIZER).count() == 0


def test_patterns_place_every_piece_with_little_padding():
    rng = random.Random(1)
    for trial in range(30):
        size = rng.choice([16, 100, 2048])
        histogram = {n: rng.randrange(1, 400) for n in rng.sample(range(1, size + 1), min(size, rng.randrange(1, 200)))}
        found = packing.patterns(histogram, size)
        placed = Counter()
        for lengths, count in found:
            assert sum(lengths) <= size and count > 0
            for n in lengths:
                placed[n] += count
        assert placed == histogram
        ranks = defaultdict(list)
        for length, lo, hi, _, _ in packing.slots(found):
            ranks[length].append((lo, hi))
        for length, parts in ranks.items():
            parts.sort()
            assert parts[0][0] == 0 and parts[-1][1] == histogram[length] and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    many = {n: 10**9 // n for n in range(1, 2049)}  # the work depends on lengths, not on pieces
    packs = packing.patterns(many, 2048)
    assert sum(sum(p) * c for p, c in packs) / (2048 * sum(c for _, c in packs)) > 0.99


# --- pipeline -------------------------------------------------------------------------------------------------

def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    item = sentence(rng, 30, 10**6)
    texts = [sentence(rng, rng.randrange(40, 90), 10**6) for _ in range(60)]
    texts += [texts[0], texts[1] + " tail", item + " " + sentence(rng, 30, 10**6), texts[2] + " password=abcdefghijkl", "too short", None, "again " * 60]
    texts += [" ".join(w + "$$$" for w in sentence(rng, 50, 10**6).split()) for _ in range(20)]
    docs = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int("$" not in (t or ""))) for k, t in enumerate(texts)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        if name != "packing":
            assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = sorted({r.doc_id for r in now.select("doc_id").collect()})
    good = [*range(60), 60, 61, 62, 63]
    assert kept["quality_rules"] == good
    unique = [i for i, _, _, k in plain.near([(i, texts[i]) for i in good]) if k]
    assert kept["near_duplicates"] == unique and 60 not in unique and 61 not in unique
    assert kept["decontamination"] == kept["secrets"] == kept["packing"] == [i for i in unique if i != 62]
    assert {name for name, _ in corpus_pipeline.STAGES} == set(kept) and now.count() == len(kept["packing"])
