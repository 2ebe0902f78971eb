"""Operators that look at one document, page or conversation at a time."""

from __future__ import annotations

import base64
import json
import random
import time
import tracemalloc
from collections import defaultdict

import numpy as np
import plain
import pyarrow as pa
import pytest
from helpers import frame, rows, sentence
from pyspark.core.broadcast import Broadcast

from waybill.llm import block_labeller, chat, decontamination, html_extraction, quality_rules, secrets
from waybill.llm.fm_index import FMIndex, suffix_order
from waybill.llm.html_blocks import leaf_blocks
from waybill.llm.text import IN_PLAIN_WORD, LOWER, blocks, words

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- quality rules --------------------------------------------------------------------------------------------

def test_statistics(spark, corpus):
    got = quality_rules.with_statistics(frame(spark, corpus))
    assert rows(got, "doc_id", *STATISTICS) == sorted(((i, *plain.statistics(t)) for i, t in corpus), key=repr)
    assert {"text_hash", "kept", "spans"} <= set(got.columns)


def _labelled(rng, n=400):
    docs, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        docs.append((k, " ".join(f"w{rng.randrange(10**6)}" + ("$$$" if bad else "") for _ in range(rng.randrange(25, 60)))))
        labels.append((k, 0 if bad else 1, 0))
    return docs, labels


def test_rules_are_learned_and_applied(spark):
    docs, labels = _labelled(random.Random(1))
    table = frame(spark, docs)
    rules = quality_rules.fit(table, spark.createDataFrame([*labels, (None, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int"))
    assert rules and all(c.feature in quality_rules.FEATURES for r in rules for c in r)
    judged = quality_rules.judge(table, rules)
    assert all(r.kept == (r.doc_id % 4 != 0) for r in judged.where("NOT base_failed").select("doc_id", "kept").collect())
    assert judged.where("kept").count() == 300  # a filter stays above the statistics and plans quickly


def test_rules_are_pure_and_ordered():
    rng = random.Random(4)
    made = [{f: rng.random() for f in quality_rules.FEATURES} | {"held": k % 3 == 0} for k in range(900)]
    for r in made:
        r["bad"] = r["symbol_share"] > 0.8 or (r["upper_share"] > 0.6 and r["mark_share"] > 0.6)
    rules = quality_rules.learn(made)
    hit = [next((k for k, rule in enumerate(rules) if all(c.holds(r) for c in rule)), None) is not None for r in made]
    assert np.mean([h == r["bad"] for h, r in zip(hit, made)]) > 0.97
    assert quality_rules.learn([r | {"bad": False} for r in made]) == []


def test_no_labels_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.fit(frame(spark, [(1, "a b")]), none) == []
    assert quality_rules.judge(frame(spark, []), []).count() == 0
    one = quality_rules.judge(frame(spark, [(None, None), (None, None)]), []).select("n_words", "base_failed", "kept").collect()
    assert [tuple(r) for r in one] == [(0, True, False)] * 2


# --- decontamination ------------------------------------------------------------------------------------------

RESULT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _benchmark(corpus):
    long = max((t or "" for _, t in corpus), key=len).split()
    items = [(1, " ".join(long[100:140])), (2, " ".join(long[120:160]).upper()), (10, "a b c"), (3, None), (None, "a b c d e"), (4, "..."), (10, "z " * 20), (5, corpus[2][1])]
    return items


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_benchmark_passages_are_found(spark, corpus, block_bytes):
    items = _benchmark(corpus)
    docs = [*corpus, (900, "before " + items[0][1] + " after"), (None, items[0][1]), (900, items[0][1]), (901, "a, B; c! a b c a"), (902, "z " * 14)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS n_words")
    want = sorted(plain.hits(docs, items), key=repr)
    assert rows(decontamination.check(frame(spark, docs), bench, block_bytes=block_bytes), *RESULT) == want
    clean = decontamination.clean(frame(spark, docs), bench, block_bytes=block_bytes)
    assert clean.columns == frame(spark, docs).columns
    assert sorted((repr(r.doc_id) for r in clean.collect())) == sorted(repr(r[0]) for r in want if not r[5])


@pytest.mark.parametrize("op", [decontamination.check, decontamination.clean])
def test_passes_do_not_pile_up(spark, corpus, monkeypatch, op):
    """One pass's patterns at a time: the plan holds the last one only, and the broadcasts of the others are gone."""
    ended, destroy = [], Broadcast.destroy
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: ended.append(1) or destroy(self, *a))
    bench = spark.createDataFrame(_benchmark(corpus) * 2, "item_id long, text string")
    made = op(frame(spark, [*corpus, *corpus[:9]]), bench, block_bytes=400)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1 and len(ended) > 2
    if op is decontamination.check:
        assert rows(made, *RESULT) == sorted(plain.hits([*corpus, *corpus[:9]], _benchmark(corpus)), key=repr)


@pytest.mark.parametrize("window", [1, 2, 3, 4, 5, 8, 13])
def test_patterns_are_the_distinct_windows(window):
    rng = random.Random(window)
    items = [(rng.randrange(12), " ".join(rng.choice("abc") for _ in range(rng.randrange(20)))) for _ in range(60)] + [(None, "a b"), (3, None), (99, "")]
    p = decontamination.patterns_of(items, window)
    _, data, offsets = next(iter(blocks(pa.array(["a b c"]), 1 << 20)))
    named = dict(zip(words(data, offsets, IN_PLAIN_WORD).hashes(data, LOWER).tolist(), "abc"))
    want = defaultdict(set)
    for i, t in items:
        own = (t or "").split() if i is not None else []
        for k in range(max(1, len(own) - window + 1) if own else 0):
            want[tuple(own[k : k + window])].add(str(i))
    got = {tuple(named[int(p.vocabulary[s - 1])] for s in row[len(row) - n :]): {p.names[o] for o in p.owners[lo:hi]}
           for row, n, lo, hi in zip(p.symbols, p.lengths.tolist(), p.bounds[:-1], p.bounds[1:])}
    assert got == want and len(p.lengths) == len(want) and not p.symbols[np.arange(window) < window - p.lengths[:, None]].any()


def test_patterns_of_a_large_benchmark_stay_small():
    rng = np.random.default_rng(1)
    items = [(k, " ".join(map(str, rng.integers(0, 50_000, 2_000)))) for k in range(300)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    p = decontamination.patterns_of(items, 13)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(p.lengths) == 300 * 1988 and peak < 60 * size


def test_empty_benchmark_and_documents(spark, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.check(frame(spark, corpus), none).where("n_hit > 0").count() == 0
    assert decontamination.check(frame(spark, []), none).count() == 0


def test_index_against_scan():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 60, 40)
    text = rng.integers(1, 5, lengths.sum())
    index = FMIndex(text, lengths, 6)
    ends = np.cumsum(lengths)
    patterns = [tuple(rng.integers(1, 7, n)) for n in rng.integers(1, 7, 200)]
    matrix = np.zeros((len(patterns), 6), np.int64)
    for k, p in enumerate(patterns):
        matrix[k, 6 - len(p) :] = p
    lo, hi = index.count(matrix, np.array([len(p) for p in patterns]))
    for k, p in enumerate(patterns):
        want = [a for b, e in zip(ends - lengths, ends) for a in range(b, e - len(p) + 1) if tuple(text[a : a + len(p)]) == p]
        assert sorted(index.locate(np.arange(lo[k], hi[k]))) == want
    ranks = np.append(rng.integers(1, 3, 200), 0)
    assert suffix_order(ranks).tolist() == sorted(range(201), key=lambda k: ranks[k:].tolist())


# --- secrets --------------------------------------------------------------------------------------------------

def _der(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + content


RSA = _der(0x30, _der(2, b"\0") + b"".join(_der(2, bytes([7]) * k) for k in (129, 3, 128, 64, 64, 64, 64, 64)))
EC = _der(0x30, _der(2, b"\1") + _der(4, b"k" * 32) + _der(0xA0, _der(6, b"\x2a\x86\x48")))


def _url(x):
    return base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")


def test_keys_and_tokens_are_confirmed():
    rsa, ec = base64.b64encode(RSA).decode(), base64.b64encode(EC).decode()
    lines = "\n".join(rsa[k : k + 64] for k in range(0, len(rsa), 64))
    token = f"{_url({'alg': 'none'})}.{_url({'sub': 1})}.sig"
    for text, kind in ((f"-----BEGIN\n{lines}\n-----END", "key"), (f"é {ec} tail", "key"), (RSA.hex().upper(), "key"), (f"see {token}!", "jwt")):
        assert [s[2] for s in secrets.spans(text) if s[2] in ("key", "jwt")] == [kind], text
    broken = bytearray(RSA)
    broken[9] += 1  # a nested length that does not come out even
    for text in (base64.b64encode(broken).decode(), rsa[:-40], "M" + "A" * 80, f"{_url({'typ': 'x'})}.{_url({})}.s", f"{_url([1])}.{_url({})}.s", "eyJ.eyJ."):
        assert not [s for s in secrets.spans(text) if s[2] in ("key", "jwt")], text


def _ssh(*parts):
    return b"".join(len(p).to_bytes(4, "big") + p for p in parts)


def _openssh(cipher=b"none", marks=b"abcdabcd"):
    public = _ssh(b"ssh-ed25519", b"p" * 32)
    private = marks + _ssh(b"ssh-ed25519", b"p" * 32, b"s" * 64, b"me")
    private += bytes(range(1, 1 + -len(private) % 8))
    return b"openssh-key-v1\0" + _ssh(cipher, b"none" if cipher == b"none" else b"bcrypt", b"") + (1).to_bytes(4, "big") + _ssh(public, private)


PASSWORD = _der(0x30, _der(6, bytes.fromhex("2a864886f70d01050d")) + _der(0x30, _der(0x30, _der(6, b"\x2a") + _der(0x30, _der(4, b"salt") + _der(2, b"\x08\x00"))) + _der(0x30, _der(6, b"\x2b") + _der(4, b"i" * 16))))
LOCKED = _der(0x30, PASSWORD + _der(4, b"\x9c" * 320))
DIGEST = _der(0x30, _der(0x30, _der(6, bytes.fromhex("608648016503040201")) + _der(5, b"")) + _der(4, b"d" * 32))
WITH_PUBLIC = _der(0x30, _der(2, b"\1") + _der(0x30, _der(6, b"\x2b\x65\x70")) + _der(4, _der(4, b"s" * 32)) + _der(0x81, b"\0" + b"p" * 32))


@pytest.mark.parametrize("key", [RSA, EC, LOCKED, WITH_PUBLIC, _openssh(), _openssh(b"aes256-ctr", b"encrypt!")])
@pytest.mark.parametrize("feed", ["", "\n", "\r\n", "\n    ", "\n\t", "\\n", "\\r\\n", "\\\\n", '\\n"\n    "', "',\n  '"])
def test_forms_of_keys(key, feed):
    """In one piece, in lines, indented (YAML), with escaped line feeds (JSON, once or twice), and in literals."""
    plain_text = base64.b64encode(key).decode()
    size = 64 if feed else len(plain_text)
    body = feed.join(plain_text[k : k + size] for k in range(0, len(plain_text), size))
    for before, after in ((f"-----BEGIN PRIVATE KEY-----{feed}", f"{feed}-----END PRIVATE KEY-----"), ("é M ", " tail"), ("M" + "x" * 40 + "\n", "\nMore text")):
        if before.endswith("-") and not feed:
            continue
        text = before + body + after
        assert [text[a:b] for a, b, k in secrets.spans(text) if k == "key"] == [body], text
    escaped = body.replace("/", "\\/")
    assert [t for a, b, k in secrets.spans(f"'{escaped}'") if k == "key" for t in [f"'{escaped}'"[a:b]]] == [escaped]
    assert [k for _, _, k in secrets.spans(key.hex()) if k == "key"] == ["key"]
    for text in (body[:-40], body[:20] + " " + body[20:]):
        assert not [s for s in secrets.spans(text) if s[2] == "key"], text


def test_what_is_no_key():
    for data in (DIGEST, _openssh(marks=b"abcdabce"), _openssh()[:-1], b"openssh-key-v1\0" + b"\xff" * 60):
        for text in (base64.b64encode(data).decode(), data.hex()):
            assert not [s for s in secrets.spans(text) if s[2] == "key"], text


def test_base_patterns():
    text = 'PassWord = "abcdefghijkl" secret=short api-key: x apikey:abcdefghijkl/+= AKIA1234567890ABCD AKIA123 deadbeefdeadbeef0 \u017fecret=abcdefghijklm'
    got = [(k, text[a:b]) for a, b, k in secrets.spans(text)]
    assert got == [("assign", 'PassWord = "abcdefghijkl'), ("assign", "apikey:abcdefghijkl/+="), ("access", "AKIA1234567890ABCD"), ("hex", "deadbeefdeadbeef0")]


def test_scan_and_redact(spark):
    docs = [(1, "é token=abcdefabcdef0123456789 x"), (1, "é token=abcdefabcdef0123456789 x"), (2, ""), (None, None), (3, "plain " * 5000)]
    base = "assign:2:30,hex:8:30"
    got = rows(secrets.scan(frame(spark, docs)), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    empty = (0, 0, 0, plain.sha(""), "")
    assert got == sorted([(1, 1, 0, 1, plain.sha(base), base)] * 2 + [(2, *empty), (None, *empty), (3, *empty)], key=repr)
    table = frame(spark, docs).selectExpr("*", "99L AS n_chars")
    out = secrets.redact(table)
    assert out.schema.simpleString() == table.schema.simpleString()
    assert rows(out, "doc_id", "text", "n_chars")[:2] == [(1, "é [SECRET] x", 12)] * 2
    assert (None, None, 99) in rows(out, "doc_id", "text", "n_chars")
    assert secrets.scan(frame(spark, [])).count() == 0


def _random_der(rng, depth=0):
    """An element, mostly well formed, of tags that keys have and some that they have not."""
    tag = rng.choice([2, 2, 2, 4, 5, 6, 0x30, 0x30, 0xA0, 0x13] if rng.random() < 0.2 else [2, 2, 4, 6, 0x30])
    if tag & 0x20 and depth < 4:
        inside = b"".join(_random_der(rng, depth + 1) for _ in range(rng.randrange(4)))
    else:
        inside = rng.choice([b"\0", b"\1", rng.randbytes(rng.randrange(300))])
    size = bytes([len(inside)]) if len(inside) < 0x80 else bytes([0x82]) + len(inside).to_bytes(2, "big")
    return bytes([tag]) + size + inside + (b"\0" if rng.random() < 0.02 else b"")


def test_keys_are_those_of_a_plain_reader():
    rng = random.Random(17)
    kinds = {True: 0, False: 0}
    for _ in range(4000):
        inside = b"".join([rng.choice([b"\2\1\0", b"\2\1\1", b""]), *(_random_der(rng) for _ in range(rng.choice([1, 2, 2, 3, 6])))])
        data = b"\x30\x82" + len(inside).to_bytes(2, "big") + inside
        want = plain.is_private_key(data)
        kinds[want] += 1
        assert secrets.is_private_key(data) == want, data.hex()
        found = [s for s in secrets.spans("\n".join(["x", *(body[k : k + 64] for body in [base64.b64encode(data).decode()] for k in range(0, len(body), 64)), "y z"])) if s[2] == "key"]
        if want and len(data) > 30:
            assert len(found) == 1, data.hex()
    assert min(kinds.values()) > 100


def test_lines_that_only_begin_like_keys_take_linear_time():
    head = bytes.fromhex("308400ffffff020100308200ff") + b"\x05\0" * 17 + b"\1"
    line = base64.b64encode(head).decode()
    assert line.startswith("M") and len(line) == 64
    text = "\n".join([line] * 160_000)
    begin = time.perf_counter()
    assert not [s for s in secrets.spans(text) if s[2] == "key"]
    assert time.perf_counter() - begin < 60


# --- html -----------------------------------------------------------------------------------------------------

def test_blocks():
    page = '<!-- x <p>no --><p class=a>One&amp;<b>two</b> <a href="a>b">three</a><br>four<p>Fi&#118;e<script>var t="</p>";</script><ul><li>s1<li>s2</ul>a < b<div title="q"'
    found = leaf_blocks(page)
    assert [b.text for b in found] == ["One&two three four", "Five", "s1", "s2", "a < b"]
    assert [[n for n, _, _ in b.path] for b in found] == [["p"], ["p"], ["ul", "li"], ["ul", "li"], []]
    assert found[0].linked == 5 and leaf_blocks("") == [] and leaf_blocks("<style>x") == []


def _tree(rng, depth, expected, path):
    """Markup of a random tree; what its blocks have to be goes to expected."""
    out = []
    for _ in range(rng.randrange(1, 4)):
        name = rng.choice(["div", "section", "ul", "table", "h2"]) if depth < 5 else "p"
        words = tuple(rng.sample(["menu", "story", "ad", "main"], rng.randrange(3)))
        out.append(f'<{name} class="{" ".join(words)}">')
        own = (*path, (name, words))
        text = " ".join(rng.choice(["a", "bc", "<b>d</b>", "&lt;e"]) for _ in range(rng.randrange(4)))
        if text:
            out.append(text)
            expected.append((text.replace("<b>", "").replace("</b>", "").replace("&lt;", "<"), own))
        if depth < 5 and rng.random() < 0.6:
            out.append(_tree(rng, depth + 1, expected, own))
        out.append(f"</{name}>" + rng.choice(["", "</em>", "</article>"]))
    return "".join(out)


def test_blocks_and_features_are_those_of_a_plain_version():
    rng = random.Random(23)
    for _ in range(60):
        expected = []
        found = leaf_blocks(_tree(rng, 0, expected, ()))
        assert [(b.text, tuple(p[:2] for p in b.path)) for b in found] == expected
        got = block_labeller.vectors(found)
        for row, block in zip(got, found):
            assert set(np.flatnonzero(row[:256])) == plain.path_buckets(block.path, 256)


def test_elements_end_others_as_in_a_plain_stack():
    rng = random.Random(29)
    for _ in range(300):
        page = "".join(rng.choice(["<p>", "<li>", "<ul>", "</ul>", "<div>", "</div>", "<td>", "<tr>", "<table>", "</table>", "<dt>", "<dd>", "</p>", "</li>"]) + str(k) for k in range(25))
        assert [[n for n, _, _ in b.path] for b in leaf_blocks(page)] == plain.open_elements(page)


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "deep", "<div>x" * 100_000, "<ul><li>" + "<div>y" * 50_000 + "</section><ul><li>z" * 50_000, "<p>" + "<b><div>" * 50_000 + "<p>q" * 50_000])
def test_deep_pages_take_linear_time(page):
    begin = time.perf_counter()
    found = leaf_blocks(page)
    block_labeller.scores(block_labeller.trained(), [block_labeller.vectors(found)])
    assert found and time.perf_counter() - begin < 90


def test_recurrence_and_gradient_are_those_of_plain_versions():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((5, 2, 7)).astype(np.float32)
    w, u = (rng.standard_normal((n, 4 * block_labeller.HIDDEN)).astype(np.float32) * 0.3 for n in (7, block_labeller.HIDDEN))
    states, kept = block_labeller._run(x, w, u)
    for page in range(2):
        assert np.allclose(states[:, page], plain.lstm(x[:, page].tolist(), w.tolist(), u.tolist(), block_labeller.HIDDEN), atol=1e-4)
    d = rng.standard_normal(states.shape).astype(np.float32)
    for grad, values in zip(block_labeller._back(x, u, kept, d), (w, u)):
        for _ in range(12):
            k = tuple(rng.integers(n) for n in values.shape)
            was, sums = values[k], []
            for step in (0.01, -0.01):
                values[k] = was + step
                sums.append(float((block_labeller._run(x, w, u)[0].astype(np.float64) * d).sum()))
            values[k] = was
            assert abs((sums[0] - sums[1]) / 0.02 - grad[k]) < 0.02 * (1 + abs(grad[k]))


def test_labeller_on_pages_it_has_not_seen():
    weights, rng = block_labeller.trained(), np.random.default_rng(123)
    made = [block_labeller.example(rng) for _ in range(200)]
    scored = block_labeller.scores(weights, [block_labeller.vectors(b) for b, _ in made])
    right = np.concatenate([(s > 0.5) == (y > 0) for (_, y), s in zip(made, scored)])
    assert right.mean() > 0.99


def test_extract(spark):
    page = (
        "<html><head><title>T</title></head><body><nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav><div class='ad'>Buy now</div>"
        "<article><h1>Head&amp;line</h1><p>Some  text\n here.</p><p>More &eacute; text.</p></article><div class=comments><div class=comment><p>First!</p></div></div><footer>&copy; x</footer></body></html>"
    )
    pages = spark.createDataFrame([(1, "u", page), (None, None, None), (2, "u", ""), (1, "u", page)], "page_id long, url string, html string").selectExpr("*", "'x' AS text")
    text = "Head&line\nSome text here.\nMore é text."
    assert rows(html_extraction.extract(pages), "page_id", "url", "text", "n_chars") == sorted(
        [(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "u", "", 0)], key=repr)
    assert html_extraction.extract(pages.limit(0)).count() == 0


def test_long_and_short_pages_score_alike():
    """A page's scores do not depend on what is scored with it."""
    weights, rng = block_labeller.trained(), np.random.default_rng(5)
    pages = [rng.random((n, block_labeller.SIZE)).astype(np.float32) for n in (1, 7, 0, 300, 7)]
    together = block_labeller.scores(weights, pages)
    for p, s in zip(pages, together):
        assert np.allclose(block_labeller.scores(weights, [p])[0], s, atol=1e-5)


# --- chats ----------------------------------------------------------------------------------------------------

TURNS = [
    (1, 0, "user", r"\### Assistant: </turn> ok"), (1, 1, "assistant", r"\### Assistant: </turn> ok"), (1, 2, "assistant", "####\\"), (2, 1, "assistant", None), (2, 0, None, "é\n"),
    (3, None, "a: b\\", "</turn>\n### user: x"), (3, 0, "", ""), (3, 0, "assistant", "twice"), (3, 0, "assistant", "twice"), (None, 0, "user", "\\"), (4, 1, "Assistant", "not counted"),
]


def _chats(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "'x' AS formatted", "1 AS part", "2 AS n_turns")


def _digest(turns):
    by = defaultdict(list)
    for c, t, role, text in sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")):
        by[c].append((role or "", text or ""))
    for c, own in by.items():
        loss = "".join(x for r, x in own if r == "assistant")
        yield c, len(own), plain.sha("".join(f"{r}\n{x}\n" for r, x in own)), len(loss), plain.sha(loss)


def test_round_trip(spark):
    rng = random.Random(0)
    bits = ["\\", "###", "#", "</turn>", "</turn", "### ", ": ", "\n", "é", "x", " </turn>\n"]
    turns = TURNS + [(100 + k % 9, k, rng.choice(["user", "assistant", "s:y"]), "".join(rng.choice(bits) for _ in range(rng.randrange(12)))) for k in range(200)]
    got = rows(chat.digests(chat.format_chats(_chats(spark, turns))), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == sorted(_digest(turns), key=repr)
    assert chat.digests(chat.format_chats(_chats(spark, []))).count() == 0


def test_long_conversations_come_in_parts(spark, monkeypatch):
    turns = [(7, k, "user" if k % 2 else "assistant", "word " * 3000) for k in range(200)] + [(8, 0, "assistant", "x" * 3_000_000)]
    made = chat.format_chats(_chats(spark, turns))
    assert made.where("conv_id = 7").count() > 1
    assert rows(chat.digests(made), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(_digest(turns), key=repr)


def test_assembled_buffer_is_the_plain_string():
    roles, texts = pa.array(["user", None, "a:b"]), pa.array(["x ### y", "</turn>", None])
    data, begins, at, end = chat.assemble(roles, texts)
    assert data.tobytes() == b"### user: x \\### y </turn>\n### : \\</turn> </turn>\n### a\\:b:  </turn>\n"
    assert [data[a:b].tobytes() for a, b in zip(at, end)] == [b"x \\### y", b"\\</turn>", b""] and begins[-1] == len(data)
    with pytest.raises(ValueError):
        chat.read_turns(data.tobytes()[1:])
