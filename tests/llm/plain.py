"""Brute-force versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def statistics(text):
    t = text or ""
    w = WORD.findall(t)
    at = defaultdict(list)
    for k in range(len(w) - 7):
        at[tuple(w[k : k + 8])].append(k)
    hit = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def _repeated(sequences, length):
    """For every sequence which of its items a repeated window covers."""
    count = Counter(tuple(s[k : k + length]) for s in sequences for k in range(len(s) - length + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for k in range(len(s) - length + 1):
            if count[tuple(s[k : k + length])] > 1:
                gone[k : k + length] = [True] * length
        out.append(gone)
    return out


def byte_dedup(docs, length):
    data = [(t or "").encode() for _, t in docs]
    out = []
    for (i, _), b, gone in zip(docs, data, _repeated(data, length)):
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def word_dedup(docs, window):
    seqs = [WORD.findall(t or "") for _, t in docs]
    return [(i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))) for (i, _), w, gone in zip(docs, seqs, _repeated(seqs, window))]


def shingles(text):
    w = WORD.findall((text or "").translate(_LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def near(docs):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        least[find(k)].append(i)
    return [(i, len(s), min(least[find(k)]), i == min(least[find(k)])) for k, ((i, _), s) in enumerate(zip(docs, sets))]


def hits(docs, items, window=13):
    windows = defaultdict(set)
    for i, t in items:
        w = PLAIN_WORD.findall((t or "").translate(_LOWER))
        if i is not None and w:
            for k in range(max(1, len(w) - window + 1)):
                windows[tuple(w[k : k + window])].add(str(i))
    lengths = set(map(len, windows))
    out = []
    for i, t in docs:
        w = PLAIN_WORD.findall((t or "").translate(_LOWER))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def _der(data, depth=0):
    out = []
    while data:
        if len(data) < 2 or data[1] == 0x80 or data[1] > 0x84:
            return None
        size, begin = (data[1], 2) if data[1] < 0x80 else (int.from_bytes(data[2 : data[1] - 126], "big"), data[1] - 126)
        tag, inside = data[0], data[begin : begin + size]
        if begin > len(data) or len(inside) < size or tag not in (2, 3, 4, 5, 6, 0x30, 0x31, 0x81, 0xA0, 0xA1, 0xA2, 0xA3):
            return None
        nested = _der(inside, depth + 1) if tag & 0x20 else None
        if tag & 0x20 and (nested is None or depth >= 16):
            return None
        out.append((tag, inside, nested))
        data = data[begin + size :]
    return out


def is_private_key(data):
    """Everything is decoded first, then looked at."""
    outer = _der(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    fields = outer[0][2]
    tags = [t for t, _, _ in fields]
    if tags == [0x30, 4]:
        how = fields[0][2]
        return [t for t, _, _ in how] == [6, 0x30] and how[0][1].startswith((bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01")))
    if len(tags) < 2 or tags[0] != 2 or fields[0][1] not in (b"\0", b"\1"):
        return False
    return tags[1:3] == [0x30, 4] or tags[1] == 4 or (len(tags) > 5 and set(tags[:6]) == {2})


def path_buckets(path, n):
    """Of an element list from the root: names, names below names, words, and the last two once more by distance."""
    tokens = set()
    for k, (name, named, _) in enumerate(path):
        tokens |= {name, (path[k - 1][0] if k else "") + ">" + name} | {"." + w for w in named}
    for distance, (name, named, _) in enumerate(path[::-1][:2]):
        tokens |= {f"{distance}{t}" for t in [name, *("." + w for w in named)]}
    return {zlib.crc32(t.encode()) % n for t in tokens}


def open_elements(page):
    """Names of the open elements at each number of a page of plain tags, by walking the stack."""
    ends = {"p": ["p"], "li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "tr": ["tr", "td", "th"], "td": ["td", "th"]}
    stack, out = [], []
    for slash, name, _ in re.findall(r"<(/?)(\w+)>(\d+)", page):
        if slash:
            if name in stack:
                while stack.pop() != name:
                    pass
        else:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in ends.get(name, []):
                    del stack[k:]
                    break
                if stack[k] in ("table", "ul", "ol", "dl") and name != "p":
                    break
            if name in ("div", "ul", "table") and stack and stack[-1] == "p":
                stack.pop()
            stack.append(name)
        out.append(list(stack))
    return out


def lstm(xs, w, u, n):
    """Gates in the order input, forget, output, candidate, one number at a time."""
    h, c, out = [0.0] * n, [0.0] * n, []
    for x in xs:
        z = [sum(a * w[j][k] for j, a in enumerate(x)) + sum(a * u[j][k] for j, a in enumerate(h)) for k in range(4 * n)]
        i, f, o = ([1 / (1 + math.exp(-v)) for v in z[g * n : (g + 1) * n]] for g in range(3))
        c = [f[k] * c[k] + i[k] * math.tanh(z[3 * n + k]) for k in range(n)]
        h = [o[k] * math.tanh(c[k]) for k in range(n)]
        out.append(h)
    return out
