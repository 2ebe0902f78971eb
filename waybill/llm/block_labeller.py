"""A bidirectional LSTM in numpy that labels the blocks of a page, and the pages it is trained on."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from waybill.llm.html_blocks import Block, Element, leaf_blocks
from waybill.llm.text import LOWER, blocks as byte_blocks, words

_PATH, _WORDS, _OTHER = 256, 32, 5
SIZE = _PATH + _WORDS + _OTHER
HIDDEN = 20


def _bits(tokens: Iterable[str]) -> int:
    """Buckets of tokens, as bits of a number."""
    return functools.reduce(int.__or__, (1 << zlib.crc32(t.encode()) % _PATH for t in tokens), 0)


@functools.lru_cache(1 << 14)
def _own_bits(above: str, name: str, named: tuple[str, ...]) -> int:
    return _bits([name, f"{above}>{name}", *(f".{w}" for w in named)])


@functools.lru_cache(1 << 14)
def _near_bits(distance: int, name: str, named: tuple[str, ...]) -> int:
    """By distance from the leaf: what is nearest says most."""
    return _bits(f"{distance}{t}" for t in (name, *(f".{w}" for w in named)))


def _marks(element: Element | None) -> int:
    """Buckets of an element and all above it; each is looked at once a page, however many blocks are below it."""
    new = []
    while element and element.marks < 0:
        new.append(element)
        element = element.above
    marks = element.marks if element else 0
    for e in reversed(new):
        e.marks = marks = marks | _own_bits(e.above.name if e.above else "", e.name, e.named)
    return marks


@functools.lru_cache(1 << 14)
def _listed(bits: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes(_PATH // 8, "little"), np.uint8), bitorder="little"))


def _path_buckets(leaf: Element | None) -> np.ndarray:
    bits = _marks(leaf)
    for distance in range(2):
        if leaf:
            bits |= _near_bits(distance, leaf.name, leaf.named)
            leaf = leaf.above
    return _listed(bits)


def vectors(page: list[Block]) -> np.ndarray:
    """One row a block: buckets of its tag path, shares of its words by hash bucket, length, links, place."""
    out = np.zeros((len(page), SIZE), np.float32)
    if not page:
        return out
    row = 0
    for _, data, offsets in byte_blocks(pa.array([b.text for b in page], pa.string())):
        w = words(data, offsets)
        bucket = (w.hashes(data, LOWER) % np.uint64(_WORDS)).astype(np.int64)
        counts = np.diff(w.offsets)
        whose = np.repeat(np.arange(len(counts)), counts)
        shares = np.bincount(whose * _WORDS + bucket, minlength=len(counts) * _WORDS).reshape(-1, _WORDS) / np.maximum(counts, 1)[:, None]
        out[row : row + len(counts), _PATH : _PATH + _WORDS] = shares
        out[row : row + len(counts), _PATH + _WORDS] = np.log1p(counts) / 5
        row += len(counts)
    for k, b in enumerate(page):
        out[k, _path_buckets(b.leaf)] = 1
        out[k, _PATH + _WORDS + 1] = b.linked / len(b.text)
        out[k, _PATH + _WORDS + 2] = b.text[-1] in ".!?:;\"'"
    out[:, -2] = np.arange(len(page)) / len(page)
    out[:, -1] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


Weights = dict[str, np.ndarray]


def _run(x: np.ndarray, w: np.ndarray, u: np.ndarray, learning: bool = True) -> tuple[np.ndarray, list]:
    """Hidden states over steps of x (steps, pages, gates already weighted in); when learning, with what the way back needs."""
    h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
    states, kept = np.empty((*x.shape[:2], HIDDEN), np.float32), []
    weighted = x @ w
    for t in range(len(x)):
        z = weighted[t] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, was = c, h
        c = f * c + i * g
        h = o * np.tanh(c)
        states[t] = h
        if learning:
            kept.append((i, f, o, g, before, c, was))
    return states, kept


def _back(x: np.ndarray, u: np.ndarray, kept: list, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dw, du = np.zeros((x.shape[2], 4 * HIDDEN), np.float32), np.zeros_like(u)
    dh, dc = np.zeros_like(d[0]), np.zeros_like(d[0])
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, before, c, was = kept[t]
        dh = dh + d[t]
        s = np.tanh(c)
        dc = dc + dh * o * (1 - s * s)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dw += x[t].T @ dz
        du += was.T @ dz
        dh, dc = dz @ u.T, dc * f
    return dw, du


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps first, forwards and backwards (each page turned in its own length), and which steps are a page's own."""
    n = max(map(len, pages))
    ahead, back, real = np.zeros((n, len(pages), SIZE), np.float32), np.zeros((n, len(pages), SIZE), np.float32), np.zeros((n, len(pages)), bool)
    for k, p in enumerate(pages):
        ahead[: len(p), k], back[: len(p), k], real[: len(p), k] = p, p[::-1], True
    return ahead, back, real


def _turned(states: np.ndarray, lengths: list[int]) -> np.ndarray:
    out = np.zeros_like(states)
    for k, n in enumerate(lengths):
        out[:n, k] = states[:n, k][::-1]
    return out


def scores(weights: Weights, pages: list[np.ndarray]) -> list[np.ndarray]:
    """For every block of every page the probability that it belongs to the article."""
    out: list[np.ndarray] = [np.empty(0, np.float32)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):  # pages of about one length together, few of the long ones
        n = 1
        while at + n < len(order) and n < 256 and (n + 1) * len(pages[order[at + n]]) <= 8192:
            n += 1
        chosen = order[at : at + n]
        ahead, back, _ = _padded([pages[k] for k in chosen])
        lengths = [len(pages[k]) for k in chosen]
        states = np.concatenate([_run(ahead, weights["w1"], weights["u1"], False)[0], _turned(_run(back, weights["w2"], weights["u2"], False)[0], lengths)], axis=2)
        p = _sigmoid(states @ weights["v"] + weights["b"])[..., 0]
        for j, k in enumerate(chosen):
            out[k] = p[: lengths[j], j]
        at += n
    return out


def train(n_pages: int = 900, epochs: int = 6, batch: int = 30, rate: float = 0.01, seed: int = 7) -> Weights:
    """Fits the labeller to made pages. The number of pages is the bound on what it learns from."""
    rng = np.random.default_rng(seed)
    made = [example(rng) for _ in range(n_pages)]
    made = [(vectors(b), y) for b, y in made if b]

    def start(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    weights = {"w1": start(SIZE, 4 * HIDDEN), "u1": start(HIDDEN, 4 * HIDDEN), "w2": start(SIZE, 4 * HIDDEN), "u2": start(HIDDEN, 4 * HIDDEN), "v": start(2 * HIDDEN, 1), "b": np.zeros(1, np.float32)}
    mean, square = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(made))
        for at in range(0, len(order), batch):
            part = [made[k] for k in order[at : at + batch]]
            ahead, back, real = _padded([x for x, _ in part])
            lengths = [len(x) for x, _ in part]
            y = np.zeros(real.shape, np.float32)
            for k, (_, labels) in enumerate(part):
                y[: len(labels), k] = labels
            s1, kept1 = _run(ahead, weights["w1"], weights["u1"])
            s2, kept2 = _run(back, weights["w2"], weights["u2"])
            states = np.concatenate([s1, _turned(s2, lengths)], axis=2)
            d = (_sigmoid(states @ weights["v"] + weights["b"])[..., 0] - y) * real / real.sum()
            ds = d[..., None] * weights["v"][:, 0]
            grads = {"v": np.einsum("tbh,tb->h", states, d)[:, None], "b": d.sum(keepdims=True).reshape(1)}
            grads["w1"], grads["u1"] = _back(ahead, weights["u1"], kept1, ds[..., :HIDDEN])
            grads["w2"], grads["u2"] = _back(back, weights["u2"], kept2, _turned(ds[..., HIDDEN:], lengths))
            step += 1
            for k, g in grads.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                weights[k] = (weights[k] - rate * (1 - epoch / epochs) * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return weights


@functools.cache
def trained() -> Weights:
    return train()


# --- made pages -----------------------------------------------------------------------------------------------

_SYLLABLES = ("an er in th on re ti es or at en nt is of ou ha st le la ed", "der die ein sch ung ver zu und ich be ge heit keit lich", "que es la el os do ra mente ci on ado", "le de eau ou ai re on tre ment par qui eux")
_CHROME = (
    "home about contact search login sign in up menu products services news blog help share tweet follow us subscribe newsletter email privacy policy terms cookies accept all rights "
    "reserved copyright read more next previous related posts comments reply advertisement sponsored click here archive categories tags sitemap"
).split()
_MAIN = ("article", "main", 'div class="content"', 'div id="main-content"', 'div class="post entry"', 'section class="story text"', 'div role="main"', 'div class="article-body"')


def example(rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """Blocks of one made page and which are its article's."""
    found = leaf_blocks(_page(rng))
    return found, np.array([b.leaf.attributes.endswith(" data-y") if b.leaf else False for b in found], np.float32)


def _page(rng: np.random.Generator) -> str:
    alphabet = _SYLLABLES[rng.integers(len(_SYLLABLES))].split()

    def prose(n: int) -> str:
        style = rng.random()
        made = ["".join(alphabet[k] for k in rng.integers(len(alphabet), size=rng.integers(1, 4))) for _ in range(max(1, n))]
        if style < 0.08:
            made = [m.upper() + "!!" for m in made]
        elif style < 0.16:
            made = [m + "***" for m in made]
        elif style < 0.2:
            made = [made[0]] * len(made)
        text = " ".join(made)
        return text.capitalize() + ("." if rng.random() < 0.85 else "")

    def chrome(n: int) -> str:
        return prose(n) if rng.random() < 0.5 else " ".join(_CHROME[k] for k in rng.integers(len(_CHROME), size=max(1, n)))

    def some(*options: str) -> str:
        return options[rng.integers(len(options))]

    def links(n: int, kind: str) -> str:
        return f"<{kind}>" + "".join(f'<li><a href="/{k}">{chrome(rng.integers(1, 3))}</a></li>' for k in range(n)) + f"</{kind}>"

    def box(opening: str, inside: str) -> str:
        return f"<{opening}>{inside}</{opening.split()[0]}>"

    def notes() -> str:
        kind = some('div class="comments"', 'section id="comments"', 'div class="comment-list"', 'ol class="commentlist"')
        return box(kind, "".join(f'<div class="comment"><p>{prose(rng.integers(1, 30))}</p></div>' for _ in range(rng.integers(1, 5))))

    def aside() -> str:
        return some(
            box(some("aside", 'div class="sidebar"', 'div id="sidebar"', 'aside class="related"', 'div class="widget"'), f"<h3>{chrome(2)}</h3>" + links(rng.integers(1, 6), "ul")),
            box(some('div class="ad"', 'div class="advert banner"', 'div class="sponsored"', 'section class="promo"', 'div id="ads"'), some(chrome(rng.integers(2, 25)), f"<p>{chrome(rng.integers(2, 25))}</p>")),
            box(some('div class="cookie-notice"', 'div id="notice"', 'div class="alert"', 'div class="gdpr consent"', 'div class="popup modal"'), f"<p>{chrome(rng.integers(3, 25))}</p><button>{chrome(1)}</button>"),
            box(some("form", 'form class="search"', 'form id="newsletter"', 'form class="login"'), f"<label>{chrome(2)}</label><input type=text><select><option>{chrome(1)}<option>{chrome(1)}</select><button>{chrome(1)}</button>"),
            box(some('div class="share social"', 'ul class="breadcrumb"', 'div class="pagination"', 'div class="tags"'), f"<a href=x>{chrome(1)}</a> <a href=y>{chrome(2)}</a>"),
        )

    def piece() -> str:
        kind = rng.random()
        n = int(rng.choice([1, 2, 4, 10, 40, 90]))
        if kind < 0.7:
            return f"<p data-y>{some('', '<b>', '<em>')}{prose(n)}{some('', '<br>')}" + some("</p>", "</p>", "")
        if kind < 0.8:
            return f"<{(h := some('h2', 'h3', 'h4'))} data-y>{prose(min(n, 8))}</{h}>"
        if kind < 0.87:
            return "<ul>" + "".join(f"<li data-y>{prose(rng.integers(1, 15))}</li>" for _ in range(rng.integers(1, 5))) + "</ul>"
        if kind < 0.92:
            return some("<blockquote data-y>{}</blockquote>", "<pre data-y>{}</pre>", "<div data-y>{}</div>", "<figure><figcaption data-y>{}</figcaption></figure>").format(prose(n))
        if kind < 0.95:
            return "<table><tr>" + "".join(f"<td data-y>{prose(2)}</td>" for _ in range(3)) + "</tr></table>"
        return aside()

    opening = _MAIN[0] if rng.random() < 0.45 else some(*_MAIN)
    inside = (f"<h1 data-y>{prose(rng.integers(2, 9))}</h1>" if rng.random() < 0.85 else "") + "".join(piece() for _ in range(rng.integers(1, 16)))
    if rng.random() < 0.15:
        inside += notes()
    before = [box(some("nav", 'div class="menu"', 'div id="nav"', 'div class="navbar"', 'ul class="nav"'), links(rng.integers(2, 9), "ul"))] if rng.random() < 0.85 else []
    if rng.random() < 0.4:
        before.insert(0, box(some("header", 'div id="header"', 'div class="masthead"'), f"<a href=/>{chrome(2)}</a><p>{chrome(rng.integers(2, 8))}</p>"))
    before += [aside() for _ in range(rng.integers(0, 3))]
    after = [aside() for _ in range(rng.integers(0, 3))] + ([notes()] if rng.random() < 0.35 else [])
    if rng.random() < 0.85:
        after.append(box(some("footer", 'div id="footer"', 'div class="footer"'), some("&copy; {} &middot; {}", "<p>{}</p><p>{}</p>", "{} {}").format(chrome(2), chrome(rng.integers(2, 20)))))
    body = "".join(before) + box(opening, inside) + "".join(after)
    if rng.random() < 0.2:
        body = box('div class="wrapper container"', body)
    page = f"<!DOCTYPE html><html><head><title>{prose(4)}</title><style>p{{}}</style></head><body>{body}</body></html>"
    return page[: int(len(page) * (0.6 + 0.4 * rng.random()))] if rng.random() < 0.1 else page
