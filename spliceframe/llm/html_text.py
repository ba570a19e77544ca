"""HTML extraction by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: stretches of text between block-level tags. A bidirectional LSTM in numpy
reads, for each block, a vector of the elements above it (names, classes, ids and roles, hashed), one of its words (hashed)
and a few counts, and labels every block with the whole page in view; the blocks of the main text are kept.

The network is trained here, on pages that a generator writes from random words: articles in many kinds of wrappers with
menus, headers, footers, sidebars, notices, adverts, forms and reader comments around and inside them.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from spliceframe.llm.common import Sealed, table

#: What follows a tag's name up to the > that ends it, with > inside quotes passed over.
_REST = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+""")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("script style template noscript head svg math iframe object select textarea button canvas video audio title".split())
_RAW = frozenset("script style textarea title iframe noscript template".split())
#: A start tag that ends an open element of the same kind, or an open paragraph.
_ENDS = {"li": "li", "dt": "dt", "dd": "dd", "tr": "tr", "td": "td", "th": "th", "option": "option"}


class Element:
    """An open element. What blocks need of all elements above them is summed up here, so that nothing copies paths."""

    __slots__ = ("above", "buckets", "depth", "heading", "names", "tag")

    def __init__(self, tag: str, names: tuple[str, ...], above: Element | None):
        self.tag, self.names, self.above = tag, names, above
        own = sum(1 << b for b in {_path_bucket(x) if len(x) < 24 else _bucket(x, N_PATH) for x in names})
        self.buckets: int = own | (above.buckets if above else 0)
        self.depth: int = len(names) + (above.depth if above else 0)
        last = (names[-3:] if len(names) > 2 or not above else (*above.last(3 - len(names)), *names))
        self.heading = any(x in ("h1", "h2", "h3") for x in last)

    def last(self, n: int) -> tuple[str, ...]:
        out: tuple[str, ...] = ()
        at: Element | None = self
        while at and len(out) < n:
            out = (*at.names[-(n - len(out)) :], *out)
            at = at.above
        return out


@dataclass
class Block:
    element: Element | None  # the innermost around it
    text: str
    linked: int  # characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        """Tag names, and .class, #id and @role parts, outermost first."""
        return self.element.last(self.element.depth) if self.element else ()


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    out = [tag]
    if "=" in attributes:
        for kind, *values in _ATTRIBUTE.findall(attributes):
            mark = {"class": ".", "id": "#"}.get(kind.lower(), "@")
            out += [mark + x for x in re.split(r"[\s_-]+|(?<=[a-z])(?=[A-Z])", "".join(values)) if x]
    return tuple(x.lower() for x in out)


def _markup(page: str, jump: list[int]) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, / or nothing, name, attributes) of tags; comments, declarations and the like without a name.

    jump: holds a place before which the caller wants no more. Time grows with the page's length, whatever is left open: where no > follows, no tag does; once quotes have not
    closed before the page's end, they no longer hide a >.
    """
    at, quotes = 0, True
    close = -1  # the first > at or after where it was last looked for
    while (start := page.find("<", max(at, jump[0]))) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = end + 3 if end >= 0 else len(page)
            yield start, end, "", "", ""
            at = end
            continue
        if close < start and (close := page.find(">", start)) < 0:
            return
        name = _NAME.match(page, start + 1)
        if name is None:
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                yield start, close + 1, "", "", ""
                at = close + 1
            else:
                at = start + 1
            continue
        end = close
        if quotes:
            end = _REST.match(page, name.end()).end()
            if end >= len(page) or page[end] != ">":
                quotes, end = False, close
        if end < name.end():
            at = start + 1
            continue
        yield start, end + 1, name[1], name[2].lower(), page[name.end() : end]
        at = end + 1


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page that are rendered, with white space folded and character references decoded."""
    page = page or ""
    top: Element | None = None
    open_tags: Counter[str] = Counter()
    out: list[Block] = []
    parts: list[str] = []
    links, linked, hidden, at = 0, 0, 0, 0
    jump = [0]

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(top, text, linked))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if not hidden and text:
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(text)

    def pop() -> str:
        nonlocal top, hidden
        tag, top = top.tag, top.above
        open_tags[tag] -= 1
        hidden -= tag in _UNSEEN
        return tag

    for start, end, shut, tag, attributes in _markup(page, jump):
        add(page[at:start])
        at = end
        if not tag:
            continue
        if tag in _INLINE:
            if tag == "a":
                links = max(0, links - 1) if shut else 1
            elif tag == "br" and not hidden:
                parts.append(" ")
            continue
        flush()
        if not shut:
            if tag in _VOID:
                continue
            if tag in _RAW and not attributes.endswith("/"):
                raw = re.compile(rf"</{tag}\b", re.I).search(page, at)
                at = jump[0] = (page.find(">", raw.end()) + 1 if raw else 0) or len(page)
                continue
            if top and (top.tag == "p" or top.tag == _ENDS.get(tag)):
                pop()
            if not attributes.endswith("/"):
                top = Element(tag, _names(tag, attributes), top)
                open_tags[tag] += 1
                hidden += tag in _UNSEEN
        elif open_tags[tag]:
            while pop() != tag:
                pass
            links = 0
    add(page[at:])
    flush()
    return out


# ---- vectors of blocks

N_PATH, N_WORDS, N_COUNTS = 192, 32, 9
_WORD = re.compile(r"\w+")


def _bucket(text: str, n: int) -> int:
    return zlib.crc32(text.encode()) % n


@cache
def _path_bucket(token: str) -> int:
    return _bucket(token, N_PATH)


_path_vectors: dict[int, np.ndarray] = {}
_word_buckets: dict[str, int] = {}


def _path_vector(buckets: int) -> np.ndarray:
    """1 for each of the buckets, given as the bits of a number."""
    v = _path_vectors.get(buckets)
    if v is None:
        if len(_path_vectors) > 50_000:
            _path_vectors.clear()
        v = _path_vectors[buckets] = np.unpackbits(np.frombuffer(buckets.to_bytes(N_PATH // 8, "little"), np.uint8), bitorder="little").astype(np.float32)
    return v


def vectors(blocks: list[Block]) -> np.ndarray:
    n = len(blocks)
    out = np.zeros((n, N_PATH + N_WORDS + N_COUNTS), np.float32)
    for i, b in enumerate(blocks):
        depth, heading = (b.element.depth, b.element.heading) if b.element else (0, False)
        out[i, :N_PATH] = _path_vector(b.element.buckets if b.element else 0)
        words = _WORD.findall(b.text.lower())
        ids = []
        for w in words:
            x = _word_buckets.get(w)
            if x is None:
                if len(_word_buckets) > 500_000:
                    _word_buckets.clear()
                x = _word_buckets[w] = _bucket(w, N_WORDS)
            ids.append(x)
        if ids:
            out[i, N_PATH : N_PATH + N_WORDS] = np.bincount(ids, minlength=N_WORDS) / len(ids) * 4
        chars = len(b.text)
        out[i, N_PATH + N_WORDS :] = (
            np.log1p(len(words)) / 5, b.linked / chars, sum(map(b.text.count, ".!?")) / (len(words) + 1), (b.text[-1] in ".!?\"»”"), i / n, (n - i) / n, depth / 12,
            "©" in b.text or "(c)" in b.text, heading,
        )
    return out


# ---- the network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction over (time, batch, features) with a mask of (time, batch, 1)."""

    def __init__(self, w: dict[str, np.ndarray], name: str):
        self.w, self.name = w, name

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = True) -> np.ndarray:
        """keep: what backward() needs."""
        wx, wh, b = (self.w[self.name + k] for k in ("x", "h", "b"))
        size = wh.shape[0]
        before = x @ wx + b
        h = c = np.zeros((x.shape[1], size), np.float32)
        self.steps, hs = [], []
        for t in range(len(x)):
            z = before[t] + h @ wh
            gates, new = _sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
            i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
            c1 = f * c + i * new
            tc = np.tanh(c1)
            h1 = o * tc
            if keep:
                self.steps.append((h, c, i, f, o, new, tc))
            h, c = mask[t] * h1 + (1 - mask[t]) * h, mask[t] * c1 + (1 - mask[t]) * c
            hs.append(h)
        self.x, self.mask = (x, mask) if keep else (None, None)
        return np.stack(hs)

    def backward(self, slope: np.ndarray) -> dict[str, np.ndarray]:
        wx, wh = self.w[self.name + "x"], self.w[self.name + "h"]
        dh = dc = np.zeros((self.x.shape[1], wh.shape[0]), np.float32)
        dz_all, dwh = [], np.zeros_like(wh)
        for t in range(len(self.x) - 1, -1, -1):
            h, c, i, f, o, new, tc = self.steps[t]
            m = self.mask[t]
            dh = dh + slope[t]
            dh1, dc1 = dh * m, dc * m
            dc1 = dc1 + dh1 * o * (1 - tc * tc)
            dz = np.concatenate([dc1 * new * i * (1 - i), dc1 * c * f * (1 - f), dh1 * tc * o * (1 - o), dc1 * i * (1 - new * new)], 1)
            dwh += h.T @ dz
            dh, dc = dh * (1 - m) + dz @ wh.T, dc * (1 - m) + dc1 * f
            dz_all.append(dz)
        dz = np.stack(dz_all[::-1])
        return {self.name + "x": self.x.reshape(-1, wx.shape[0]).T @ dz.reshape(-1, wx.shape[1]), self.name + "h": dwh, self.name + "b": dz.sum((0, 1))}


class Labeller:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.ahead, self.back = Lstm(weights, "a"), Lstm(weights, "b")

    @classmethod
    def new(cls, features: int, size: int, seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        w = {}
        for d in "ab":
            w |= {d + "x": rng.normal(0, 0.15, (features, 4 * size)), d + "h": rng.normal(0, 0.15, (size, 4 * size)), d + "b": np.r_[np.zeros(size), np.ones(size), np.zeros(2 * size)]}
        w |= {"out": rng.normal(0, 0.3, 2 * size), "bias": np.zeros(1)}
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _both(self, pages: list[np.ndarray], keep: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hidden states of both directions, in page order, with the mask and each page's reversed order."""
        lengths = np.array([len(p) for p in pages])
        longest = int(lengths.max())
        x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
        for i, p in enumerate(pages):
            x[: len(p), i] = p
        t = np.arange(longest)[:, None]
        mask = (t < lengths)[:, :, None].astype(np.float32)
        flip = np.where(t < lengths, lengths - 1 - t, t)
        cols = np.arange(len(pages))[None, :]
        ahead = self.ahead.forward(x, mask, keep)
        back = self.back.forward(x[flip, cols], mask, keep)[flip, cols]
        return np.concatenate([ahead, back], 2), mask, flip

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page, the probability of every block to be main text."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            n = max(1, min(256, 20_000 // len(pages[order[min(at + 255, len(order) - 1)]])))
            mine = order[at : at + n]
            at += n
            h, _, _ = self._both([pages[i] for i in mine], False)
            p = _sigmoid(h @ self.w["out"] + self.w["bias"])
            for j, i in enumerate(mine):
                out[i] = p[: len(pages[i]), j]
        return out

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int, batch: int, rate: float, seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        mean, square, n = {k: np.zeros_like(v) for k, v in self.w.items()}, {k: np.zeros_like(v) for k, v in self.w.items()}, 0
        steps = epochs * -(-len(pages) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            order = sorted(order, key=lambda i: len(pages[i]) // 16)  # pages of like length together
            starts = rng.permutation(range(0, len(pages), batch))
            for at in starts:
                mine = order[at : at + batch]
                h, mask, flip = self._both([pages[i] for i in mine])
                y = np.zeros(mask.shape[:2], np.float32)
                for j, i in enumerate(mine):
                    y[: len(labels[i]), j] = labels[i]
                slope = (_sigmoid(h @ self.w["out"] + self.w["bias"]) - y) * mask[:, :, 0] / mask.sum()
                grads = {"out": (h * slope[:, :, None]).sum((0, 1)), "bias": slope.sum(keepdims=True).reshape(1)}
                dh = slope[:, :, None] * self.w["out"]
                size = dh.shape[2] // 2
                cols = np.arange(len(mine))[None, :]
                grads |= self.ahead.backward(dh[:, :, :size]) | self.back.backward(dh[:, :, size:][flip, cols])
                n += 1
                length = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g / max(1.0, length) + 1e-5 * self.w[k]
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    now = rate * (1 - n / (steps + 1))
                    self.w[k] -= (now * (mean[k] / (1 - 0.9**n)) / (np.sqrt(square[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
        return self


# ---- pages to train on

_SYLLABLES = ("the an re er in on at ing ed st ti ha or th ly ble", "ch ein der en ung lich keit zu ver be ö ü ß sch", "le é eau tion ai qu ou ment è ç vi re", "ción os la que ez ñ í ado mente co ar", "ka to mi no shi ra de ku 中 文 да не ми ро")
_BOILER = "home about contact login search menu privacy terms cookies accept subscribe newsletter share reply comment comments posted advertisement sponsored related popular more read sign copyright rights reserved follow tags next previous".split()


class Pages:
    """Writes pages of random words with each leaf block labelled 1 (main text) or 0, through a mark that parsing keeps."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)  # single draws: numpy's take many times as long

    def one(self, xs):
        return xs[int(self.rng.random() * len(xs))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def number(self, lo: int, hi: int) -> int:
        return lo + int(self.rng.random() * (hi - lo))

    def word(self) -> str:
        return "".join(self.one(self.tongue) for _ in range(self.number(1, 5)))

    def words(self, lo: int, hi: int, boiler: float = 0) -> str:
        return " ".join(self.one(_BOILER) if self.chance(boiler) else self.word() for _ in range(self.number(lo, hi)))

    def sentences(self, lo: int, hi: int, boiler: float = 0) -> str:
        out = " ".join(self.words(2, 18, boiler).capitalize() + self.one(".....!?") for _ in range(self.number(lo, hi)))
        k = self.rng.random()
        if k < 0.04:  # shouting, one word over and over, lists in a line, numbers
            return " ".join(w.upper() + "!!" for w in out.split())
        if k < 0.07:
            return " ".join([self.word()] * self.number(1, 30))
        if k < 0.1:
            return self.one([" | ", ", ", "; "]).join(out.split())
        return out if k < 0.97 else out + f" {self.number(0, 10**9)} +{self.number(0, 99)} ({self.number(0, 999)}) {self.word()}@{self.word()}.com"

    def attributes(self, *names: str) -> str:
        n = self.one(names)
        n = self.one([n, n, n.replace("-", "_"), f"{n} {self.word()}", f"{self.word()} {n}", f"{n}-{self.number(0, 99)}", f"site-{n}", f"{n}-wrap"])
        return self.one([f' class="{n}"', f' class="{n}"', f' id="{n}"', f" class='{n}' id=\"{n}\""])

    def plain(self) -> str:
        return self.attributes("row", "col", "box", "wrap", "inner", "container", "page", "layout", "block", "section", "grid") if self.chance(0.5) else ""

    def text(self, label: int, text: str) -> str:
        return f"{text}\x03{label}"

    def link(self, boiler: float) -> str:
        return f'<a href="/{self.word()}">{self.text(0, self.words(1, 6, boiler))}</a>'

    def links(self, boiler: float = 0.3) -> str:
        kind = self.one(["ul", "ol", "div", "p"])
        n = self.number(2, 9)
        if kind in ("ul", "ol"):
            return f"<{kind}>" + "".join(f"<li>{self.link(boiler)}{'</li>' if self.chance(0.9) else ''}" for _ in range(n)) + f"</{kind}>"
        return f"<{kind}>" + self.one([" ", " | ", "</div><div>" if kind == "div" else " "]).join(self.link(boiler) for _ in range(n)) + f"</{kind}>"

    def prose(self, boiler: float = 0.1) -> str:
        """Text of a part that isn't main: bare, or in paragraphs, headings, lists."""
        t = self.text(0, self.sentences(1, 4, boiler))
        return self.one([t, t, f"<p>{t}</p>", f"<div>{t}</div>", f"<h3>{self.text(0, self.words(1, 5, boiler))}</h3><p>{t}</p>", f"<span>{t}</span>", f"<p>{t}</p><p>{self.text(0, self.sentences(1, 3, boiler))}</p>"])

    def menu(self) -> str:
        return self.one([f"<nav{self.plain()}>{self.links()}</nav>", f"<div{self.attributes('nav', 'menu', 'navbar', 'navigation', 'breadcrumb', 'breadcrumbs', 'topnav', 'toolbar', 'pagination')}>{self.links()}</div>", f"<nav>{self.links()}{self.prose(0.4)}</nav>"])

    def header(self) -> str:
        inner = self.one([f"<h1>{self.text(0, self.words(1, 5))}</h1>", f"<div{self.attributes('logo', 'brand', 'tagline')}>{self.text(0, self.words(1, 6))}</div>", "", f"<p>{self.text(0, self.sentences(1, 2))}</p>"]) + self.one([self.menu(), "", self.prose(0.2)])
        return self.one([f"<header{self.plain()}>{inner}</header>", f"<div{self.attributes('header', 'masthead', 'top', 'banner', 'topbar')}>{inner}</div>"])

    def footer(self) -> str:
        t = self.one(["&copy; ", "© ", "", "Copyright "]) + self.words(1, 4) + self.one([" &middot; ", " ", ". "]) + self.sentences(1, 4, 0.15)
        inner = self.one([self.text(0, t), f"<p>{self.text(0, t)}</p>", f"<div>{self.text(0, t)}</div>{self.links()}", self.links() + f"<p>{self.text(0, t)}</p>"])
        return self.one([f"<footer{self.plain()}>{inner}</footer>", f"<footer>{inner}</footer>", f"<div{self.attributes('footer', 'bottom', 'copyright', 'colophon', 'legal')}>{inner}</div>"])

    def side(self) -> str:
        inner = self.one([self.links(0.1), self.prose(), self.prose() + self.links(), f"<h3>{self.text(0, self.words(1, 4, 0.3))}</h3>" + self.links(0.05)])
        return self.one([f"<aside{self.plain()}>{inner}</aside>", f"<aside>{inner}</aside>", f"<div{self.attributes('sidebar', 'side', 'widget', 'related', 'recommended', 'popular', 'recent', 'trending', 'more', 'rail', 'secondary', 'promo-list', 'teaser', 'read-more', 'author-bio', 'tags', 'share', 'social', 'meta')}>{inner}</div>"])

    def advert(self) -> str:
        tag = self.one(["div", "div", "div", "section", "aside", "p", "ins"])
        return f"<{tag}{self.attributes('ad', 'ad', 'ads', 'advert', 'advertisement', 'banner', 'sponsored', 'sponsor', 'promo', 'promotion', 'adsbox', 'commercial')}>{self.prose(0.05) if tag != 'p' else self.text(0, self.sentences(1, 4))}</{tag}>"

    def notice(self) -> str:
        tag = self.one(["div", "div", "section", "dialog"])
        return f"<{tag}{self.attributes('cookie', 'cookies', 'cookie-banner', 'consent', 'gdpr', 'notice', 'notification', 'alert', 'popup', 'modal', 'overlay', 'newsletter', 'subscribe', 'paywall', 'privacy', 'disclaimer', 'message', 'warning', 'announcement', 'signup')}{self.one(['', ' role=\"alert\"', ' role=\"dialog\"'])}>{self.prose(0.1)}</{tag}>"

    def form(self) -> str:
        t = lambda: self.text(0, self.words(1, 6, 0.3))
        return f"<form{self.one(['', self.attributes('search', 'login', 'contact', 'subscribe', 'form')])}>" + "".join(self.one([f"<label>{t()}</label><input name=x>", f"<p>{t()}</p>", f"<div><label>{t()}</label> <input></div>", f"<fieldset><legend>{t()}</legend></fieldset>", f"<p>{self.text(0, self.sentences(1, 3))}</p>"]) for _ in range(self.number(1, 5))) + "<button>Go</button></form>"

    def comments(self) -> str:
        def comment() -> str:
            inner = self.one([f"<p>{self.text(0, self.sentences(1, 4))}</p>", self.text(0, self.sentences(1, 4)), f"<b>{self.word()}</b> {self.text(0, self.sentences(1, 3))}", f"<div{self.attributes('author', 'user', 'byline')}>{self.text(0, self.words(1, 3))}</div><p>{self.text(0, self.sentences(1, 5))}</p>", f"<h4>{self.text(0, self.words(1, 3))}</h4><p>{self.text(0, self.sentences(1, 3))}</p><p>{self.text(0, self.sentences(1, 3))}</p>"])
            tag = self.one(["div", "li", "article", "section"])
            return f"<{tag}{self.one([self.attributes('comment', 'reply', 'response', 'post'), self.attributes('comment'), ''])}>{inner}</{tag}>"

        tag = self.one(["section", "div", "div", "ol", "ul"])
        head = f"<h2>{self.text(0, self.words(1, 4, 0.5))}</h2>" if tag in ("section", "div") and self.chance(0.6) else ""
        return f"<{tag}{self.attributes('comments', 'comments', 'comment-list', 'commentlist', 'replies', 'responses', 'discussion', 'disqus', 'reader-comments', 'feedback')}>{head}{''.join(comment() for _ in range(self.number(1, 6)))}</{tag}>"

    def paragraph(self) -> str:
        t = self.text(1, self.sentences(1, 7) if self.chance(0.85) else self.words(1, 4).capitalize() + self.one(["", ".", ".", "!", ":"]))
        k = self.rng.random()
        if k < 0.68:
            return self.one([f"<p>{t}</p>", f"<p>{t}</p>", f"<p><b>{t}<br>", f"<p>{t}", f"<P>{t}</P>", f"<p{self.attributes('text', 'lead', 'intro', 'first')}>{t}</p>"])
        if k < 0.78:
            n = self.one([2, 3, 4])
            return f"<h{n}>{self.text(1, self.words(1, 8))}</h{n}><p>{t}</p>"
        if k < 0.85:
            kind = self.one(["ul", "ol"])
            return f"<{kind}>" + "".join(f"<li>{self.text(1, self.words(1, 12))}</li>" for _ in range(self.number(2, 6))) + f"</{kind}>"
        if k < 0.9:
            return f"<blockquote>{self.one([t, f'<p>{t}</p>'])}</blockquote>"
        if k < 0.93:
            return f"<pre>{t}</pre>"
        if k < 0.96:
            return f"<figure><img src=x.png><figcaption>{self.text(1, self.words(2, 9))}</figcaption></figure>"
        if k < 0.98:
            return "<table>" + "".join(f"<tr><td>{self.text(1, self.words(1, 4))}</td><td>{self.text(1, self.words(1, 4))}</td></tr>" for _ in range(3)) + "</table>"
        return f'<p>{self.text(1, self.sentences(1, 3) + f" <a href=x>{self.words(1, 4)}</a> " + self.sentences(1, 3))}</p>'

    def article(self) -> str:
        out = [f"<h1{self.one(['', self.attributes('title', 'headline', 'entry-title')])}>{self.text(1, self.words(2, 12))}</h1>" if self.chance(0.85) else ""]
        if self.chance(0.2):
            out[0] = f"<header>{out[0]}</header>"
        for _ in range(self.number(1, 14)):
            out.append(self.paragraph())
            if self.chance(0.06):
                out.append(self.one([self.advert, self.side, self.notice, self.form])())
        if self.chance(0.12):
            out.append(self.comments())
        names = ("content", "article", "post", "entry", "story", "text", "body", "post-content", "article-body", "entry-content", "main-content", "main", "page-content", "prose")
        inner = "".join(out)
        return self.one([f"<article{self.plain()}>{inner}</article>", f"<article>{inner}</article>", f"<main>{inner}</main>", f"<main><article{self.one(['', self.attributes(*names)])}>{inner}</article></main>", f"<div{self.attributes(*names)}>{inner}</div>", f"<section{self.attributes(*names)}>{inner}</section>", f'<div role="main">{inner}</div>', f"<div{self.attributes('main')}><div{self.attributes(*names)}>{inner}</div></div>", f'<div itemprop="articleBody">{inner}</div>'])

    def page(self) -> str:
        self.tongue = self.one(_SYLLABLES).split()
        parts = [x() for x, p in ((self.notice, 0.2), (self.header, 0.5), (self.menu, 0.65), (self.form, 0.12), (self.advert, 0.45), (self.side, 0.2)) if self.chance(p)]
        after = [x() for x, p in ((self.advert, 0.25), (self.comments, 0.4), (self.side, 0.4), (self.form, 0.15), (self.notice, 0.2)) if self.chance(p)]
        self.rng.shuffle(parts)
        self.rng.shuffle(after)
        inner = "".join(parts) + self.article() + "".join(after) + (self.footer() if self.chance(0.8) else "")
        for _ in range(self.number(0, 3)):
            inner = f"<div{self.plain()}>{inner}</div>"
        return f"<html><head><title>{self.word()}</title></head><body>{inner}</body></html>"

    def sample(self) -> tuple[np.ndarray, np.ndarray]:
        blocks = blocks_of(self.page())
        labels = []
        for b in blocks:
            marks = re.findall(r"\x03([01])", b.text)
            labels.append(int(marks[-1]) if marks else 0)
            b.linked = max(0, b.linked - 2 * len(marks)) if b.linked else 0
            b.text = re.sub(r"\s*\x03[01]", "", b.text) or "-"
        return vectors(blocks), np.array(labels, np.float32)


@cache
def labeller(pages: int = 3000, size: int = 24, epochs: int = 8, batch: int = 24, rate: float = 0.01, seed: int = 3) -> Labeller:
    """The trained network; a seed makes reruns agree."""
    writer = Pages(seed)
    xs, ys = zip(*(writer.sample() for _ in range(pages)), strict=True)
    return Labeller.new(N_PATH + N_WORDS + N_COUNTS, size, seed).train(list(xs), list(ys), epochs, batch, rate, seed)


def extract(pages: DataFrame, html_col: str = "html", model: Labeller | None = None, cut: float = 0.5) -> DataFrame:
    """pages without html_col and with text and n_chars.

    text: the main blocks in page order, joined by \\n; each with white space folded to one space, trimmed, character
    references decoded. Null, empty and text-less pages give "". Columns text and n_chars of pages are replaced.
    """
    s = Sealed(pages, "text", "n_chars")
    rest, given = s.df, s[html_col]
    keep = [c for c in rest.columns if c != given]
    held = pages.sparkSession.sparkContext.broadcast((model or labeller()).w)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = Labeller(held.value)
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                some = pdf.iloc[at : at + 512]
                blocks = [blocks_of(h) for h in some[given]]
                main = net.label([vectors(b) for b in blocks])
                text = ["\n".join(b.text for b, x in zip(bs, p, strict=True) if x >= cut) for bs, p in zip(blocks, main, strict=True)]
                yield some[keep].assign(text=text, n_chars=[len(t) for t in text])

    schema = StructType([*(f for f in rest.schema if f.name != given), StructField("text", StringType()), StructField("n_chars", LongType())])
    return s.opened(rest.mapInPandas(run, schema), "text", "n_chars", without=(html_col,))


def op2(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", F.col("n_chars"))
