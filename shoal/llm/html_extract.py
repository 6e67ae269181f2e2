"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: the texts between block-level tags. A block
is read as hashed vectors of its tag path (tags, and words of classes and ids, of
all open elements) and of its words, and a few measures. A bidirectional LSTM in
numpy runs over all blocks of the page, so each label depends on the whole
document; blocks labelled main are joined.

Training pages come from a bounded sample (``SAMPLE`` pages of least hash among
those with an article or main element, of any length; a page of over ``STEP`` blocks is
trained on in pieces): the element that marks the article
gives the labels, and copies of each page get other article wrappers, and
menus, notices, forms, adverts, sidebars and comments put in and around the
article from the texts of other pages, so that the labeller learns the names and
contexts of such blocks beyond the sample's own. The fit runs in the driver on that
sample; all pages are labelled in tasks, each by itself, in batches of pages.

Defined results: null, empty and tagless html: a page without tags is one block;
null and empty give the empty text. Repeated pages give equal results, an empty
table an empty one (without a page there is no model, and none is needed). Only comments,
scripts and styles are left out unread, to the end of the page if they are never closed, as browsers
do; all other elements (noscript, object, svg...) hold blocks that the labeller
judges, closed or not. Other columns are ignored. Where no page has such an element, nothing can be learned, and a rule labels:
every block outside ``_JUNK_TAGS`` is main.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import bounded_sample

SAMPLE = 240
STEP = 1024
_ARTICLE = r"<(article|main)\b[^>]*>"
COPIES = 4
EPOCHS = 8
PATH, WORD, MEASURES = 384, 128, 6
INNER, HIDDEN = 24, 16
_CELLS = 1 << 14

#: Attributes that training puts on elements; no feature reads them.
MARK, _JUNK = "data-training-main", "data-training-junk"
_JUNK_TAGS = frozenset("nav aside form footer button select".split())

# Possessive and without "<" inside tags, so that no input is scanned again from every "<".
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^<>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^<>]*+>|[^<]+|<", re.S | re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
                    "strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that the start of another one of the same kind closes.
_SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"},
                 "dd": {"dt", "dd"}, "option": {"option"}}
_P = frozenset(["p"])
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
                      "section table ul".split())


@lru_cache(1 << 14)
def _element_ids(tag: str, attributes: str) -> tuple[int, ...]:
    """Path slots of an element: its tag, and the words of its names."""
    names = {w.lower() for m in _NAMES.findall(attributes) for w in _WORDS.findall(" ".join(m))} if "=" in attributes else ()
    return tuple(sorted({zlib.crc32(t.encode()) % PATH for t in (f"<{tag}", *names)}))


class Block:
    """A leaf block: its text, path slots, leaf tag, characters in links, and
    whether training marks it as main text."""

    __slots__ = ("text", "path", "leaf", "linked", "main")

    def __init__(self, text, path, leaf, linked, main):
        self.text, self.path, self.leaf, self.linked, self.main = text, path, leaf, linked, main


class _Open:
    """The open elements, with what their blocks need kept up to date, so that
    a block costs the same however deep it lies."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[int, ...], bool, bool]] = []
        self.tags: dict[str, int] = {}
        self.slots: dict[int, int] = {}
        self.leaves: list[str] = [""]  # tags that are not inline
        self.main = self.junk = 0      # open elements that training marks, and of junk inside them

    def push(self, tag: str, attributes: str) -> None:
        ids = _element_ids(tag, attributes)
        main = MARK in attributes
        junk = bool(self.main) and (tag in _JUNK_TAGS or _JUNK in attributes)
        self.stack.append((tag, ids, main, junk))
        self.tags[tag] = self.tags.get(tag, 0) + 1
        for i in ids:
            self.slots[i] = self.slots.get(i, 0) + 1
        self.main, self.junk = self.main + main, self.junk + junk
        if tag not in _INLINE:
            self.leaves.append(tag)

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            tag, ids, main, junk = self.stack.pop()
            self.tags[tag] -= 1
            for i in ids:
                self.slots[i] -= 1
                if not self.slots[i]:
                    del self.slots[i]
            self.main, self.junk = self.main - main, self.junk - junk
            if tag not in _INLINE:
                self.leaves.pop()

    def close(self, tag: str) -> None:
        if self.tags.get(tag):
            self.cut(next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag))

    def close_before(self, tag: str) -> None:
        """Close the elements that the start of ``tag`` ends, as far as only
        inline elements lie between."""
        closed = _SELF_CLOSING.get(tag, _P if tag in _CLOSES_P else ())
        at = None
        if closed and any(self.tags.get(t) for t in closed):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in closed:
                    at = i
                elif self.stack[i][0] not in _INLINE:
                    break
        if at is not None:
            self.cut(at)


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order; tags that are never closed end with their parent."""
    out: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append(Block(text, tuple(sorted(open_.slots)), open_.leaves[-1], min(linked, len(text)), bool(open_.main) and not open_.junk))
        linked = 0

    for m in _TOKEN.finditer(page or ""):
        token = m[0]
        tag = m[3]
        if tag is None:
            if m[1] is not None or token[:2] in ("<!", "<?"):
                continue
            parts.append(token)
            if open_.stack and open_.stack[-1][0] == "a":
                linked += len(token)
            continue
        tag = tag.lower()
        if tag not in _INLINE:
            flush()
        if m[2]:
            open_.close(tag)
        elif tag == "br":
            parts.append(" ")
        elif tag not in _VOID:
            open_.close_before(tag)
            open_.push(tag, m[4] or "")
    flush()
    return out


@lru_cache(1 << 10)
def _leaf_id(tag: str) -> int:
    return zlib.crc32(f"leaf {tag}".encode()) % PATH


def features(page: list[Block], lo: int = 0, hi: int | None = None) -> np.ndarray:
    """(blocks, PATH + WORD + MEASURES) of the blocks lo to hi of a page."""
    some = page[lo:hi]
    n = len(some)
    out = np.zeros((n, PATH + WORD + MEASURES), np.float32)
    if not n:
        return out
    words = [b.text.lower().encode().split() for b in some]
    sizes = np.array([len(w) for w in words])
    at = np.fromiter(map(zlib.crc32, chain.from_iterable(words)), np.int64, int(sizes.sum())) % WORD
    counts = np.bincount(np.repeat(np.arange(n) * WORD, sizes) + at, minlength=n * WORD).reshape(n, WORD)
    out[:, PATH:PATH + WORD] = np.sqrt(counts / sizes[:, None])
    slots = [(*b.path, _leaf_id(b.leaf)) for b in some]
    out[np.repeat(np.arange(n), [len(x) for x in slots]), list(chain.from_iterable(slots))] = 1.0
    i, total = np.arange(lo, lo + n), len(page)
    out[:, PATH + WORD:] = np.stack([
        np.log1p(sizes) / 4, [b.linked / len(b.text) for b in some], [b.text[-1] in ".!?" for b in some], i / total,
        np.log1p(i) / 4, np.log1p(total - i) / 4], axis=1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Labeller:
    """tanh layer, bidirectional LSTM, logistic output; trained by Adam."""

    trained = True

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        mat = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.w = {"in": r.standard_normal((PATH + WORD + MEASURES, INNER)).astype(np.float32) * 0.3, "in_b": np.zeros(INNER, np.float32)}
        for d in "fb":
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1.0  # remember at first
            self.w |= {f"x{d}": mat(INNER, 4 * HIDDEN), f"h{d}": mat(HIDDEN, 4 * HIDDEN), f"b{d}": bias}
        self.w |= {"out": mat(2 * HIDDEN + INNER, 1), "out_b": np.zeros(1, np.float32)}

    def inner(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w["in"] + self.w["in_b"])

    def _run(self, d: str, z: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (batch, steps, HIDDEN) of direction d over z (batch, steps, INNER).
        Steps without a block leave the state as it is."""
        n, steps, _ = z.shape
        out = np.zeros((n, steps, HIDDEN), np.float32)
        h = c = np.zeros((n, HIDDEN), np.float32)
        wx, wh, b = self.w[f"x{d}"], self.w[f"h{d}"], self.w[f"b{d}"]
        gates = z @ wx + b
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = gates[:, t] + h @ wh
            i, f, o = (_sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN:])
            m = mask[:, t, None]
            c2 = f * c + i * u
            h2 = o * np.tanh(c2)
            if keep is not None:
                keep.append((t, h, c, i, f, o, u, c2, m))
            h, c = m * h2 + (1 - m) * h, m * c2 + (1 - m) * c
            out[:, t] = h
        return out

    def _joint(self, z, mask, keep=(None, None)):
        return np.concatenate([self._run("f", z, mask, keep[0]), self._run("b", z, mask, keep[1]), z], axis=2)

    def scores(self, z: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return _sigmoid(self._joint(z, mask) @ self.w["out"] + self.w["out_b"])[..., 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over the blocks of a batch of padded pages."""
        z = self.inner(x)
        keep: tuple[list, list] = ([], [])
        joint = self._joint(z, mask, keep)
        p = _sigmoid(joint @ self.w["out"] + self.w["out_b"])[..., 0]
        dl = ((p - y) * mask / mask.sum())[..., None]
        g = {"out": np.einsum("nti,ntj->ij", joint, dl), "out_b": dl.sum((0, 1))}
        dj = dl @ self.w["out"].T
        dz = dj[..., 2 * HIDDEN:].copy()
        for k, d in enumerate("fb"):
            dz += self._back(d, z, keep[k], dj[..., k * HIDDEN:(k + 1) * HIDDEN], g)
        da = dz * (1 - z * z)
        g |= {"in": np.einsum("nti,ntj->ij", x, da), "in_b": da.sum((0, 1))}
        return g

    def _back(self, d, z, keep, dout, g):
        wx, wh = self.w[f"x{d}"], self.w[f"h{d}"]
        dgates = np.zeros((*z.shape[:2], 4 * HIDDEN), np.float32)
        dh = dc = np.zeros((z.shape[0], HIDDEN), np.float32)
        dwh = np.zeros_like(wh)
        for t, h, c, i, f, o, u, c2, m in reversed(keep):
            dh = dh + dout[:, t]
            th = np.tanh(c2)
            dh2, dc2 = m * dh, m * dc
            dc2 = dc2 + dh2 * o * (1 - th * th)
            dg = np.concatenate([dc2 * u * i * (1 - i), dc2 * c * f * (1 - f), dh2 * th * o * (1 - o), dc2 * i * (1 - u * u)], axis=1)
            dgates[:, t] = dg
            dwh += h.T @ dg
            dh, dc = (1 - m) * dh + dg @ wh.T, (1 - m) * dc + dc2 * f
        g |= {f"x{d}": np.einsum("nti,ntj->ij", z, dgates), f"h{d}": dwh, f"b{d}": dgates.sum((0, 1))}
        return dgates @ wx.T

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 3) -> None:
        """By Adam on batches of pages of like length."""
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        pages = sorted(pages, key=lambda p: len(p[1]))
        batches = [pages[i:i + 16] for i in range(0, len(pages), 16)]
        step = 0
        for epoch in range(epochs):
            for k in r.permutation(len(batches)):
                x, mask, y = _padded([p[0] for p in batches[k]], [p[1] for p in batches[k]])
                step += 1
                rate = 0.02 * (1 - 0.9 * epoch / epochs)
                for name, v in self.gradients(x, mask, y).items():
                    first[name] += 0.1 * (v - first[name])
                    second[name] += 0.01 * (v * v - second[name])
                    self.w[name] -= (rate * first[name] / (1 - 0.9 ** step) / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Scores of the blocks of each page; pages of like length run together."""
        if not self.trained:
            junk = {i for t in _JUNK_TAGS for i in _element_ids(t, "")}
            return [np.array([float(junk.isdisjoint(b.path)) for b in p], np.float32) for p in pages]
        step = 1024
        z = [np.concatenate([self.inner(features(p, i, i + step)) for i in range(0, len(p), step)]) for p in pages if p]
        index = [i for i, p in enumerate(pages) if p]
        out = [np.zeros(0, np.float32)] * len(pages)
        order = sorted(range(len(z)), key=lambda i: len(z[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end - at + 1) * len(z[order[end]]) <= _CELLS:
                end += 1
            part = [z[i] for i in order[at:end]]
            x, mask, _ = _padded(part, [np.zeros(len(v), np.float32) for v in part])
            s = self.scores(x, mask)
            for row, i in enumerate(order[at:end]):
                out[index[i]] = s[row, :len(z[i])]
            at = end
        return out


def _padded(xs: list[np.ndarray], ys: list[np.ndarray]):
    n = max(len(y) for y in ys)
    x = np.zeros((len(xs), n, xs[0].shape[1]), np.float32)
    mask, y = np.zeros((2, len(xs), n), np.float32)
    for k, (a, b) in enumerate(zip(xs, ys)):
        x[k, :len(b)], mask[k, :len(b)], y[k, :len(b)] = a, 1.0, b
    return x, mask, y


# Wrappers of articles, and kinds of blocks that are no main text ({s}: a few
# words, {t}: a paragraph, {l}: links), as pages commonly have them.
_WRAPPERS = (
    ("article", ""), ("article", 'class="post"'), ("main", ""), ("div", 'class="content"'), ("div", 'id="main-content"'),
    ("div", 'class="entry-content"'), ("section", 'class="article-body"'), ("div", 'role="main"'), ("div", 'class="story text"'))
_BEFORE = (
    '<header><h2>{s}</h2><p>{s}</p></header>', '<header class="site-header top"><div class="logo">{s}</div><p>{t}</p></header>',
    '<div id="header"><p>{s}</p></div>', '<nav class="menu"><ul>{l}</ul></nav>', '<div class="navigation nav"><ul>{l}</ul></div>',
    '<div class="breadcrumb"><a href="/">{s}</a> / <a href="/a">{s}</a></div>', '<div id="menu"><ul>{l}</ul></div>')
_ANYWHERE = (
    '<div class="ad">{t}</div>', '<div class="advert"><p>{t}</p></div>', '<aside class="sponsored promo"><p>{t}</p></aside>',
    '<div class="ads banner"><p>{s}</p></div>', '<div class="cookie-notice"><p>{t}</p><button>{s}</button></div>',
    '<div class="notice">{t}</div>', '<p class="notice alert">{t}</p>', '<div role="alert"><p>{t}</p></div>',
    '<div class="consent popup"><p>{t}</p><a href="#">{s}</a></div>', '<form action="/find"><label>{s}</label><p>{t}</p><button>{s}</button></form>',
    '<form class="newsletter subscribe"><p>{t}</p><input name="m"><button>{s}</button></form>', '<div class="share social"><a href="#">{s}</a> <a href="#">{s}</a></div>',
    '<aside><h3>{s}</h3><p>{t}</p></aside>', '<div class="sidebar"><h3>{s}</h3><p>{t}</p><ul>{l}</ul></div>', '<div class="related"><h3>{s}</h3><ul>{l}</ul></div>',
    '<aside class="widget"><ul>{l}</ul></aside>', '<div id="sidebar"><p>{t}</p></div>')
_AFTER = (
    '<section class="comments"><h2>{s}</h2><div class="comment"><p>{t}</p></div><div class="comment"><p>{t}</p></div></section>',
    '<div id="comments"><h3>{s}</h3><ol><li class="comment"><p>{t}</p></li><li class="comment"><p>{t}</p></li></ol></div>',
    '<div class="comment-list"><p class="author">{s}</p><p>{t}</p></div>', '<ul class="replies discussion"><li>{t}</li><li>{t}</li></ul>',
    '<footer><p>{t}</p></footer>', '<div id="footer"><p>{s}</p></div>', '<footer class="site-footer">&copy; {s}</footer>', '<div class="copyright footer">{s}</div>')
_TEXT_TAGS = ("p", "p", "p", "div", "li", "blockquote", "h2", "h3", "pre", "td")


def _copy(page: str, texts: list[str], r: np.random.Generator, plain: bool) -> str | None:
    """``page`` with its article marked; unless ``plain`` in another wrapper and
    with other blocks around and inside. None if it has no article."""
    start = re.search(r"<article\b[^>]*>", page) or re.search(r"<main\b[^>]*>", page)
    if not start:
        return None
    end = page.find(f"</{start[0][1:].split()[0].strip('>')}>", start.end())
    end = len(page) if end < 0 else end
    head, inner, tail = page[:start.start()], page[start.end():end], page[end:]
    if plain:
        return f"{head}{start[0][:-1]} {MARK}>{inner}{tail}"
    pick = lambda a: a[r.integers(len(a))]

    def junk(forms: tuple[str, ...], most: int) -> str:
        out = []
        for _ in range(r.integers(most + 1)):
            form = pick(forms)
            links = "".join(f'<li><a href="/x">{pick(texts)[:20]}</a></li>' for _ in range(r.integers(1, 6)))
            while "{t}" in form:
                form = form.replace("{t}", html_lib.escape(pick(texts)), 1)
            while "{s}" in form:
                form = form.replace("{s}", html_lib.escape(" ".join(pick(texts).split()[:r.integers(1, 6)])), 1)
            out.append(re.sub(r"^<(\w+)", rf"<\1 {_JUNK}", form.replace("{l}", links)))
        return "".join(out)

    pieces = re.split(r"(?=<p>)", inner)
    kept = []
    for piece in pieces:
        if piece.startswith("<p>") and r.random() < 0.2:
            tag = pick(_TEXT_TAGS)
            piece = f"<{tag}>{piece[3:].replace('</p>', '')}</{tag}>"
        kept.append(piece)
        if r.random() < 0.12:
            kept.append(junk(_ANYWHERE, 1))
    tag, names = pick(_WRAPPERS)
    if r.random() < 0.3:
        head = re.sub(r"<nav\b.*?</nav>", "", head, flags=re.S)
    article = f"<{tag} {names} {MARK}>{''.join(kept)}{junk(_ANYWHERE + _AFTER, 1)}</{tag}>"
    return f"{head}{junk(_BEFORE, 2)}{junk(_ANYWHERE, 2)}{article}{junk(_ANYWHERE + _AFTER, 3)}{re.sub('^</[a-z]+>', '', tail)}"


def training_pages(pages: list[str], copies: int = COPIES, seed: int = 17) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, labels) of each page and of its varied copies."""
    r = np.random.default_rng(seed)
    texts = [b.text for p in pages for b in blocks(p) if len(b.text) > 40] or ["text"]
    out = []
    for page in pages:
        for k in range(copies):
            marked = _copy(page, texts, r, plain=k == 0)
            bs = blocks(marked) if marked else []
            for i in range(0, len(bs), STEP):
                out.append((features(bs, i, i + STEP), np.array([b.main for b in bs[i:i + STEP]], np.float32)))
    return out


def fit(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    """The labeller trained on a bounded sample of ``pages`` (html)."""
    marked = pages.select("html").filter(F.col("html").rlike(_ARTICLE))
    some = [r["html"] for r in bounded_sample(marked, sample).collect()]
    model = Labeller()
    known = training_pages(some)
    model.train(known)
    model.trained = bool(known)
    return model


def main_text(pages: list[str | None], model: Labeller) -> list[str]:
    parsed = [blocks(p) for p in pages]
    return [" ".join(b.text for b, s in zip(p, scores) if s > 0.5) for p, scores in zip(parsed, model.label(parsed))]


def extract(pages: DataFrame, model: Labeller | None = None, batch: int = 256) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    model = model or fit(pages)

    @F.pandas_udf(T.StringType())
    def text(htmls: pd.Series) -> pd.Series:
        return pd.Series([t for i in range(0, len(htmls), batch) for t in main_text(htmls.iloc[i:i + batch].tolist(), model)], dtype=object)

    return (pages.select("page_id", "url", text("html").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
