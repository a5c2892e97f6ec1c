"""HTML extraction: a recurrent block labeller.

A page is cut into leaf blocks (text between block-level tags, in page
order).  Each block becomes a vector: the sum of trained vectors of its
hashed tag path (tag names, class, id and role words of all open elements),
the mean of trained vectors of its hashed words, and a few ratios.  A numpy
bidirectional LSTM reads the whole sequence of a page, so each block is
classified in the context of all others; the blocks labelled as article are
decoded, joined in page order and returned.

Training (``train``) needs labels by block, which raw pages do not carry:
sentences of a bounded sample of pages, spread over the whole of each, are
set into randomly built page layouts (menus, headers, sidebars, notices, adverts, forms, comments,
footers around and inside an article), where every block's label is known.
Bounds (parameters): ``sample_pages`` pages, ``page_sentences`` sentences of
each and ``layouts`` built pages.

Open elements are a linked list that blocks share, and a path's vector is that
of its parent plus the element's own, so work and memory grow with the page
and not with its depth; a closing tag without an open element costs one lookup.

Defined cases: null html is empty text; markup that is cut off or badly
nested is read as far as it goes; scripts, styles and comments are never
blocks; white space is what ``str.split`` takes as such; repeated rows are
extracted each on their own; an empty table gives an empty result; without
sample pages the layouts hold made-up words; extra columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import first_by_hash, small_batches

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+")
RAW = {"script", "style", "noscript", "template", "svg", "iframe"}
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_SELF = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
PATH_VECTORS, WORD_VECTORS = 2048, 1024
PATH_DIMS, WORD_DIMS, RATIOS, HIDDEN = 16, 8, 6, 16


class Element:
    """An open element; ``above`` is the one that holds it."""

    __slots__ = ("tag", "tokens", "label", "above")

    def __init__(self, tag: str, tokens: tuple, label: int | None, above: Element | None):
        self.tag, self.tokens, self.above = tag, tokens, above
        self.label = above.label if label is None and above is not None else label


@dataclass
class Block:
    element: Element | None
    text: str
    linked: int
    label: int | None = None

    @property
    def path(self) -> tuple:
        """The tokens of all open elements, outermost first."""
        held, at = [], self.element
        while at is not None:
            held.append(at.tokens)
            at = at.above
        return tuple(t for tokens in reversed(held) for t in tokens)


def _tokens(tag: str, attributes: str) -> tuple:
    words = []
    for m in ATTRIBUTE.finditer(attributes):
        words += PART.findall((m[1] or m[2] or m[3] or "").lower())
    return (tag, *(f".{w}" for w in words))


def blocks(html, labelled: bool = False) -> list[Block]:
    """Leaf blocks in page order.  ``labelled``: a ``data-label`` attribute labels what is below it."""
    if not isinstance(html, str) or not html:
        return []
    out: list[Block] = []
    stack: list[Element] = []
    opened: dict[str, int] = {}
    run: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                top = stack[-1] if stack else None
                label = (0 if top is None or top.label is None else top.label) if labelled else None
                out.append(Block(top, text, linked, label))
            run.clear()
        linked = 0

    def close(i):
        for o in stack[i:]:
            opened[o.tag] -= 1
        del stack[i:]

    at, links = 0, 0
    while at < len(html):
        m = TAG.search(html, at)
        stop = m.start() if m else len(html)
        if stop > at:
            piece = html[at:stop]
            run.append(piece)
            if links:
                linked += len(piece)
        if m is None:
            break
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0].startswith("<![CDATA["):
                run.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = name.lower()
        closing, attributes = bool(m[1] or m[4]), (m[3] if m[2] else m[6]) or ""
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            continue
        flush()
        if closing:
            if opened.get(tag):
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in VOID or attributes.rstrip().endswith("/"):
            continue
        if tag in CLOSES_SELF or (stack and stack[-1].tag == "p"):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag or stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag not in CLOSES_SELF:
                    break
        label = None
        if labelled and (found := re.search(r"data-label=(\d)", attributes)):
            label = int(found[1])
        stack.append(Element(tag, _tokens(tag, attributes), label, stack[-1] if stack else None))
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    return out


class _Hashes(dict):
    def __init__(self, size: int, limit: int = 300_000):
        super().__init__()
        self.size, self.limit = size, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = zlib.crc32(key.encode("utf-8", "surrogatepass")) % self.size
        return value


@dataclass
class Model:
    """Vectors and the two LSTMs; gates in the order input, forget, output, candidate."""

    path: np.ndarray
    word: np.ndarray
    w: list
    u: list
    b: list
    v: np.ndarray
    c: np.ndarray
    hashes: tuple = field(default=None, repr=False)

    @staticmethod
    def fresh(seed: int) -> Model:
        r = np.random.default_rng(seed)
        size = PATH_DIMS + WORD_DIMS + RATIOS
        some = lambda *s: (r.standard_normal(s) * 0.2).astype(np.float32)
        bias = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
        return Model(some(PATH_VECTORS, PATH_DIMS), some(WORD_VECTORS, WORD_DIMS), [some(size, 4 * HIDDEN) for _ in range(2)], [some(HIDDEN, 4 * HIDDEN) for _ in range(2)], [bias.copy(), bias.copy()], some(2 * HIDDEN), np.zeros(1, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.path, self.word, *self.w, *self.u, *self.b, self.v, self.c]

    def _hashes(self) -> tuple:
        if self.hashes is None:
            self.hashes = (_Hashes(PATH_VECTORS), _Hashes(WORD_VECTORS), {})
        return self.hashes

    def _contents(self, page: list[Block]):
        """Per block its word indexes and ratios."""
        words = self._hashes()[1]
        total, before = sum(len(b.text) for b in page) or 1, 0
        for b in page:
            split = b.text.split(" ")
            n = len(b.text)
            ratios = np.array([np.log1p(n) / 8, min(1.0, b.linked / n), before / total, n / total, float(b.text[-1] in ".!?\"»”"), min(1.0, b.text.count(",") / len(split))], np.float32)
            yield np.fromiter(map(words.__getitem__, split), np.int64, len(split)), ratios
            before += n

    def indexes(self, page: list[Block]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """What training needs of a page: path indexes, word indexes and ratios of every block."""
        tags = self._hashes()[0]
        paths = [np.array([tags[t] for t in b.path], np.int64) for b in page]
        return [(path, *rest) for path, rest in zip(paths, self._contents(page), strict=True)]

    def inputs(self, index) -> np.ndarray:
        x = np.empty((len(index), PATH_DIMS + WORD_DIMS + RATIOS), np.float32)
        for i, (path, words, ratios) in enumerate(index):
            x[i, :PATH_DIMS] = self.path[path].sum(axis=0)
            x[i, PATH_DIMS:-RATIOS] = self.word[words].mean(axis=0)
            x[i, -RATIOS:] = ratios
        return x

    def page_inputs(self, page: list[Block]) -> np.ndarray:
        """``inputs(indexes(page))``, each element's path vector made once from that of the one above."""
        tags, _, own = self._hashes()
        x = np.empty((len(page), PATH_DIMS + WORD_DIMS + RATIOS), np.float32)
        vectors: dict[Element | None, np.ndarray] = {None: np.zeros(PATH_DIMS, np.float32)}
        for i, (b, (words, ratios)) in enumerate(zip(page, self._contents(page), strict=True)):
            at, new = b.element, []
            while at not in vectors:
                new.append(at)
                at = at.above
            vector = vectors[at]
            for element in reversed(new):
                mine = own.get(element.tokens)
                if mine is None:
                    if len(own) > 50_000:
                        own.clear()
                    mine = own[element.tokens] = self.path[[tags[t] for t in element.tokens]].sum(axis=0)
                vector = vectors[element] = vector + mine
            x[i, :PATH_DIMS] = vector
            x[i, PATH_DIMS:-RATIOS] = self.word[words].mean(axis=0)
            x[i, -RATIOS:] = ratios
        return x

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of padded pages (time, pages, inputs); padded steps leave the state as it is."""
        steps, pages = mask.shape
        outs, tapes = [], []
        for d in range(2):
            h = np.zeros((pages, HIDDEN), np.float32)
            c = np.zeros((pages, HIDDEN), np.float32)
            out = np.empty((steps, pages, HIDDEN), np.float32)
            tape = []
            z = x @ self.w[d] + self.b[d]
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                a = z[t] + h @ self.u[d]
                gates = 1 / (1 + np.exp(-np.clip(a[:, : 3 * HIDDEN], -30, 30)))
                g = np.tanh(a[:, 3 * HIDDEN :])
                i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
                m = mask[t][:, None]
                new_c = m * (f * c + i * g) + (1 - m) * c
                tc = np.tanh(new_c)
                new_h = m * (o * tc) + (1 - m) * h
                if keep:
                    tape.append((t, h, c, i, f, o, g, tc, m))
                h, c = new_h, new_c
                out[t] = h
            outs.append(out)
            tapes.append(tape)
        hidden = np.concatenate(outs, axis=2)
        return hidden @ self.v + self.c[0], hidden, tapes

    def gradients(self, pages, labels):
        """Loss and gradients of one batch (back-propagation through time)."""
        x, mask = _padded([self.inputs(p) for p in pages])
        y = np.zeros(mask.shape, np.float32)
        for k, label in enumerate(labels):
            y[: len(label), k] = label
        logits, hidden, tapes = self.forward(x, mask, keep=True)
        p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        n = mask.sum()
        loss = -(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / n
        delta = mask * (p - y) / n
        gv, gc = np.einsum("tp,tph->h", delta, hidden), np.array([delta.sum()], np.float32)
        dx = np.zeros_like(x)
        gw, gu, gb = [], [], []
        for d in range(2):
            from_out = delta[:, :, None] * self.v[None, None, d * HIDDEN : (d + 1) * HIDDEN]
            dw, du, db = np.zeros_like(self.w[d]), np.zeros_like(self.u[d]), np.zeros_like(self.b[d])
            dh = np.zeros((x.shape[1], HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, tc, m in reversed(tapes[d]):
                total = dh + from_out[t]
                do = total * m * tc
                dcell = dc + total * m * o * (1 - tc * tc)
                open_ = dcell * m
                da = np.concatenate([open_ * g * i * (1 - i), open_ * c * f * (1 - f), do * o * (1 - o), open_ * i * (1 - g * g)], axis=1)
                dw += x[t].T @ da
                du += h.T @ da
                db += da.sum(axis=0)
                dx[t] += da @ self.w[d].T
                dh = da @ self.u[d].T + total * (1 - m)
                dc = open_ * f + dcell * (1 - m)
            gw.append(dw)
            gu.append(du)
            gb.append(db)
        gpath, gword = np.zeros_like(self.path), np.zeros_like(self.word)
        for k, page in enumerate(pages):
            for t, (path, words, _) in enumerate(page):
                np.add.at(gpath, path, dx[t, k, :PATH_DIMS])
                np.add.at(gword, words, dx[t, k, PATH_DIMS:-RATIOS] / len(words))
        return loss, [gpath, gword, *gw, *gu, *gb, gv.astype(np.float32), gc]

    def label(self, pages: list[list[Block]], cells: int = 60_000) -> list[np.ndarray]:
        """Whether each block of each page is article text; pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        while order:
            take = [order.pop()]
            longest = len(pages[take[0]])
            while order and (len(take) + 1) * longest <= cells:
                take.append(order.pop())
            x, mask = _padded([self.page_inputs(pages[i]) for i in take])
            logits = self.forward(x, mask)[0]
            for k, i in enumerate(take):
                out[i] = logits[: len(pages[i]), k] > 0
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), PATH_DIMS + WORD_DIMS + RATIOS), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k] = p
        mask[: len(p), k] = 1
    return x, mask


# Words that page makers commonly use to name the parts of a page.
_NAMES = {
    "article": ["article", "post", "post-body", "entry-content", "content", "article-body", "story", "main-content", "text", "page-content"],
    "nav": ["nav", "menu", "navbar", "navigation", "main-menu", "breadcrumb", "breadcrumbs", "pagination", "toc", "tabs"],
    "header": ["header", "site-header", "masthead", "banner", "topbar", "branding", "logo"],
    "footer": ["footer", "site-footer", "copyright", "colophon", "legal", "bottom"],
    "aside": ["sidebar", "aside", "related", "widget", "teaser", "popular", "recommended", "tags", "share", "social", "author-box"],
    "notice": ["notice", "cookie-notice", "cookie", "consent", "alert", "gdpr", "popup", "modal", "paywall", "disclaimer", "banner-message"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "promotion", "banner-ad", "adsense"],
    "form": ["form", "newsletter", "subscribe", "search", "login", "signup", "contact-form"],
    "comments": ["comments", "comment", "comment-list", "replies", "discussion", "responses", "disqus", "reader-comments", "user-comments"],
}
_TAGS = {"article": ["article", "main", "div", "section", "td"], "nav": ["nav", "div", "ul", "td"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "notice": ["div", "section", "p", "dialog"], "ad": ["div", "aside", "section", "ins-block"], "form": ["form", "div"], "comments": ["section", "div", "ol"]}


class Layouts:
    """Random page layouts with a known label for every block."""

    def __init__(self, sentences: list[str], seed: int):
        self.r = random.Random(seed)
        made = [" ".join("".join(self.r.choice("aeioumnrstl") for _ in range(self.r.randint(2, 8))) for _ in range(self.r.randint(3, 15))).capitalize() + "." for _ in range(200)]
        self.sentences = sentences or made

    def text(self, low: int, high: int) -> str:
        return " ".join(self.r.choice(self.sentences) for _ in range(self.r.randint(low, high))).replace("&", "&amp;").replace("<", "&lt;")

    def words(self, low: int, high: int) -> str:
        return " ".join(self.text(1, 1).split()[: self.r.randint(low, high)])

    def name(self) -> str:
        """A class name that says nothing: names no layout has taught must not decide."""
        return "".join(self.r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(self.r.randint(3, 8)))

    def link(self) -> str:
        return f'<a href="#">{self.words(1, 4)}</a>'

    def items(self, low: int, high: int, inside) -> str:
        return "<ul>" + "".join(f"<li>{inside()}</li>" for _ in range(self.r.randint(low, high))) + "</ul>"

    def paragraph(self) -> str:
        body = self.text(1, 8)
        if self.r.random() < 0.2:
            body += f" {self.link()} {self.words(1, 4)}"
        return self.r.choice(["<p>{}</p>"] * 6 + ["<p><b>{}<br>", "<p>{}", "<div>{}</div>", "<blockquote>{}</blockquote>"]).format(body)

    def named(self, kind: str, inside: str, label: int | None) -> str:
        r = self.r
        tag = r.choice(_TAGS[kind])
        own = tag not in ("div", "section", "td", "p", "ul", "ol", "ins-block")
        forms = [' class="{}"', ' id="{}"', ' class="{} box"', ' class="c-{}"', f' class="{{}}-{self.name()}"', f' class="{self.name()} {{}}"', f' class="{{}}" id="{self.name()}"']
        names = "" if own and r.random() < 0.6 else r.choice(forms).format(r.choice(_NAMES[kind]))
        if label is not None:
            names += f" data-label={label}"
        return f"<{tag}{names}>{inside}</{tag}>"

    def other(self, kind: str) -> str:
        r = self.r
        if kind == "nav":
            inside = self.items(2, 8, self.link) if r.random() < 0.8 else " | ".join(self.link() for _ in range(r.randint(2, 6)))
        elif kind == "header":
            inside = f"<h1>{self.words(1, 4)}</h1>" * (r.random() < 0.5) + f"<p>{self.words(2, 8)}</p>" * (r.random() < 0.6) + self.items(1, 5, self.link) * (r.random() < 0.4) + f"<div>{self.words(1, 5)}</div>"
        elif kind == "footer":
            inside = r.choice(["&copy; {} &middot; {}", "<p>&copy; {}</p><p>{}</p>", "Copyright {}. <div>{}</div>"]).format(self.words(1, 3), self.text(1, 2)) + self.items(1, 4, self.link) * (r.random() < 0.4)
        elif kind == "aside":
            inside = f"<h3>{self.words(1, 4)}</h3>" * (r.random() < 0.6) + r.choice([self.items(2, 5, self.link), f"<p>{self.text(1, 3)}</p>", self.items(1, 4, lambda: self.text(1, 1))])
        elif kind == "notice":
            inside = r.choice(["<p>{}</p>", "{}"]).format(self.text(1, 3)) + f"<button>{self.words(1, 2)}</button>" * (r.random() < 0.4)
        elif kind == "ad":
            inside = r.choice(["{}", "<p>{}</p>", '<a href="#">{}</a>', "<h4>{}</h4>"]).format(self.text(1, 2))
        elif kind == "form":
            inside = f"<label>{self.words(1, 4)}</label><input type=text><button>{self.words(1, 2)}</button>" + f"<p>{self.text(1, 2)}</p>" * (r.random() < 0.5) + f"<textarea>{self.words(1, 5)}</textarea>" * (r.random() < 0.2) + f"<select><option>{self.words(1, 2)}</option><option>{self.words(1, 2)}</option></select>" * (r.random() < 0.2)
        else:
            one = lambda: f'<div class="{r.choice(["comment", "reply", "comment-body", "user"])}"><b>{self.words(1, 2)}</b> <p>{self.text(1, 3)}</p></div>'
            inside = f"<h3>{self.words(1, 3)}</h3>" * (r.random() < 0.6) + "".join(one() if r.random() < 0.7 else f"<p>{self.text(1, 3)}</p>" for _ in range(r.randint(1, 6)))
        return self.named(kind, inside, 0)

    def article(self) -> str:
        r = self.r
        title = r.choice(["<h1>{}</h1>"] * 5 + ["<header><h1>{}</h1></header>"]).format(self.words(2, 10))
        parts = [title] * (r.random() < 0.8)
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            kind = r.random()
            if kind < 0.1:
                parts.append(f"<h{r.randint(2, 4)}>{self.words(2, 8)}</h{r.randint(2, 4)}>")
            elif kind < 0.16:
                parts.append(self.items(2, 5, lambda: self.text(1, 1)))
            elif kind < 0.19:
                parts.append(f"<table><tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr></table>")
            elif kind < 0.21:
                parts.append(f"<pre>{self.text(1, 2)}</pre>")
            else:
                parts.append(self.paragraph())
            if r.random() < 0.1:
                parts.append(self.other(r.choice(["ad", "ad", "aside", "notice", "form"])))
        if r.random() < 0.1:
            parts.append(self.other("comments"))
        return "".join(parts)

    def page(self) -> str:
        r = self.r
        before = [k for k in ("notice", "header", "nav", "ad", "aside", "form") if r.random() < {"nav": 0.75, "header": 0.45, "ad": 0.45}.get(k, 0.25)]
        after = [k for k in ("aside", "ad", "form", "comments", "nav", "notice", "footer") if r.random() < {"footer": 0.8, "comments": 0.4, "aside": 0.35}.get(k, 0.2)]
        bare = r.random() < 0.08  # an article without an element of its own
        article = self.article() if bare else self.named("article", self.article(), 1)
        body = "".join(self.other(k) for k in before) + article + "".join(self.other(k) for k in after)
        if r.random() < 0.4:
            body = f'<div class="{r.choice(["page", "wrapper", "container", "layout", "row"])}">{body}</div>'
        return f"<html><head><title>{self.words(2, 8)}</title></head><body{' data-label=1' * bare}>{body}" + "</body></html>" * (r.random() < 0.8)


def fit(sentences: list[str], layouts: int = 1500, epochs: int = 5, seed: int = 1, rate: float = 0.01) -> Model:
    """Train on built pages with Adam; the same sentences and seed give the same model."""
    model = Model.fresh(seed)
    maker = Layouts(sentences, seed)
    built = [blocks(maker.page(), labelled=True) for _ in range(layouts)]
    data = [(model.indexes(p), np.array([b.label for b in p], np.float32)) for p in built if p]
    first = [np.zeros_like(w) for w in model.weights()]
    second = [np.zeros_like(w) for w in model.weights()]
    shuffle, step = random.Random(seed), 0
    for epoch in range(epochs):
        shuffle.shuffle(data)
        data.sort(key=lambda d: (len(d[0]) // 12))
        batches = [data[i : i + 20] for i in range(0, len(data), 20)]
        shuffle.shuffle(batches)
        for batch in batches:
            step += 1
            _, grads = model.gradients([p for p, _ in batch], [y for _, y in batch])
            for w, g, m, s in zip(model.weights(), grads, first, second, strict=True):
                np.clip(g, -1, 1, out=g)
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= rate * (0.5 ** (epoch / 2)) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return model


def sentences_of(html, most: int) -> list[str]:
    """Up to ``most`` sentences of 11 to 399 characters, evenly spread over the whole page."""
    found = [x for b in blocks(html) for x in re.split(r"(?<=[.!?]) ", b.text) if 10 < len(x) < 400]
    if len(found) <= most:
        return found
    return [found[i * len(found) // most] for i in range(most)]


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = 48, page_sentences: int = 64, **options) -> Model:
    """Fit on layouts filled with sentences of the first ``sample_pages`` pages in hash order.

    Tasks cut the pages; at most ``page_sentences`` short sentences of a page
    reach the driver.
    """
    h = F.xxhash64(F.lit(1), F.col(id_col))
    filled = pages.where(F.col(html_col).isNotNull() & F.col(id_col).isNotNull())
    first = first_by_hash(filled.select(F.lit(0).alias("grp"), h.alias("h")), sample_pages)
    chosen = filled.where(h <= max((r["h"] for r in first), default=-(1 << 63)))

    def cut(batches):
        for batch in small_batches(batches, "html"):
            found = [sentences_of(x, page_sentences) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(found, pa.list_(pa.string()))], names=["h", "sentences"])

    cutting = chosen.select(h.alias("h"), F.col(html_col).alias("html")).mapInArrow(cut, "h long, sentences array<string>")
    rows = cutting.orderBy("h", "sentences").limit(sample_pages).collect()
    return fit([s for r in rows for s in r["sentences"]], **options)


def extract_table(pages: DataFrame, model: Model, html_col: str = "html", keep=("page_id", "url")) -> DataFrame:
    """``keep`` columns plus ``text``; one pass, no shuffle."""
    keep = list(keep)
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("text", T.StringType())])
    weights = model.weights()

    def run(batches):
        own = Model(weights[0], weights[1], weights[2:4], weights[4:6], weights[6:8], weights[8], weights[9])
        for batch in small_batches(batches, "__html", 2 << 20):
            cut = [blocks(h) for h in batch.column("__html").to_pylist()]
            marks = own.label(cut)
            texts = [" ".join([b.text for b, m in zip(p, good, strict=True) if m]) for p, good in zip(cut, marks, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(texts, pa.string())], names=[*keep, "text"])

    return pages.select(*keep, F.col(html_col).alias("__html")).mapInArrow(run, schema)
