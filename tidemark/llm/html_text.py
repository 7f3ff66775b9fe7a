"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its text blocks: runs of text between block-level
tags, with the open elements above them.  Features of a block are its ancestor
tags, words in the ancestors' class, id and role, and properties of its text and
of its neighbours.  The chain is trained on labelled pages and the best label
sequence of each page is found by Viterbi; blocks labelled as content are the text.

Labelled pages: (a) layouts written in this module, in which every block is
marked, filled with words of the given pages; (b) at most ``SEED_PAGES`` of the
given pages, the first by a hash of the page, that have an ``article`` or ``main``
element, labelled by these elements.  Both are bounded, so the driver's share is.

Rows: a null or empty page has an empty text; a page cut off inside a tag, a
reference or an element is read as far as it goes; scripts, styles and comments
are never text; repeated rows get equal results; other columns are kept; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import crf
from .common import table, thinned

SEED_PAGES, SEED_CHARS, LAYOUT_PAGES, LAYOUT_WORDS = 200, 200_000, 400, 20_000

# Element names of HTML.
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas audio video".split())
CLOSES_P = BLOCK - frozenset("body button caption head html legend li option optgroup tbody td tfoot th thead title tr".split())
ALONE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}

TAG_FEATURES = "a address article aside blockquote body button caption dd dialog dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 head header label legend li main nav ol option p pre section select span summary table td textarea th title ul".split()
#: Words in class, id or role, by meaning.
WORD_FEATURES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pager pagination toc skip tabs",
    "head": "header head masthead topbar banner toolbar branding logo",
    "foot": "footer foot bottom copyright colophon contentinfo legal imprint",
    "side": "sidebar side aside rail widget complementary related recommended recommendations more trending popular",
    "note": "notice notices cookie cookies consent gdpr alert warning modal popup overlay message toast paywall",
    "advert": "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion promoted",
    "form": "form search login signin signup register subscribe subscription newsletter contact input",
    "talk": "comment comments reply replies discussion respond disqus thread feedback reviews",
    "share": "share sharing social follow tags meta byline author",
    "main": "main content article post entry story body text prose page maincontent articlebody postcontent",
}
_WORD_OF = {w: k for k, ws in enumerate(WORD_FEATURES.values()) for w in ws.split()}
_TAG_OF = {t: k for k, t in enumerate(TAG_FEATURES)}
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


class Block:
    """A text block: its text, the letters of it inside links, its ancestors' tags (of ``TAG_FEATURES``) and meanings, and the innermost meanings."""

    __slots__ = ("inner", "linked", "meanings", "tags", "text")

    def __init__(self, text: str, linked: int, tags: set, meanings: set, inner: tuple):
        self.text, self.linked, self.tags, self.meanings, self.inner = text, linked, tags, meanings, inner


class _Open:
    """The open elements, with counts, so that a block or a closing tag does not walk through all of them."""

    def __init__(self):
        self.stack: list[tuple[str, tuple]] = []
        self.names, self.tags, self.meanings, self.inner = Counter(), set(), Counter(), []

    def push(self, name: str, meanings: tuple) -> None:
        self.stack.append((name, meanings))
        self.names[name] += 1
        if name in _TAG_OF:
            self.tags.add(name)
        self.meanings.update(meanings)
        if meanings:
            self.inner.append(meanings)

    def drop(self) -> None:
        name, meanings = self.stack.pop()
        self.names[name] -= 1
        if not self.names[name]:
            self.tags.discard(name)
        self.meanings.subtract(meanings)
        if meanings:
            self.inner.pop()

    def close(self, names: tuple[str, ...], stop: frozenset | tuple = ()) -> None:
        """Close the innermost element of these names and all in it, unless one of ``stop`` is met first."""
        if not any(self.names[n] for n in names):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in names:
                while len(self.stack) > k:
                    self.drop()
                return
            if self.stack[k][0] in stop:
                return

    def block(self, text: str, linked: int) -> Block:
        return Block(text, linked, set(self.tags), {m for m, n in self.meanings.items() if n}, self.inner[-1] if self.inner else ())


def _meanings(attributes: str) -> tuple[int, ...]:
    if not attributes or "=" not in attributes:
        return ()
    found = {_WORD_OF.get(w.lower()) for m in _NAMED.finditer(attributes) for w in _SPLIT.split(m[1] or m[2] or m[3] or "")}
    return tuple(found - {None})


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order."""
    page, out, opened, held, linked, at = page or "", [], _Open(), [], 0, 0

    def text_to(end: int) -> None:
        nonlocal linked
        if end > at:
            piece = html.unescape(page[at:end]) if "&" in page[at:end] else page[at:end]
            held.append(piece)
            if opened.names["a"]:
                linked += len(piece)

    def close_block() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(opened.block(text, linked))
            held.clear()
        linked = 0

    while m := _TOKEN.search(page, at):
        text_to(m.start())
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in BLOCK:
            close_block()
        elif name == "br":
            held.append(" ")
        if closing:
            opened.close((name,), () if name in BLOCK else BLOCK)
            continue
        if name in RAW:
            # only elements of other vocabularies can close themselves
            if not (name in ("svg", "math") and attributes.endswith("/")):
                at = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(page, at).end()
            continue
        if name in CLOSES_P:
            opened.close(("p",), ("table", "td", "li", "div", "article", "section", "blockquote"))
        if name in ALONE:
            opened.close(ALONE[name], ("ul", "ol", "dl", "table", "select", "nav"))
        if name not in VOID and not (attributes.endswith("/") and name not in BLOCK):
            opened.push(name, _meanings(attributes))
    text_to(len(page))
    close_block()
    return out


def features(found: list[Block]) -> np.ndarray:
    """Feature rows of one page's blocks."""
    n_tags, n_words = len(TAG_FEATURES), len(WORD_FEATURES)
    own = np.zeros((len(found), n_tags + 2 * n_words + 9))
    for i, b in enumerate(found):
        for t in b.tags:
            if (k := _TAG_OF.get(t)) is not None:
                own[i, k] = 1
        for k in b.meanings:
            own[i, n_tags + k] = 1
        for k in b.inner:
            own[i, n_tags + n_words + k] = 1
        text, n = b.text, len(b.text)
        words = text.count(" ") + 1
        own[i, n_tags + 2 * n_words :] = (
            min(np.log1p(words), 5), words < 4, words > 12, min(b.linked / n, 1), text[-1] in ".!?。", min(sum(map(text.count, ",;")) / words, 1),
            text[0] in "©" or "©" in text[:20], sum(map(text.count, "|·»")) / words > 0.1, bool({"article", "main"} & b.tags),
        )
    tail = own[:, n_tags + 2 * n_words :]
    before, after = np.zeros_like(tail), np.zeros_like(tail)
    before[1:], after[:-1] = tail[:-1], tail[1:]
    return np.hstack([own, before, after])


#: Layouts: + marks a block of the main text, - any other; a trailing number is how many words, * how many times.
LAYOUTS = [
    '<header><h1>-3</h1><p>-6</p></header><nav><ul>(<li><a>-1</a></li>)*5</ul></nav><main><article><h1>+6</h1>(<p>+40</p>)*4<h2>+4</h2>(<p>+30</p>)*2<ul>(<li>+8</li>)*3</ul></article></main><aside><h3>-2</h3>(<p>-12</p>)*2</aside><footer><p>-10</p></footer>',
    '<div id="menu">(<a>-2</a><br>)*4</div><div class="content"><h1>+5</h1>(<p>+50</p>)*3<blockquote><p>+20</p></blockquote>(<p>+25</p>)*2</div><div class="sidebar"><h4>-2</h4><ul>(<li><a>-4</a></li>)*4</ul></div><div id="footer">-9</div>',
    '<div class="cookie-notice"><p>-18</p><button>-2</button></div><div class="header">-4</div><div class="post"><h2>+6</h2>(<p>+35</p>)*3<div class="ad">-8</div>(<p>+35</p>)*2</div><section class="comments"><h3>-2</h3>(<div class="comment"><p>-20</p></div>)*3</section><div class="footer">-12</div>',
    '<nav>(<a>-1</a>)*5</nav><article><h1>+7</h1><div class="byline">-4</div>(<p>+45</p>)*3<aside class="related"><h4>-2</h4>(<a>-6</a>)*2</aside>(<p>+30</p>)*2<form><label>-2</label><button>-1</button></form><section id="comments"><h2>-1</h2>(<p>-25</p>)*2</section></article><footer>-8</footer>',
    '<div role="banner">-5</div><div role="navigation"><ul>(<li>-1</li>)*4</ul></div><div role="main"><h1>+4</h1>(<p>+60</p>)*2<table><tr>(<td>+2</td>)*4</tr></table><p>+30</p></div><div role="complementary">(<p>-15</p>)*2</div><div role="contentinfo">-9</div>',
    '<div class="topbar notice">-14</div><div class="advert">-10</div><article>(<p>+8</p>)*5</article><div class="ad">-9</div><footer>-7</footer>',
    '<div class="ad">-8</div><article><h1>+5</h1><p>+3</p><p>+1</p>(<p>+70</p>)*2<p>+2</p></article><div class="newsletter"><form><p>-14</p><input><button>-1</button></form></div><footer><small>-11</small></footer>',
    '<nav><ul>(<li><a>-1</a></li>)*6</ul></nav><div class="ad">-9</div><article><h1>+8</h1><p><b>+10<br><p>+60</p><p>+2</p>(<p>+30</p>)*3<p><b>+9<br><p>+25</p></article><footer>-10</footer>',
    '<header class="site-header"><div class="logo">-2</div><form class="search"><label>-1</label></form></header><section class="story"><h1>+5</h1><figure><figcaption>+9</figcaption></figure>(<p>+40</p>)*4</section><section class="related-posts">(<p>-12</p>)*3</section><div class="share">-3</div><div class="reader-comments">(<article class="comment"><p>-22</p></article>)*2</div><footer>-9</footer>',
    '<div class="breadcrumb">(<a>-1</a>)*3</div><main><h1>+4</h1>(<section><h2>+3</h2><p>+40</p><ol>(<li>+10</li>)*2</ol></section>)*2<pre>+20</pre></main><aside>(<p>-20</p>)*2</aside><dialog><p>-15</p></dialog><div class="legal">-16</div>',
    '<table><tr><td class="nav">(<a>-2</a><br>)*3</td><td class="main"><h1>+3</h1>(<p>+45</p>)*3</td></tr></table><p class="copyright">-7</p>',
    '<div class="notice">-12</div><main><div class="article-body"><h1>+5</h1>(<p>+30</p>)*2<div class="ad-slot">-3</div><p>+25</p><div class="promo">-9</div><p>+20</p><div class="newsletter">-12</div><p>+3</p></div><div class="comment-list">(<p>-16</p>)*2</div></main><footer>-6</footer>',
    '<article><header><h1>+6</h1></header>(<p>+30</p>)*2<div class="sponsored"><p>-20</p></div>(<p>+12</p>)*2<nav class="pager"><a>-2</a></nav><footer class="share">-4</footer><div class="comments">(<p>-25</p>)*3</div></article>',
    '<h1>+5</h1>(<p>+40</p>)*4',
    '<nav>(<a>-1</a>)*4</nav><h1>+5</h1>(<p>+40</p>)*5<footer>-8</footer>',
    '<p>+60</p>',
    '<article><h1>+3</h1><p>+7</p><div class="cookie-banner">-6</div><p>+7</p><aside>-7</aside><p>+5</p><form><label>-1</label></form><p>+9</p><section class="reader-comments"><h3>-1</h3>(<p>-12</p>)*2</section></article>',
    '<main><h1>+5</h1><div class="alert">-9</div>(<p>+14</p>)*3<div class="related-links"><p>-10</p></div>(<p>+6</p>)*3</main><div class="popup"><p>-9</p></div>',
    '<aside class="notice"><p>-25</p></aside><div class="entry-content">(<p>+35</p>)*4<h3>+3</h3>(<p>+15</p>)*2</div><div id="respond"><h3>-3</h3><form><p>-8</p><textarea>-2</textarea></form></div><ol class="commentlist">(<li><p>-18</p></li>)*3</ol>',
]


def _layout_page(layout: str, words: list[str], rng: random.Random) -> tuple[str, list[int]]:
    """A page of a layout with random words, and the labels of its blocks."""
    while m := re.search(r"\(((?:[^()]|\([^()]*\)\*\d+)*?)\)\*(\d+)", layout):
        layout = layout[: m.start()] + m[1] * max(1, int(m[2]) + rng.randint(-2, 3)) + layout[m.end() :]
    labels: list[int] = []

    def fill(m: re.Match) -> str:
        n = max(1, int(int(m[2]) * rng.uniform(0.3, 2)))
        labels.append(int(m[1] == "+"))
        text = " ".join(rng.choice(words) for _ in range(n))
        return m[0][0] + (text[:1].upper() + text[1:] + rng.choice(["", "."] if n < 8 else [".", ".", "!"]))

    body = re.sub(r">([+-])(\d+)", fill, layout)
    title = '<head><title>' + " ".join(rng.choice(words) for _ in range(5)) + "</title></head>"
    return f"<html>{title}<body>{body}</body></html>", [0, *labels]


def labelled_layouts(words: list[str], pages: int = LAYOUT_PAGES) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages of the layouts; the same words give the same pages."""
    rng, out = random.Random(7), []
    for k in range(pages):
        page, labels = _layout_page(LAYOUTS[k % len(LAYOUTS)], words, rng)
        found = blocks(page)
        if len(found) == len(labels):  # inline neighbours may share a block
            out.append((found, labels))
        else:
            merged, texts = [], re.findall(r">([^<>]+)(?=<)", page)
            by_text = dict(zip((" ".join(t.split()) for t in texts), labels))
            for b in found:
                merged.append(by_text.get(b.text, next((v for t, v in by_text.items() if b.text.startswith(t)), 0)))
            out.append((found, merged))
        if k % 10 == 0:  # text without any markup
            found = blocks(" ".join(rng.choice(words) for _ in range(rng.randint(3, 80))))
            out.append((found, [1] * len(found)))
    return out


def seed_labels(found: list[Block]) -> list[int] | None:
    """Labels of a page with an ``article`` or ``main``: content is inside it, but for asides, forms and the like; None without one."""
    outside = {"nav", "aside", "footer", "header", "form", "button", "head", "dialog"}
    not_main = set(range(len(WORD_FEATURES))) - {list(WORD_FEATURES).index("main"), list(WORD_FEATURES).index("head")}
    labels = [int(bool({"article", "main"} & b.tags) and not outside & b.tags and not not_main & b.meanings) for b in found]
    return labels if any(labels) else None


def train(pages: list[str]) -> crf.Model:
    """Fit the chain on the layouts and on those of ``pages`` that can be labelled."""
    found = [blocks(p) for p in pages]
    # a bounded choice of words by their hash: it fills the layouts
    words = sorted({w for page in found for b in page for w in b.text.split()}, key=lambda w: (crc32(w.encode("utf-8", "surrogatepass")), w))[:LAYOUT_WORDS] or ["word", "text", "and", "the", "of"]
    data = labelled_layouts(words)
    data += [(b, labels) for b in found if (labels := seed_labels(b))]
    return crf.fit(np.vstack([features(b) for b, _ in data]), np.concatenate([np.array(y) for _, y in data]), np.array([len(y) for _, y in data]), 2, l2=1e-4, rounds=200)


def extract_texts(model: crf.Model, pages: list[str | None]) -> list[str]:
    """Main texts of pages, decoded together."""
    found = [blocks(p) for p in pages]
    lengths = np.array([len(b) for b in found], np.int64)
    if not lengths.sum():
        return [""] * len(pages)
    labels = crf.viterbi(model.unary(np.vstack([features(b) for b in found if b])), model.transitions, lengths[lengths > 0])
    out, at = [], 0
    for page in found:
        out.append("\n".join(b.text for b, y in zip(page, labels[at : at + len(page)]) if y == 1))
        at += len(page)
    return out


def main_text(pages: DataFrame, into: str = "text", html_column: str = "html") -> DataFrame:
    """``pages`` with the main text of every row in a new column (in place of one of that name)."""
    source = F.col(html_column).cast("string")
    # a fraction by hash first, so that what the tasks send does not grow with their number
    sample = pages.where(thinned(pages, pages.columns, 4 * SEED_PAGES)).select(source.alias("html")).where(F.length("html").between(1, SEED_CHARS))
    sample = sample.orderBy(F.xxhash64("html"), F.length("html")).limit(SEED_PAGES).collect()
    held = pages.sparkSession.sparkContext.broadcast(train([r.html for r in sample]))
    names = [c for c in pages.columns if c != into or c == html_column]
    place = names.index(html_column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(extract_texts(held.value, part.column(place).to_pylist()), pa.string())], [*names, into])

    rows = pages.select(*names)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, T.StringType())]))


def op3(spark, sf_dir: str) -> DataFrame:
    """Main text of all ``pages``."""
    pages = table(spark, sf_dir, "pages", spread=True).select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
