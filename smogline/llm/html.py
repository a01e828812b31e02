"""Main-text extraction with a tree-structured graphical model over the block elements of a page.

Every block element is a node in one of three states: outside, content, or inside a side part (menu, advert, reader
comments, ...). A node's signs (tag, class and id words, amount of own text, link share, ...) depend on its state, and
its state on its parent's; both tables are counted on labelled pages. Messages pass up and down the tree (sum-product),
which gives the exact marginals of every node given the whole page; text of nodes more likely content than not is kept,
block by block.

Labelled pages are a bounded sample of the table's own pages that mark their article (``<article>``, ``<main>``: what
lies inside and in no part that names itself navigation, advert and the like is content), and a few seed pages below
for parts that such a sample may lack.

Defined cases: a null or empty page gives an empty text; unclosed and misnested tags are closed as a browser would
(a new paragraph ends the open one); comments, scripts, styles, form controls, drawings and markup never reach the text;
formulas and fallback text of objects do; a script, style or the like that is never closed takes the rest of the page, a
button, select or drawing only what stands directly in it up to the end of the element around it; a page is read in one
forward pass, so that its time grows with its length whatever its markup; character references are decoded; ``<br>`` is white space; a page without block elements is all content; repeated rows are extracted each; without any page that
marks its article the seeds alone are learned from; only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import hash_sample, prepare

SAMPLE_PAGES = 2000
SIGNS = 4096
OUTSIDE, CONTENT, PART = range(3)

#: Fixed values of HTML: elements without content, elements whose content is raw text and no text of the page, others
#: whose content is no text of the page, inline elements, and the open elements that a start tag ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes".split())
HIDDEN = frozenset("template svg select button annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark object q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var "
                   "math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
                   "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}}
KEEPS_PARAGRAPH = INLINE | VOID - {"hr"}

#: Words by which pages name their parts that aren't the article.
PART_TAGS = frozenset("nav footer aside form menu dialog".split())
PART_WORDS = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent "
                       "disclaimer footer form header login menu nav navbar navigation newsletter notice pager "
                       "pagination popup promo recommended related share sharing sidebar signup social sponsor "
                       "sponsored subscribe toolbar widget".split())

#: Elements nested deeper are children of the element at this depth, as in browsers.
MAX_DEPTH = 512
#: Characters of a tag's attributes that are read for names.
ATTRIBUTES = 1 << 16

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)|<!--|<[!?/]")
_ATTRIBUTE = re.compile(r"""(>)|=\s*(["'])""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_SENTENCE = re.compile(r"[.!?](?:\s|\Z)")


@dataclass
class Hidden:
    """An open element whose text doesn't count: open elements around it, where its text begins (in the running text, or, once
    that was ended, in the blocks), the nodes before it, and the linked characters before it."""

    tag: str
    depth: int
    text: int
    blocks: int
    nodes: int
    linked: int


@dataclass
class Page:
    """Block elements (parent before child) and the pieces of text in page order."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    parents: list[int] = field(default_factory=lambda: [-1])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters inside links


def tag_end(source: str, at: int) -> int:
    """The position after the tag whose name ends at ``at``. A quote opens a value only after an equals sign; one
    that is never closed doesn't, and the tag then ends at the next ``>``."""
    while True:
        m = _ATTRIBUTE.search(source, at)
        if not m:
            return len(source)  # a tag that never ends
        if m[1]:
            return m.end()
        closing = source.find(m[2], m.end())
        if closing < 0:
            return (source.find(">", m.end()) + 1) or len(source)
        at = closing + 1


class Parser:
    """One forward pass over a page: every character is looked at a bounded number of times."""

    def __init__(self) -> None:
        self.page = Page()
        self.stack = [0]
        self.open: Counter[str] = Counter()
        self.text: list[str] = []
        self.linked = self.links = 0
        self.hidden: list[Hidden] = []

    def parse(self, source: str) -> Page:
        at, last = 0, source.rfind(">")
        while at < len(source):
            m = _TAG.search(source, at)
            if m and m.start() > last and not m[0].startswith("<!"):
                m = None  # no tag ends from here on: text
            self.add(source[at:m.start() if m else len(source)])
            if not m:
                break
            if m[0] == "<!--":
                end = source.find("-->", m.end())
                at = end + 3 if end >= 0 else len(source)
            elif not m[2]:
                at = (source.find(">", m.end()) + 1) or len(source)
            else:
                at = tag_end(source, m.end())
                at = self.tag(m[1], m[2].lower(), source, m.end(), at)
        self.flush()
        return self.page

    def add(self, piece: str) -> None:
        if piece:
            self.text.append(piece)
            self.linked += len(piece) if self.links else 0

    def flush(self) -> None:
        """End the running text as a block of the innermost element."""
        for h in self.hidden:  # what stands directly in a hidden element goes; blocks inside stay until it is closed
            if h.blocks < 0:
                del self.text[h.text:]
        if self.text:
            joined = " ".join(references.unescape("".join(self.text)).split())
            if joined:
                self.page.blocks.append((self.stack[-1], joined, self.linked))
            self.text.clear()
        for h in self.hidden:
            if h.blocks < 0:
                h.blocks, h.text = len(self.page.blocks), 0
        self.linked = 0

    def close(self, depth: int) -> None:
        """Pop open elements down to ``depth``; hidden elements that began inside them end too."""
        for n in self.stack[depth:]:
            self.open[self.page.tags[n]] -= 1
        del self.stack[depth:]
        while self.hidden and self.hidden[-1].depth > depth:
            self.hidden.pop()

    def tag(self, close: str, tag: str, source: str, name_end: int, end: int) -> int:
        """Handle the tag that ends before ``end``; returns where to go on."""
        page, itself = self.page, source[end - 2:end] == "/>"
        if tag in RAW:
            self.add(" ")
            if close or itself:
                return end
            m = _RAW_END[tag].search(source, end)
            return (source.find(">", m.end()) + 1) or len(source) if m else len(source)
        if tag in HIDDEN:
            self.hide(close, tag, itself)
        elif tag in INLINE or tag in VOID and tag != "hr":
            self.links = max(0, self.links + (-1 if close else 1)) if tag == "a" else self.links
            if tag == "br":
                self.add(" ")
        elif close:
            self.flush()
            self.links = 0
            if self.open[tag] > 0:
                depth = len(self.stack) - 1
                while page.tags[self.stack[depth]] != tag:
                    depth -= 1
                self.close(depth)
        else:
            self.flush()
            self.links = 0
            ends, depth = ENDS.get(tag, ()), len(self.stack)
            floor = self.hidden[-1].depth if self.hidden else 1  # a hidden element is only left by an end tag
            while depth > floor and (page.tags[self.stack[depth - 1]] in ends or page.tags[self.stack[depth - 1]] == "p"):
                depth -= 1
            if depth < len(self.stack):
                self.close(depth)
            if tag == "hr" or itself:
                return end
            rest = source[name_end:min(end - 1, name_end + ATTRIBUTES)]
            words = tuple(w for a in _NAMES.findall(rest) for w in _WORDS.findall("".join(a).lower())) if rest else ()
            page.tags.append(tag)
            page.names.append(words)
            page.parents.append(self.stack[min(len(self.stack), MAX_DEPTH) - 1])
            self.stack.append(len(page.tags) - 1)
            self.open[tag] += 1
        return end

    def hide(self, close: str, tag: str, itself: bool) -> None:
        if not close:
            self.add(" ")
            if not itself and len(self.hidden) < MAX_DEPTH:
                self.hidden.append(Hidden(tag, len(self.stack), len(self.text), -1, len(self.page.tags), self.linked))
            return
        at = len(self.hidden) - 1
        while at >= 0 and self.hidden[at].tag != tag:
            at -= 1
        if at < 0:
            return
        h = self.hidden[at]
        del self.hidden[at:]
        if h.blocks < 0:
            del self.text[h.text:]
        else:  # it held blocks: they go with their elements
            self.text.clear()
            del self.page.blocks[h.blocks:]
        self.close(h.depth)
        for column in (self.page.tags, self.page.names, self.page.parents):
            del column[h.nodes:]
        self.linked = h.linked if h.blocks < 0 else 0


def parse(source: str) -> Page:
    return Parser().parse(source)


def names_a_part(tag: str, words: tuple[str, ...]) -> bool:
    return tag in PART_TAGS or any(w in PART_WORDS for w in words)


def signs(page: Page) -> list[list[int]]:
    """The hashed signs of each node."""
    length, linked, stops = ([0] * len(page.tags) for _ in range(3))
    for node, text, inside in page.blocks:
        length[node] += len(text)
        linked[node] += min(inside, len(text))
        stops[node] += len(_SENTENCE.findall(text))
    out = []
    for tag, words, n, a, s in zip(page.tags, page.names, length, linked, stops, strict=True):
        size = 0 if not n else 1 if n <= 25 else 2 if n <= 100 else 3
        own = [f"tag {tag}", f"text {size}", f"part {names_a_part(tag, words)}", *(f"word {w}" for w in set(words))]
        if n:
            own += [f"links {0 if not a else 1 if 2 * a < n else 2}", f"stops {min(s, 2)}"]
        out.append([zlib.crc32(x.encode()) % SIGNS for x in own])
    return out


def marked(page: Page) -> list[int] | None:
    """Labels of the nodes of a page that marks its article, else None."""
    roots = [i for i, t in enumerate(page.tags) if t == "article"] or [i for i, t in enumerate(page.tags) if t == "main"]
    if not roots:
        return None
    # a reader's comment is often an article too: the one with most text is meant
    weight = [0] * len(page.tags)
    for node, text, _ in page.blocks:
        weight[node] += len(text)
    for i in range(len(page.tags) - 1, 0, -1):
        weight[page.parents[i]] += weight[i]
    root = max(roots, key=lambda i: (weight[i], -i))
    labels = [OUTSIDE] * len(page.tags)
    for i in range(1, len(page.tags)):
        above = labels[page.parents[i]]
        if i == root:
            labels[i] = CONTENT
        elif above == PART or names_a_part(page.tags[i], page.names[i]) or above == OUTSIDE and page.tags[i] == "header":
            labels[i] = PART
        else:
            labels[i] = above
    return labels


#: Labelled pages: the article is marked, parts inside and around it name themselves.
SEED_PAGES = (
    "<body><header><h1>Daily site</h1><p>All the news</p></header><nav><a href=x>Home</a></nav><main><h1>A title</h1>"
    "<p>First words of the article.</p><p>More of it, at some length, so that it reads as prose.</p>"
    "<ul><li>A point made.</li><li>Another point.</li></ul><aside>See also: other pages</aside></main>"
    "<aside class=sidebar><h3>Popular</h3><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul></aside>"
    "<div class=cookie-notice><p>We use cookies.</p></div><footer><p>Terms</p></footer></body>",
    "<body><div class=header><p>Site</p></div><div class=menu><ul><li><a href=x>Start</a></li></ul></div><article>"
    "<h1>Another title</h1><h2>Part one</h2><p>Plain prose of the article stands here.</p><blockquote><p>A quotation of "
    "some length.</p></blockquote><div class=ad>Buy this now.</div><table><tr><td>Number</td><td>7</td></tr></table>"
    "<pre>code of the article</pre><div class=share><a href=x>Share</a></div></article><section class=comments>"
    "<h3>Comments</h3><div class=comment><p>I read this and liked it very much.</p></div></section>"
    "<form action=x><p>Your mail address</p><label>Mail</label></form><div id=footer><p>Imprint</p></div></body>",
    "<body><div id=banner class=advert><p>Offer of the day!</p></div><article><div class=body><p>Prose inside a plain "
    "block of the article.</p><p>It goes on here.</p></div><div class=newsletter><form><p>Sign up for our letter</p>"
    "</form></div></article><div class=related><h4>Related</h4><p><a href=x>Another page</a></p></div>"
    "<div class=notice><p>This site is closed tomorrow.</p></div></body>",
)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(-1)
    return top + np.log(np.exp(x - top[..., None]).sum(-1))


@dataclass
class PageModel:
    """Log tables: start[y] of the root, step[parent, child], and sign[sign, y]."""

    start: np.ndarray
    step: np.ndarray
    sign: np.ndarray

    def marginals(self, parents: np.ndarray, depths: np.ndarray, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
        """P(state) of every node of a forest; ``rows``/``own`` list (node, sign) pairs."""
        up = np.zeros((len(parents), len(self.start)))
        np.add.at(up, rows, self.sign[own])
        sent = np.zeros_like(up)
        by_depth = np.argsort(depths, kind="stable")
        levels = np.split(by_depth, np.cumsum(np.bincount(depths))[:-1])
        for level in levels[:0:-1]:  # leaves to root
            sent[level] = _log_sum(up[level][:, None, :] + self.step)
            np.add.at(up, parents[level], sent[level])
        total = up.copy()
        total[levels[0]] += self.start
        for level in levels[1:]:  # root to leaves
            above = total[parents[level]] - sent[level]
            total[level] += _log_sum(above[:, None, :] + self.step.T)
        return np.exp(total - _log_sum(total)[:, None])


def counts_of(page: Page, labels: list[int]) -> dict[tuple[int, int, int], int]:
    """Occurrences of (0, sign, state), (1, parent state, state) and (2, state, 0) for the root."""
    out: dict[tuple[int, int, int], int] = {}
    for i, (own, y) in enumerate(zip(signs(page), labels, strict=True)):
        for s in own:
            out[0, s, y] = out.get((0, s, y), 0) + 1
        key = (1, labels[page.parents[i]], y) if i else (2, y, 0)
        out[key] = out.get(key, 0) + 1
    return out


def model_from(counts: dict[tuple[int, int, int], float]) -> PageModel:
    sign, step, start = np.full((SIGNS, 3), 0.5), np.full((3, 3), 0.01), np.full(3, 0.01)
    for (kind, a, b), n in counts.items():
        if kind == 0:
            sign[a, b] += n
        elif kind == 1:
            step[a, b] += n
        else:
            start[a] += n
    nodes = start + step.sum(0)  # a sign is present or not, so its table is a share of the nodes
    return PageModel(np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)), np.log(sign / nodes))


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> PageModel:
    prepare(pages.sparkSession)
    rows = pages.select("page_id", F.col("html")).filter("html IS NOT NULL")
    sample = hash_sample(rows, "page_id", sample_pages, rows.count(), "pages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for source in batch.column("html").to_pylist():
                page = parse(source)
                labels = marked(page)
                if labels:
                    for key, n in counts_of(page, labels).items():
                        total[key] = total.get(key, 0) + n
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.int32()) for i in range(3)]
                                         + [pa.array([total[k] for k in keys], pa.int64())], ["kind", "a", "b", "n"])

    got = sample.mapInArrow(run, "kind int, a int, b int, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    counts: dict[tuple[int, int, int], float] = {(r["kind"], r["a"], r["b"]): r["n"] for r in got.collect()}
    seen = sum(n for (kind, _, _), n in counts.items() if kind == 2)
    for source in SEED_PAGES:  # seeds count as a twentieth of the sample
        page = parse(source)
        for key, n in counts_of(page, marked(page)).items():
            counts[key] = counts.get(key, 0) + n * max(1.0, seen / 20 / len(SEED_PAGES))
    return model_from(counts)


def extract_texts(sources: list[str], model: PageModel) -> list[str]:
    """The main text of each page; messages pass over all pages of the list at once."""
    pages = [parse(s) for s in sources]
    parents, depths, rows, own, first = [], [], [], [], []
    for page in pages:
        base = len(parents)
        first.append(base)
        for i, (p, found) in enumerate(zip(page.parents, signs(page), strict=True)):
            parents.append(base + p if i else -1)
            depths.append(depths[base + p] + 1 if i else 0)
            rows += [base + i] * len(found)
            own += found
    content = model.marginals(np.array(parents), np.array(depths, int), np.array(rows, int), np.array(own, int))[:, CONTENT] > 0.5
    return ["\n\n".join(text for node, text, _ in page.blocks if content[base + node] or len(page.tags) == 1)
            for page, base in zip(pages, first, strict=True)]


def extract(pages: DataFrame, model: PageModel) -> DataFrame:
    """Per page row: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = [s or "" for s in batch.column("html").to_pylist()]
            texts = []
            for at in range(0, len(sources), 64):
                texts += extract_texts(sources[at:at + 64], shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
