"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

Every node of a page (elements and text runs) gets features of its subtree
(length, density, links, punctuation, controls), its attribute words and those
above it, its depth and its siblings.  Boosted trees give the odds that its
subtree holds main text.  Decoding picks the best set of nodes in which no node
is kept below a dropped one, by dynamic programming over the tree; the kept text
runs, entities decoded, are the text.

The model is fitted on at most about ``sample_pages`` pages of any size, chosen
by a hash; in the order of the hash, they are taken until they have
``sample_bytes`` bytes together (the page that reaches them is the last).  It
learns from pages whose parts are known: those with an ``article`` or ``main``
element as they are, and pages composed of the sample's sentences, with menus,
headers, footers, sidebars, notices, adverts, forms and reader comments placed
around and inside the text under many tags and attribute words.

Defined cases: NULL or empty html gives an empty text; broken markup is read as
browsers do, roughly (open elements are closed, stray end tags ignored); scripts,
styles and comments are never text; white space is what Python's ``split`` takes,
so no-break and other Unicode spaces too; a NULL page_id or url is kept; repeated rows
give equal rows; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import html as entities
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.arrow_text import slices
from ratecraft.llm.boosting import BoostedTrees
from ratecraft.llm.dom import INLINE, RAW, Nodes

SAMPLE_PAGES = 200
SAMPLE_BYTES = 8 << 20  # of all pages in the sample
COMPOSED = 300          # pages composed for training
_RUN = 1 << 20


def _sentences(nodes: Nodes) -> list[str]:
    return [s for t in nodes.text if t for s in re.findall(r"[^.!?<&]{2,200}[.!?]", " ".join(t.split()))]


class Composer:
    """Pages with known main text, for training: elements carry their label in ``data-y``."""

    def __init__(self, sentences: list[str], seed: int):
        self.sentences = sentences or ["Some words of a text that says something, and goes on.", "Short one."]
        self.rng = random.Random(seed)

    def prose(self, least: int, most: int) -> str:
        return " ".join(self.rng.choices(self.sentences, k=self.rng.randint(least, most)))

    def element(self, tags: list[str], names: list[str], inner: str, label: int | None = None) -> str:
        rng = self.rng
        tag = rng.choice([t for t in tags if t != "p" or "<p>" not in inner])     # a paragraph holds no paragraphs
        name = rng.choice(names) if names else ""
        if name and rng.random() < 0.3:
            name = f"{rng.choice(['site', 'page', 'box', 'block', 'c', 'js'])}-{name}"
        attribute = f' {rng.choice(["class", "class", "id"])}="{name}"' if name else ""
        mark = "" if label is None else f' data-y="{label}"'
        return f"<{tag}{attribute}{mark}>{inner}</{tag}>"

    def words(self, most: int = 3) -> str:
        return " ".join(self.rng.choice(self.sentences).split()[:self.rng.randint(1, most)])

    def links(self, n: int) -> str:
        items = [f'<a href="/{i}">{self.words()}</a>' for i in range(n)]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if self.rng.random() < 0.7 else " ".join(items)

    def paragraphs(self, least: int, most: int) -> str:
        return "".join(f"<p>{self.prose(1, 4)}</p>" for _ in range(self.rng.randint(least, most)))

    def chrome(self) -> str:
        """One part that is not main text."""
        rng, kind = self.rng, self.rng.randrange(9)
        text = self.prose(1, 3) if rng.random() < 0.5 else self.paragraphs(1, 3)
        if kind == 0:
            return self.element(*rng.choice([(["nav"], ["", "main", "top"]), (["div", "ul"], ["menu", "nav", "navbar", "navigation", "breadcrumb"])]), self.links(rng.randint(2, 8)), 0)
        if kind == 1:
            return self.element(*rng.choice([(["header"], ["", "top"]), (["div"], ["header", "masthead", "topbar", "banner"])]), rng.choice([f"<h1>{self.words(6)}</h1>", self.links(3), text]), 0)
        if kind == 2:
            return self.element(*rng.choice([(["footer"], ["", "bottom"]), (["div"], ["footer", "copyright", "contentinfo"])]), "&copy; " + text, 0)
        if kind == 3:
            return self.element(*rng.choice([(["aside"], ["", "left", "right"]), (["div"], ["sidebar", "widget", "rail", "related", "recommended", "trending"])]), rng.choice([text, f"<h3>{self.words()}</h3>" + self.links(4)]), 0)
        if kind == 4:
            return self.element(["div", "section", "p"], ["notice", "cookie", "cookies", "alert", "consent", "gdpr", "message", "warning", "notification"], self.prose(1, 2) if rng.random() < 0.6 else text, 0)
        if kind == 5:
            return self.element(["div", "section", "aside", "p"], ["ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "promoted"], text, 0)
        if kind == 6:
            return self.element(["form"], ["", "search", "newsletter", "subscribe", "login"], f"<label>{self.words(5)}</label><input name=q>{text if rng.random() < 0.4 else ''}<button>{self.words()}</button>", 0)
        if kind == 7:
            each = "".join(self.element(["div", "li", "article", "p"], ["comment", "reply", ""], self.prose(1, 3)) for _ in range(rng.randint(1, 5)))
            return self.element(["div", "section", "ul", "ol"], ["comments", "comment-list", "discussion", "replies", "responses comments"], f"<h3>{self.words()}</h3>" * rng.randint(0, 1) + each, 0)
        return self.element(["div", "section"], ["share", "social", "tags", "pagination", "toc", "links"], self.links(rng.randint(2, 5)), 0)

    def article(self) -> str:
        rng, parts = self.rng, []
        if rng.random() < 0.8:
            parts.append(f"<h1>{self.words(12)}</h1>")
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            kind = rng.random()
            if kind < 0.7:
                body = self.prose(1, 8)
                cut = body.split(" ")
                if rng.random() < 0.3 and len(cut) > 4:
                    cut[2] = f'<{(t := rng.choice(["a", "b", "em", "span", "strong", "i"]))}{" href=/x" if t == "a" else ""}>{cut[2]}</{t}>'
                parts.append(f"<p>{rng.choice(['', '', '<b>'])}{' '.join(cut)}{rng.choice(['</p>', '</p>', '<br>'])}")
            elif kind < 0.78:
                parts.append(f"<h2>{self.words(6)}</h2>")
            elif kind < 0.86:
                parts.append("<ul>" + "".join(f"<li>{self.prose(1, 1)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote><p>{self.prose(1, 2)}</p></blockquote>")
            else:
                parts.append(f"<div>{self.prose(1, 4)}</div>")
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            parts.insert(rng.randint(0, len(parts)), self.chrome())
        inner = "".join(parts)
        if rng.random() < 0.3:
            inner = self.element(["div", "section"], ["", "body", "content", "entry-content", "inner"], inner)
        return self.element(*rng.choice([(["article"], ["", "post", "story"]), (["main"], ["", "main"]), (["div", "section"], ["article", "content", "main-content", "post", "entry", "story-body", "text", "article-body"]), (["div"], [""])]), inner, 1)

    def page(self) -> str:
        rng = self.rng
        before, after = ([self.chrome() for _ in range(rng.randint(0, 4))] for _ in "ab")
        body = "".join([*before, self.article(), *after])
        if rng.random() < 0.3:
            body = self.element(["div"], ["", "wrapper", "container", "page", "content"], body)
        return f"<!DOCTYPE html><html><head><title>{self.words(8)}</title></head><body>{body}{rng.choice(['', '</body></html>'])}"


def sample_of(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_bytes: int = SAMPLE_BYTES) -> list[str]:
    """Pages of any size, drawn by a hash, up to the first that makes ``sample_bytes``."""
    pages = pages.where("html is not null").select("html", F.xxhash64("html").alias("h"))
    n = pages.count()
    draw = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    drawn = pages.where(draw < min(1.0, sample_pages / max(n, 1)))
    taken, size = [], 0
    for h, length in drawn.select("h", F.octet_length("html").alias("length")).orderBy(draw, "h").limit(2 * sample_pages).collect():
        if size >= sample_bytes:
            break
        taken.append(h)
        size += length
    html = dict(pages.where(F.col("h").isin(taken)).groupBy("h").agg(F.min("html")).collect())    # each distinct page once
    return [html[h] for h in taken]


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, seed: int = 7, sample_bytes: int = SAMPLE_BYTES) -> BoostedTrees:
    """The model, from a bounded sample of pages."""
    sample = sample_of(pages, sample_pages, sample_bytes)
    plain = Nodes()
    for h in sample:
        plain.read(h)
    own = [re.sub(r"(?i)<(article|main)\b", r'<\1 data-y="1"', h, count=1) for h in sample if re.search(r"(?i)<(article|main)\b", h)]
    composer = Composer(_sentences(plain), seed)
    labelled = Nodes()
    for h in own + [composer.page() for _ in range(COMPOSED)]:
        labelled.read(h)
    x, y = labelled.features(), labelled.positives()
    weight = 0.3 + np.log1p([len(t) if t else 0 for t in labelled.text])      # text matters by its length
    return BoostedTrees().fit(x, y.astype(float), np.where([t is None for t in labelled.text], 2.0, weight))


def decode(nodes: Nodes, odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the most likely choice in which nothing is kept below a dropped node.

    Per node, log odds are summed over the best choice of its subtree; dropping
    a node drops its subtree and scores 0.  A root is always kept.  The running
    text of a node (its text and inline children) is one choice, with the mean
    odds of its text.
    """
    parent, odds = nodes.parent, odds.tolist()
    n = len(parent)
    running = [text is not None or tag in INLINE for text, tag in zip(nodes.text, nodes.tag, strict=True)]
    for i in range(n - 1, 0, -1):
        if not running[i] and parent[i] >= 0:
            running[parent[i]] = False       # an inline element around blocks is one of them
    holder, mass, sums, gain = list(range(n)), [0.0] * n, [0.0] * n, list(odds)
    for i, p in enumerate(parent):
        if running[i] and p >= 0:
            holder[i] = holder[p] if running[p] else p
            if (text := nodes.text[i]) is not None and (size := len(text.strip())):
                mass[holder[i]] += size
                sums[holder[i]] += size * odds[i]
    line = [s / m if m else 0.0 for s, m in zip(sums, mass, strict=True)]
    for i in range(n - 1, -1, -1):
        if not running[i]:
            if line[i] > 0:
                gain[i] += line[i]
            if gain[i] > 0 and parent[i] >= 0:
                gain[parent[i]] += gain[i]
    kept = [False] * n
    for i, p in enumerate(parent):
        kept[i] = p < 0 or (kept[holder[i]] and line[holder[i]] > 0 if running[i] else kept[p] and gain[i] > 0)
    return np.array(kept, bool)


def texts(nodes: Nodes, kept: np.ndarray) -> list[str]:
    """The kept text of every page: blocks with single blanks, joined by one."""
    parts: list[list[str]] = [[] for _ in range(nodes.pages)]
    # a block's start and end part the words around it, inline elements do not
    ends: dict[int, list[int]] = {}
    for i, tag in enumerate(nodes.tag):
        out = parts[nodes.page[i]]
        if ends and i in ends:
            for p in ends.pop(i):
                parts[p].append(" ")
        text = nodes.text[i]
        if text is not None:
            if kept[i]:
                out.append(text)
        elif tag not in INLINE and tag not in RAW and tag != "img":
            out.append(" ")
            ends.setdefault(nodes.end[i], []).append(nodes.page[i])
    return [" ".join(entities.unescape("".join(p)).split()) for p in parts]


def extract(pages: DataFrame, model: BoostedTrees | None = None, **options) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = model or fit(pages, **options)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html", _RUN):
                nodes = Nodes()
                for html in part.column("html").to_pylist():
                    nodes.read(html or "")
                found = texts(nodes, decode(nodes, model.predict(nodes.features())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
