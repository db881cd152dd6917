"""Main text of web pages: boosted trees rate every block element, and a tree decoding picks a consistent set.

Training pages come from a bounded sample of at most about ``SAMPLE_PAGES`` pages. Their own landmarks (article, main,
nav, footer and the like) label their elements; further pages are put together from their texts in many
layouts (other element names and classes, sidebars, notices, adverts, forms, reader comments), with labels
known by construction.

Decoding maximises the summed evidence under the rule that nothing is kept inside a dropped element, so
answers for ancestors and descendants never contradict each other.

Blocks are runs of text between starts and ends of block elements; line breaks inside a block count as white space.

Defined results: null, empty and markup-only pages give an empty text; text without any markup is one
block; repeated pages each get a row; without sample pages the model still learns from built layouts.
"""

from __future__ import annotations

import html
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm import boosting
from tickforge.llm.html_nodes import LANDMARKS, NAMES, Node, features, read
from tickforge.llm.samples import hashed_share

SAMPLE_PAGES = 240
LAYOUTS = 420
SEED = 20

# Element starts for the parts of built training pages.
MAIN_STARTS = ("article", "main", "div class=content", "div id=main-content", "div class=post-body", "section class=story", "div class=entry-content", "div itemprop=articleBody", "div class=x1", "div")
WRAPS = ("div class=wrap", "div id=page", "div class=container", "div class=row", "div", "section", "div class=inner", "div class=col-8")
JUNK_STARTS = {
    "nav": ("nav", "div class=menu", "div id=navigation", "ul class=nav", "div class=navbar"),
    "header": ("header", "div class=header", "div id=masthead", "div class=site-header"),
    "footer": ("footer", "div class=footer", "div id=footer", "div class=site-footer"),
    "side": ("aside", "div class=sidebar", "div id=sidebar", "div class=related", "div class=widget", "section class=recommended"),
    "ad": ("div class=ad", "div class=advert", "div class=sponsored", "div id=banner", "aside class=promo"),
    "notice": ("div class=cookie-notice", "div class=notice", "div id=consent", "div role=alert", "div class=newsletter"),
    "form": ("form", "form class=search", "div class=login", "form class=subscribe"),
    "comments": ("section class=comments", "div id=comments", "div class=comment-list", "section id=discussion", "ol class=comments"),
    "share": ("div class=share", "ul class=social", "div class=tags", "div class=breadcrumbs"),
}


def _end(start: str) -> str:
    return f"</{start.split()[0]}>"


class Layouts:
    """Builds labelled pages from given texts."""

    def __init__(self, texts: list[str], seed: int = SEED):
        self.random = random.Random(seed)
        words = [w for t in texts for w in t.split()] or "one two three four five six seven eight nine ten".split()
        self.words = words

    def sentence(self, low: int, high: int) -> str:
        at = self.random.randrange(len(self.words))
        size = self.random.randint(low, high)
        picked = [self.words[(at + i) % len(self.words)] for i in range(size)]
        return html.escape(" ".join(picked))

    def junk(self, kind: str) -> str:
        r = self.random
        start = r.choice(JUNK_STARTS[kind])
        inner = []
        if kind in ("nav", "share", "footer", "side", "header") and r.random() < 0.8:
            links = [f"<a href='/{i}'>{self.sentence(1, 3)}</a>" for i in range(r.randint(2, 9))]
            if r.random() < 0.6:
                inner.append("<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>")
            else:
                inner.append(" | ".join(links))
        if kind == "header":
            inner.append(f"<h1>{self.sentence(1, 4)}</h1>" if r.random() < 0.3 else f"<div>{self.sentence(1, 4)}</div>")
        if kind == "footer":
            inner.append(f"&copy; {self.sentence(3, 14)}")
        if kind == "side":
            inner += [f"<h3>{self.sentence(1, 3)}</h3>"] + [f"<p>{self.sentence(4, 25)}</p>" for _ in range(r.randint(0, 3))]
        if kind in ("ad", "notice"):
            text = self.sentence(3, 25)
            inner.append(text if r.random() < 0.6 else f"<p>{text}</p>")
        if kind == "form":
            inner.append(f"<label>{self.sentence(1, 4)}</label><input><p>{self.sentence(2, 10)}</p><button>{self.sentence(1, 2)}</button>")
        if kind == "comments":
            inner.append(f"<h2>{self.sentence(1, 3)}</h2>")
            for _ in range(r.randint(1, 6)):
                name, text = self.sentence(1, 2), self.sentence(4, 70)
                inner.append(r.choice((f"<div class=comment><b>{name}</b><p>{text}</p></div>", f"<div class=reply><p>{text}</p></div>", f"<li><p>{name}</p><p>{text}</p></li>")))
        return f"<{start} data-main=0>" + "".join(inner) + _end(start)

    def body(self) -> str:
        """The blocks of an article, with junk in between at times."""
        r = self.random
        out = [f"<{h} data-main=1>{self.sentence(3, 12)}</{h}>" for h in [r.choice(("h1", "h1", "h2"))] if r.random() < 0.9]
        if r.random() < 0.3:
            out.append(self.junk(r.choice(("share", "ad"))))
        for _ in range(r.choice((0, 1, 2, 3, 4, 6, 9, 14))):
            kind = r.random()
            text = self.sentence(*r.choice(((3, 12), (12, 60), (40, 140))))
            if kind < 0.72:
                out.append(r.choice((f"<p data-main=1>{text}</p>", f"<p data-main=1><b>{text}<br>")))
            elif kind < 0.8:
                out.append(f"<div data-main=1>{text}</div>")
            elif kind < 0.87:
                out.append("<ul data-main=1>" + "".join(f"<li data-main=1>{self.sentence(2, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.93:
                out.append(f"<blockquote data-main=1><p data-main=1>{text}</p></blockquote>")
            else:
                out.append(f"<h2 data-main=1>{self.sentence(2, 8)}</h2>")
            if r.random() < 0.07:
                out.append(self.junk(r.choice(("ad", "side", "notice", "form"))))
        if r.random() < 0.2:
            out.append(self.junk(r.choice(("comments", "share", "side"))))
        return "".join(out)

    def page(self) -> str:
        r = self.random
        start = r.choice(MAIN_STARTS)
        main = f"<{start} data-main=1>{self.body()}{_end(start)}"
        side = [self.junk("side") for _ in range(r.choice((0, 0, 1, 2)))]
        middle = [main, *side] if r.random() < 0.7 else [*side, main]
        if r.random() < 0.35:
            middle.append(self.junk("comments"))
        for _ in range(r.choice((0, 0, 1, 2))):
            wrap = r.choice(WRAPS)
            middle = [f"<{wrap} data-main=1>" + "".join(middle) + _end(wrap)]
        top = [self.junk(k) for k in ("notice", "header", "nav", "ad", "form", "share") if r.random() < 0.45]
        end = [self.junk(k) for k in ("ad", "side", "form", "notice", "footer") if r.random() < 0.45]
        return "<html data-main=1><body data-main=1>" + "".join(top + middle + end) + "</body></html>"


def landmark_labels(nodes: list[Node]) -> list[bool] | None:
    """Labels of a page's own landmarks: what an article or main element holds outside navigation and the like.

    None for pages without such an element.
    """
    inside = [False] * len(nodes)
    place = {id(n): i for i, n in enumerate(nodes)}
    found = False
    holds = [False] * len(nodes)
    for i, n in enumerate(nodes):
        above = n.parent is not None and inside[place[id(n.parent)]]
        junk = n.tag in LANDMARKS or n.bad > n.good
        inside[i] = not junk and (above or n.tag in ("article", "main"))
        if n.tag in ("article", "main") and not junk:
            found = True
            up = n.parent
            while up is not None:
                holds[place[id(up)]] = True
                up = up.parent
    return [a or b for a, b in zip(inside, holds, strict=True)] if found else None


def built_labels(nodes: list[Node]) -> list[bool]:
    """Labels of a built page: each element's own mark, or its parent's where it has none."""
    place = {id(n): i for i, n in enumerate(nodes)}
    out: list[bool] = []
    for n in nodes:
        up = out[place[id(n.parent)]] if n.parent is not None else True
        out.append(up and (n.main if n.main is not None else up))
    return out


def fit_pages(sample: list[str]) -> boosting.Trees:
    """Trees from a list of pages of bounded length."""
    x: list[list[float]] = []
    y: list[bool] = []
    texts: list[str] = []
    for page in sample:
        nodes = read(page)
        labels = landmark_labels(nodes)
        if labels is not None:
            x += features(nodes)
            y += labels
            texts += [t for n in nodes for _, t in n.runs][:40]
    layouts = Layouts(texts)
    for _ in range(LAYOUTS):
        nodes = read(layouts.page())
        x += features(nodes)
        y += built_labels(nodes)
    return boosting.fit_trees(np.array(x, float).reshape(len(x), len(NAMES)), np.array(y, float), rounds=50, depth=4, rate=0.2)


def decode(nodes: list[Node], margin: np.ndarray) -> str:
    """Text of the best consistent choice of elements."""
    place = {id(n): i for i, n in enumerate(nodes)}
    n = len(nodes)
    own = [m * (1.0 + sum(len(t) for _, t in x.runs) ** 0.5 / 4) for x, m in zip(nodes, margin, strict=True)]
    keep, whole = own[:], own[:]  # best value with the element kept; value of keeping its whole subtree
    take = [True] * n
    for i in range(n - 1, 0, -1):
        p = place[id(nodes[i].parent)]
        take[i] = keep[i] > -whole[i]
        keep[p] += max(keep[i], -whole[i])
        whole[p] += whole[i]
    runs: list[tuple[int, str]] = []
    for i, x in enumerate(nodes):
        if i and not take[place[id(x.parent)]]:
            take[i] = False
        if take[i]:
            runs += x.runs
    return "\n".join(t for _, t in sorted(runs))


def sample_pages(pages: DataFrame, key_col: str = "page_id", html_col: str = "html") -> list[str]:
    """At most about SAMPLE_PAGES pages, chosen by a hash of their identifier and sorted."""
    rows = pages.select(pages[key_col].alias("key"), pages[html_col].alias("html")).where(F.col("html").isNotNull())
    got = rows.where(hashed_share(F.col("key"), rows.count(), SAMPLE_PAGES)).select("html").collect()
    return sorted(r["html"] for r in got)


def main_texts(pages: DataFrame, trees: boosting.Trees, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of every row in struct ``row``, with text and n_chars."""
    rows = pages.select(F.struct(*(pages[c] for c in (pages.columns if keep is None else keep))).alias("row"), pages[html_col].alias("html"))

    def extract(batches):
        for batch in batches:
            texts: list[str] = []
            column = batch.column("html")
            for first in range(0, len(column), 256):  # rate the nodes of some pages at once
                trees_of = [read(h or "") for h in column.slice(first, 256).to_pylist()]
                rated = [features(nodes) for nodes in trees_of]
                flat = np.array([r for page in rated for r in page], float)
                margin = trees.margin(flat)
                at = 0
                for nodes in trees_of:
                    texts.append(decode(nodes, margin[at : at + len(nodes)]))
                    at += len(nodes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["row", "text", "n_chars"]
            )

    return rows.mapInArrow(extract, rows.select("row").schema.add("text", "string").add("n_chars", "long"))


def query(pages: DataFrame) -> DataFrame:
    got = main_texts(pages, fit_pages(sample_pages(pages)), keep=["page_id", "url"])
    return got.select("row.page_id", "row.url", "text", "n_chars")
