"""A small tolerant reader of HTML: block elements of a page as a tree, with features of each node."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
    "audio canvas map object video math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder semantics "
    "svg circle defs ellipse g line path polygon polyline rect text tspan use".split()
)
# What is never shown as text: scripts, styles, templates, the head, form controls and the fallback of frames.
SKIPPED = frozenset("script style template iframe select textarea button datalist title head".split())
RAW = frozenset("script style textarea title iframe template select".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split()
)
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
}
SCOPE = frozenset("table td th caption object html body button".split())
# Attribute tokens that speak for or against main text.
GOOD_TOKENS = frozenset("article articlebody content entry main post story text body prose page chapter column copy".split())
BAD_TOKENS = frozenset(
    "ad ads adv advert advertisement sponsor sponsored promo banner nav navigation menu navbar breadcrumb breadcrumbs header masthead footer foot sidebar side aside rail widget related recommended more "
    "comment comments reply replies respondent disqus discussion cookie cookies consent notice notices alert gdpr popup modal overlay share sharing social follow newsletter subscribe signup login form search "
    "tags pagination pager copyright legal toolbar skip hidden".split()
)
LANDMARKS = {"nav": 1, "aside": 1, "footer": 1, "form": 1, "menu": 1, "dialog": 1, "header": 1, "fieldset": 1}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|style|aria-hidden|data-main)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
SPACE = re.compile(r"\s+")
SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
MARKS = re.compile(r"[.,;:!?]")


class Node:
    """A block element: its place in the tree and the runs of text directly in it."""

    __slots__ = ("tag", "parent", "depth", "good", "bad", "tokens", "order", "children", "runs", "links", "link_chars", "tags", "main", "role")

    def __init__(self, tag: str, parent: Node | None, order: int, attributes: str):
        self.tag, self.parent, self.order = tag, parent, order
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node] = []
        self.runs: list[tuple[int, str]] = []
        self.links = self.link_chars = self.tags = 0
        self.good = self.bad = 0
        self.main = None
        self.role = ""
        if attributes:
            for name, value in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower() if name.lower() != "class" else value.strip("\"'")
                if name == "data-main":
                    self.main = value == "1"
                elif name == "role":
                    self.role = value
                    self.bad += value in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert")
                    self.good += value in ("main", "article")
                elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                    self.bad += 3
                elif name in ("class", "id", "itemprop"):
                    parts = {x.lower() for x in SPLIT.split(value)}
                    parts.add(value.lower().replace("-", "").replace("_", ""))
                    self.good += len(GOOD_TOKENS & parts)
                    self.bad += len(BAD_TOKENS & parts)


def read(page: str) -> list[Node]:
    """Block nodes of a page in document order; the first is the root."""
    root = Node("#root", None, 0, "")
    nodes, stack = [root], [("#root", root)]
    runs: list[str] = []
    order = 0
    skip_until = ""
    in_link = 0
    at = 0

    def flush():
        nonlocal order
        if runs:
            text = SPACE.sub(" ", html.unescape("".join(runs))).strip()
            runs.clear()
            if text:
                order += 1
                stack[-1][1].runs.append((order, text))

    def owner():
        return stack[-1][1]

    pos, size = 0, len(page)
    while pos < size:
        m = TOKEN.search(page, pos)
        if m is None:
            runs.append(page[pos:])
            break
        at = m.start()
        if at > pos:
            piece = page[pos:at]
            runs.append(piece)
            if in_link:
                owner().link_chars += len(piece)
        pos = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name in SKIPPED:
                continue
            if name in INLINE:
                if name == "a" and in_link:
                    in_link -= 1
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    flush()
                    del stack[i:]
                    in_link = 0
                    break
                if stack[i][0] in ("table", "td", "th") and name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break
            continue
        attributes = m[3]
        if name in SKIPPED:
            if name in RAW and not attributes.rstrip().endswith("/"):
                close = re.compile(f"</{name}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(page, pos)
                pos = close.end() if close else size
                runs.append(" ")
            elif name == "head":
                close = HEAD_END.search(page, pos)
                if close and page[close.start() : close.start() + 2].lower() == "</":
                    pos = close.end()
            elif name not in VOID:
                close = re.compile(f"</{name}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(page, pos)
                pos = close.end() if close else pos
            continue
        if name in VOID:
            if name in ("br", "hr", "wbr"):
                if name == "br":
                    runs.append(" ")
                elif name == "hr":
                    flush()
            owner().tags += 1
            continue
        if name in INLINE:
            owner().tags += 1
            if name == "a":
                in_link = 1
                owner().links += 1
            continue
        flush()
        in_link = 0
        if name in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] in SCOPE:
                    break
        rule = CLOSED_BY.get(name)
        if rule:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in rule[1]:
                    break
                if stack[i][0] in rule[0]:
                    del stack[i:]
                    if name not in ("tr", "tbody", "tfoot"):
                        break
        node = Node(name, owner(), order, attributes)
        owner().children.append(node)
        nodes.append(node)
        stack.append((name, node))
    flush()
    return nodes


HEAD_END = re.compile(r"</head\s*>|<body", re.I)
NAMES = (
    "depth tag_p tag_h tag_li tag_div tag_article tag_cell tag_quote landmark own_chars chars share density links link_share marks word_length children paragraphs "
    "good bad good_above bad_above article_above landmark_above siblings alike sibling_chars sibling_links place before_share index"
).split()


def features(nodes: list[Node]) -> list[list[float]]:
    """One row per node; see NAMES."""
    n = len(nodes)
    index = {id(x): i for i, x in enumerate(nodes)}
    own = [sum(len(t) for _, t in x.runs) for x in nodes]
    chars, links, link_chars, tags, paragraphs = own[:], [x.links for x in nodes], [x.link_chars for x in nodes], [1 + x.tags for x in nodes], [int(x.tag == "p") for x in nodes]
    parent = [index[id(x.parent)] if x.parent else -1 for x in nodes]
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        link_chars[p] += link_chars[i]
        tags[p] += tags[i]
        paragraphs[p] += paragraphs[i]
    total = max(1, chars[0])
    above = [(0, 0, 0, 0)] * n
    before = [0] * n
    seen = 0
    kinds: dict[int, Counter] = {}  # tags of the children by parent
    rows = []
    log = math.log1p
    for i, x in enumerate(nodes):
        before[i] = seen
        seen += own[i]
        p = parent[i]
        if p >= 0:
            up, q = nodes[p], above[p]
            above[i] = (
                q[0] + up.good,
                q[1] + up.bad,
                q[2] or up.tag in ("article", "main") or up.role in ("main", "article"),
                q[3] or up.tag in LANDMARKS,
            )
            family = up.children
            if p not in kinds:
                kinds[p] = Counter(s.tag for s in family)
            alike = kinds[p][x.tag]
            others = max(1, len(family) - 1)
            sibling_chars = (chars[p] - own[p] - chars[i]) / others
            sibling_links = (link_chars[p] - up.link_chars - link_chars[i]) / max(1, chars[p] - own[p] - chars[i])
        else:
            family, alike, sibling_chars, sibling_links = [x], 1, 0.0, 0.0
        text = " ".join(t for _, t in x.runs)
        tag = x.tag
        a = above[i]
        rows.append(
            [
                x.depth,
                tag == "p",
                tag[0] == "h" and tag[1:].isdigit(),
                tag in ("li", "dt", "dd"),
                tag in ("div", "section"),
                tag in ("article", "main"),
                tag in ("td", "th", "tr", "table", "tbody"),
                tag in ("blockquote", "pre", "figure", "figcaption"),
                tag in LANDMARKS,
                log(own[i]),
                log(chars[i]),
                chars[i] / total,
                log(chars[i] / tags[i]),
                links[i],
                link_chars[i] / max(1, chars[i]),
                100 * len(MARKS.findall(text)) / max(1, own[i]),
                own[i] / (1 + text.count(" ")),
                len(x.children),
                log(paragraphs[i]),
                x.good,
                x.bad,
                a[0],
                a[1],
                a[2],
                a[3],
                len(family),
                alike,
                log(max(0.0, sibling_chars)),
                sibling_links,
                i / n,
                before[i] / total,
                seen / total,
            ]
        )
    return rows
