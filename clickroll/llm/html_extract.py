"""Main text of web pages by tree scoring.

A page becomes a tree of elements with text blocks. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, hidden parts and reader comments are marked by
tag, role or class words. Each other block is a paragraph that passes points (one, one a
comma, up to three for length) to its container, half to the next ancestor, less beyond.
An ancestor's score is its points and what its tag and class say, times one less its link
density. The best container, or the article it stands in, is kept. Outside an article its
siblings stay too, and those of its ancestors up to the main element or the body, unless
half of their text is links: headings, leads, lists and short paragraphs beside the best
container are the page's text as well. Blocks come in page order, one a line; character
references are decoded and white space becomes one blank.

Edge cases: missing or empty html: empty text. No markup: the whole is a block. No
container scores: all blocks that are not marked. Equal scores: the first in page order.
Unclosed or crossed tags close as browsers close them. Repeated rows give equal texts.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript noframes iframe xmp template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
DROPPED = RAW | frozenset("head nav footer aside form button select input dialog menu object canvas label fieldset".split())
#: start tags that end an open element of the same family
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar nav navbar navigation "
    "menu breadcrumb breadcrumbs masthead header footer comment comments disqus reply replies respond cookie cookies consent notice "
    "notices gdpr popup modal overlay newsletter subscribe subscription signup social share sharing related recommended recommendations "
    "pagination pager widget toolbar login search hidden notification alert".split())
LIKELY = frozenset("article body content entry main page post text blog story".split())
WEIGHT = {"article": 25, "main": 15, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "address": -3, "ol": -3, "ul": -3, "dl": -3,
          "dd": -3, "dt": -3, "li": -3, "h1": -5, "h2": -5, "h3": -5, "h4": -5, "h5": -5, "h6": -5, "th": -5}
#: elements that are paragraphs themselves: their points go to the element around them
PARAGRAPHS = frozenset("p pre li dd dt blockquote h1 h2 h3 h4 h5 h6 td th figcaption caption summary".split())
LEVELS = 5
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)"
    r"((?:[^>\"']*+(?:\"[^\"]*+\"|'[^']*+'))*+[^>\"']*+(?=>|\Z)|[^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Tree:
    """Elements in page order: tag, parent, marks; blocks: owner, text, characters in links."""

    def __init__(self, html: str):
        self.tags, self.parents, self.dropped, self.bonus, self.by_class = ["#"], [-1], [False], [0.0], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self.stack, self.words, self.linked, self.links = [0], [], 0, 0
        # by depth: the element that owns text there, and the depth of the nearest block; by tag: depths of open ones
        self.owners, self.nearest, self.open = [0], [0], defaultdict(list)
        at, n = 0, len(html)
        while at < n:
            m = _TOKEN.search(html, at)
            self._text(html[at:m.start()] if m else html[at:])
            if not m:
                break
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if m[1]:
                    self._end(tag)
                else:
                    closed = (m[3] or "").rstrip().endswith("/")
                    self._start(tag, m[3] or "")
                    if tag in RAW and not closed:
                        end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
                        at = end.start() if end else n
                    elif closed and tag in RAW:
                        self._end(tag)
        self._flush()

    def _text(self, raw: str) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self.words.append(text)
            if self.links:
                self.linked += len("".join(text.split()))

    def _flush(self) -> None:
        if self.words:
            text = " ".join("".join(self.words).split())
            if text:
                self.blocks.append((self._owner(), text, self.linked))
            self.words, self.linked = [], 0

    def _owner(self) -> int:
        return self.owners[-1]

    def _pop_to(self, depth: int) -> None:
        gone = self.stack[depth:]
        if any(self.tags[i] in BLOCKS or self.dropped[i] for i in gone):
            self._flush()
        for i in gone:
            self.open[self.tags[i]].pop()
        self.links -= sum(self.tags[i] == "a" for i in gone)
        del self.stack[depth:], self.owners[depth:], self.nearest[depth:]

    def _start(self, tag: str, attrs: str) -> None:
        if tag in ("br", "wbr"):
            self.words.append(" " if tag == "br" else "")
            return
        if tag in BLOCKS and tag not in ("html", "body"):
            if self.tags[self.stack[self.nearest[-1]]] == "p":
                self._pop_to(self.nearest[-1])
        for depth in range(len(self.stack) - 1, 0, -1) if any(self.open[t] for t in CLOSES.get(tag, ())) else ():
            t = self.tags[self.stack[depth]]
            if t in SCOPES[tag]:
                break
            if t in CLOSES[tag]:
                self._pop_to(depth)
                if tag != "tr" or t == "tr":
                    break
        drop, bonus, by_class = self._marks(tag, attrs)
        if tag in BLOCKS or drop:
            self._flush()
        parent = self.stack[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.dropped.append(drop)
        self.bonus.append(bonus)
        self.by_class.append(by_class)
        if tag not in VOID:
            depth = len(self.stack)
            self.stack.append(len(self.tags) - 1)
            self.owners.append(self.stack[-1] if tag in BLOCKS or drop else self.owners[-1])
            self.nearest.append(depth if tag in BLOCKS else self.nearest[-1])
            self.open[tag].append(depth)
            self.links += tag == "a"

    def _end(self, tag: str) -> None:
        if tag == "br":
            self.words.append(" ")
            return
        # an inline element's end reaches no further than the nearest block
        if self.open[tag] and (tag in BLOCKS or self.open[tag][-1] > self.nearest[-1]):
            self._pop_to(self.open[tag][-1])

    def _marks(self, tag: str, attrs: str) -> tuple[bool, float, bool]:
        drop, bonus, by_class = tag in DROPPED, float(WEIGHT.get(tag, 0)), False
        if tag == "header" and not self.open["article"] and not self.open["main"]:
            drop = True
        if attrs.strip():
            got = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
            words = set(_SPLIT.split(f"{got.get('class', '')} {got.get('id', '')}".lower()))
            if tag not in ("html", "body", "article", "main"):
                by_class = bool(words & UNLIKELY)
                drop = drop or got.get("role", "").lower() in ROLES
            drop = drop or "hidden" in got or got.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(got.get("style", "")))
            bonus += 25 * bool(words & LIKELY)
        return drop, bonus, by_class


def main_text(html: str) -> str:
    tree = _Tree(html)
    tags, parents, n = tree.tags, tree.parents, len(tree.tags)
    holds = [t in ("article", "main", "h1") for t in tags]
    for i in range(n - 1, 0, -1):
        holds[parents[i]] = holds[parents[i]] or holds[i]
    # class words drop an element unless the article is inside it
    dropped = [False] * n
    for i in range(1, n):
        dropped[i] = dropped[parents[i]] or tree.dropped[i] or (tree.by_class[i] and not holds[i])
    blocks = [b for b in tree.blocks if not dropped[b[0]]]
    if not blocks:
        return ""
    points, chars, linked = [0.0] * n, [0] * n, [0] * n
    candidates = set()
    for owner, text, in_links in blocks:
        chars[owner] += len(text)
        linked[owner] += in_links
        worth = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3.0)
        up = parents[owner] if tags[owner] in PARAGRAPHS else owner
        for level in range(LEVELS):
            if up <= 0:
                break
            points[up] += worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
            candidates.add(up)
            up = parents[up]
    for i in range(n - 1, 0, -1):
        chars[parents[i]] += chars[i]
        linked[parents[i]] += linked[i]

    def score(i: int) -> float:
        return (points[i] + tree.bonus[i]) * (1 - min(1.0, linked[i] / max(1, chars[i])))

    usable = [i for i in sorted(candidates) if tags[i] not in ("html", "body")]
    if not usable:
        return "\n".join(t for _, t, _ in blocks)
    top = max(usable, key=lambda i: (score(i), -i))
    best = score(top)
    up = top
    while up > 0:
        if tags[up] == "article":
            top = up
            break
        up = parents[up]
    if tags[top] == "article":
        inside = [False] * n
        for i in range(1, n):
            inside[i] = i == top or inside[parents[i]]
        return "\n".join(t for owner, t, _ in blocks if inside[owner])
    path = {top}
    up = top
    while up > 0 and tags[up] not in ("main", "body"):
        up = parents[up]
        path.add(up)
    # what hangs off the path, link lists left out; ``up`` is the main element, the body or the root
    inside = [i == up for i in range(n)]
    for i in range(1, n):
        inside[i] = inside[i] or inside[parents[i]] and (parents[i] not in path or i in path or 2 * linked[i] < max(1, chars[i]))
    return "\n".join(t for owner, t, k in blocks if inside[owner] and (owner not in path or 2 * k < len(t)))


def _extracted(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(h.as_py() or "") for h in b.column(text)]
        arrays = [b.column(i) for i in range(b.num_columns) if i != text]
        names = [x for i, x in enumerate(b.schema.names) if i != text]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], names=[*names, "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(partial(_extracted, text=2), "page_id long, url string, text string").withColumn(
        "n_chars", F.length("text").cast("long"))


ship(__name__)
