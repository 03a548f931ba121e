"""Main text of web pages by composite text density.

Every node of a page's tree has a density: its characters per tag, made smaller where characters or tags
belong to links. The node whose children's densities have the largest sum holds the main text; blocks beside
its path to the body join it if they are at least as dense as the least dense node on that path. Parts that
say by their tag, role or class what they are (menus, adverts, comments) are left out beforehand. A form, or a
part of whose class names only one piece says so (``has-sidebar``, ``no-comments``), is left out only if the page
has its text elsewhere; if most text is inside, it is no more than a wrapper, and its parts are judged instead.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
#: What these hold is no text of a page.
UNSEEN = frozenset("head script style noscript template svg math canvas object iframe audio video title map".split())
ASIDE = frozenset("nav footer aside button select textarea input dialog menu label".split())
#: Left out unless they wrap the text of the page.
DOUBTFUL = frozenset("form fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words that say a part is not the article, as a class or id of their own or, doubtfully, as a piece of one.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu "
    "menus breadcrumb breadcrumbs sidebar aside widget widgets footer footnav masthead topbar cookie cookies consent gdpr notice notices "
    "alert popup modal overlay subscribe subscription newsletter signup login search form share sharing social related recommended "
    "pagination pager toolbar comment comments reply replies respond disqus discussion copyright legal disclaimer skip hidden".split()
)
#: What an article is made of.
PLAIN = frozenset("h1 h2 h3 h4 h5 h6 p ul ol dl pre blockquote table figure".split())
#: These belong to the article even where a class word above names them.
ROOTS = frozenset("html body main article h1".split())
#: A start tag of the first kind ends an open element of the second.
CLOSED_BY = {
    **{t: ("p",) for t in BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option"}},
    "li": ("p", "li"), "dt": ("p", "dt", "dd"), "dd": ("p", "dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
}
#: An implied end does not reach over these.
SCOPES = frozenset("html body table ul ol dl article section div main aside nav header footer form blockquote td th".split())
MARK = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: What a part is: text, doubtful, aside, or none of the page's text.
TEXT, DOUBT, OUT, NEVER = range(4)
#: A doubtful part is a wrapper if all text outside such parts is less than this share of its own, and its own not
#: tiny, or under a heading.
ELSEWHERE, TINY = 0.25, 200


class Page(HTMLParser):
    """A page's nodes in the order they start: tag, parent, what kind of part, and the texts in between.

    ``left_out`` tells, once the page is read, which nodes hold no text of the article.
    """

    def __init__(self, html: str = ""):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.kinds, self.unseen, self.texts = ["#"], [-1], [TEXT], [False], []
        self.open, self.held = [0], Counter()
        self.feed(html)
        self.close()
        self.left_out = self._judged()

    def _kind(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag in UNSEEN:
            return NEVER
        if tag in ASIDE or (tag == "header" and not self.held["article"] and not self.held["main"]):
            return OUT
        found = DOUBT if tag in DOUBTFUL else TEXT
        if tag in ROOTS or not attrs:
            return found
        given = dict(attrs)
        if "hidden" in given or given.get("aria-hidden") == "true" or HIDDEN.search(given.get("style") or ""):
            return NEVER
        if (given.get("role") or "").lower() in ASIDE_ROLES:
            return OUT
        names = f"{given.get('class') or ''} {given.get('id') or ''}"
        if not ASIDE_WORDS.isdisjoint(names.lower().split()):
            return OUT
        if not ASIDE_WORDS.isdisjoint(MARK.split(HUMP.sub(" ", names).lower())):
            return DOUBT
        return found

    def _end(self, depth: int) -> None:
        """The open elements from this depth on are closed."""
        self.held.subtract(self.tags[i] for i in self.open[depth:])
        del self.open[depth:]

    def _close(self, tags: tuple[str, ...]) -> None:
        while any(self.held[t] > 0 for t in tags):
            for depth in range(len(self.open) - 1, 0, -1):
                tag = self.tags[self.open[depth]]
                if tag in tags:
                    self._end(depth)
                    break
                if tag in SCOPES:
                    return
            else:
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSED_BY:
            self._close(CLOSED_BY[tag])
        parent = self.open[-1]
        kind = self._kind(tag, attrs)
        self.tags.append(tag)
        self.parents.append(parent)
        self.kinds.append(kind)
        self.unseen.append(self.unseen[parent] or kind == NEVER)
        if tag not in VOID:
            self.open.append(len(self.tags) - 1)
            self.held[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "g", "circle", "rect", "use", "math"):
            self._end(len(self.open) - 1)

    def handle_endtag(self, tag):
        if self.held[tag] <= 0:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[depth]] == tag:
                self._end(depth)
                return

    def handle_data(self, data):
        node = self.open[-1]
        if not self.unseen[node]:
            self.texts.append((len(self.tags) - 1, node, data))

    def parse_comment(self, i, report=True):
        return self.parse_html_declaration(i)

    def parse_html_declaration(self, i):
        """A comment, or all up to the next ``>``; what is not closed reaches to the end. Nothing of it is text."""
        text = self.rawdata
        if text.startswith("<!--", i):
            if text.startswith((">", "->"), i + 4):
                return text.index(">", i + 4) + 1
            ends = [text.find(mark, i + 4) + len(mark) for mark in ("-->", "--!>") if text.find(mark, i + 4) >= 0]
            return min(ends, default=len(text))
        start = i + 2
        if text[i + 2 : i + 9].lower() == "doctype" or text.startswith("[CDATA[", i + 2):
            # a subset or section of its own stands in brackets
            first, inner = text.find(">", start), text.find("[", start)
            if 0 <= inner < first and (end := text.find("]", inner)) >= 0:
                start = end
        return text.find(">", start) + 1 or len(text)

    def _judged(self) -> list[bool]:
        n = len(self.tags)
        own = [0] * n
        for _, node, text in self.texts:
            own[node] += len("".join(text.split()))
        headed = [tag in ("article", "main", "h1") for tag in self.tags]
        for i in range(n - 1, 0, -1):
            headed[self.parents[i]] |= headed[i] and self.kinds[i] <= DOUBT
        while True:
            left = [False] * n
            for i in range(1, n):
                left[i] = left[self.parents[i]] or self.kinds[i] != TEXT
            outside = sum(c for c, gone in zip(own, left) if not gone)
            inside = list(own)  # with what doubtful parts hold
            for i in range(n - 1, 0, -1):
                if self.kinds[i] <= DOUBT:
                    inside[self.parents[i]] += inside[i]
            doubtful = [i for i in range(1, n) if self.kinds[i] == DOUBT and not left[self.parents[i]]]
            wrapper = max(doubtful, key=lambda i: inside[i], default=0)
            if not wrapper or outside >= ELSEWHERE * inside[wrapper] or (inside[wrapper] < TINY and not headed[wrapper]):
                return left
            # one of a chain of wrappers goes at a time; all that hold nothing else go together
            while wrapper:
                self.kinds[wrapper] = TEXT
                below = [i for i in range(wrapper + 1, n) if self.kinds[i] == DOUBT and self.parents[i] == wrapper and inside[i] == inside[wrapper]]
                wrapper = below[0] if below else 0


def densities(page: Page) -> tuple[list[float], list[float], list[int]]:
    """Of each node: its composite density, the sum of its children's, and its characters in links."""
    n = len(page.tags)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[page.parents[i]] or page.tags[i] == "a"
    for _, node, text in page.texts:
        if page.left_out[node]:
            continue
        size = len("".join(text.split()))
        chars[node] += size
        links[node] += size * linked[node]
    for i in range(n - 1, 0, -1):
        if page.left_out[i]:
            continue
        up = page.parents[i]
        chars[up] += chars[i]
        links[up] += links[i]
        tags[up] += tags[i] + 1
        link_tags[up] += link_tags[i] + (page.tags[i] == "a")
    share = links[0] / chars[0] if chars[0] else 0.0
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):
        if chars[i] and not page.left_out[i]:
            c, lc, t, lt = chars[i], links[i], max(tags[i], 1), max(link_tags[i], 1)
            base = math.log(math.e + c * lc / max(c - lc, 1) + share * c)
            density[i] = c / t * max(0.0, math.log(c * t / (max(lc, 1) * lt) + 1e-9)) / base
        total[page.parents[i]] += density[i]
    return density, total, links


def main_nodes(page: Page) -> set[int]:
    """The roots of the subtrees that hold the main text."""
    density, total, links = densities(page)
    n = len(page.tags)
    best = max(range(n), key=lambda i: (total[i], -i)) if n else 0
    path = []
    node = best
    while node > 0:
        path.append(node)
        node = page.parents[node]
    limit = min((density[i] for i in path if page.tags[i] not in ("html", "body")), default=0.0)
    found = {best}
    inside = set(path)
    for i in range(1, n):
        if page.parents[i] in inside and page.parents[i] != best and i not in inside and not page.left_out[i]:
            # a short paragraph between dense ones is as thin as a menu, but has no links
            if density[i] >= limit or (page.tags[i] in PLAIN and not links[i]):
                found.add(i)
    return found


def text_of(html: str | None) -> str:
    """The main text: a line for each block, in page order."""
    if not html:
        return ""
    page = Page(html)
    if not any(text for _, node, text in page.texts if not page.left_out[node]):
        return ""
    roots = main_nodes(page)
    n = len(page.tags)
    taken, block = [False] * n, [0] * n
    for i in range(n):
        up = page.parents[i]
        taken[i] = i in roots or (up >= 0 and taken[up])
        block[i] = i if page.tags[i] in BLOCKS or up < 0 else block[up]
    lines: list[list[str]] = []
    last: tuple[int, int] | None = None
    edges = [0] * (n + 1)  # blocks started before each node
    for i in range(n):
        edges[i + 1] = edges[i] + (page.tags[i] in BLOCKS)
    seen = 0
    for upto, node, text in page.texts:
        if taken[node] and not page.left_out[node]:
            # a new line where the block differs or another block came in between
            here = (block[node], edges[upto + 1])
            if last is None or here != last:
                lines.append([])
            elif any(page.tags[i] == "br" for i in range(seen + 1, upto + 1)):
                lines[-1].append(" ")
            lines[-1].append(text)
            last = here
        seen = upto
    return "\n".join(x for x in (" ".join("".join(parts).split()) for parts in lines) if x)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id``, ``url``, ``text`` and ``n_chars`` of every row; a null, empty or textless page has an empty text.

    Each page is a row's own work and is read whole; unclosed and wrongly nested tags are mended as browsers do
    for paragraphs, list items and table cells. Rows that repeat are extracted again.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(extract, "id long, url string, text string, n_chars long")
