"""Main text of web pages by composite text density.

A page is parsed into a tree (unclosed and implied end tags included). Every node gets the characters C and tags T
below it, those inside links (LC, LT), and its composite text density: characters per tag, times a logarithm that
falls with the share of links, where zero counts are taken as one:

    C / T * log(C / LC * T / LT) / log(ln(C / (C - LC) * LC + LC_body / C_body * C + e))

A node's density sum is the sum over its children. The lowest density on the path from the body to the node with the
largest sum is the threshold. From the body down, each node that reaches the threshold marks the node with the largest
sum in its subtree, until it lies in a marked one itself; so the main text can be several subtrees, taken in page order.
If the node with the largest sum lies inside an ``article`` or ``main``, the page says itself where its main text is:
those tags that hold a marked node are taken as a whole, so headings are not lost, and marks outside of them are not.

Left out beforehand: scripts, styles, the head, menus, page headers, footers, asides, forms, elements with the attribute
``hidden``, and elements whose class, id or role says they are navigation, advert, notice, comment or the like, unless
they hold the article. An ``article`` in an aside, in another ``article`` or ``main``, or with the name of a comment
does not say where the main text is; the last kind is left out with the other comments. A class or id
says so if all words of one of its names are of that kind or say nothing but the place (``cookie-notice``,
``sidebar-left``, but not ``has-sidebar``). On pages without ``article`` and ``main``, class, id and role don't remove an
element with more than half of the page's characters outside of links.

Text: character references are decoded, white space in a block becomes one space, blocks are joined by a newline in
page order; nothing else is dropped. ``br`` is white space. Null and empty pages, and pages without text, give ''.
A page without a body is taken as a whole. Rows stand for themselves.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The names that HTML gives these kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "body": ("head",),
}
SCOPE = frozenset("ul ol table dl article section div main body aside nav header footer form blockquote".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul figure".split()
)
NOISE_TAGS = frozenset(
    "script style head noscript template nav footer aside form button select textarea input iframe svg canvas dialog "
    "menu object embed audio video map noembed noframes".split()
)
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar widget "
    "menu nav navbar navigation breadcrumb breadcrumbs footer masthead share sharing social related recommended "
    "newsletter subscribe subscription signup popup modal overlay cookie cookies consent gdpr notice alert toolbar "
    "pagination pager comment comments disqus respond replies login search skip".split()
)
PLACE_WORDS = frozenset(
    "container box wrapper wrap inner outer left right top bottom primary secondary area block section list bar panel "
    "unit slot site page item group links buttons posts tools articles stories icons form count".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
HOLDERS = frozenset(("article", "main"))
NAME = re.compile(r"[a-z]+")
# Where a comment, a declaration or a tag begins.
START = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


class TagEnds:
    """The end of a tag from any place in it: the first > outside of quotes, or the first one if a quote stays open.

    Found for all places at once, from the end of the page to its beginning, so broken pages take no longer.
    """

    def __init__(self, source: str):
        self.places = [m.start() for m in SPECIAL.finditer(source)]
        count = len(self.places)
        self.outside, self.first = [-1] * (count + 1), [-1] * (count + 1)
        nearest = {}
        for k in range(count - 1, -1, -1):
            at = self.places[k]
            mark = source[at]
            self.first[k] = at if mark == ">" else self.first[k + 1]
            if mark == ">":
                self.outside[k] = at
            elif mark in nearest:
                self.outside[k] = self.outside[nearest[mark] + 1]
            nearest[mark] = k

    def after(self, at: int) -> int:
        """The place of the > that ends the tag, or -1."""
        k = bisect_left(self.places, at)
        return self.outside[k] if self.outside[k] >= 0 else self.first[k]


@dataclass
class Page:
    """Nodes in page order, so parents come before children; texts by the node that holds them."""

    tag: list[str] = field(default_factory=lambda: ["html"])
    parent: list[int] = field(default_factory=lambda: [-1])
    attributes: list[dict[str, str]] = field(default_factory=lambda: [{}])
    pieces: list[tuple[int, str]] = field(default_factory=list)  # (node, text), and (node, '') where it begins or ends


def parse(source: str) -> Page:
    page, open_nodes, at, ends_at = Page(), [0], 0, TagEnds(source)
    # How many elements of each name are open, so that an end tag without any is passed over at once.
    opened = Counter()

    def text(a: int, b: int) -> None:
        if b > a:
            page.pieces.append((open_nodes[-1], html.unescape(source[a:b])))

    def close(k: int) -> None:
        for node in reversed(open_nodes[k:]):
            page.pieces.append((node, ""))
            opened[page.tag[node]] -= 1
        del open_nodes[k:]

    while True:
        m = START.search(source, at)
        if m is None:
            text(at, len(source))
            break
        if m[0] == "<!--":
            end = source.find("-->", m.end())
            text(at, m.start())
            at = end + 3 if end >= 0 else len(source)
            continue
        end = ends_at.after(m.end()) if m[2] else source.find(">", m.end())
        if end < 0:
            # A tag that does not end is text, a declaration is not.
            text(at, len(source) if m[2] else m.start())
            break
        text(at, m.start())
        at = end + 1
        if m[2] is None:
            continue
        name, written = m[2].lower(), source[m.end() : end]
        if m[1]:
            if opened[name]:
                k = len(open_nodes) - 1
                while page.tag[open_nodes[k]] != name:
                    k -= 1
                close(k)
            continue
        if name in ("html",):
            continue
        ends = CLOSES.get(name, ())
        # Elements that this one may end; the way up is over with the last of them.
        left = sum(opened[tag] for tag in ends) + (opened["p"] if name in CLOSES_P else 0)
        if left:
            k, lowest = len(open_nodes) - 1, None
            while k > 0 and left:
                tag = page.tag[open_nodes[k]]
                if tag in ends or (tag == "p" and name in CLOSES_P):
                    lowest, left = k, left - 1
                elif tag in SCOPE:
                    break
                k -= 1
            if lowest is not None:
                close(lowest)
        node = len(page.tag)
        page.tag.append(name)
        page.parent.append(open_nodes[-1])
        page.attributes.append({k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(written)} if written else {})
        page.pieces.append((node, ""))
        if name in VOID or written.endswith("/") and name not in ("p", "div", "a", "b", "span"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        open_nodes.append(node)
        opened[name] += 1
    return page


def _has_noise_name(page: Page, node: int) -> bool:
    attributes = page.attributes[node]
    if NOISE_ROLES.intersection(NAME.findall(attributes.get("role", ""))):
        return True
    for name in [*attributes.get("class", "").split(), *attributes.get("id", "").split()]:
        parts = NAME.findall(name)
        if NOISE_WORDS.intersection(parts) and all(x in NOISE_WORDS or x in PLACE_WORDS for x in parts):
            return True
    return False


def _holders(page: Page) -> list[bool]:
    """The ``article`` and ``main`` tags by which a page says where its main text is.

    Not those inside of an aside, a menu, a footer or the like, inside of another one, or with the name of comments.
    """
    n = len(page.tag)
    holder, beside = [False] * n, [False] * n
    within = [False] * n
    for v in range(1, n):
        p, tag = page.parent[v], page.tag[v]
        beside[v] = beside[p] or tag in NOISE_TAGS
        within[v] = within[p] or holder[p]
        holder[v] = tag in HOLDERS and not beside[v] and not within[v] and not _has_noise_name(page, v)
    # What stands beside an aside's article is no holder; a main may hold articles, which are part of it.
    return holder


def _is_noise(page: Page, node: int, holds: list[bool], inside: list[bool], holder: list[bool]) -> bool:
    tag = page.tag[node]
    if tag in ("html", "body") or holder[node]:
        return False
    if tag in NOISE_TAGS or (tag == "header" and not inside[node]):
        return not (holds[node] and tag not in ("head", "script", "style"))
    return not holds[node] and "hidden" in page.attributes[node]


def _is_named_noise(page: Page, node: int, holds: list[bool], holder: list[bool]) -> bool:
    if page.tag[node] in ("html", "body") or holder[node] or holds[node] or not page.attributes[node]:
        return False
    return _has_noise_name(page, node)


def density(c: int, t: int, lc: int, lt: int, body_links: float) -> float:
    if c == 0:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + body_links * c + math.e)
    share = max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1.0)
    # Without links the base of the logarithm would be 1.
    return c / max(t, 1) * math.log(share) / math.log(max(base, 1.1))


def main_text(source: str | None) -> str:
    if not source:
        return ""
    page = parse(source)
    n = len(page.tag)
    holder_tag = _holders(page)
    holds, inside, link = [False] * n, [False] * n, [False] * n
    for v in range(n - 1, 0, -1):
        if holder_tag[v] or holds[v]:
            holds[page.parent[v]] = True
    for v in range(1, n):
        inside[v] = inside[page.parent[v]] or holder_tag[page.parent[v]]
        link[v] = link[page.parent[v]] or page.tag[v] == "a"
    gone = [False] * n
    for v in range(1, n):
        gone[v] = gone[page.parent[v]] or _is_noise(page, v, holds, inside, holder_tag)
    plain = [0] * n
    for v, text in page.pieces:
        if text and not gone[v] and not link[v]:
            plain[v] += len("".join(text.split()))
    for v in range(n - 1, 0, -1):
        plain[page.parent[v]] += plain[v]
    for v in range(1, n):
        most = not holds[0] and 2 * plain[v] > plain[0]
        gone[v] = gone[v] or gone[page.parent[v]] or not most and _is_named_noise(page, v, holds, holder_tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for v, text in page.pieces:
        if text and not gone[v]:
            size = len("".join(text.split()))
            chars[v] += size
            link_chars[v] += size if link[v] else 0
    for v in range(n - 1, 0, -1):
        if not gone[v]:
            p = page.parent[v]
            chars[p] += chars[v]
            link_chars[p] += link_chars[v]
            tags[p] += tags[v] + 1
            link_tags[p] += link_tags[v] + link[v]
    body = next((v for v in range(n) if page.tag[v] == "body"), 0)
    body_links = link_chars[body] / max(chars[body], 1)
    value = [density(chars[v], tags[v], link_chars[v], link_tags[v], body_links) for v in range(n)]
    total = [0.0] * n
    for v in range(1, n):
        if not gone[v]:
            total[page.parent[v]] += value[v]
    below = [False] * n
    below[body] = True
    for v in range(body + 1, n):
        below[v] = below[page.parent[v]] and not gone[v]
    best = max((v for v in range(n) if below[v]), key=lambda v: (total[v], -v))
    path, v = [], best
    while v != -1 and v != body:
        path.append(v)
        v = page.parent[v]
    threshold = min((value[v] for v in [*path, body]), default=0.0)
    largest = list(range(n))
    for v in range(n - 1, body, -1):
        if below[v]:
            p = page.parent[v]
            largest[p] = max(largest[p], largest[v], key=lambda x: (total[x], -x))
    marked, covered, open_ = [False] * n, [False] * n, [False] * n
    for v in range(body, n):
        if below[v]:
            covered[v] = marked[v] or v != body and covered[page.parent[v]]
            open_[v] = value[v] >= threshold and not covered[v] and (v == body or open_[page.parent[v]])
            if open_[v]:
                marked[largest[v]] = True
                covered[v] = marked[v]
    holder = [-1] * n
    for v in range(1, n):
        holder[v] = v if holder_tag[v] else holder[page.parent[v]]
    tops = [v for v in range(n) if marked[v]]
    if holder[best] != -1:
        tops = [holder[v] for v in tops if holder[v] != -1]
    taken = [False] * n
    for v in tops:
        taken[v] = True
    for v in range(1, n):
        taken[v] = (taken[v] or taken[page.parent[v]]) and not gone[v]
    blocks, line = [], []
    for v, text in page.pieces:
        if not taken[v]:
            continue
        if text:
            line.append(text)
        elif page.tag[v] == "br":
            line.append(" ")
        elif page.tag[v] not in INLINE:
            blocks.append("".join(line))
            line = []
    blocks.append("".join(line))
    return "\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [main_text(x) for x in part.column("html").to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), sizes],
                    ["page_id", "url", "text", "n_chars"],
                )

    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
