"""Main text of web pages by composite text density.

For every node of a page's tree, C is the number of characters below it, T the number of tags, LC and LT the same for
links alone, and c, lc are C and LC of the body. The density of a node is

    C / T * log(C * T / (LC * LT)) to the base of ln(C / (C - LC) * LC + lc / c * C + e)

with 1 for a count of zero. Sums of the children's densities point to the subtree with the main text: the largest sum
wins. The smallest density on the way from the body to that node is the threshold; every node that reaches it gives its
own subtree with the largest sum. A chosen node inside an ``article`` or ``main`` element stands for that element. The
subtree with the largest sum is always kept. If it lies in such an element, only such elements are; if it holds some with
most of its text and nothing else in it reaches the threshold, they stand for it.

Parts that are never main text go before: scripts, styles, menus, page headers and footers, sidebars, forms, hidden
parts, and parts whose class, id or role names a notice, advert, menu or reader comments. Only whole words of a class or id
count, or joined ones that all are such names. An element so named stays, as a wrapper, if it holds the largest ``article``
or ``main``; so does one, unless named for comments, with more text than these that holds the subtree with the largest sum
or most of the text. If no text is left otherwise, class and id do not count.

Character references are decoded. White space in a block becomes one space, blocks are joined by a line feed in page
order. A NULL, empty or text-free page has empty text. Rows do not influence each other, so repeated pages have
repeated results; other columns are ignored. Pages without end tags, or cut off anywhere, are read as far as they go.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body caption dd dt html legend li optgroup option summary tbody td tfoot th thead title tr".split())
# An element of the first name ends an open one of the others, inside the innermost element of the last names.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
}
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form head iframe input map math menu nav noscript object "
    "script select style svg template textarea title video".split()
)
COMMENTS = r"(?:comments?|commentlist|disqus|replies|respond)"
NAME = (
    r"(?:ads?|advert[a-z0-9]*|adbox|adslot|banner|breadcrumbs?|byline-share|captcha|consent|cookies?|"
    r"footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|overlay|pagination|paywall|"
    r"popup|promo[a-z0-9]*|related|share|sharing|sidebar|skip|social|sponsor[a-z0-9]*|subscribe|toolbar|widgets?)"
)
PART = rf"(?:{NAME}|{COMMENTS}|\d+)"
# A whole word of a class or id; the group is there if it names comments.
NAMED = re.compile(rf"(?:^|(?<=\s))(?=\S*[a-z])(?:(?=\S*?{COMMENTS}(?![a-z0-9]))(?P<comments>)|){PART}(?:[_-]{PART})*(?=$|\s)", re.IGNORECASE)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
MAIN = frozenset(("article", "main"))


class _Tree(HTMLParser):
    """Nodes as parallel lists; a child always has a larger number than its parent. Node 0 is the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.dropped = ["#page"], [-1], [False]
        # Names of unwanted parts, for each node: none, one, or one of comments.
        self.named = [0]
        self.open = [0]
        # Texts in page order with their nodes; None ends a block.
        self.texts: list[tuple[int, str | None]] = []

    def _end(self, names: tuple[str, ...], walls: frozenset[str] | tuple[str, ...] = ()) -> None:
        """Close the innermost open element of these names, if no wall is nearer."""
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[i]]
            if tag in names:
                self._break()
                del self.open[i:]
                return
            if tag in walls:
                return

    def _break(self) -> None:
        self.texts.append((self.open[-1], None))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and tag in self.tag:
            return
        if tag in CLOSES_P:
            self._end(("p",), ("button", "td", "th", "caption", "table", "object"))
        if tag in IMPLIED:
            self._end(*IMPLIED[tag])
        if tag == "br":
            self.texts.append((self.open[-1], " "))
        if tag in BLOCKS:
            self._break()
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.dropped.append(self._unwanted(tag, attrs))
        self.named.append(0 if tag in MAIN or tag in ("html", "body") else self._names(attrs))
        if tag not in VOID:
            self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body") or tag in VOID:
            return
        if tag in BLOCKS:
            self._break()
            self._end((tag,))
        else:
            self._end_inline(tag)

    def _end_inline(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[i]] == tag:
                del self.open[i:]
                return
            if self.tag[self.open[i]] in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        self.texts.append((self.open[-1], data))

    def _unwanted(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        inside = any(self.tag[i] in MAIN for i in self.open)
        if tag in DROPPED or (tag == "header" and not inside):
            return True
        if tag in ("html", "body"):
            return False
        for name, value in attrs:
            value = value or ""
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                return True
            if name == "role" and value.lower() in ROLES:
                return True
            if name == "class" and tag in MAIN and re.search(r"(?:^|[\s_-])comment", value, re.IGNORECASE):
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                return True
        return False


    def _names(self, attrs: list[tuple[str, str | None]]) -> int:
        found = [m for name, value in attrs if name in ("class", "id") for m in NAMED.finditer(value or "")]
        return 2 if any(m["comments"] is not None for m in found) else int(bool(found))


def _density(c: int, t: int, lc: int, lt: int, body_c: int, body_lc: int) -> float:
    """Composite density of a node; a node that is all links has none."""
    if c == 0:
        return 0.0
    t, linked, link_tags = t or 1, lc or 1, lt or 1
    base = math.log(c / ((c - lc) or 1) * lc + body_lc / (body_c or 1) * c + math.e)
    score = math.log(max(c * t / (linked * link_tags), 1.0))
    return c / t * score / math.log(base) if base > 1 else c / t * score


def _measured(tree: _Tree, gone: list[bool]) -> tuple[list[int], list[float], list[int], int]:
    """Characters and density of each node, the node of its subtree with the largest sum, and the body."""
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = tree.tag[i] == "a" or in_link[tree.parent[i]]
    for node, text in tree.texts:
        if text is not None and not gone[node]:
            size = len(text) - text.count(" ") - text.count("\n")
            chars[node] += size
            link_chars[node] += size if in_link[node] else 0
    kept = [i for i in range(n) if not gone[i]]
    for i in reversed(kept[1:]):
        up = tree.parent[i]
        chars[up] += chars[i]
        tags[up] += tags[i] + 1
        link_chars[up] += link_chars[i]
        link_tags[up] += link_tags[i] + (tree.tag[i] == "a")
    body = next((i for i in kept if tree.tag[i] == "body"), 0)
    density = [0.0] * n
    for i in kept:
        density[i] = _density(chars[i], tags[i], link_chars[i], link_tags[i], chars[body], link_chars[body])
    sums, has_child = [0.0] * n, [False] * n
    for i in kept[1:]:
        sums[tree.parent[i]] += density[i]
        has_child[tree.parent[i]] = True
    sums = [s if child else d for s, d, child in zip(sums, density, has_child)]
    below = list(range(n))  # of each subtree the node with the largest sum
    for i in reversed(kept[1:]):
        up = tree.parent[i]
        if sums[below[i]] > sums[below[up]]:
            below[up] = below[i]
    return chars, density, below, body


def _below(tree: _Tree, dropped: list[bool]) -> list[bool]:
    """Which nodes lie in dropped ones."""
    gone = [False] * len(tree.tag)
    for i in range(1, len(gone)):
        gone[i] = dropped[i] or gone[tree.parent[i]]
    return gone


def _way(tree: _Tree, i: int) -> set[int]:
    """A node and all that hold it."""
    way = set()
    while i >= 0:
        way.add(i)
        i = tree.parent[i]
    return way


def _without_named(tree: _Tree, gone: list[bool]) -> list[bool]:
    """``gone`` with the elements named as unwanted, except those that wrap the main text."""
    named = [i for i in range(1, len(gone)) if tree.named[i] and not gone[i]]
    if not named:
        return gone
    chars, _, below, body = _measured(tree, gone)
    largest = max((i for i in range(len(gone)) if tree.tag[i] in MAIN and not gone[i]), key=chars.__getitem__, default=0)
    best, wraps = _way(tree, below[body]), _way(tree, largest)
    within = _below(tree, [i == largest and i > 0 for i in range(len(gone))])
    dropped = list(gone)
    for i in named:
        most = i in best or 2 * chars[i] > chars[body]
        rival = (chars[largest] if largest else 0) // (2 if within[i] else 1)
        dropped[i] = not (i in wraps and chars[largest] or tree.named[i] == 1 and most and chars[i] > rival)
    return _below(tree, dropped)


def _chosen(tree: _Tree, gone: list[bool]) -> set[int]:
    """The nodes whose subtrees hold the main text."""
    n = len(tree.tag)
    kept = [i for i in range(n) if not gone[i]]
    chars, density, below, body = _measured(tree, gone)
    best = below[body]
    if not chars[best]:
        return set()
    threshold, i = density[best], best
    while i != body and i > 0:
        i = tree.parent[i]
        threshold = min(threshold, density[i])
    inside_body = [i for i in kept if i >= body]
    found = {below[i] for i in inside_body if density[i] >= threshold and chars[below[i]]} | {best}
    def raised(i: int) -> int:
        top = i
        while i > 0:
            top = i if tree.tag[i] in MAIN else top
            i = tree.parent[i]
        return top

    tops = {raised(i) for i in found}
    mains = {i for i in tops if tree.tag[i] in MAIN}
    if raised(best) in mains:
        return mains
    inside = [False] * n
    for i in kept[1:]:
        inside[i] = tree.parent[i] == best or inside[tree.parent[i]]
    held = {i for i in mains if inside[i]}
    if 2 * sum(chars[i] for i in held) > chars[best] and all(i in held or not inside[i] for i in tops):
        return tops - {best}
    return tops


def main_text(html: str | None) -> str:
    """The main text of a page."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    always = _below(tree, tree.dropped)
    gone = _without_named(tree, always)
    chosen = _chosen(tree, gone)
    if not chosen and gone != always:
        gone, chosen = always, _chosen(tree, always)
    inside = [i in chosen for i in range(len(tree.tag))]
    for i in range(1, len(tree.tag)):
        inside[i] = (inside[i] or inside[tree.parent[i]]) and not gone[i]
    blocks: list[list[str]] = [[]]
    for node, text in tree.texts:
        if text is None:
            blocks.append([])
        elif inside[node]:
            blocks[-1].append(text)
    lines = (" ".join("".join(block).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            texts = [main_text(html) for html in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(_pages, "page_id long, url string, text string, n_chars long")
