"""Main text of web pages by wrapper induction.

Pages become trees of elements. The pages of a host are aligned with one of them, the page of least
hash among those of at least the median length of the host's distinct pages that are not empty, by
simple tree matching: the largest order-preserving mapping between the trees in which
parents map to parents and elements agree in name and class. Over all pages of the host other than
copies of the reference, a block whose text is nearly always that of the reference is template (on
hosts with some distinct pages). So is a text that nearly all of the host's distinct pages with a path
of keys have in a block at this path, whether the reference has the block or not; with it blocks are
found that the reference lacks, and those of other layouts. All other text fills a slot. The slots'
text, added up the reference tree, shows the container of the content: the article or main elements of
a page, unless they hold less than half of the slot text in the induced container, else the deepest
container that holds nearly all slot text, by the page's own tree where the container of the reference
is not aligned. On hosts of two or three distinct pages, only blocks with a class or id that are equal
on all of them are template, and only if most text of the reference differs.

A page's main text are the blocks in that container, without template text and without elements
that are boilerplate by their name, class, id or role (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments). A header inside an article keeps its headings.

White space inside a block becomes one space; blocks are joined by one space. Character references
are decoded; an unfinished tag at the end of a page is dropped. Null html gives an empty text; a
null url counts as host ''. A page of its own host
has no partner: nothing is template, and its boilerplate is known by names only. Extra columns take
no part; repeated rows give a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import materialize, slices, table
from trafficlens.llm.url_rules import host_of
from trafficlens.session import broadcast_if_small

CONSTANT_SHARE = 0.8
MIN_PAGES = 4
CONTAINER_SHARE = 0.9
#: On fewer pages than MIN_PAGES, template text may be at most this share of the reference; articles by name hold at least this share of a page's slots.
HALF = 0.5
KNOWN_TREES = 64
KNOWN_PATHS = 100_000
BROADCAST_BYTES = 16 << 20
#: Beyond so many cells two child lists are matched without keeping the whole table.
CELLS = 200_000

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = "script|style|noscript|template|textarea|title|svg|iframe|select|math|object"
DROPPED = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "head"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
DROPPED_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "sidebar", "menu", "nav", "navbar", "navigation", "footer", "header",
    "cookie", "cookies", "consent", "notice", "notices", "alert", "comment", "comments", "replies", "promo", "promotion", "sponsor",
    "sponsored", "share", "sharing", "social", "related", "breadcrumb", "breadcrumbs", "popup", "modal", "newsletter", "subscribe",
    "subscription", "widget", "toolbar", "pagination", "pager", "login", "signup", "skip",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
CONTAINERS = {"article", "main", "section", "div", "body", "td", "html", ""}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
#: An element that begins closes an open one of these.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
} | {t: {"p"} for t in (
    "p", "div", "ul", "ol", "dl", "table", "section", "article", "aside", "nav", "main", "header", "footer", "form", "pre", "blockquote",
    "h1", "h2", "h3", "h4", "h5", "h6", "hr", "figure", "address", "fieldset", "details")}
SCOPES = {"table", "ul", "ol", "dl", "td", "th", "div", "section", "article", "aside", "nav", "main", "header", "footer", "form", "body", "blockquote", "figure", "", "html"}

PIECE = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[/a-z][^>]*\Z|(?P<text>[^<]+|<)",
    re.S | re.I)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAME_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("children", "drop", "items", "key", "number", "parent", "role", "tag")

    def __init__(self, tag: str, parent: Node | None, key: str = "", drop: bool = False, role: str = ""):
        self.tag, self.parent, self.key, self.drop, self.role = tag, parent, key or tag, drop, role
        #: Child elements, and text and elements in their order.
        self.children: list[Node] = []
        self.items: list[Node | str] = []
        self.number = 0

    def own_text(self) -> str:
        """The text of a block with that of the inline elements in it."""
        out, open_ = [], list(reversed(self.items))
        while open_:
            x = open_.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag in INLINE and not x.drop:
                open_ += reversed(x.items)
        return " ".join("".join(out).split())

    def is_inline(self) -> bool:
        """Whether an element and all below it are inline."""
        return self.tag in INLINE and all(c.is_inline() for c in self.children)


def _element(tag: str, attrs: str, parent: Node) -> Node:
    names, role, hidden = "", "", False
    if attrs:
        for name, a, b, c in ATTRIBUTE.findall(attrs):
            value, name = (a or b or c).lower(), name.lower()
            if name == "role":
                role = value.strip()
            elif name in ("class", "id"):
                names += " " + value
            else:
                hidden = hidden or name == "hidden" or value == "true"
    words = set(NAME_WORD.findall(names))
    drop = tag in DROPPED or hidden or role in DROPPED_ROLES or bool(words & DROPPED_WORDS)
    if tag in ("article", "main", "body", "html"):
        drop = hidden
    return Node(tag, parent, tag + "." + ".".join(sorted(words)), drop, role)


def parse(html: str) -> list[Node]:
    """The elements of a page in order; the first is the root."""
    root = Node("", None)
    nodes, at = [root], root
    for m in PIECE.finditer(html):
        text = m["text"]
        if text is not None:
            at.items.append(text)
            continue
        if m["raw"]:
            at.items.append(" ")
            continue
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag, attrs = tag.lower(), m["attrs"] or m["attrs2"] or ""
        if m["end"] or m["end2"]:
            up = at
            while up is not root and up.tag != tag:
                if tag in INLINE and up.tag in SCOPES:
                    up = root
                    break
                up = up.parent
            if up is not root:
                at = up.parent
            continue
        closed = CLOSES.get(tag)
        if closed:
            up = at
            while up.tag not in SCOPES or up.tag in closed:
                if up.tag in closed:
                    at = up.parent
                    break
                up = up.parent
        if tag in VOID:
            at.items.append(" " if tag in ("br", "hr") else "")
            continue
        node = _element(tag, attrs, at)
        node.number = len(nodes)
        nodes.append(node)
        at.children.append(node)
        at.items.append(node)
        if not attrs.endswith("/"):
            at = node
    for node in nodes:
        node.items = [unescape(x) if isinstance(x, str) and "&" in x else x for x in node.items]
    return nodes


def align(page: list[Node], reference: list[Node]) -> dict[int, int]:
    """Simple tree matching: page element -> reference element."""
    # Parents map to parents, so only elements on a path of keys that both trees have can be mapped.
    known: dict[tuple[int, str], int] = {}
    there = _path_numbers(reference, known, True)
    here = _path_numbers(page, known, False)
    met = set(here)
    shapes = Shapes()
    left = shapes.of(page, [p >= 0 for p in here])
    right = shapes.of(reference, [p in met for p in there])
    shapes.match(left[0][0], right[0][0])
    mapping, open_ = {}, [(0, 0)]
    while open_:
        a, b = open_.pop()
        mapping[a] = b
        x, y = left[a], right[b]
        pairs = zip(x[1], y[1]) if x[0] == y[0] else ((x[1][i], y[1][j]) for i, j in shapes.found[x[0], y[0]][1])
        open_ += pairs
    return mapping


def _path_numbers(nodes: list[Node], known: dict[tuple[int, str], int], grow: bool) -> list[int]:
    """A number per path of keys from the root; -1 for one that is not known."""
    numbers: list[int] = []
    for node in nodes:
        path = (numbers[node.parent.number] if node.parent else -2, node.key)
        numbers.append(known.setdefault(path, len(known)) if grow else known.get(path, -1))
    return numbers


class Shapes:
    """Trees by their keys alone: equal trees share a number, so a pair of shapes is matched once."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.keys: list[str] = []
        self.children: list[tuple[int, ...]] = []
        self.sizes: list[int] = []
        #: Of two unequal shapes with one key: the size of their matching, and the pairs of children.
        self.found: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def of(self, nodes: list[Node], kept: list[bool]) -> list[tuple[int, list[int]]]:
        """Shape and children of every kept element."""
        out: list = [None] * len(nodes)
        for node in reversed(nodes):
            if not kept[node.number]:
                continue
            inner = [c.number for c in node.children if kept[c.number]]
            children = tuple([out[c][0] for c in inner])
            number = self.numbers.setdefault((node.key, children), len(self.keys))
            if number == len(self.keys):
                self.keys.append(node.key)
                self.children.append(children)
                self.sizes.append(1 + sum(self.sizes[c] for c in children))
            out[node.number] = number, inner
        return out

    def gain(self, a: int, b: int) -> int:
        if a == b:
            return self.sizes[a]
        return self.found[a, b][0] if self.keys[a] == self.keys[b] else 0

    def match(self, a: int, b: int) -> None:
        # Depth-first without recursion: children are matched before their parents.
        open_ = [(a, b, False)]
        while open_:
            a, b, ready = open_.pop()
            if a == b or (a, b) in self.found:
                continue
            x, y = self.children[a], self.children[b]
            front, back = _equal_ends(x, y)
            if ready:
                self.found[a, b] = self._match_children(x, y, front, back)
                continue
            open_.append((a, b, True))
            by_key: dict[str, list[int]] = {}
            for d in set(y[front:len(y) - back]):
                by_key.setdefault(self.keys[d], []).append(d)
            for c in set(x[front:len(x) - back]):
                open_ += [(c, d, False) for d in by_key.get(self.keys[c], ()) if c != d and (c, d) not in self.found]

    def _match_children(self, x: tuple[int, ...], y: tuple[int, ...], front: int, back: int) -> tuple[int, list[tuple[int, int]]]:
        # Equal children at both ends belong to a largest matching; so do none without a partner's key.
        keys = self.keys
        names = {keys[d] for d in y[front:len(y) - back]}
        rows = [i for i in range(front, len(x) - back) if keys[x[i]] in names]
        names = {keys[x[i]] for i in rows}
        columns = [j for j in range(front, len(y) - back) if keys[y[j]] in names]
        pairs = [(i, i) for i in range(front)]
        if rows:
            largest = _largest if len(rows) * len(columns) <= CELLS else _largest_of_long
            pairs += [(rows[i], columns[j]) for i, j in largest([x[i] for i in rows], [y[j] for j in columns], self.gain)]
        pairs += [(len(x) - k, len(y) - k) for k in range(back, 0, -1)]
        return 1 + sum(self.gain(x[i], y[j]) for i, j in pairs), pairs


def _equal_ends(x: tuple[int, ...], y: tuple[int, ...]) -> tuple[int, int]:
    """Lengths of the equal run from the front and of the one from the back."""
    n = min(len(x), len(y))
    front = 0
    while front < n and x[front] == y[front]:
        front += 1
    back = 0
    while back < n - front and x[-1 - back] == y[-1 - back]:
        back += 1
    return front, back


def _largest(left: list[int], right: list[int], gain) -> list[tuple[int, int]]:
    """The order-preserving pairs with the largest sum of gains."""
    table, gains = [[0] * (len(right) + 1)], []
    by_shape: dict[int, list[int]] = {}
    for x in left:
        row_gains = by_shape.get(x)
        if row_gains is None:
            row_gains = by_shape[x] = [gain(x, y) for y in right]
        above, row, last = table[-1], [0], 0
        for j, g in enumerate(row_gains):
            last = max(above[j + 1], last, above[j] + g)
            row.append(last)
        table.append(row)
        gains.append(row_gains)
    pairs, i, j = [], len(left), len(right)
    while i and j:
        # From the front on equal sizes: a match is left out only if it is not needed.
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def _largest_of_long(left: list[int], right: list[int], gain) -> list[tuple[int, int]]:
    """The same for long lists: every k-th row of the table is kept, those between are made again on the way back."""
    distinct, column = np.unique(np.array(right), return_inverse=True)
    shapes = distinct.tolist()
    by_shape: dict[int, np.ndarray] = {}

    def row_after(above: np.ndarray, x: int) -> np.ndarray:
        if x not in by_shape:
            by_shape[x] = np.array([gain(x, y) for y in shapes], np.int32)
        row = np.zeros_like(above)
        np.maximum(above[1:], above[:-1] + by_shape[x][column], out=row[1:])
        return np.maximum.accumulate(row, out=row)

    step = max(1, math.isqrt(len(left)))
    row = np.zeros(len(right) + 1, np.int32)
    kept = [row]
    for i, x in enumerate(left, 1):
        row = row_after(row, x)
        if i % step == 0:
            kept.append(row)
    pairs, i, j, rows, begun = [], len(left), len(right), [], len(left) + 1
    while i and j:
        if i - 1 < begun:
            begun = (i - 1) // step * step
            rows = [kept[begun // step]]
            for x in left[begun:i]:
                rows.append(row_after(rows[-1], x))
        row, above = rows[i - begun], rows[i - begun - 1]
        if row[j] == above[j]:
            i -= 1
        elif row[j] == row[j - 1]:
            # Left to the first column of this size.
            j = int(np.searchsorted(row, row[j]))
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


class Trees(dict):
    """Parsed reference pages, remembered while they are few."""

    def __missing__(self, html: str) -> list[Node]:
        if len(self) >= KNOWN_TREES:
            self.clear()
        value = self[html] = parse(html)
        return value


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class Paths(dict):
    """Hashes of paths of keys from the root, by the hash of the parent's path and a key."""

    def __missing__(self, path: tuple[int, str]) -> int:
        if len(self) >= KNOWN_PATHS:
            self.clear()
        value = self[path] = _hash(f"{path[0]} {path[1]}")
        return value

    def of(self, nodes: list[Node]) -> list[int]:
        out: list[int] = []
        for node in nodes:
            out.append(self[out[node.parent.number] if node.parent else 0, node.key])
        return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and reference element: pages aligned, with the same text, and characters of slots.

    Rows without a node name a page's paths of blocks (text null) and the texts at them.
    """
    trees, paths, counts, same, chars, read = Trees(), Paths(), Counter(), Counter(), Counter(), set()
    for part in slices(batches, "html"):
        found: set[tuple[str, int, int | None, int]] = set()
        for host, html, reference, h in zip(*(part.column(c).to_pylist() for c in ("host", "html", "reference", "h"))):
            is_reference = html == reference
            if is_reference and host in read:
                continue
            page, known = parse(html or ""), trees[reference]
            if is_reference:
                read.add(host)
            mapping = {} if is_reference else align(page, known)
            path_of = paths.of(page)
            for node in page:
                text = "" if node.tag in INLINE else node.own_text()
                if not text:
                    continue
                dropped = _dropped(node)
                if not dropped:
                    path = path_of[node.number]
                    found.add((host, path, None, h))
                    found.add((host, path, _hash(text), h))
                if is_reference:
                    continue
                at = node
                while at.number not in mapping:
                    at = at.parent
                key = (host, mapping[at.number])
                if at is node:
                    counts[key] += 1
                    if text == known[mapping[at.number]].own_text():
                        same[key] += 1
                        continue
                if not dropped:
                    chars[key] += len(text)
        hosts, path, text, h = zip(*found) if found else ((), (), (), ())
        none = pa.nulls(len(found), pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array(hosts, pa.string()), pa.nulls(len(found), pa.int32()), *[pa.array(c, pa.int64()) for c in (path, text, h)], none, none, none], names=COUNTS)
    keys = list(counts.keys() | chars.keys())
    none = pa.nulls(len(keys), pa.int64())
    yield pa.RecordBatch.from_arrays([
        pa.array([h for h, _ in keys], pa.string()), pa.array([n for _, n in keys], pa.int32()), none, none, none,
        *[pa.array([c[k] for k in keys], pa.int64()) for c in (counts, same, chars)],
    ], names=COUNTS)


COUNTS = ["host", "node", "path", "text", "h", "pages", "same", "chars"]


def _dropped(node: Node) -> bool:
    """Whether an element stands in boilerplate by names."""
    inside_heading = False
    while node is not None:
        inside_heading = inside_heading or node.tag in HEADINGS
        if node.drop:
            return True
        if node.tag == "header":
            up, owned = node.parent, False
            while up is not None:
                owned = owned or up.tag in ("article", "main")
                up = up.parent
            if not owned or not inside_heading:
                return True
        node = node.parent
    return False


def template_of(reference: list[Node], rows: list[tuple[int, int, int, int]], n_distinct: int) -> tuple[set[int], int]:
    """Constant elements, and the container of the content, from (node, pages, same, chars)."""
    if n_distinct >= MIN_PAGES:
        constant = {n for n, pages, same, _ in rows if pages >= MIN_PAGES - 1 and same >= CONSTANT_SHARE * pages}
    else:
        # Two or three pages: named blocks equal on all of them, if most text of the reference differs.
        texts = [0 if n.tag in INLINE or _dropped(n) else len(n.own_text()) for n in reference]
        equal = {n for n, pages, same, _ in rows if same == pages >= n_distinct - 1 > 0}
        alike = sum(texts[n] for n in equal) > HALF * sum(texts)
        constant = set() if alike else {n for n in equal if reference[n].key != reference[n].tag + "."}
    chars = [0] * len(reference)
    for n, _, _, c in rows:
        chars[n] += c
    return constant, _container(reference, chars).number


def _container(nodes: list[Node], chars: list[int]) -> Node:
    """The deepest container with nearly all of the characters, given by element."""
    for node in reversed(nodes[1:]):
        chars[node.parent.number] += chars[node.number]
    at = nodes[0]
    while True:
        inner = [c for c in at.children if chars[c.number] >= CONTAINER_SHARE * max(1, chars[0]) and c.tag in CONTAINERS]
        if not inner:
            return at
        at = inner[0]


def main_text(page: list[Node], mapping: dict[int, int], constant: set[int], container: int, recurring: frozenset[int] | set[int] = frozenset()) -> str:
    """``constant``: elements of the reference, ``recurring``: elements of the page that are template."""
    articles = [n for n in page if (n.tag in ("article", "main") or n.role == "main") and not _dropped(n)]
    tops = []
    for n in articles:
        up = n.parent
        while up is not None and up not in articles:
            up = up.parent
        if up is None:
            tops.append(n)
    slots = [n.tag not in INLINE and n.number not in recurring and mapping.get(n.number) not in constant and not _dropped(n) for n in page]
    chars = [len(n.own_text()) if slot else 0 for n, slot in zip(page, slots)]
    induced = [n for n in page if mapping.get(n.number) == container]
    if not tops:
        tops = induced or [_container(page, chars)]
    elif len(mapping) > 1 and induced and _below(tops, page, chars) < HALF * _below(induced, page, chars):
        # Teasers: most of the page's slots lie in the container, outside the articles.
        tops = induced
    out: list[str] = []

    def walk(top: Node) -> None:
        open_: list = [top]
        while open_:
            x = open_.pop()
            if isinstance(x, str):
                out.append(x)
                continue
            if x is not top and (x.drop or x.tag == "header" and not _owned(x)):
                out.append(" ")
                continue
            block = x.tag not in INLINE
            fixed = block and (mapping.get(x.number) in constant or x.number in recurring)
            header = x.tag == "header"
            items: list = [] if not block else [" "]
            for item in x.items:
                if isinstance(item, str):
                    items.append("" if fixed or header else item)
                elif fixed and item.is_inline():
                    continue
                elif not header or item.tag in HEADINGS or any(c.tag in HEADINGS for c in item.children):
                    items.append(item)
            if block:
                items.append(" ")
            open_ += reversed(items)

    for top in tops:
        walk(top)
    return " ".join("".join(out).split())


def _below(tops: list[Node], page: list[Node], chars: list[int]) -> int:
    """Characters of some elements and all below them."""
    inside = [False] * len(page)
    for n in tops:
        inside[n.number] = True
    for n in page[1:]:
        inside[n.number] = inside[n.number] or inside[n.parent.number]
    return sum(c for c, i in zip(chars, inside) if i)


def _owned(node: Node) -> bool:
    up = node.parent
    while up is not None:
        if up.tag in ("article", "main"):
            return True
        up = up.parent
    return False


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trees, paths, templates = Trees(), Paths(), {}
    for part in slices(batches, "html"):
        texts = []
        for host, html, reference, n, rows, known_texts in zip(*(part.column(c).to_pylist() for c in ("host", "html", "reference", "n_distinct", "rows", "texts"))):
            page = parse(html or "")
            known = trees[reference or ""]
            if host not in templates:
                if len(templates) >= KNOWN_TREES:
                    templates.clear()
                at_paths: dict[int, set[int]] = {}
                for r in known_texts or []:
                    at_paths.setdefault(r["path"], set()).add(r["text"])
                templates[host] = *template_of(known, [(r["node"], r["pages"], r["same"], r["chars"]) for r in rows or []], n), at_paths
            constant, container, at_paths = templates[host]
            path_of = paths.of(page) if at_paths else []
            recurring = {n for n, p in enumerate(path_of) if p in at_paths and page[n].tag not in INLINE and _hash(page[n].own_text()) in at_paths[p]}
            texts.append(main_text(page, align(page, known), constant, container, recurring))
        yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("url"), F.coalesce(host_of(url), F.lit("")).alias("host"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("h", F.xxhash64("html"))
    length = F.octet_length("html")
    distinct = rows.select("host", "h", length.alias("length")).distinct().groupBy("host").agg(
        F.count("*").alias("n_distinct"), F.percentile_approx(F.when(F.col("length") > 0, F.col("length")), 0.5).alias("usual"))
    distinct = broadcast_if_small(materialize(distinct, "page-hosts"))
    # An empty or stub page shows no template, so the shorter half of a host's pages is no reference.
    fit = rows.join(distinct, "host").where(length >= F.coalesce("usual", F.lit(0)))
    references = fit.groupBy("host").agg(F.min(F.struct("h", "html")).alias("least"))
    references = materialize(references.select("host", F.col("least.html").alias("reference")).join(distinct.drop("usual"), "host"), "page-references")
    bytes_ = references.agg(F.sum(F.octet_length("reference") + F.octet_length("host")).alias("b")).first()["b"] or 0

    def with_host(pages: DataFrame, known: DataFrame) -> DataFrame:
        # Reference pages up to a measured size go to all tasks, beyond it pages are shuffled to them.
        return pages.join(F.broadcast(known) if bytes_ <= BROADCAST_BYTES else known, "host", "left")

    counted = with_host(rows.select("host", "html", "h"), references).select("host", "html", "reference", "h").mapInArrow(
        _statistics, "host string, node int, path long, text long, h long, pages long, same long, chars long")
    # Copies of a page are one page for the texts at paths.
    sums = [F.sum(c).alias(c) for c in ("pages", "same", "chars")]
    counted = counted.groupBy("host", "node", "path", "text", "h").agg(*sums).groupBy("host", "node", "path", "text").agg(F.count("*").alias("on"), *sums)
    counted = materialize(counted.where(F.col("node").isNotNull() | (F.col("on") >= MIN_PAGES)), "page-counts")
    templates = counted.where("node IS NOT NULL").groupBy("host").agg(F.collect_list(F.struct("node", "pages", "same", "chars")).alias("rows"))
    at_path = counted.where("node IS NULL AND text IS NULL").select("host", "path", F.col("on").alias("of"))
    texts = counted.where("text IS NOT NULL").join(at_path, ["host", "path"]).where(F.col("on") - 1 >= CONSTANT_SHARE * (F.col("of") - 1))
    texts = texts.groupBy("host").agg(F.collect_list(F.struct("path", "text")).alias("texts"))
    # A host's template has at most one row per element of its reference page, and few texts per path.
    wrapped = materialize(references.join(templates, "host", "left").join(texts, "host", "left"), "page-templates")
    found = with_host(rows, wrapped).select("page_id", "url", "host", "html", "reference", "n_distinct", "rows", "texts")
    found = found.mapInArrow(_extract, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_html_extraction(spark, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, folder, "pages"))
