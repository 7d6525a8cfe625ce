"""Main-text extraction from HTML by wrapper induction.

Every page is parsed into a tree of blocks and aligned, whole and once, with the
first page of its host by simple tree matching. For each node of the first page
the aligned pages then tell two things. A text that nearly all of them have
alike is constant, else it varies. An element whose shape (labels and order
below it) nearly all of them have alike is fixed, as menus, adverts and footers
are whose texts differ from page to page, else its shape varies, as an article's
does. The host's region is found from the root downwards: of the elements that
vary in shape the longest, as long as it holds half of the text. On a page with
the region, texts outside it are template (but for a varying ``h1``). Blocks of
constant texts are template, blocks with a varying text are content.

Names and marks break the ties that this leaves. Parts that their tag, role,
class or id names as menu, header, footer, sidebar, notice, advert, form,
comment and the like are never content nor the region: by the first or last
word of a whole class name, so not by ``with-sidebar``, ``has-comments`` or
``entry-header``. A part that is cut by a name of a layout (a form, a sidebar, a
header) stays if all marked text of the page is in marks below it. The mark of
an article (``article``, ``main`` or the like) widens the region to the mark
around it, and a region beside all marks is none. Texts that the slots leave
open (without a partner, or at a node that too few different pages have) are
content inside the page's strongest mark, and everywhere on a page without one;
texts outside all marks of a marked page (its author or date, say) are not
content; and if the template leaves nothing of a marked article, as among pages
that differ in a date only, the article is kept. ``names=False`` leaves names
and marks out, to measure what the alignment finds alone.

Each page is aligned in one row of work; the hosts' compact first trees are
broadcast below a measured size, else joined by a join that AQE can split for a
large host, and the statistics of a node are summed map-side.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined in page order by one space.

Defined results: a null, empty or text-less html has the empty text, bad
declarations are skipped and nesting may have any depth; a page
without ``://`` in its url, or with a null url, belongs to the host ``""``; on a
host with fewer than ``MIN_PAGES`` different trees nothing is template; rows
repeat with equal results, as copies of a tree count once; the first page of a
host is the one with the smallest id (null ids last) among those with a text
outside tags, scripts and styles, ties by html; a host whose first page parses
to no text all the same has no template; other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, written
from .url_filter import host_of

MIN_PAGES = 3
#: Share of the aligned pages that must have the same text at a template node,
#: or the same shape below a fixed element.
CONSTANT = 0.8
#: Largest size of all first trees together that is broadcast with their slots.
BROADCAST_BYTES = 64 << 20
#: Cells of an alignment table above which equal shapes at the ends are paired first.
TABLE_CELLS = 4_000_000
#: Shapes and scores that a worker remembers between pages.
REMEMBERED = 200_000

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
#: Never part of a page's running text.
_UNSEEN = {"head", "script", "style", "noscript", "template", "title", "button", "select", "textarea",
           "option", "iframe", "svg", "canvas", "object"}
_CUT_TAGS = {"nav", "menu", "header", "footer", "aside", "form", "dialog"}
_CUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
              "alert", "menu", "menubar", "toolbar", "alertdialog"}
_CUT_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored",
              "promo", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert",
              "popup", "modal", "overlay", "newsletter", "subscribe", "sidebar", "menu", "nav", "navbar",
              "navigation", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "comment",
              "comments", "reply", "replies", "disqus", "related", "recommended", "share", "sharing",
              "social", "widget", "toolbar", "pagination", "pager", "login", "search", "skip"}
#: Of these, what may also name the layout around an article; the others are cut whole.
_LAYOUT_TAGS = {"form", "header"}
_LAYOUT_NAMES = {"banner", "notice", "notices", "popup", "modal", "overlay", "sidebar", "menu", "nav",
                 "navbar", "navigation", "header", "masthead", "widget", "toolbar", "search", "skip"}
_MAIN_NAMES = {"article", "articlebody", "post", "entry", "story"}
_MAIN_PARTS = {"content", "body", "text"}
#: Words after which a class name tells of a part that is elsewhere, or missing.
_ELSEWHERE = {"with", "has", "no", "not", "without", "is", "hide"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
           "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span",
           "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "link", "meta"}
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"ul", "ol", "dl", "table", "article", "main", "section", "div", "body", "blockquote", "td",
           "th", "aside", "nav", "form", "header", "footer"}
_WORD = re.compile(r"[a-z]+")
#: What a page may hold besides texts, for the choice of first pages. Every
#: opening that is not closed matches up to the end, so the time is linear.
_NO_TEXT = (r"(?is)<(head|title|script|style|noscript|template)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)"
            r"|<[^<>]*+>|&nbsp;")


@functools.lru_cache(4096)
def _cut_words(name: str) -> set[str]:
    """The words by which a whole class name or id says that its part is none of the article."""
    words = _WORD.findall(name)
    if not words or not _ELSEWHERE.isdisjoint(words) or (words[0] in _MAIN_NAMES and words[-1] == "header"):
        return set()
    return {words[0], words[-1]} & _CUT_NAMES


@functools.lru_cache(4096)
def _names_article(name: str) -> bool:
    words = _WORD.findall(name)
    return bool(words) and _ELSEWHERE.isdisjoint(words) and (
        words[-1] in _MAIN_NAMES or (words[0] in _MAIN_NAMES and words[-1] in _MAIN_PARTS))


class _Node:
    __slots__ = ("tag", "names", "children", "cut", "main")

    def __init__(self, tag: str, names: str = "", cut: int = 0, main: int = 0):
        self.tag, self.names, self.cut, self.main, self.children = tag, names, cut, main, []


class _Tree(HTMLParser):
    """A tree of the page's elements and texts. ``cut`` of a node is 1 where the
    name of a layout cuts it, 2 where it is cut whole, 3 where it is no running
    text; only the last stay empty. Without ``names`` nothing is 1 or 2, or marked."""

    def __init__(self, names: bool = True):
        super().__init__(convert_charrefs=True)
        self.by_names = names
        self.root = _Node("#root")
        self.open = [self.root]
        self.layouts = False

    def handle_starttag(self, tag, attrs):
        closes = _CLOSES.get(tag)
        if closes or tag not in _INLINE:
            ends = closes or {"p"}
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in ends:
                    del self.open[i:]
                    break
                if self.open[i].tag in _SCOPES and self.open[i].tag not in ends:
                    break
        a = dict(attrs)
        names = f"{a.get('class') or ''} {a.get('id') or ''}".lower()
        role = (a.get("role") or "").lower()
        page = tag in ("html", "body")
        cut = main = 0
        if self.open[-1].cut == 3 or tag in _UNSEEN or "hidden" in a:
            cut = 3
        elif self.by_names:
            words = set() if page else set().union(*map(_cut_words, names.split()))
            if tag in _CUT_TAGS - _LAYOUT_TAGS or role in _CUT_ROLES - {"form"} or not words <= _LAYOUT_NAMES:
                cut = 2
            else:
                cut = int(bool(words) or tag in _LAYOUT_TAGS or role == "form")
            main = (3 if tag == "article" or (a.get("itemprop") or "").lower() == "articlebody" else
                    2 if tag == "main" or role == "main" else
                    1 if not page and any(map(_names_article, names.split())) else 0)
        self.layouts |= cut == 1
        node = _Node(tag, " ".join(sorted(names.split())), cut, main)
        if cut < 3 or tag in _SCOPES:
            self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def parse_marked_section(self, i, report=1):
        """``<![`` begins a comment up to the next ``>``, as in browsers."""
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else len(self.rawdata)

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def handle_data(self, data):
        if self.open[-1].cut < 3:
            self.open[-1].children.append(data)


def parse(html: str | None, names: bool = True) -> _Node:
    tree = _Tree(names)
    tree.feed(html or "")
    tree.close()
    if tree.layouts:
        _keep_layouts(tree.root)
    return tree.root


def _keep_layouts(root: _Node) -> None:
    """Takes back the cut of a layout around the strongest mark, if no marked
    text of the page is outside such cuts."""
    cuts: list[_Node] = []
    marks: list[tuple[int, int]] = []  # (mark, cuts around it)
    found: dict[int, dict[int, _Node]] = {}
    stack: list = [(root, False)]
    while stack:
        item, done = stack.pop()
        if isinstance(item, str):
            around = [m for m, n in marks if n == len(cuts)] if item.strip() else []
            if around and not cuts:
                return
            if around:
                found.setdefault(max(around), {}).update((id(c), c) for c in cuts)
        elif done:
            if item.cut:
                cuts.pop()
            elif item.main:
                marks.pop()
        elif item.cut < 2:
            if item.cut:
                cuts.append(item)
            elif item.main:
                marks.append((item.main, len(cuts)))
            stack.append((item, True))
            stack.extend((c, False) for c in reversed(item.children))
    for node in found[max(found)].values() if found else ():
        node.cut = 0


def join_blocks(parts: list[tuple[str, int]]) -> str:
    out, last = [], None
    for text, block in parts:
        if block != last and out:
            out.append(" ")
        out.append(text)
        last = block
    return " ".join("".join(out).split())


def compact(root: _Node) -> list:
    """The tree in page order, without empty branches: [depth, label, mark] of
    an element, [depth, text, block, mark] of a text, where mark is the
    strongest mark of an article around a text, or an element's own; -1 in parts
    that are cut."""
    out, block, last, space = [], 0, 0, -1
    stack: list = [(root, 0, 0)]
    while stack:
        item, depth, mark = stack.pop()
        if item is None:  # the end of an element: a new block, or the one around it
            if mark is None:
                block = last = last + 1
            else:
                block, space = mark
        elif isinstance(item, str):
            if words := " ".join(item.split()):
                before = " " if space == block or item[0].isspace() else ""
                out.append([depth, f"{before}{words}{' ' if item[-1].isspace() else ''}", block, mark])
                space = -1
            else:  # white space alone parts the texts around it
                space = block
        elif item.cut == 3:
            if item.tag in _SCOPES:
                block = last = last + 1
        else:
            first_cut = item.cut and mark >= 0
            own = -1 if item.cut or mark < 0 else item.main
            out.append([depth, f"{item.tag} {item.names}", own])
            mark = max(mark, own) if own >= 0 else -1
            if first_cut:
                stack.append((None, 0, None if item.tag in _SCOPES else (block, space)))
                block = last = last + 1
            elif item.tag not in _INLINE:
                stack.append((None, 0, None))
                block = last = last + 1
            stack.extend((c, depth + 1, mark) for c in reversed(item.children))
    kept, below = [], -1
    for item in reversed(out):
        if len(item) == 4 or below > item[0]:
            kept.append(item)
            below = item[0]
    return kept[::-1]


def nested(items: list) -> list:
    """The same as nested lists: [label, children] or [text, block] leaves."""
    path: list = []
    for item in items:
        node = [item[1], item[2] if len(item) == 4 else []]
        del path[item[0]:]
        if path:
            path[-1][1].append(node)
        path.append(node)
    return path[0]


def _is_leaf(node) -> bool:
    return isinstance(node[1], int)


class _Matcher:
    """Simple tree matching. Trees are numbered bottom up by their shape (labels
    and order) and by shape and texts; scores of two shapes are made once."""

    def __init__(self):
        self.shapes, self.fulls, self.scores = {}, {}, {}
        self.parts, self.sizes = [("", ())], [1]  # shape 0 is a text

    def crowded(self) -> bool:
        return len(self.shapes) + len(self.fulls) + len(self.scores) > REMEMBERED

    def number(self, tree: list) -> dict[int, tuple[int, int]]:
        """(shape, shape and texts) of each node by its ``id``."""
        order, stack = [], [tree]
        while stack:
            node = stack.pop()
            order.append(node)
            if not _is_leaf(node):
                stack.extend(node[1])
        found: dict[int, tuple[int, int]] = {}
        for node in reversed(order):
            if _is_leaf(node):
                shape, key = 0, node[0].strip()
            else:
                below = [found[id(c)] for c in node[1]]
                part = (node[0], tuple(s for s, _ in below))
                shape = self.shapes.get(part)
                if shape is None:
                    shape = self.shapes[part] = len(self.parts)
                    self.parts.append(part)
                    self.sizes.append(1 + sum(self.sizes[s] for s in part[1]))
                key = (node[0], tuple(f for _, f in below))
            found[id(node)] = shape, self.fulls.setdefault(key, len(self.fulls))
        return found

    def score(self, a: int, b: int) -> int:
        """Pairs of two shapes; asks for missing scores on a stack of its own."""
        stack = [(a, b)]
        while stack:
            x, y = stack[-1]
            if self._known(x, y) is not None:
                stack.pop()
                continue
            xs, ys = _without_ends(self.parts[x][1], self.parts[y][1])[:2]
            missing = [(p, q) for p in set(xs) for q in set(ys) if self._known(p, q) is None]
            if missing:
                stack.extend(missing)
                continue
            inner = int(_table(self._weights(xs, ys))[-1][-1]) if xs and ys else 0
            ends = self.sizes[x] - 1 - sum(self.sizes[s] for s in xs)
            self.scores[x, y] = 1 + ends + inner
            stack.pop()
        return self._known(a, b)

    def _known(self, a: int, b: int) -> int | None:
        if a == b:
            return self.sizes[a]
        if not a or not b or self.parts[a][0] != self.parts[b][0]:
            return 0
        return self.scores.get((a, b))

    def _weights(self, xs, ys) -> np.ndarray:
        rows: dict[int, list[int]] = {}
        for x in xs:
            if x not in rows:
                one = {y: self.score(x, y) for y in dict.fromkeys(ys)}
                rows[x] = [one[y] for y in ys]
        return np.array([rows[x] for x in xs], np.int64)

    def pairs(self, a: list, b: list, na: dict, nb: dict) -> list:
        """The pairs of nodes of a largest matching; of equal ones, one that
        pairs more equal subtrees."""
        out, stack = [], [(a, b)]
        while stack:
            x, y = stack.pop()
            if _is_leaf(x) or _is_leaf(y):
                if _is_leaf(x) and _is_leaf(y):
                    out.append((x, y))
                continue
            if x[0] != y[0]:
                continue
            out.append((x, y))
            xs, ys = x[1], y[1]
            left, right = [na[id(c)] for c in xs], [nb[id(c)] for c in ys]
            if [s for s, _ in left] == [s for s, _ in right]:
                stack.extend(zip(xs, ys))  # the only matching of all nodes
                continue
            # equal ends align by themselves and keep the table small
            _, _, head, tail = _without_ends([f for _, f in left], [f for _, f in right])
            if (len(xs) - head - tail) * (len(ys) - head - tail) > TABLE_CELLS:
                _, _, head, tail = _without_ends([s for s, _ in left], [s for s, _ in right])
            stack.extend(zip(xs[:head], ys[:head]))
            stack.extend(zip(xs[len(xs) - tail:], ys[len(ys) - tail:]))
            xs, left = xs[head:len(xs) - tail], left[head:len(left) - tail]
            ys, right = ys[head:len(ys) - tail], right[head:len(right) - tail]
            if not xs or not ys:
                continue
            if len(xs) == len(ys) == 1:
                stack.append((xs[0], ys[0]))
                continue
            weights = self._weights([s for s, _ in left], [s for s, _ in right])
            equal = np.equal.outer([f for _, f in left], [f for _, f in right])
            weights = weights * (min(len(xs), len(ys)) + 1) + equal
            table = _table(weights).tolist()
            i, j = len(xs), len(ys)
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    stack.append((xs[i], ys[j]))
        return out


def _without_ends(xs, ys) -> tuple:
    """Both without their common head and tail, and the lengths of these."""
    head, most = 0, min(len(xs), len(ys))
    while head < most and xs[head] == ys[head]:
        head += 1
    tail = 0
    while tail < most - head and xs[-1 - tail] == ys[-1 - tail]:
        tail += 1
    return xs[head:len(xs) - tail], ys[head:len(ys) - tail], head, tail


def _table(weights: np.ndarray) -> np.ndarray:
    """Largest sums of weights of ordered pairs of the first i and j."""
    best = np.zeros((weights.shape[0] + 1, weights.shape[1] + 1), np.int64)
    for i, row in enumerate(weights):
        np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + row), out=best[i + 1, 1:])
    return best


def match(a: list, b: list, matcher: _Matcher | None = None) -> tuple[int, list]:
    """Simple tree matching: the largest number of node pairs of two ordered
    trees that keep labels, order and ancestry; and these pairs."""
    matcher = matcher or _Matcher()
    na, nb = matcher.number(a), matcher.number(b)
    return matcher.score(na[id(a)][0], nb[id(b)][0]), matcher.pairs(a, b, na, nb)


def _in_order(tree: list) -> list:
    """The nodes in page order: as the items of the compact tree."""
    out, stack = [], [tree]
    while stack:
        node = stack.pop()
        out.append(node)
        if not _is_leaf(node):
            stack.extend(reversed(node[1]))
    return out


def _lengths(items: list) -> list[int]:
    """Characters of the uncut texts at or below each item."""
    out, sums = [], {}
    for item in reversed(items):
        n = sums.pop(item[0] + 1, 0) if len(item) == 3 else len(item[1]) if item[3] >= 0 else 0
        sums[item[0]] = sums.get(item[0], 0) + n
        out.append(n)
    return out[::-1]


def _pack(tree: list) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(json.dumps(tree, ensure_ascii=False)
                                                      .encode("utf-8", "surrogatepass"))


def _unpack(packed: bytes) -> list:
    return json.loads(zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass"))


def _pack_seeds(batches, names: bool):
    """(host, seed): the packed compact tree of each host's first page, null without a text."""
    for batch in batches:
        trees = [compact(parse(html, names)) for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array([_pack(t) if t else None for t in trees], pa.binary())], ["host", "seed"])


class _Aligner:
    """Aligns pages with their seeds; seeds are unpacked once."""

    def __init__(self):
        self.matcher, self.seeds = _Matcher(), {}

    def slots(self, items: list, seed: bytes) -> list[int]:
        """For each item of the page 2 * its node in the seed + (equal text, or
        equal shape of an element, there); -1 without a node."""
        if self.matcher.crowded():
            self.__init__()
        if seed not in self.seeds:
            tree = nested(_unpack(seed))
            self.seeds[seed] = (tree, self.matcher.number(tree),
                                {id(node): i for i, node in enumerate(_in_order(tree))})
        first, numbers, nodes = self.seeds[seed]
        page = nested(items)
        own = self.matcher.number(page)
        partner = {id(y): x for x, y in self.matcher.pairs(first, page, numbers, own)}
        out = []
        for node in _in_order(page):
            x = partner.get(id(node))
            if x is None:
                out.append(-1)
            else:
                same = (x[0].strip() == node[0].strip() if _is_leaf(node)
                        else numbers[id(x)][0] == own[id(node)][0])
                out.append(2 * nodes[id(x)] + same)
        return out


def _align(batches, names: bool):
    """The packed trees of the pages, null without a text, their digests, and
    the slots and lengths of their items; ``first`` on one row of each tree of a
    host and batch."""
    aligner = _Aligner()
    for batch in batches:
        done: dict = {}  # each page of a host once
        seen, out = set(), []
        for host, html, seed in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "seed"))):
            if (host, html) not in done:
                items = compact(parse(html, names))
                tree = _pack(items) if items else None
                done[host, html] = (
                    (tree, hashlib.blake2b(tree, digest_size=16).digest(),
                     aligner.slots(items, seed) if seed else [-1] * len(items), _lengths(items))
                    if items else (None, None, None, None))
            tree, key, slots, lengths = done[host, html]
            out.append((tree, key, key is not None and (host, key) not in seen, slots, lengths))
            seen.add((host, key))
        ints = pa.list_(pa.int32())
        types = (pa.binary(), pa.binary(), pa.bool_(), ints, ints)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "url", "host")),
             *(pa.array([o[i] for o in out], t) for i, t in enumerate(types))],
            ["page_id", "url", "host", "tree", "tree_key", "first", "slots", "lengths"])


def region(items: list, decided: dict[int, tuple[bool, float]]) -> int:
    """The seed's element that holds its host's articles, -1 if the shapes do
    not tell. ``decided``: the nodes that enough pages have, with whether they
    are constant (or of a fixed shape) and their mean length."""
    at, path = 0, []
    while at not in path:
        if at not in decided or decided[at][0]:
            return -1
        path.append(at)
        below = []
        for i in range(at + 1, len(items)):
            if items[i][0] <= items[at][0]:
                break
            if (items[i][0] == items[at][0] + 1 and len(items[i]) == 3 and items[i][2] >= 0
                    and i in decided and not decided[i][0]):
                below.append(i)
        longest = max(below, key=lambda i: decided[i][1], default=at)
        if 2 * decided[longest][1] >= decided[at][1]:
            at = longest
    marks = [items[i][2] for i in path]
    if max(marks) > 0:
        at = path[marks.index(max(marks))]
    elif any(len(i) == 4 and i[3] > 0 for i in items):
        return -1
    return -1 if items[at][1].split(" ")[0] in ("#root", "html", "body") else at


def outside(items: list, slots: list[int], at: int) -> set[int]:
    """The numbers of the page's texts that are not in the host's region nor in
    an ``h1``; none if the page has no such region, or a stronger mark elsewhere."""
    out, n, within, title, found = set(), -1, None, None, False
    marks = {True: -1, False: -1}
    for item, slot in zip(items, slots):
        if within is not None and item[0] <= within:
            within = None
        if title is not None and item[0] <= title:
            title = None
        if len(item) == 4:
            n += 1
            inside = within is not None
            marks[inside] = max(marks[inside], item[3])
            if not inside and title is None:
                out.add(n)
        elif slot >= 0 and slot >> 1 == at:
            within, found = item[0], True
        elif title is None and item[1].startswith("h1 "):
            title = item[0]
    return out if found and marks[True] >= max(marks[False], 0) else set()


def content(items: list, slots: list[tuple[int, bool]], decided: dict[int, bool],
            beside: frozenset[int] | set[int] = frozenset()) -> str:
    """The page's text. ``slots``: (node, equal) of each text; ``decided``: the
    seed's nodes that enough pages have, and whether their text is constant;
    ``beside``: the numbers of the texts outside the region."""
    texts = [i for i in items if len(i) == 4]
    best = max(t[3] for t in texts)
    wanted = set()  # a block with any content is content as a whole
    for n, (text, (node, same)) in enumerate(zip(texts, slots)):
        if text[3] < 0 or n in beside:
            continue
        varies = not (same and decided[node]) if node in decided else text[3] == best
        if varies and (text[3] or not best):
            wanted.add(text[2])
    if best > 0 and not any(t[3] == best and t[2] in wanted for t in texts):
        wanted.update(t[2] for t in texts if t[3] == best)
    return join_blocks([(t[1], t[2]) for t in texts if t[2] in wanted])


def _induce(batches):
    """(host, wrapper): the region and the constant and the varying nodes of a
    host's seed, as packed JSON."""
    for batch in batches:
        out = []
        for seed, decided in zip(batch.column("seed").to_pylist(), batch.column("decided").to_pylist()):
            known = {d["slot"] // 2: (d["slot"] % 2 == 1, d["length"]) for d in decided or ()}
            out.append(_pack([region(_unpack(seed), known) if known else -1,
                              sorted([node, int(constant)] for node, (constant, _) in known.items())]))
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, pa.binary())], ["host", "wrapper"])


def _assemble(batches):
    wrappers: dict = {}
    for batch in batches:
        texts, done = [], {}
        for host, key, tree, slots, wrapper in zip(
                *(batch.column(c).to_pylist() for c in ("host", "tree_key", "tree", "slots", "wrapper"))):
            if tree is None:
                texts.append("")
                continue
            if (host, key) not in done:
                if host not in wrappers:
                    if len(wrappers) >= REMEMBERED // 100:
                        wrappers.clear()
                    at, nodes = _unpack(wrapper) if wrapper else (-1, ())
                    wrappers[host] = at, {node: constant == 1 for node, constant in nodes}
                at, decided = wrappers[host]
                items = _unpack(tree)
                of_texts = [(s >> 1, s & 1 == 1) for i, s in zip(items, slots) if len(i) == 4]
                done[host, key] = content(items, of_texts, decided,
                                          outside(items, slots, at) if at >= 0 else frozenset())
            texts.append(done[host, key])
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            ["page_id", "url", "text"])


def _small(table: DataFrame, *columns: str) -> DataFrame:
    """``table`` marked for a broadcast if its columns are small together."""
    size = sum((F.coalesce(F.length(c), F.lit(0)) for c in columns), F.lit(64))
    total = table.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(table) if total <= BROADCAST_BYTES else table


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", names: bool = True) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"),
                        F.col(html_col).cast("string").alias("html"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    # one html a host and task is kept before the shuffle
    firsts = (rows.where(F.regexp_replace("html", _NO_TEXT, " ").rlike(r"\S")).groupBy("host")
              .agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "html"))["html"].alias("html")))
    seeds = written(map_arrow(firsts, functools.partial(_pack_seeds, names=names), "host string, seed binary"),
                    "html-seeds")
    aligned = written(map_arrow(rows.join(_small(seeds, "seed"), "host", "left"),
                                functools.partial(_align, names=names),
                                f"page_id {id_type}, url string, host string, tree binary, tree_key binary, "
                                "first boolean, slots array<int>, lengths array<int>"), "html-aligned")
    # copies of a tree count once
    nodes = (aligned.where("first").dropDuplicates(["host", "tree_key"])
             .select("host", F.explode(F.arrays_zip("slots", "lengths")).alias("item"))
             .where("item.slots >= 0")
             .groupBy("host", F.shiftright("item.slots", 1).alias("node"))
             .agg(F.count(F.lit(1)).alias("pages"), F.sum(F.col("item.slots") % 2).alias("same"),
                  F.avg("item.lengths").alias("length"))
             .where(F.col("pages") >= MIN_PAGES))
    constant = (F.col("same") >= CONSTANT * F.col("pages")).cast("int")
    decided = nodes.groupBy("host").agg(
        F.collect_list(F.struct((2 * F.col("node") + constant).alias("slot"), "length")).alias("decided"))
    wrappers = _small(written(map_arrow(seeds.join(decided, "host", "left"), _induce,
                                        "host string, wrapper binary"), "html-wrappers"), "wrapper")
    done = map_arrow(aligned.join(wrappers, "host", "left").select("page_id", "url", "host", "tree", "tree_key",
                                                                   "slots", "wrapper"),
                     _assemble, f"page_id {id_type}, url string, text string")
    return done.withColumn("n_chars", F.char_length("text").cast("long"))
