"""Main text of web pages by wrappers: union-free regular expressions over tags.

A page is a tree of block elements and text slots; inline elements belong to the
slot they stand in.  Siblings of one kind that follow each other are a repeated
group.  Pages of a host that have their article or main element at one place, or
else the same outer boxes, are a layout.  Its trees are aligned one after the
other: children that match are aligned in turn, and a child that one side lacks
becomes optional.  What is left is the layout's wrapper.  Its slots gather, over all pages, how much text they
hold, how much of it in links, and whether it ever differs.  Each page is then
matched against the wrapper, and the texts in the wanted slots are its main text.

The slots that are extracted are data in the sense of the wrapper: text that
varies with the page.  Slots below elements that say they are menus, headers,
footers, sidebars, notices, adverts, forms or comments are not.  Inside an article words such as
tags, share or alert need the slots to agree: half of the text in links, or the same text on all pages.  Such words don't
count for an article or main element and for what holds one (repeated articles may
be comments), and not at all if without them next to no text is left.  Of the others,
those below an article, else below a main element, else below the element with
most text outside links.  A page that has none of its layout's slots is decided by
itself.  A slot outside of articles and main elements with one and the same text on
nearly all distinct pages of a layout is part of the template.

Trees are worked off with lists of what is to do, so elements may be nested to any
depth.  Words of classes and ids that few pages have are dropped from names, so a wrapper does not grow with the titles
of articles.  A page is parsed once, and its parts are stored.  Trees are reduced before they move: a task sends one partial wrapper per layout,
and partial wrappers are merged in two steps, so a host with very many pages
is many small groups.  Where slots may be template, all pages are matched, and the distinct ones with the slot are counted.

Defined cases: null and empty pages have an empty text; pages without url are a
host of their own; a layout with one page has only its marks to go by; tags that
are not closed end with their parent; repeated rows get a row each; empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.text import read, small_batches, stored
from millrace.session import shuffle_parts

# fixed values of the markup language
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|template|iframe|svg|xmp"
HIDDEN = frozenset(RAW.split("|")) | {"head", "select", "button", "object", "canvas", "audio", "video", "option"}
ASIDE = frozenset("nav header footer aside form menu dialog fieldset address".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
LISTS = frozenset("ul ol dl table tbody thead tfoot select".split())
# words of classes, ids and roles: whole ones, and beginnings of longer ones
SIDE_WORDS = frozenset("ad ads alert aside breadcrumb consent contentinfo complementary footer gdpr header login masthead menu modal nav "
                       "recommended related replies reply search share sharing signup social tags toc".split())
SIDE_BEGINNINGS = ("advert", "banner", "breadcrumb", "comment", "cookie", "disqus", "footer", "menu", "navbar", "navigation", "newsletter",
                   "notice", "popup", "promo", "respond", "sidebar", "sponsor", "subscri", "toolbar", "widget")
# words that articles also use of boxes with text of their own
WEAK_WORDS = frozenset("alert recommended related search share sharing social tags toc".split())
REPLIES = ("comment", "disqus", "replies", "reply", "respond")
MAIN_WORDS = frozenset("article articlebody content entry main post story text".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>|<[!?][^>]*>",
    re.S | re.I)
MARKS = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPACE = re.compile(r"\s+")
HIDING = re.compile(r"""\bhidden\b(?!\s*=\s*["']?false)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)


@dataclass(slots=True, eq=False)
class Step:
    """An open block element of a page: its name, the element around it, and what is worked out of its path when it is asked for."""

    name: str
    up: Step | None
    path: tuple | None = None


def _path(step: Step | None) -> tuple[int, bool, bool, Step | None]:
    """Of a path: a key of its names, whether it says that it is no main text, whether an article is in it, its outermost element inside of the body."""
    chain = []
    while step is not None and step.path is None:
        chain.append(step)
        step = step.up
    key, aside, in_article, outer = step.path if step else (0, False, False, None)
    for x in reversed(chain):
        key = _crc(x.name, key)
        aside, in_article = aside or _says(x.name, in_article), in_article or _is_article(x.name)
        outer = outer or (None if _tag(x.name) in ("html", "body") else x)
        x.path = key, aside, in_article, outer
    return key, aside, in_article, outer


#: a text of a page in its element, with the characters of it in links; an element is given once with no text
Part = tuple[Step | None, str, int]


@dataclass(slots=True, eq=False)
class Node:
    """A block element of a page or of a wrapper; a slot has no children and the name ``#``.

    ``pages`` counts the pages that have it.  ``stats`` of a slot: characters, characters in links, the least and the greatest hash
    of its text on a page (equal: it never differs); the root has those of whole pages; ``parts``: numbers of the blocks of a page that stand in it.
    """

    name: str
    children: list = field(default_factory=list)
    many: bool = False
    maybe: bool = False
    stats: list | None = None
    parts: list = field(default_factory=list)
    pages: int = 1

    def __str__(self) -> str:
        """The expression."""
        out, todo = [], [(self, True)]
        while todo:
            node, opens = todo.pop()
            sign = {(False, False): "", (False, True): "?", (True, False): "+", (True, True): "*"}[node.many, node.maybe]
            if not opens:
                out.append(")" + sign)
            elif node.children:
                out.append(" " * bool(out and not out[-1].endswith("(")) + node.name + "(")
                todo.append((node, False))
                todo += [(x, True) for x in reversed(node.children)]
            else:
                out.append(" " * bool(out and not out[-1].endswith("(")) + node.name + sign)
        return "".join(out)


@lru_cache(maxsize=1 << 16)
def _tag(name: str) -> str:
    return name.partition(".")[0]


def _named(tag: str, attributes: str) -> str:
    """Tag with the words of its class, id and role; digits don't count."""
    words = {w for m in MARKS.finditer(attributes) for w in re.split(r"[^a-z]+", next(filter(None, m.groups()[1:]), "").lower()) if w}
    if HIDING.search(attributes):
        words.add("hidden")
    return ".".join([tag, *sorted(words)])


@lru_cache(maxsize=1 << 16)
def _plain(name: str) -> str:
    """The name with those words only that say something of the place of a text."""
    tag, *words = name.split(".")
    told = SIDE_WORDS | MAIN_WORDS | {"hidden"}
    return ".".join([tag, *[w for w in words if w in told or w.startswith(SIDE_BEGINNINGS)]])


def blocks(page: str) -> Iterator[Part]:
    """Texts of a page in order, and its elements, each before what it holds."""
    stack: list[tuple[str, Step]] = []   # tag and step of open elements
    count: Counter[str] = Counter()      # open elements by tag: a tag that is not open is not looked for
    texts: list[str] = []
    linked, in_link, at = 0, 0, 0

    def flush():
        nonlocal linked
        text = SPACE.sub(" ", html.unescape("".join(texts))).strip()
        if text:
            yield (stack[-1][1] if stack else None), text, min(linked, len(text))
        texts.clear()
        linked = 0

    def drop(to: int):
        nonlocal in_link
        in_link = 0
        for tag_, _ in stack[to:]:
            count[tag_] -= 1
        del stack[to:]

    for m in TOKEN.finditer(page):
        if m.start() > at:
            texts.append(page[at:m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue  # a comment, a declaration or an element of raw text
        if tag in INLINE:
            if tag == "br" or tag == "img":
                texts.append(" ")
            elif tag == "a":
                in_link = 0 if m[2] else 1
            continue
        yield from flush()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1) if count[tag] else ():
                if stack[i][0] == tag:
                    drop(i)
                    break
            continue
        if tag in CLOSES_P and count["p"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    drop(i)
                    break
                if stack[i][0] in LISTS or stack[i][0] in ("td", "th", "li", "div", "article", "section", "main"):
                    break
        closes = CLOSED_BY.get(tag, ())
        for i in range(len(stack) - 1, -1, -1) if any(count[x] for x in closes) else ():
            if stack[i][0] in closes:
                drop(i)
                break
            if stack[i][0] in LISTS:
                break
        step = Step(_named(tag, m[4] or ""), stack[-1][1] if stack else None)
        yield step, "", 0
        if tag not in VOID:
            stack.append((tag, step))
            count[tag] += 1
    if at < len(page):
        texts.append(page[at:])
    yield from flush()


def _crc(text: str, start: int = 0) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"), start)


def tree(parts: list[Part]) -> Node:
    """Tree of a page's block elements and slots, equal neighbours merged."""
    own = _crc("\n".join([text for _, text, _ in parts if text]))
    root = Node("", stats=[0, 0, own, own])
    at: dict[int, Node] = {id(None): root}
    order = []
    for i, (step, text, linked) in enumerate(parts):
        if not text:
            at[id(step)] = node = Node(step.name)
            at[id(step.up)].children.append(node)
            order.append(node)
            continue
        here = at[id(step)].children
        if not here or here[-1].name != "#":
            here.append(Node("#", stats=[0, 0, 0, 0]))
        stats = here[-1].stats
        stats[0] += len(text)
        stats[1] += linked
        stats[2] = stats[3] = _crc(text, stats[2])
        here[-1].parts.append(i)
    for node in reversed(order):  # what an element holds comes after it
        if len(node.children) > 1:
            node.children = _groups(node.children, True)
    root.children = _groups(root.children, True)
    return root


#: siblings of a name that may stand apart from each other; more are one repeated group, so a wrapper has a bounded length
APART = 3
#: pages after which a name must be on a tenth of an element's pages to keep words that say nothing of its place
KNOWN, SHARE = 16, 10
#: distinct pages that a slot must be on to be template
LEAST = 4


def _merged_stats(a: Node, b: Node, one_page: bool) -> list | None:
    if not (a.stats and b.stats):
        return a.stats or b.stats
    (chars, linked, least, greatest), (more, links, low, high) = a.stats, b.stats
    if one_page:
        least = greatest = zlib.crc32(low.to_bytes(4, "big"), least)
        return [chars + more, linked + links, least, greatest]
    return [chars + more, linked + links, min(least, low), max(greatest, high)]


@lru_cache(maxsize=1 << 12)
def _stay(names: tuple[str, ...]) -> bool:
    """Whether no siblings of these names come together."""
    return _places(list(names)) == list(range(len(names)))


def _twins(a: Node, b: Node) -> list[tuple[Node, Node]] | None:
    """The pairs of nodes of two expressions of one form, none if the forms differ."""
    pairs = [(a, b)]
    for x, y in pairs:  # grows as it goes
        left, right = x.children, y.children
        if len(left) != len(right):
            return None
        for c, d in zip(left, right):
            if c.name != d.name:
                return None
            pairs.append((c, d))
        if len(left) > 1 and not _stay(tuple([c.name for c in left])):
            return None
    return pairs


def aligned(a: Node, b: Node, one_page: bool = False) -> Node:
    """One expression for two nodes of a name, with the statistics of both.

    Children that match are aligned in turn, the rest is optional, and neighbours of a name are a repeated group.
    Pairs wait in a list, so trees may be of any depth; a group is put together after the pairs inside of it are known.
    The nodes given are used up.  Only the slots of a single page keep the numbers of their parts.
    """
    def joined(x: Node, y: Node) -> Node:
        pages = max(x.pages, y.pages) if one_page else x.pages + y.pages
        return Node(x.name, [], x.many or y.many, x.maybe or y.maybe, _merged_stats(x, y, one_page), x.parts + y.parts if one_page else [], pages)

    twins = _twins(a, b)
    if twins:
        for x, y in twins:
            x.many, x.maybe, x.stats = x.many or y.many, x.maybe or y.maybe, _merged_stats(x, y, one_page)
            x.pages = max(x.pages, y.pages) if one_page else x.pages + y.pages
            if one_page:
                x.parts += y.parts
            else:
                x.parts = []
        return a

    top = joined(a, b)
    todo = [(top, a.children, b.children)]
    while todo:
        into, left, right = todo.pop()
        out: list[tuple[Node, list]] = []    # a node and the lists of children that it stands for
        for x, y in _steps(left, right):
            if x and y:
                out.append((joined(x, y), [x.children, y.children]))
            else:
                z = x or y
                out.append((Node(z.name, [], z.many, True, z.stats, z.parts, z.pages), [z.children]))
        kept = _places([z.name for z, _ in out])
        nodes: list[tuple[Node, list]] = []
        for (z, below), place in zip(out, kept):
            if place == len(nodes):
                nodes.append((z, below))
                continue
            old, under = nodes[place]
            maybe = old.maybe and z.maybe
            new = joined(old, z)
            new.many, new.maybe = new.many or z.name != "#", maybe
            nodes[place] = (new, under + below)
        into.children = [z for z, _ in nodes]
        for z, below in nodes:
            # more than two lists: the first ones are aligned, the others follow
            if len(below) == 1:
                z.children = below[0]
            elif len(below) == 2:
                todo.append((z, *below))
            else:
                first = Node(z.name, below[0])
                for other in below[1:]:
                    first = aligned(first, Node(z.name, other), one_page) if first.children or other else first
                z.children = first.children
    return top


def _places(names: list[str]) -> list[int]:
    """Where each of some siblings goes: to its neighbour of the same name, or to the first of a name that comes again and again."""
    again: Counter[str] = Counter(x for i, x in enumerate(names) if not i or names[i - 1] != x)
    out: list[int] = []
    first: dict[str, int] = {}
    size, last = 0, None
    for x in names:
        if again[x] > APART and x in first:
            out.append(first[x])
        elif again[x] <= APART and last == x:
            out.append(size - 1)
        else:
            first.setdefault(x, size)
            out.append(size)
            size += 1
            last = x
    return out


def _groups(nodes: list[Node], one_page: bool) -> list[Node]:
    """Siblings with those of one name put together."""
    places = _places([x.name for x in nodes])
    out: list[Node] = []
    for x, place in zip(nodes, places):
        if place == len(out):
            out.append(x)
            continue
        maybe = out[place].maybe and x.maybe
        out[place] = aligned(out[place], x, one_page)
        out[place].many, out[place].maybe = out[place].many or x.name != "#", maybe
    return out if len(out) == len(nodes) else _groups(out, one_page)


def _steps(a: list[Node], b: list[Node]) -> Iterator[tuple[Node | None, Node | None]]:
    """Longest common sequence of names as pairs, the rest alone."""
    lo, hi, n, m = 0, 0, len(a), len(b)
    while lo < n and lo < m and a[lo].name == b[lo].name:
        yield a[lo], b[lo]
        lo += 1
    while hi < n - lo and hi < m - lo and a[n - 1 - hi].name == b[m - 1 - hi].name:
        hi += 1
    x, y = a[lo:n - hi], b[lo:m - hi]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)] if x and y else None
    if best:
        for i in range(len(x) - 1, -1, -1):
            for j in range(len(y) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if x[i].name == y[j].name else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i].name == y[j].name:
            yield x[i], y[j]
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and best[i + 1][j] >= best[i][j + 1]:
            yield x[i], None
            i += 1
        else:
            yield None, y[j]
            j += 1
    for k in range(hi, 0, -1):
        yield a[n - k], b[m - k]


def generalised(root: Node) -> None:
    """Rare children of an element lose the words of their names that say nothing of their place, and those of one name come together.

    So a wrapper does not grow with words that only a few pages have, such as the title of an article in an id.
    """
    todo = [root]
    while todo:
        node = todo.pop()
        rare = [x for x in node.children if "." in x.name and node.pages >= KNOWN and SHARE * x.pages < node.pages]
        for x in rare:
            x.name = _plain(x.name)
        if rare:
            # names that are rare take the first place of their name, wherever it is
            first: dict[str, int] = {}
            out: list[Node] = []
            for x in node.children:
                if x in rare and x.name in first:
                    place = first[x.name]
                    maybe = out[place].maybe and x.maybe
                    out[place] = aligned(out[place], x)
                    out[place].many, out[place].maybe = True, maybe
                else:
                    first.setdefault(x.name, len(out))
                    out.append(x)
            node.children = _groups(out, False)
        todo += node.children


def matched(page: Node, wrapper: Node) -> Iterator[tuple[Node, Node]]:
    """Slots of a page's tree with the slots of the wrapper they stand in; what comes again stands in the nearest group of its name."""
    todo = [(page, wrapper)]
    while todo:
        x, y = todo.pop()
        if x.name == "#":
            yield x, y
            continue
        places = {id(c): k for k, c in enumerate(y.children)}
        found, at = [], 0
        for below, place in list(_steps(x.children, y.children)):
            at = places[id(place)] if place else at
            if below and not place:
                for name in (below.name, _plain(below.name)):
                    place = min((z for z in y.children if z.name == name), key=lambda z: abs(places[id(z)] - at), default=None)  # noqa: B023
                    if place:
                        break
            if below and place:
                found.append((below, place))
        todo += reversed(found)


@dataclass
class Wrapper:
    """Expression of pages; its slots hold what the pages have in them."""

    root: Node | None = None
    known: tuple[dict[int, int], list[int]] | None = None

    def add(self, parts: list[Part]) -> None:
        self._align(tree(parts))

    def merge(self, other: Wrapper) -> None:
        if other.root:
            self._align(other.root)

    def _align(self, root: Node) -> None:
        more, self.known = root.pages, None
        self.root = aligned(self.root, root) if self.root else root
        if self.root.pages >= KNOWN and self.root.pages // KNOWN != (self.root.pages - more) // KNOWN:
            generalised(self.root)

    def dump(self) -> str:
        """The nodes in order, each with the number of its children."""
        out, todo = [], [self.root] if self.root else []
        while todo:
            n = todo.pop()
            out.append([n.name, n.many + 2 * n.maybe, n.pages, len(n.children), n.stats or 0])
            todo += reversed(n.children)
        return json.dumps(out, separators=(",", ":"))

    @classmethod
    def load(cls, text: str) -> Wrapper:
        root, open_ = None, []
        for name, signs, pages, size, stats in json.loads(text):
            node = Node(name, [], bool(signs & 1), signs > 1, stats or None, [], pages)
            while open_ and not open_[-1][1]:
                open_.pop()
            if open_:
                open_[-1][0].children.append(node)
                open_[-1][1] -= 1
            else:
                root = node
            open_.append([node, size])
        return cls(root)

    def nodes(self) -> list[tuple[Node, int, int]]:
        """All elements and slots in order, each with the number of the element around it (-1: none) and of the last node inside."""
        out: list[list] = []
        todo = [(x, -1) for x in reversed(self.root.children)] if self.root else []
        while todo:
            node, up = todo.pop()
            out.append([node, up, len(out)])
            todo += [(x, len(out) - 1) for x in reversed(node.children)]
        for i in range(len(out) - 1, -1, -1):
            if out[i][1] >= 0:
                out[out[i][1]][2] = max(out[out[i][1]][2], out[i][2])
        return [tuple(x) for x in out]

    @property
    def slots(self) -> list[Node]:
        """The slots in order."""
        return [n for n, _, _ in self.nodes() if n.name == "#"]

    def places(self) -> tuple[dict[int, int], list[int]]:
        """Number of each slot by its identity, and key of the path of each slot, as steps have it; kept until a page is added."""
        if self.known is None:
            at: list[int] = []
            numbers, keys = {}, []
            for node, up, _ in self.nodes():
                around = at[up] if up >= 0 else 0
                at.append(around if node.name == "#" else _crc(node.name, around))
                if node.name == "#":
                    numbers[id(node)] = len(keys)
                    keys.append(around)
            self.known = numbers, keys
        return self.known

    def constant(self) -> list[int]:
        """Numbers of the slots outside articles and main elements whose text never differs."""
        out, number, marked = [], 0, []
        for node, up, _ in self.nodes():
            inside = up >= 0 and marked[up]
            marked.append(inside or _is_article(node.name) or _is_main(node.name))
            if node.name == "#":
                if not inside and not _varies(node):
                    out.append(number)
                number += 1
        return out

    def main(self, template: frozenset[int] | set[int] = frozenset()) -> list[int]:
        """Numbers of the slots that hold the main text; those of the template don't."""
        nodes = self.nodes()
        several = bool(self.root) and _varies(self.root)
        holds, menus = _holds(nodes), _like_menus(nodes, several)
        numbers: dict[int, int] = {}
        for i, (node, _, _) in enumerate(nodes):
            if node.name == "#":
                numbers[i] = len(numbers)
        # names count less and less, as long as what they leave has next to no text
        open_, had = [], -1
        for trust in (2, 1, 0):
            apart: list[tuple[bool, bool]] = []
            for i, (node, up, _) in enumerate(nodes):
                gone, in_article = apart[up] if up >= 0 else (False, False)
                if node.name != "#":
                    name = _trusted(node.name, holds[i], trust)
                    gone = gone or _says(name, in_article) and not (in_article and _is_weak(name) and not menus[i])
                    in_article = in_article or _is_article(name)
                apart.append((gone, in_article))
            more = [i for i in numbers if numbers[i] not in template and not apart[i][0]]
            mass_ = sum(max(x.stats[0] - 2 * x.stats[1], 0) for x in (nodes[i][0] for i in more) if not several or _varies(x))
            if had < 0 or mass_ > 10 * had:
                open_, had = more, mass_
        for wanted in (_is_article, _is_main):
            inside: list[bool] = []
            for node, up, _ in nodes:
                inside.append(up >= 0 and inside[up] or wanted(node.name))
            below = [numbers[i] for i in open_ if inside[i]]
            if below:
                return below
        mass: dict[int, float] = {}
        for i in open_:
            chars, linked, *_ = nodes[i][0].stats
            at, share = nodes[i][1], 0.5  # text counts less for an element the deeper it stands; far ones get next to nothing
            if at < 0:
                mass[-1] = mass.get(-1, 0) + max(chars - 2 * linked, 0) * share
            for distance in range(FAR):
                if at < 0:
                    break
                mass[at] = mass.get(at, 0) + max(chars - 2 * linked, 0) * share
                at, share = nodes[at][1], 0.8 ** distance
        if not mass:
            return [numbers[i] for i in open_]
        most = max(mass.values())
        top = next(x for x in mass if mass[x] == most)
        last = nodes[top][2] if top >= 0 else len(nodes)
        return [numbers[i] for i in open_ if (top < i <= last if top >= 0 else nodes[i][1] < 0) and 2 * nodes[i][0].stats[1] <= nodes[i][0].stats[0]]


#: elements around a text that get a share of its mass; further ones would get less than a millionth
FAR = 64


def _varies(node: Node) -> bool:
    """Whether the text of a slot differs between pages."""
    return node.stats[2] != node.stats[3]


def template(on: dict[int, int], pages: int) -> set[int]:
    """Slots that are on nearly all distinct pages, of those whose text never differs."""
    return {slot for slot, n in on.items() if n >= LEAST and 10 * n >= 9 * pages}


def held(wrapper: Wrapper, parts: list[Part]) -> dict[int, int]:
    """Numbers of the slots in which the parts of a page stand."""
    number, _ = wrapper.places()
    return {k: number[id(y)] for x, y in matched(tree(parts), wrapper.root) for k in x.parts} if wrapper.root else {}


def main_text(parts: list[Part], wrapper: Wrapper, wanted: set[int], constant: frozenset[int] | set[int] = frozenset()) -> str:
    """Texts of a page in the wanted slots; a page that has none of them is decided by itself, without the ``constant`` ones of its template."""
    slots, keys = held(wrapper, parts), wrapper.places()[1]
    known = {keys[i] for i in wanted}  # of parts that no alignment has a place for
    use = [text for k, (step, text, _) in enumerate(parts) if text and (slots[k] in wanted if k in slots else _path(step)[0] in known)]
    if not use:
        own = Wrapper()
        parts = [x for k, x in enumerate(parts) if slots.get(k) not in constant]
        own.add(parts)
        slots, wanted = held(own, parts), set(own.main())
        use = [text for k, (_, text, _) in enumerate(parts) if slots.get(k) in wanted]
    return "\n".join(use)


def layout(parts: list[Part]) -> int:
    """Key of pages that are built alike: where their article or main element stands, else their outer boxes."""
    steps = [step for step, text, _ in parts if not text]
    for wanted in (_is_article, _is_main):
        marked = [x for x in steps if wanted(x.name)]
        at = next((x for x in marked if not _path(x)[1]), marked[0] if marked else None)
        if at is not None:
            tags = []
            while at is not None:
                tags.append(_tag(at.name))
                at = at.up
            return zlib.crc32("/".join([wanted.__name__, *reversed(tags)]).encode("utf-8", "surrogatepass"))
    # optional elements of a text must not make a layout: only outermost boxes that hold elements count
    boxes = (_path(x.up)[3] for x in steps if x.up and not _path(x)[1])
    outer = {x.name for x in boxes if x and _tag(x.name) in ("div", "section")}
    return _crc("\n".join(sorted(map(_plain, outer))))


@lru_cache(maxsize=1 << 16)
def _says(name: str, in_article: bool) -> bool:
    """Whether an element says that it is no main text; the header of an article holds its title."""
    tag, *words = name.split(".")
    title = in_article and (tag == "header" or "header" in words)
    if tag in HIDDEN or "hidden" in words or tag in ASIDE and not title:
        return True
    return tag not in ("body", "html") and any(w in SIDE_WORDS and not (title and w == "header") or w.startswith(SIDE_BEGINNINGS) for w in words)


@lru_cache(maxsize=1 << 16)
def _is_weak(name: str) -> bool:
    """Whether only words or a tag that articles use of their own text say that an element is no main text."""
    tag, *words = name.split(".")
    if tag in HIDDEN or "hidden" in words or tag in ASIDE and tag != "address":
        return False
    told = [w for w in words if w in SIDE_WORDS or w.startswith(SIDE_BEGINNINGS)]
    return all(w in WEAK_WORDS or w.startswith("widget") for w in told)


def _like_menus(nodes: list[tuple[Node, int, int]], several: bool) -> list[bool]:
    """Per element, whether its slots say that it is no text: at least half of it in links, or the same on all of several pages."""
    sums = [[0, 0, False] for _ in nodes]
    for i in range(len(nodes) - 1, -1, -1):
        node, up, _ = nodes[i]
        if node.name == "#":
            sums[i] = [node.stats[0], node.stats[1], _varies(node)]
        if up >= 0:
            sums[up] = [sums[up][0] + sums[i][0], sums[up][1] + sums[i][1], sums[up][2] or sums[i][2]]
    return [2 * linked >= chars or several and not varies for chars, linked, varies in sums]


def _holds(nodes: list[tuple[Node, int, int]]) -> list[int]:
    """What stands below each element: 2 a main element or one article, 1 repeated articles, 0 none of them."""
    most, articles = [0] * len(nodes), [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node, up, _ = nodes[i]
        most[i] = max(most[i], min(articles[i], 1) if articles[i] != 1 else 2)
        if up < 0:
            continue
        if _tag(node.name) == "main":
            most[up] = 2
        elif _is_article(node.name):
            articles[up] += 2 if node.many else 1
        most[up] = max(most[up], min(most[i], 1) if node.many else most[i])
    return most


def _trusted(name: str, holds: int, trust: int) -> str:
    """The name of an element with those words only that count: not for an article or main element and what holds one.

    With less trust an element that holds repeated articles isn't apart, then no element by its words but one of comments.
    """
    tag, *words = name.split(".")
    own = tag == "main" or _is_article(name)
    around = holds >= min(max(trust, 1), 2)
    if own or around or not trust:
        replies = not own and (trust == 2 or not trust and not around)
        words = [w for w in words if w in ("hidden", "articlebody") or replies and w.startswith(REPLIES)]
        tag = "div" if around and tag in ("form", "fieldset") else tag
    return ".".join([tag, *words])


@lru_cache(maxsize=1 << 16)
def _is_article(step: str) -> bool:
    return _tag(step) == "article" or "articlebody" in step.split(".")[1:]


@lru_cache(maxsize=1 << 16)
def _is_main(step: str) -> bool:
    tag, *words = step.split(".")
    return tag == "main" or tag not in ("body", "html") and bool(MAIN_WORDS.intersection(words))


def packed(parts: list[Part]) -> tuple[str, list[str]]:
    """Parts of a page as its frame and its texts.

    The frame has the name of each element with the number of the one around, what each part is (-2: the next element, else a text
    by the number of its element) and the characters in links.
    """
    number: dict[int, int] = {id(None): -1}
    steps, order, links, texts = [], [], [], []
    for step, text, linked in parts:
        if text:
            order.append(number[id(step)])
            links.append(linked)
            texts.append(text)
        else:
            number[id(step)] = len(steps)
            steps.append([number[id(step.up)], step.name])
            order.append(-2)
    return json.dumps([steps, order, links], ensure_ascii=False, separators=(",", ":")), texts


def unpacked(frame: str, texts: list[str] | None = None) -> list[Part]:
    """Parts of a page; without texts each one is a dash."""
    names, order, links = json.loads(frame)
    steps: list[Step] = []
    out: list[Part] = []
    known = zip(texts or ["-"] * len(links), links)
    for i in order:
        if i == -2:
            up, name = names[len(steps)]
            steps.append(Step(name, steps[up] if up >= 0 else None))
            out.append((steps[-1], "", 0))
        else:
            out.append((steps[i] if i >= 0 else None, *next(known)))
    return out


@lru_cache(maxsize=256)
def _loaded(text: str) -> Wrapper:
    return Wrapper.load(text)


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_PARTIAL = "host string, layout bigint, salt int, wrapper string"
_PARTIAL_ROW = pa.schema([("host", pa.string()), ("layout", pa.int64()), ("salt", pa.int32()), ("wrapper", pa.string())])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of rows that stand in order of host, layout and salt."""
    at, wrapper = None, None
    for batch in batches:
        for *key, text in zip(*(c.to_pylist() for c in batch.columns)):
            if key != at:
                if wrapper is not None:
                    yield _table(_PARTIAL_ROW, [(*at, wrapper.dump())])
                at, wrapper = key, Wrapper()
            wrapper.merge(Wrapper.load(text))
    if wrapper is not None:
        yield _table(_PARTIAL_ROW, [(*at, wrapper.dump())])


_APART = "page_id bigint, url string, host string, layout bigint, own binary, frame string, texts array<string>, salt int, wrapper string"
_APART_ROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("layout", pa.int64()), ("own", pa.binary()),
                        ("frame", pa.string()), ("texts", pa.list_(pa.string())), ("salt", pa.int32()), ("wrapper", pa.string())])


def taken_apart(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, html`` rows as stored rows of frame, texts and ``own``, a hash of all texts; and a row per task, host and layout with the wrapper of its pages."""
    salts = shuffle_parts(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, Wrapper] = {}
        for batch in batches:
            rows = []
            for page_id, url, host, source in zip(*(c.to_pylist() for c in batch.columns)):
                parts = list(blocks(source))
                key = layout(parts)
                frame, texts = packed(parts)
                own = hashlib.blake2b("\n".join(texts).encode("utf-8", "surrogatepass"), digest_size=16).digest()
                rows.append((page_id, url, host, key, own, frame, texts, None, None))
                known.setdefault((host, key), Wrapper()).add(parts)
            yield _table(_APART_ROW, rows)
        for (host, key), wrapper in known.items():
            text = wrapper.dump()
            yield _table(_APART_ROW, [(None, None, host, key, None, None, None, _crc(text) % salts, text)])

    return stored(pages.select("page_id", "url", "host", "html").mapInArrow(run, _APART), "pages")


_LEARNED = "host string, layout bigint, wrapper string, constant array<int>"
_LEARNED_ROW = pa.schema([("host", pa.string()), ("layout", pa.int64()), ("wrapper", pa.string()), ("constant", pa.list_(pa.int32()))])


def wrappers(parts: DataFrame) -> DataFrame:
    """Stored rows ``host, layout, wrapper, constant`` (numbers of the slots that may be template) of partial wrappers."""
    keys = ["host", "layout", "salt"]
    for salt in (F.col("salt"), F.lit(0)):
        parts = parts.withColumn("salt", salt.cast("int")).repartition(*keys).sortWithinPartitions(*keys, "wrapper")
        parts = parts.mapInArrow(_merged, _PARTIAL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _table(_LEARNED_ROW, [(*row, Wrapper.load(row[2]).constant()) for row in zip(*(c.to_pylist() for c in batch.columns))])

    return stored(parts.select("host", "layout", "wrapper").mapInArrow(run, _LEARNED), "wrappers", "uncompressed")


_DECIDED = "host string, layout bigint, wrapper string, slots array<int>, template array<int>"
_DECIDED_ROW = pa.schema([("host", pa.string()), ("layout", pa.int64()), ("wrapper", pa.string()), ("slots", pa.list_(pa.int32())),
                          ("template", pa.list_(pa.int32()))])


def decided(pages: DataFrame, learned: DataFrame) -> DataFrame:
    """Stored rows ``host, layout, wrapper, slots, template``: the slots of the main text, and those of the template.

    The distinct pages (by their texts) of a layout, and those on which a constant slot is found, are all counted.
    """
    keys = ["host", "layout"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for frame, text, constant in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5))):
                slots = {*held(_loaded(text), unpacked(frame)).values()}
                out.append([-1, *(k for k in constant if k in slots)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.int32()))], ["host", "layout", "own", "slots"])

    asked = pages.join(learned.where(F.size("constant") > 0), keys).select(*keys, "own", "frame", "wrapper", "constant")
    on = asked.mapInArrow(found, "host string, layout bigint, own binary, slots array<int>").withColumn("slot", F.explode("slots"))
    on = on.groupBy(*keys, "slot").agg(F.count_distinct("own").alias("n"))
    on = on.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("slot", "n"))).alias("counts"))  # at most one item per slot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, key, text, counts in zip(*(c.to_pylist() for c in batch.columns)):
                numbers = {x["slot"]: x["n"] for x in counts or ()}
                same = template(numbers, numbers.pop(-1, 0))
                rows.append((host, key, text, Wrapper.load(text).main(same), sorted(same)))
            yield _table(_DECIDED_ROW, rows)

    rows = learned.join(on, keys, "left").select(*keys, "wrapper", "counts").mapInArrow(run, _DECIDED)
    return stored(rows, "slots", "uncompressed")


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """A row per page: ``page_id, url, text, n_chars``."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), _host(F.col(url)).alias("host"),
                        F.coalesce(F.col(page), F.lit("")).alias("html"))

    parts = taken_apart(rows)
    apart = parts.where("wrapper is null").drop("salt", "wrapper")
    learned = wrappers(parts.where("wrapper is not null").select("host", "layout", "salt", "wrapper"))
    joined = apart.join(decided(apart, learned), ["host", "layout"], "left").select("page_id", "url", "frame", "texts", "wrapper", "slots", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(unpacked(frame, own), _loaded(text), set(slots), set(same))
                     for frame, own, text, slots, same in zip(*(batch.column(i).to_pylist() for i in range(2, 7)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op7_main_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(read(spark, sf_dir, "pages"))
