"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of one host.

A page is a stream of block-level tags and text. Runs of one pattern in a page fold into repeated groups.
A host's pages are aligned one after the other against the wrapper so far: what both have stays, what only
one has becomes optional, a single occurrence of a repeated group joins the group, and text that differs
becomes a slot; text that at least two different pages have alike is template. The wrapper tells where a host
keeps its article: in the plainest element for it (article, then main, then a class or id that says so), and
among equally plain ones in the one whose slots hold most text, so a long passage that all pages repeat does
not win. Each page is read in its host's region, or in its own where it does not have that one. Inside the
article, elements go that are forms, menus and the like by name, or of which a class is made up of words for
adverts, comments, notices and so on: "ad-box" goes, "search-methods" stays; words that an article uses too
("discussion", "search", "alert") say nothing there, nor does an id that is such a word.

Reading a page takes time in proportion to its length: tags are found by one index of its quotes and angle
brackets, alignment looks for shapes that occur once on either side and leaves long stretches without any as
optional. Elements below MOST_DEPTH open ones keep their text and no path of their own.

A wrapper is fitted on all pages of its host and applied to every page, whole. Pages travel folded, their
texts as lengths and digests, copies once; a host's pages are dealt to parts of about PART_CHARS by the pages'
keys, each part gives a wrapper, and wrappers of parts meet FAN at a time until a host has one. A text that differs
somewhere is a slot for good, so its characters leave the wrapper for a table of (host, region) that is added up
apart. A wrapper of more than MOST_NODES nodes is made more general, not cut: stretches of optional nodes become
one repeated group of the stretch's different patterns, then of its plain tags and one slot, so a wrapper's size is
bounded by its host's shortest page, however many pages differ. Wrappers are joined back to pages.
On a host without a marked region, a text is template if at least two different pages have its path and all
pages that have the path have the text there; where all text of a host is so, none is.

Definitions: null html is empty and gives text '' with 0 characters; a null or odd url belongs to the host
''. Character references are decoded, white space inside a block becomes one space, blocks (paragraphs,
headings, list items, cells and so on) are joined by one line break, blank blocks are left out. A page
without any marked region is read from its body by the marks alone. Repeated rows are extracted each; a
null page_id stays null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as html_module
import json
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from difflib import SequenceMatcher
from functools import lru_cache, reduce
from itertools import compress, count, groupby
from operator import eq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import by_group, stored, text_batches

#: Folded pages of a part of a host, in characters, and wrappers of parts that are merged at once.
PART_CHARS = 1 << 17
FAN = 8
#: A wrapper of more nodes is made more general.
MOST_NODES = 2000
#: Longer texts stand in a wrapper as digests.
LONGEST_VALUE = 40
#: Longest pattern, in tokens, that folds into a repeated group.
LONGEST_PATTERN = 24
#: Open elements that a path tells apart.
MOST_DEPTH = 256
#: Stretches without a shape that occurs once are aligned by all their nodes up to so many pairs of nodes.
GAP_PAIRS = 40_000

# Element names of HTML.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "canvas")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BLOCK = ("address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog",
         "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
         "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p",
         "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul")
#: Elements that an opening tag closes, and where the search for them ends.
CLOSES = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
          "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
#: Elements and class or id words that never hold an article's text.
DROP_ELEMENTS = ("nav", "aside", "form", "footer", "head", "title", "button", "select", "option", "dialog", "menu",
                 "fieldset", "legend")
DROP_WORDS = ("ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "banners", "sponsor",
              "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
              "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
              "login", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "comment",
              "comments", "disqus", "respond", "reply", "replies", "discussion", "share", "sharing", "social", "related",
              "recommended", "recommendations", "widget", "toolbar", "pagination", "pager", "skip", "search",
              "copyright", "footer", "hidden", "paywall", "teaser", "outbrain", "taboola")
#: Those of them that articles use as well: inside an article they say nothing.
DOUBTFUL = ("alert", "discussion", "hidden", "notification", "overlay", "promotion", "related", "reply", "replies",
            "respond", "search", "share", "skip", "social", "teaser")
#: Words for the shape of an element, which may stand beside the others in a class.
SHAPES = ("area", "bar", "block", "body", "box", "button", "buttons", "container", "content", "form", "inner", "item", "items",
          "label", "left", "link", "links", "list", "main", "outer", "panel", "post", "posts", "right", "section", "site",
          "slot", "text", "thread", "title", "top", "unit", "wrap", "wrapper")
#: Words that mark a page's frame outside the article only.
FRAME_WORDS = ("header", "masthead", "top", "side", "rail", "bottom", "foot", "topbar", "logo", "brand")
#: Words of classes and ids that mark an article, and words that tell that they mark a part or a list of them.
MAIN_WORDS = ("article", "articlebody", "content", "post", "entry", "story")
PART_WORDS = ("meta", "title", "headline", "byline", "author", "date", "list", "grid", "tags", "tag", "category", "thumb",
              "thumbnail", "info", "links", "nav", "next", "prev", "previous", "more", "popular", "latest", "recent")

NAME = re.compile(r"[^\s/>]*")
STOP = re.compile(r"[>\"']")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
ATTRIBUTE = re.compile(r"(?<![-\w:.])([a-zA-Z_:][-\w:.]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORDS = re.compile(r"[a-z]+")


def label_of(name: str, attributes: str) -> str:
    """An element with the classes, id and role that tell its purpose; numbers in them do not count."""
    if not attributes.strip():
        return name
    marks = []
    for key, value in ATTRIBUTE.findall(attributes):
        key = key.lower()
        value = value.strip("\"'").lower()
        if key in ("class", "id", "role", "itemprop"):
            marks += [re.sub(r"\d+", "0", v) for v in value.split()]
        elif key == "style" and HIDDEN.search(value) or key == "aria-hidden" and value == "true":
            marks.append("hidden")
    if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)):
        marks.append("hidden")
    return name + "".join("." + m for m in sorted(set(marks)))


class TagEnds:
    """Where the tags of a page end. A ``>`` in quotes ends a tag only if none outside of quotes does; ways that
    have led to the page's end once are not gone again, so that a page's tags take time in proportion to it."""

    def __init__(self, page: str):
        self.page = page
        self.stops = [m.start() for m in STOP.finditer(page)]
        self.last = page.rfind(">")
        self.nowhere: set[int] = set()
        self.after = {c: self.followers(c) for c in "\"'"}

    def followers(self, quote: str) -> dict[int, int]:
        places = [at for at in self.stops if self.page[at] == quote]
        return dict(zip(places, places[1:]))

    def find(self, at: int) -> int:
        """The position of the ``>`` of the tag whose attributes begin at ``at``; -1 if there is none."""
        if at > self.last:
            return -1
        begin, way = at, []
        while (k := bisect_left(self.stops, at)) < len(self.stops):
            place = self.stops[k]
            if self.page[place] == ">":
                return place
            if place in self.nowhere:
                break
            way.append(place)
            close = self.after[self.page[place]].get(place)
            if close is None:
                break
            at = close + 1
        self.nowhere.update(way)
        return self.page.find(">", begin)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', string, ''), ('raw', '', '') for scripts and the like, ('open' or 'close', name, attributes)."""
    ends = TagEnds(page)
    at, size = 0, len(page)
    while at < size:
        if page[at] != "<":
            to = page.find("<", at)
            to = size if to < 0 else to
            yield "text", page[at:to], ""
            at = to
            continue
        mark = page[at + 1:at + 2]
        if page.startswith("<!--", at) or page.startswith("<![CDATA[", at):
            last = "-->" if mark == "!" and page[at + 2] == "-" else "]]>"
            to = page.find(last, at + 4)
            at = size if to < 0 else to + 3
            continue
        closing = mark == "/"
        begin = at + 1 + closing
        if page[begin:begin + 1].isascii() and page[begin:begin + 1].isalpha() and begin <= ends.last:
            name = NAME.match(page, begin)
            lower = name[0].lower()
            if not closing and lower in RAW:
                to = page.find(">", name.end())
                last = RAW_END[lower].search(page, to) if to >= 0 else None
                if to >= 0:
                    yield "raw", "", ""
                    at = last.end() if last else size
                    continue
            to = ends.find(name.end())
            if to >= 0:
                yield "close" if closing else "open", lower, page[name.end():to]
                at = to + 1
                continue
        if mark in ("!", "?", "/") and mark:
            to = page.find(">", at) if at < ends.last else -1
            if to >= 0:
                at = to + 1
                continue
        yield "text", "<", ""
        at += 1


def blocks(page: str) -> Iterator[tuple[str, object]]:
    """('open', label), ('close', name) and ('text', (path, string)) of block-level elements, in order; paths
    are tuples of labels."""
    stack: list[tuple[str, str]] = []
    deep: list[str] = []  # open elements below MOST_DEPTH
    opened: Counter[str] = Counter()
    path: tuple[str, ...] = ()
    text: list[str] = []

    def flush() -> Iterator[tuple[str, object]]:
        if text:
            whole = " ".join(html_module.unescape("".join(text)).split())
            text.clear()
            if whole:
                yield "text", (path, whole)

    def pop(count: int) -> Iterator[tuple[str, object]]:
        nonlocal path
        for _ in range(count):
            if deep:
                opened[deep.pop()] -= 1
            else:
                name = stack.pop()[0]
                opened[name] -= 1
                yield "close", name
        path = path[:len(stack)]

    def names() -> Iterator[str]:
        """Open elements, the inmost first."""
        yield from reversed(deep)
        for x in reversed(stack):
            yield x[0]

    for kind, name, attributes in tokens(page):
        if kind == "text":
            text.append(name)
            continue
        if kind == "raw" or name == "br":
            text.append(" ")
            continue
        closing = kind == "close"
        marked = name not in BLOCK and not closing and name not in VOID and "hidden" in attributes
        if name not in BLOCK:
            if name in ("img", "input", "embed") and not marked:
                text.append(" ")
            continue
        if name in VOID:
            yield from flush()
            continue
        if closing:
            yield from flush()
            if opened[name]:
                yield from pop(next(k for k, x in enumerate(names()) if x == name) + 1)
            continue
        yield from flush()
        if next(names(), "") == "p":
            yield from pop(1)
        if name in CLOSES and any(opened[x] for x in CLOSES[name][0]):
            closed, stops = CLOSES[name]
            count = None
            for k, x in enumerate(names()):
                if x in stops or k > MOST_DEPTH:
                    break
                if x in closed:
                    count = k + 1
            if count:
                yield from pop(count)
        opened[name] += 1
        if len(stack) >= MOST_DEPTH:
            deep.append(name)
            continue
        label = label_of(name, attributes)
        stack.append((name, label))
        path = (*path, label)
        yield "open", label
    yield from flush()
    yield from pop(len(stack) + len(deep))


# ---- wrappers ----------------------------------------------------------------------------------------------

@dataclass(slots=True)
class Node:
    """A token of a wrapper: a tag, text (None: a slot) with its characters by region, or a group of nodes ('+',
    '?' or '*'). ``page``: the key of the only page that has it, None: several have; ``spare``: optional, while
    wrappers are aligned; ``form``: the shape, in which all text is alike."""

    kind: str
    value: object = None
    places: dict[tuple[str, ...], int] = field(default_factory=dict)
    body: list["Node"] = field(default_factory=list)
    page: int | None = None
    spare: bool = False
    form: str = ""

    def shape(self) -> str:
        if not self.form:
            if self.kind == "text":
                self.form = "#"
            elif self.kind == "group":
                whole = "(" + "".join(n.shape() for n in self.body) + ")"
                self.form = whole if len(whole) < 64 else "(" + hashlib.blake2b(whole.encode("utf-8", "replace"), digest_size=16).hexdigest() + ")"
            else:
                self.form = str(self.value)
        return self.form


def key_of(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def brief(text: str) -> str:
    """A text's value in a wrapper."""
    return text if len(text) <= LONGEST_VALUE else "~" + hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=16).hexdigest()


def stream(page: str) -> list[Node]:
    out = []
    key = key_of(page)
    for kind, value in blocks(page):
        if kind == "text":
            out.append(Node("text", brief(value[1]), {region_of(value[0]): len(value[1])}, page=key))
        else:
            out.append(Node("tag", f"<{value}>" if kind == "open" else f"</{value}>"))
    return out


def merge(a: Node, b: Node) -> Node:
    """Two nodes of one shape: text that differs becomes a slot, groups merge their bodies."""
    spare = a.spare or b.spare
    if a.kind == "text":
        places = dict(a.places)
        for place, chars in b.places.items():
            places[place] = places.get(place, 0) + chars
        return Node("text", a.value if a.value == b.value else None, places, page=a.page if a.page == b.page else None, spare=spare)
    if a.kind == "group":
        marks = {a.value, b.value}
        mark = a.value if len(marks) == 1 else "*" if "*" in marks or marks == {"+", "?"} else "+"
        return Node("group", mark, body=[merge(x, y) for x, y in zip(a.body, b.body)], spare=spare)
    return a if a.spare == spare else b


def fold(nodes: list[Node]) -> list[Node]:
    """Runs of one pattern to repeated groups, inner ones first."""
    shapes = [n.shape() for n in nodes]
    for length in range(1, LONGEST_PATTERN + 1):
        out, forms, done = [], [], 0
        # where a pattern of this length can begin: its first shape comes again behind it
        for at in compress(count(), map(eq, shapes, shapes[length:])):
            if at < done:
                continue
            pattern = shapes[at:at + length]
            if shapes[at + length:at + 2 * length] != pattern or not balanced(pattern):
                continue
            times = 2
            while shapes[at + times * length:at + (times + 1) * length] == pattern:
                times += 1
            body = [merged(nodes[at + k:at + times * length:length]) for k in range(length)]
            group = Node("group", "+", body=body)
            out += [*nodes[done:at], group]
            forms += [*shapes[done:at], group.shape()]
            done = at + times * length
        if done:
            nodes, shapes = out + nodes[done:], forms + shapes[done:]
    return nodes


def merged(nodes: list[Node]) -> Node:
    """Nodes of one shape as one."""
    if nodes[0].kind == "tag":
        return nodes[0]
    return reduce(merge, nodes)


def balanced(shapes: list[str]) -> bool:
    depth = 0
    for s in shapes:
        if s.startswith("</"):
            depth -= 1
        elif s.startswith("<"):
            depth += 1
        if depth < 0:
            return False
    return depth == 0 and bool(shapes) and not (len(shapes) == 1 and shapes[0].startswith("("))


def patterns(nodes: list[Node]) -> set[tuple[str, ...]]:
    """Shapes of the nodes of group bodies."""
    found = set()
    for n in nodes:
        if n.kind == "group":
            if n.value != "?":
                found.add(tuple(x.shape() for x in n.body))
            found |= patterns(n.body)
    return found


def by_first(known: set[tuple[str, ...]]) -> dict[str, list[tuple[str, ...]]]:
    """Patterns by the shape they begin with, the longest first."""
    out: dict[str, list[tuple[str, ...]]] = defaultdict(list)
    for pattern in sorted(known, key=lambda p: (-len(p), p)):
        if pattern:
            out[pattern[0]].append(pattern)
    return out


def regroup(nodes: list[Node], known: dict[str, list[tuple[str, ...]]], own: tuple[str, ...] = ()) -> list[Node]:
    """Single occurrences of known patterns but ``own`` to groups, so that they meet the groups of other pages."""
    out, at = [], 0
    shapes = [n.shape() for n in nodes]
    while at < len(nodes):
        for pattern in known.get(shapes[at], ()):
            if tuple(shapes[at:at + len(pattern)]) == pattern and pattern != own:
                body = nodes[at:at + len(pattern)]
                out.append(Node("group", "+", body=[replace(n, spare=False) for n in body], spare=all(n.spare for n in body)))
                at += len(pattern)
                break
        else:
            n = nodes[at]
            if n.kind == "group":
                n = Node("group", n.value, body=regroup(n.body, known, tuple(x.shape() for x in n.body)), spare=n.spare)
            out.append(n)
            at += 1
    return joined(out)


def joined(nodes: list[Node]) -> list[Node]:
    """Neighbouring groups of one pattern as one group."""
    out: list[Node] = []
    for n in nodes:
        if out and n.kind == "group" and out[-1].kind == "group" and out[-1].shape() == n.shape():
            both = merge(out[-1], n)
            out[-1] = Node("group", "+" if "+" in (out[-1].value, n.value) else "*", body=both.body,
                           spare=out[-1].spare and n.spare)
        else:
            out.append(n)
    return out


def optional(n: Node) -> Node:
    if n.kind == "group":
        return Node("group", {"+": "*"}.get(str(n.value), n.value), body=n.body)
    return Node("group", "?", body=[replace(n, spare=False)])


def bare(n: Node) -> Node:
    """What an optional token is when it is there."""
    return replace(n.body[0], spare=True) if n.kind == "group" and n.value == "?" and len(n.body) == 1 else n


def matched(a: list[str], b: list[str]) -> Iterator[tuple[int, int, int, int, bool]]:
    """Stretches (a0, a1, b0, b1, equal) that make up both lists of shapes, in order. Shapes that occur once in
    either list, in the longest run of common order, are the anchors; what lies between them is matched in turn."""
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        head = 0
        while a0 + head < a1 and b0 + head < b1 and a[a0 + head] == b[b0 + head]:
            head += 1
        if head:
            yield a0, a0 + head, b0, b0 + head, True
            a0, b0 = a0 + head, b0 + head
        if a0 == a1 or b0 == b1:
            if a0 < a1 or b0 < b1:
                yield a0, a1, b0, b1, False
            continue
        if (a1 - a0) * (b1 - b0) <= GAP_PAIRS:
            for op, i0, i1, j0, j1 in SequenceMatcher(None, a[a0:a1], b[b0:b1], autojunk=False).get_opcodes():
                yield a0 + i0, a0 + i1, b0 + j0, b0 + j1, op == "equal"
            continue
        left, right = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {x: b0 + k for k, x in enumerate(b[b0:b1]) if right[x] == 1}
        once = [(k, where[a[k]]) for k in range(a0, a1) if left[a[k]] == 1 and a[k] in where]
        tails: list[int] = []  # longest run of common order, by its smallest ends
        piles: list[int] = []
        before: list[int] = []
        for k, (_, at) in enumerate(once):
            place = bisect_left(tails, at)
            before.append(piles[place - 1] if place else -1)
            if place == len(tails):
                tails.append(at)
                piles.append(k)
            else:
                tails[place], piles[place] = at, k
        if not piles:
            yield a0, a1, b0, b1, False
            continue
        run, k = [], piles[-1]
        while k >= 0:
            run.append(once[k])
            k = before[k]
        parts, x, y = [], a0, b0
        for i, j in reversed(run):
            parts.append((x, i, y, j))
            x, y = i, j
        parts.append((x, a1, y, b1))
        work += reversed(parts)


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """The wrapper that fits what either of two wrappers, or folded pages, fits."""
    known = by_first(patterns(a) | patterns(b))
    left, right = (regroup([bare(n) for n in nodes], known) for nodes in (a, b))
    out: list[Node] = []
    for a0, a1, b0, b1, equal in matched([n.shape() for n in left], [n.shape() for n in right]):
        if equal:
            both = [merge(x, y) for x, y in zip(left[a0:a1], right[b0:b1])]
            out += [optional(n) if n.spare else n for n in both]
        else:
            out += [optional(n) for n in left[a0:a1]] + [optional(n) for n in right[b0:b1]]
    return joined(out)


def width(nodes: list[Node]) -> int:
    return sum(1 + width(n.body) for n in nodes)


def loose(n: Node) -> bool:
    return n.kind == "group" and n.value in ("?", "*")


def any_of(nodes: list[Node], plain: bool) -> Node:
    """A stretch of optional nodes as one repeated group of its patterns, all optional, which fits them in any
    order; ``plain``: of its tags without marks and of text."""
    found: dict[str, Node] = {}
    work = list(reversed(nodes))
    while work:
        n = work.pop()
        if n.kind == "group" and (plain or n.value == "?" or all(loose(x) for x in n.body)):
            work += reversed(n.body)
            continue
        if plain and n.kind == "tag":
            n = Node("tag", str(n.value).rstrip(">").split(".")[0] + ">")
        shape = n.shape()
        found[shape] = merge(found[shape], n) if shape in found else n
    return Node("group", "*", body=[optional(n) for n in found.values()])


def general(nodes: list[Node]) -> list[Node]:
    """A wrapper of more than MOST_NODES nodes with its stretches of optional nodes each as one group."""
    for plain in (False, True):
        if width(nodes) <= MOST_NODES:
            break
        out: list[Node] = []
        for spare, run in groupby(nodes, loose):
            stretch = list(run)
            out += [any_of(stretch, plain)] if spare and (len(stretch) > 1 or plain) else stretch
        nodes = out
    return nodes


def united(wrappers: Iterable[list[Node]]) -> list[Node]:
    """One wrapper of several, or of folded pages; those of one shape are merged first, text by text."""
    alike: dict[tuple[str, ...], list[Node]] = {}
    for nodes in wrappers:
        # a group's shape does not tell how often it occurs
        shape = tuple(f"{n.shape()}{n.value}" if n.kind == "group" else n.shape() for n in nodes)
        alike[shape] = [merge(x, y) for x, y in zip(alike[shape], nodes)] if shape in alike else nodes
    return reduce(lambda a, b: general(fold(align(a, b))), alike.values()) if alike else []


def infer(pages: list[str]) -> list[Node]:
    """The wrapper of a host's pages; equal pages count once."""
    return united(fold(stream(page)) for page in dict.fromkeys(pages))


def expression(nodes: list[Node]) -> str:
    """The wrapper as a regular expression; # is a slot."""
    parts = []
    for n in nodes:
        if n.kind == "group":
            parts.append("(" + expression(n.body) + ")" + str(n.value))
        elif n.kind == "text":
            parts.append("#" if n.value is None else str(n.value))
        else:
            parts.append(str(n.value))
    return "".join(parts)


def slots(nodes: list[Node]) -> Iterator[Node]:
    for n in nodes:
        if n.kind == "text":
            yield n
        elif n.kind == "group":
            yield from slots(n.body)


def words_of(label: str) -> set[str]:
    return {w for part in label.split(".")[1:] for w in WORDS.findall(part)}


@lru_cache(maxsize=20_000)
def goes(label: str, framed: bool, article: bool) -> bool:
    """Whether an element goes: ``article``: it stands inside the article; ``framed``: frames go too."""
    name, *marks = label.split(".")
    if name in DROP_ELEMENTS:
        return True
    if not article:
        words = words_of(label)
        return bool(words & set(DROP_WORDS)) or framed and (name == "header" or bool(words & set(FRAME_WORDS)))
    if "hidden" in marks:
        return True
    for mark in marks:
        words = WORDS.findall(mark)
        if any(w in DROP_WORDS and w not in DOUBTFUL for w in words) and all(w in DROP_WORDS or w in SHAPES for w in words):
            return True
    return False


@lru_cache(maxsize=4096)
def dropped(path: tuple[str, ...], main: int) -> bool:
    """Whether a path leads into a menu, notice, advert and so on; ``main``: labels that lead to the article."""
    return any(goes(label, not main, main > 0) for label in path[main:])


def rank_of(label: str) -> int:
    """How plainly an element says that it holds the article."""
    name, *marks = label.split(".")
    if "articlebody" in marks or name == "article":
        return 3
    if name == "main" or "main" in marks:
        return 2
    words = words_of(label)
    return int(bool(words & set(MAIN_WORDS)) and not words & {*PART_WORDS, *FRAME_WORDS, *DROP_WORDS})


@lru_cache(maxsize=20_000)
def region_of(path: tuple[str, ...]) -> tuple[str, ...]:
    """The labels of a path down to the first element that may hold the article; () if there is none."""
    for k in range(1, len(path) + 1):
        if rank_of(path[k - 1]) and not dropped(path[:k], 0):
            return path[:k]
    return ()


def region(places: dict[tuple[str, ...], int], varied: dict[tuple[str, ...], int] | None = None) -> tuple[str, ...]:
    """Labels that lead to the article, from characters by path: the plainest element that is not itself
    inside a dropped one, with most text, of equally plain ones that with most ``varied`` text; () if there is none."""
    weight: dict[tuple[str, ...], int] = defaultdict(int)
    slots_: dict[tuple[str, ...], int] = defaultdict(int)
    for path, chars in places.items():
        place = region_of(path)
        if place:
            weight[place] += chars
            slots_[place] += (varied or {}).get(path, 0)
    if not weight:
        return ()
    return max(weight, key=lambda p: (plainness(p), slots_[p], weight[p], p))


def plainness(place: tuple[str, ...]) -> int:
    return max(map(rank_of, place))


@dataclass
class Wrapper:
    """``main`` leads to the article."""

    main: tuple[str, ...]

    def to_json(self, nodes: list[Node] | None = None) -> str:
        own = {"main": self.main}
        return json.dumps(own if nodes is None else own | {"expression": expression(nodes)}, ensure_ascii=False)

    @staticmethod
    def from_json(text: str | None) -> "Wrapper":
        return Wrapper(tuple(json.loads(text)["main"]) if text else ())


def inside(path: tuple[str, ...], main: tuple[str, ...]) -> bool:
    return path[:len(main)] == main


def mark(nodes: list[Node]) -> Wrapper:
    """The region of a wrapper. Without one, text of the page's frame is told apart by ``template_texts``."""
    places: dict[tuple[str, ...], int] = defaultdict(int)
    varied: dict[tuple[str, ...], int] = defaultdict(int)
    for s in slots(nodes):
        for place, chars in s.places.items():
            places[place] += chars
            if s.value is None or s.page is not None:  # other text is template
                varied[place] += chars
    return Wrapper(region(places, varied))


def settled(nodes: list[Node], last: bool) -> dict[tuple[str, ...], list[int]]:
    """(varied, all) characters by region of the texts that no further page can change, which the wrapper gives
    up: slots, and at the ``last`` merge all."""
    out: dict[tuple[str, ...], list[int]] = defaultdict(lambda: [0, 0])
    for s in slots(nodes):
        if last or s.value is None:
            for place, chars in s.places.items():
                out[place][0] += chars if s.value is None or s.page is not None else 0
                out[place][1] += chars
            s.places = {}
    out.pop((), None)
    return out


def packed(nodes: list[Node]) -> str:
    """A wrapper as text: tags are strings, groups {mark: nodes}, texts [value, characters by region, page]."""
    regions: dict[tuple[str, ...], int] = {}
    owners: dict[int | None, int] = {}

    def pack(n: Node) -> object:
        if n.kind == "tag":
            return n.value
        if n.kind == "group":
            return {n.value: [pack(x) for x in n.body]}
        return [n.value, [x for place, chars in n.places.items() for x in (regions.setdefault(place, len(regions)), chars)],
                owners.setdefault(n.page, len(owners))]

    body = [pack(n) for n in nodes]
    return json.dumps([list(regions), list(owners), body], separators=(",", ":"))


def unpacked(text: str) -> list[Node]:
    regions, owners, body = json.loads(text)
    regions = [tuple(r) for r in regions]

    def unpack(x: object) -> Node:
        if isinstance(x, str):
            return Node("tag", x)
        if isinstance(x, dict):
            (mark_, inner), = x.items()
            return Node("group", mark_, body=[unpack(y) for y in inner])
        return Node("text", x[0], {regions[r]: chars for r, chars in zip(x[1][::2], x[1][1::2])}, page=owners[x[2]])

    return [unpack(x) for x in body]


def extract(page: str | None, wrapper: Wrapper, template: frozenset[int] = frozenset()) -> str:
    """The page's main text through its host's wrapper, without its host's ``template`` texts (of ``key_of``)."""
    texts = [value for kind, value in blocks(page or "") if kind == "text"]
    main = wrapper.main
    if main and not any(inside(path, main) for path, _ in texts) or not main:
        places: dict[tuple[str, ...], int] = defaultdict(int)
        for path, text in texts:
            places[path] += len(text)
        main = region(places)
    out = []
    for path, text in texts:
        if inside(path, main) and not dropped(path, len(main)) and not (template and not main and key_of(*path, "", text) in template):
            out.append(text)
    return "\n".join(out)


# ---- over tables ---------------------------------------------------------------------------------------------

def host_of(url: str = "url"):
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def folded_pages(pages: DataFrame) -> DataFrame:
    """(host, page, nodes): the different pages of each host, folded."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"host": frame["host"], "page": [key_of(page) for page in frame["html"]],
                                "nodes": [packed(fold(stream(page))) for page in frame["html"]]})

    return (pages.where("html is not null and html <> ''").select(host_of().alias("host"), "html")
            .mapInPandas(run, "host string, page long, nodes string")
            .groupBy("host", "page").agg(F.first("nodes").alias("nodes")))


def infer_wrappers(pages: DataFrame, part_chars: int = PART_CHARS, fan: int = FAN) -> DataFrame:
    """(host, wrapper, expression), fitted on all pages of a host: wrappers of its parts, of about ``part_chars``
    characters of folded pages, are merged ``fan`` at a time; ``wrapper`` is what ``extract`` needs."""
    folded = stored(folded_pages(pages), "html-folded")
    parts = stored(folded.groupBy("host").agg(F.ceil(F.sum(F.length("nodes")) / part_chars).alias("parts")), "html-parts")
    rows = folded.join(parts, "host").select("host", F.pmod("page", "parts").alias("part"), "parts", F.col("page").alias("at"), "nodes")

    def work(cols: dict) -> tuple:
        parts_ = int(cols["parts"][0])
        order = sorted(range(len(cols["at"])), key=lambda k: int(cols["at"][k]))
        nodes = united(unpacked(cols["nodes"][k]) for k in order)
        tally = settled(nodes, parts_ == 1)
        return ([cols["host"][0]], [int(cols["part"][0])], [parts_], [packed(nodes)],
                [json.dumps([{"place": p, "rank": plainness(p), "varied": v, "chars": c} for p, (v, c) in tally.items()])],
                [expression(nodes) if parts_ == 1 else None])

    rounds = []
    most = parts.agg(F.max("parts")).first()[0] or 1
    while True:
        done = stored(by_group(rows, ["host", "part"], work, "host string, part long, parts long, nodes string, tally string, "
                                                             "expression string"), "html-round")
        rounds.append(done)
        if most == 1:
            break
        most = -(-most // fan)
        rows = done.where("parts > 1").select("host", F.floor(F.col("part") / fan).alias("part"), F.ceil(F.col("parts") / fan).alias("parts"),
                                              F.col("part").alias("at"), "nodes")
    made = reduce(DataFrame.unionByName, rounds)
    tally = F.from_json("tally", "array<struct<place: array<string>, rank: int, varied: long, chars: long>>")
    mains = (made.select("host", F.inline(tally)).groupBy("host", "place", "rank")
             .agg(F.sum("varied").alias("varied"), F.sum("chars").alias("chars"))
             .groupBy("host").agg(F.max(F.struct("rank", "varied", "chars", "place")).alias("best")))
    main = F.coalesce("best.place", F.array().cast("array<string>"))
    return (made.where("parts = 1").select("host", "expression").join(mains, "host", "left")
            .select("host", F.to_json(F.struct(main.alias("main"))).alias("wrapper"), "expression"))


def template_texts(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, template): keys of the template texts of ``hosts``, told over all of their pages."""
    of_hosts = (pages.where("html is not null and html <> ''").select(host_of().alias("host"), "html")
                .join(hosts, "host", "left_semi"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = set()
            for host, page in zip(frame["host"], frame["html"]):
                own = key_of(page)
                for kind, value in blocks(page):
                    if kind == "text" and not dropped(value[0], 0):
                        out.add((host, own, key_of(*value[0]), key_of(*value[0], "", value[1])))
            yield pd.DataFrame(sorted(out), columns=["host", "page", "place", "text"])

    # copies of a page count once
    seen = of_hosts.mapInPandas(run, "host string, page long, place long, text long")
    texts = stored(seen.distinct().groupBy("host", "place", "text").agg(F.count("*").alias("n")), "html-texts")
    places = stored(seen.select("host", "page", "place").distinct().groupBy("host", "place").agg(F.count("*").alias("pages")),
                    "html-places")
    same = (F.col("n") == F.col("pages")) & (F.col("n") > 1)
    return (texts.join(places, ["host", "place"]).groupBy("host")
            .agg(F.collect_set(F.when(same, F.col("text"))).alias("template"), F.max(~same).alias("own"))
            .where("own").select("host", "template"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    text_batches(pages.sparkSession)
    wrappers = stored(infer_wrappers(pages).drop("expression"), "html-wrappers")
    rows = pages.select("page_id", "url", "html", host_of().alias("host"))
    unmarked = wrappers.where(F.get_json_object("wrapper", "$.main") == "[]").select("host")
    template = F.lit(None).cast("string")
    if not unmarked.isEmpty():
        same = stored(template_texts(pages, unmarked).select("host", F.array_join(F.col("template").cast("array<string>"), " ")
                                                             .alias("template")), "html-template")
        wrappers, template = wrappers.join(same, "host", "left"), F.col("template")
    joined = rows.join(wrappers, "host", "left").select(F.col("page_id").cast("string").alias("page_id"), "url", "html", "wrapper",
                                                        template.alias("template"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[tuple[str | None, str | None], tuple[Wrapper, frozenset[int]]] = {}
        for frame in frames:
            texts = []
            for page, *key in zip(frame["html"], frame["wrapper"], frame["template"]):
                key = tuple(key)
                if key not in cache:
                    if len(cache) > 2000:
                        cache.clear()
                    cache[key] = Wrapper.from_json(key[0]), frozenset(int(x) for x in (key[1] or "").split())
                texts.append(extract(page, *cache[key]))
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    return (joined.mapInPandas(run, "page_id string, url string, text string, n_chars long")
            .withColumn("page_id", F.col("page_id").cast("long")))
