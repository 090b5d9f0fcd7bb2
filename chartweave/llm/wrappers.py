"""Main text of web pages by wrappers that are inferred from the pages of a host."""

from __future__ import annotations

import html as entities
import json
import re
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, slices

# Elements that run inside a line, elements without content, and elements that never hold an
# article's text; class, id and role tokens that tell the same, alone or in one token with other such parts.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br img".split()
)
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = set(
    "nav header footer aside form button select option textarea input fieldset dialog menu iframe object svg canvas head "
    "title meta link base".split()
)
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar side widget menu "
    "nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar header masthead footer copyright social "
    "share sharing related recommended comment comments reply replies respond responses disqus".split()
)
ASIDE_PARTS = set(
    "area banner bar block box btn button buttons col column container content form icon icons inner item items legal link "
    "links list message page panel post posts reader readers section site slot text thread top bottom unit user users wrap "
    "wrapper".split()
)
# Class and id words of an author and of a date, elements of headings and of tables.
AUTHOR_WORDS = set("author byline commenter nick nickname user username".split())
DATE_WORDS = set("date datetime posted published time timestamp".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
TABLE = set("table thead tbody tfoot tr td th dl dt dd".split())
SECTIONS = ("article", "main")
WHOLE = ("page", "html", "body", *SECTIONS)
FAN = 64
LINK_SHARE = 0.6
SAME_PAGES = 5
MOST = 0.5
MARKED = 0.8
BYLINE = 100
#: texts that are counted in a slot, as in a summary of frequent items
COUNTED = 32
DATED, NAMED = 1, 2

_RAW = r"<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)"
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|{_RAW}|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>", re.S | re.I
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_MONTH = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
_DATE = re.compile(
    rf"\b\d{{4}}-\d\d?-\d\d?|\b\d\d?[./]\d\d?[./]\d\d(?:\d\d)?\b|\b\d\d?(?:st|nd|rd|th)?\s+{_MONTH}\s|\b{_MONTH}\s+\d\d?\b"
    rf"|\b\d\d?(?:st|nd|rd|th)?\s+{_MONTH}$|\b\d+\s+(?:second|minute|hour|day|week|month|year)s?\s+ago\b", re.I
)
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
              "th": {"td", "th"}, "option": {"option"}}


class Node:
    """An element or a text ("#") of a page, or the same places of many pages in a wrapper."""

    __slots__ = ("label", "children", "text", "links", "pages", "chars", "values", "uses", "dated", "named", "marks",
                 "optional", "repeated")

    def __init__(self, label: str):
        self.label, self.children, self.text = label, [], ""
        self.links = self.chars = self.uses = self.dated = self.named = self.marks = 0
        self.pages = 1
        #: hash of a text -> pages that have it in this place, at least
        self.values: dict[str, int] = {}
        self.optional = self.repeated = False

    def dump(self) -> list:
        """Rows of all places, each before its children; flat, since pages may be nested to any depth."""
        rows, todo = [], [self]
        while todo:
            n = todo.pop()
            rows.append([n.label, len(n.children), n.pages, n.chars, n.links, n.uses, n.dated, n.named, n.values,
                         n.optional, n.repeated])
            todo += reversed(n.children)
        return rows

    @classmethod
    def load(cls, rows) -> Node:
        top = cls("")
        open_places = [[top, 1]]
        for row in rows:
            node = cls(row[0])
            node.pages, node.chars, node.links, node.uses, node.dated, node.named, node.values = row[2:9]
            node.optional, node.repeated = row[9:]
            _attach(open_places, node, row[1])
        return top.children[0]

    def pattern(self) -> str:
        """The wrapper as a regular expression over tags, with ``#`` for text slots."""
        parts, todo = [], [self]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                parts.append(n)
                continue
            end = ")" + ("?" if not n.repeated else "*" if n.optional else "+") if n.repeated or n.optional else ""
            parts.append("(" if end else "")
            todo.append(end)
            if n.label == "#":
                parts.append("#")
            else:
                if n.label[0] != "(":
                    parts.append(f"<{n.label}>")
                    todo.append("</>")
                todo += reversed(n.children)
        return "".join(parts)


def _attach(open_places: list, node, children: int) -> None:
    """Put the next node of a list in preorder below the innermost place that still lacks children."""
    while not open_places[-1][1]:
        open_places.pop()
    open_places[-1][0].children.append(node)
    open_places[-1][1] -= 1
    open_places.append([node, children])


def parse(html: str | None) -> Node:
    """The block elements of a page, with their texts; inline elements only tell what is a link."""
    root = Node("page")
    stack, names = [root], ["page"]
    open_names: dict[str, int] = {}
    at = in_link = marks = 0
    source = html or ""

    def put(text: str) -> None:
        nonlocal marks
        if not text:
            return
        last = stack[-1].children
        if not last or last[-1].label != "#":
            if not text.strip():
                return
            last.append(Node("#"))
        last[-1].text += text
        if text.strip():
            last[-1].marks |= marks
            marks = 0
        if in_link:
            last[-1].links += len(text.strip())

    def close(to: int) -> None:
        for name in names[to:]:
            open_names[name] -= 1
        del stack[to:], names[to:]

    for m in _TAG.finditer(source):
        if m.start() > at:
            put(source[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            if stack[-1].children and stack[-1].children[-1].label == "#":
                put(" ")
        elif name in INLINE:
            if name == "a":
                in_link = 0 if m[2] else 1
            if not m[2]:
                marks |= DATED if name == "time" else _marks_of(_label(name, m[4]))
        elif m[2]:
            if open_names.get(name):
                to = len(names) - 1
                while names[to] != name:
                    to -= 1
                close(to)
            in_link = marks = 0
        else:
            while names[-1] == "p" or names[-1] in _CLOSED_BY.get(name, ()):
                close(len(names) - 1)
            in_link = marks = 0
            node = Node(_label(name, m[4]))
            stack[-1].children.append(node)
            if name not in EMPTY and not m[4].endswith("/"):
                stack.append(node)
                names.append(name)
                open_names[name] = open_names.get(name, 0) + 1
    put(source[at:])
    return root


def _label(name: str, attributes: str) -> str:
    words = set()
    if "=" in attributes:
        for m in _NAMES.finditer(attributes):
            tokens = (m[1] or m[2] or m[3] or "").lower().split()
            words.update("-".join(re.findall(r"[a-z]+", token)) for token in tokens)
    words.discard("")
    return ".".join([name, *sorted(words)])


@lru_cache(maxsize=100_000)
def _marks_of(label: str) -> int:
    words = {word for token in label.split(".")[1:] for word in token.split("-")}
    return (DATED if words & DATE_WORDS else 0) | (NAMED if words & AUTHOR_WORDS else 0)


def block_text(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def _digest(text: str) -> str:
    return blake2b(text.encode(), digest_size=8).hexdigest()


def _slot(node: Node, around: str) -> Node:
    """A text of a page as a slot: whether it is short and tells an author or a date, and its hash."""
    text = block_text(node.text)
    out = Node("#")
    out.chars, out.links, out.uses = len(text), min(len(text), node.links), 1
    if len(text) <= BYLINE:
        marks = node.marks | _marks_of(around)
        date = _DATE.search(text)
        out.dated = int(bool(marks & DATED or date))
        rest = text.replace(date[0], "") if date else ""
        out.named = int(bool(marks & NAMED or re.search(r"[^\W\d_]{2}", rest)))
    elif node.marks == DATED | NAMED:
        out.dated = out.named = 1
    out.values = {_digest(text): 1}
    return out


def grouped(node: Node) -> Node:
    """The page's tree as a wrapper of its own, with repeated stretches of a stream as one repeated group."""
    top = Node("")
    todo = [(node, top, iter([node]))]
    while todo:
        around, out, rest = todo[-1]
        child = next(rest, None)
        if child is None:
            todo.pop()
            if todo:
                _collapse(todo[-1][1].children)
        elif child.label == "#":
            out.children.append(_slot(child, around.label))
            _collapse(out.children)
        else:
            out.children.append(Node(child.label))
            todo.append((child, out.children[-1], iter(child.children)))
    return top.children[0]


def _collapse(stream: list[Node]) -> None:
    """Fold the end of a stream into what it repeats: the same label, or a stretch of any length."""
    if len(stream) > 1 and stream[-1].label == stream[-2].label:
        last = stream.pop()
        stream[-1] = joined(stream[-1], last, 1)
        stream[-1].repeated = True
    if len(stream) < 3:
        return
    labels = [n.label for n in stream]
    for size in range(2, len(stream)):
        before = labels[-size - 1]
        if before[0] == "(" and before == f"({' '.join(labels[-size:])})":
            group = stream[-size - 1]
            group.children = [joined(a, b, 1) for a, b in zip(group.children, stream[-size:])]
            del stream[-size:]
            return
        if before == labels[-1] and 2 * size <= len(stream) and labels[-2 * size : -size] == labels[-size:]:
            group = Node(f"({' '.join(labels[-size:])})")
            group.repeated = True
            group.children = [joined(a, b, 1) for a, b in zip(stream[-2 * size : -size], stream[-size:])]
            stream[-2 * size :] = [group]
            return


def _counted(a: dict[str, int], b: dict[str, int]) -> dict[str, int]:
    """Counts of two lots of pages as one; beyond COUNTED texts all lose what the next one has, so none is overstated."""
    out = dict(a)
    for value, n in b.items():
        out[value] = out.get(value, 0) + n
    if len(out) > COUNTED:
        less = sorted(out.values(), reverse=True)[COUNTED]
        out = {value: n - less for value, n in out.items() if n > less}
    return out


def joined(a: Node, b: Node, pages: int | None = None) -> Node:
    """Two wrappers of one label as one: their streams are aligned, and what only one of them has is optional.

    ``pages`` is 1 if both are of one page, where a text counts once.
    """

    def both(x: Node, y: Node) -> Node:
        out = Node(x.label)
        out.pages = pages or x.pages + y.pages
        out.chars, out.links, out.uses = x.chars + y.chars, x.links + y.links, x.uses + y.uses
        out.dated, out.named = x.dated + y.dated, x.named + y.named
        out.values = {**x.values, **y.values} if pages else _counted(x.values, y.values)
        out.optional, out.repeated = x.optional or y.optional, x.repeated or y.repeated
        return out

    top = both(a, b)
    todo = [(top, a, b)]
    while todo:
        out, left, right = todo.pop()
        for x, y in aligned(left.children, right.children):
            if x and y:
                out.children.append(both(x, y))
                if x.children or y.children:
                    todo.append((out.children[-1], x, y))
            else:
                only = x or y
                only.optional = True
                out.children.append(only)
    return top


def aligned(left: list[Node], right: list[Node]) -> list[tuple[Node | None, Node | None]]:
    """Pairs of a longest common subsequence of labels, and the rest alone, in order."""
    a, b = [n.label for n in left], [n.label for n in right]
    if a == b:
        return list(zip(left, right))
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, under = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = under[j + 1] + 1 if a[i] == b[j] else max(under[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((left[i], right[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append((left[i], None))
            i += 1
        else:
            out.append((None, right[j]))
            j += 1
    return out + [(n, None) for n in left[i:]] + [(None, n) for n in right[j:]]


@lru_cache(maxsize=100_000)
def _aside_label(label: str) -> bool:
    name, *tokens = label.split(".")
    if name in ASIDE:
        return True
    if name in WHOLE or name[0] == "(":
        return False
    split = [token.split("-") for token in tokens]
    return any(not ASIDE_WORDS.isdisjoint(t) and ASIDE_WORDS.union(ASIDE_PARTS).issuperset(t) for t in split)


def _is_aside(node: Node) -> bool:
    return _aside_label(node.label)


def _links_here(node: Node) -> bool:
    """Whether an element of a page is mostly links, without its asides."""
    chars = links = 0
    for part in _inside(node):
        text = block_text(part.text)
        chars, links = chars + len(text), links + min(len(text), part.links)
    return links > LINK_SHARE * chars


def _inside(node: Node):
    """A node and what lies in it, in page order, without its asides."""
    todo = [node]
    while todo:
        part = todo.pop()
        yield part
        todo += reversed([c for c in part.children if not _is_aside(c)])


def _name(node: Node) -> str:
    return node.label.split(".")[0]


class Place:
    """A place of a finished wrapper: what is left out there, and its stream with groups laid open."""

    __slots__ = ("label", "aside", "links", "comment", "template", "children")

    def __init__(self, label, aside, links, comment, template):
        self.label, self.aside, self.links, self.comment, self.template = label, aside, links, comment, template
        self.children: list[Place] = []


def _template_texts(wrapper: Node) -> dict[int, list[str]]:
    """Texts of a slot that most pages with the slot have, SAME_PAGES of them or more, if it has few others.

    Inside article and main, headings and tables have none. They are judged with all texts in the outermost place that just these pages have. If nothing varies there,
    the place holds copies of one page, and none is a template; inside article and main what varies must also
    be no less than what is alike, so that pages which differ in little keep their text.
    """
    found: dict[int, list[str]] = {}
    inside: set[int] = set()
    kept: set[int] = set()
    order, todo = [], [wrapper]
    while todo:
        node = todo.pop()
        order.append(node)
        for child in node.children:
            if not _is_aside(child):
                if id(node) in inside or _name(child) in SECTIONS:
                    inside.add(id(child))
                    if id(node) in kept or _name(child) in HEADINGS or _name(child) in TABLE:
                        kept.add(id(child))
                todo.append(child)
    #: node -> slots alike, and characters that vary, of the places that have the node's pages
    alike: dict[int, list[tuple[Node, list[str], float]]] = {}
    varying: dict[int, float] = {}
    for node in reversed(order):
        same, varies = [], 0.0
        if node.label == "#":
            texts = [v for v, n in node.values.items() if n >= max(SAME_PAGES, MOST * node.pages)]
            share = min(1.0, sum(node.values[v] for v in texts) / max(node.uses, 1))
            if share < MARKED or id(node) in kept:
                share = 0.0
            varies = node.chars * (1 - share)
            if share:
                same.append((node, texts, node.chars * share))
        for child in node.children:
            if _is_aside(child):
                continue
            own, v = alike.pop(id(child)), varying.pop(id(child))
            varies += v
            if child.pages == node.pages:
                same += own
            elif child.label != "#":
                _settle(found, inside, own, v)
        alike[id(node)], varying[id(node)] = same, varies
    _settle(found, inside, alike[id(wrapper)], varying[id(wrapper)])
    return found


def _settle(found, inside, same, varies: float) -> None:
    held = sum(chars for node, _, chars in same if id(node) in inside)
    for node, texts, _ in same:
        if varies > 0 and (id(node) not in inside or varies >= held):
            found[id(node)] = texts


def _is_comments(node: Node) -> bool:
    """A repeated place whose every copy has an author and a date beside a longer text, and no heading."""
    if not node.repeated or node.label == "#" or _name(node) in WHOLE or _name(node) in TABLE:
        return False
    dated = named = False
    byline = rest = slots = 0
    for part in _inside(node):
        if _name(part) in HEADINGS or _name(part) in TABLE:
            return False
        if part.label == "#":
            slots += 1
            is_dated, is_named = part.dated >= MARKED * part.uses, part.named >= MARKED * part.uses
            dated, named = dated or is_dated, named or is_named
            if is_dated or is_named:
                byline += part.chars
            else:
                rest += part.chars
    return dated and named and slots > 1 and rest > byline


def finished(wrapper: Node) -> list:
    """What the wrapper decides, as rows in preorder: label, number of children, aside, links, comments, template texts."""
    templates = _template_texts(wrapper)
    totals: dict[int, tuple[int, int]] = {}
    order, todo = [], [wrapper]
    while todo:
        order.append(todo.pop())
        todo += order[-1].children
    for node in reversed(order):
        counted = [totals[id(c)] for c in node.children if not _is_aside(c)]
        totals[id(node)] = node.chars + sum(c for c, _ in counted), node.links + sum(k for _, k in counted)

    rows, stack, before = [], [(wrapper, False, False)], 0
    while stack:
        node, comment, laid_open = stack.pop()
        chars, links = totals[id(node)]
        mostly_links = chars > 0 and links > LINK_SHARE * chars and _name(node) not in (*WHOLE, "p")
        stream, todo = [], [(c, False) for c in reversed(node.children)]
        while todo:
            child, mark = todo.pop()
            mark = mark or (_is_comments(child) and _ends(child, node.children))
            if child.label[0] == "(":
                todo += [(c, mark) for c in reversed(child.children)]
            else:
                stream.append((child, mark, False))
        aside = _is_aside(node)
        if node.label == "#" and not comment:
            before += node.chars
        rows.append([node.label, len(stream), aside, mostly_links, bool(comment and before), templates.get(id(node), [])])
        if aside:
            rows[-1][1] = 0
        else:
            stack += reversed(stream)
    return rows


def _ends(place: Node, stream: list[Node]) -> bool:
    """Whether no paragraph and no heading of the stream comes after the place."""
    after = reversed(stream)
    return not any(_name(n) == "p" or _name(n) in HEADINGS for n in iter(lambda: next(after, place), place))


class Wrapper:
    """A host's finished wrapper, ready to be applied to its pages."""

    def __init__(self, rows: list):
        top = Place("", False, False, False, [])
        open_places: list = [[top, 1]]
        for label, children, *rest in rows:
            _attach(open_places, Place(label, *rest), children)
        self.root = top.children[0]

    def main_blocks(self, page: Node) -> list[str]:
        """The texts of a page in the wrapper's content slots, in page order.

        If the page itself has article (else main) elements outside its asides, only what lies in them counts.
        """
        blocks: list[tuple[str, frozenset[str]]] = []
        met: set[str] = set()
        #: open elements: slot, next children, place reached, sections around, in a list of links, heading just before
        stack = [[self.root, iter(page.children), 0, frozenset(), False, None]]
        while stack:
            top = stack[-1]
            slot, rest, at, inside, listed, heading = top
            child = next(rest, None)
            if child is None:
                stack.pop()
                continue
            places = slot.children
            ahead = (k for part in (range(at, len(places)), range(at)) for k in part)
            at = top[2] = next(k for k in ahead if places[k].label == child.label)
            place = places[at]
            if place.aside:
                continue
            if place.comment and blocks and all(_name(part) not in HEADINGS for part in _inside(child)):
                if heading is not None and heading > 0:  # a heading right before the comments is theirs
                    del blocks[heading:]
                    top[5] = None
                continue
            links = place.links and _links_here(child)
            if links and not inside:
                continue
            if child.label == "#":
                text = block_text(child.text)
                if text and not (place.template and _digest(text) in place.template):
                    blocks.append((text, inside))
                continue
            name = _name(child)
            top[5] = len(blocks) if name in HEADINGS else None
            if name in SECTIONS and not listed:  # teasers in a list of links are no section
                met.add(name)
                stack.append([place, iter(child.children), 0, inside | {name}, False, None])
            else:
                stack.append([place, iter(child.children), 0, inside, listed or links, None])
        section = next((s for s in SECTIONS if s in met), None)
        return [text for text, around in blocks if section is None or section in around]


def _partial(batches):
    """A wrapper per host of the task's pages; pages of one shape are summed before shapes are aligned."""
    wrappers: dict[str, Node] = {}
    for batch in slices(batches, "html"):
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = grouped(parse(html))
            wrappers[host] = joined(wrappers[host], page) if host in wrappers else page
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(wrappers), pa.string()), pa.array([json.dumps(w.dump()) for w in wrappers.values()], pa.string())],
        names=["host", "wrapper"],
    )


def _fold(key, rows):
    wrapper = None
    for text in sorted(rows.column("wrapper").to_pylist()):
        node = Node.load(json.loads(text))
        wrapper = joined(wrapper, node) if wrapper else node
    keys = {name: [value.as_py()] for name, value in zip(("host", "part"), key)}
    return pa.table({**keys, "wrapper": pa.array([json.dumps(wrapper.dump())], pa.string())})


def _finish(batches):
    for batch in batches:
        hosts = [Node.load(json.loads(text)) for text in batch.column("wrapper").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("host"), pa.array([json.dumps(finished(w)) for w in hosts], pa.string()),
                pa.array([w.pattern() for w in hosts], pa.string()),
            ],
            names=["host", "wrapper", "pattern"],
        )


def host_of(url: str = "url"):
    """The host of an address, lower-case, without user, port and what follows; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host``, ``wrapper`` (JSON) and ``pattern``, a union-free regular expression over tags, of every host.

    Every page takes part. The pages of a task are aligned one after another: neighbours of one label become
    repeated groups, what a page lacks becomes optional, texts become slots. The tasks' wrappers, one small row
    per task and host, are aligned in the same way in a tree: those of FAN neighbouring tasks, then of FAN such
    groups, then the rest. ``wrapper`` holds what is left out in each place, not the counts behind it.
    """
    rows = pages.select(host_of(url_col).alias("host"), F.col(f"`{html_col}`").cast("string").alias("html"))
    partial = rows.mapInArrow(_partial, "host string, wrapper string").withColumn("part", F.spark_partition_id())
    for _ in range(2):
        partial = partial.withColumn("part", F.floor(F.col("part") / FAN).cast("long"))
        partial = partial.groupBy("host", "part").applyInArrow(_fold, "host string, part long, wrapper string")
    folded = partial.groupBy("host").applyInArrow(_fold, "host string, wrapper string")
    return folded.mapInArrow(_finish, "host string, wrapper string, pattern string")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: the id, the address and ``text``, the main text with one block a line.

    Slots of the host's wrapper are content unless they lie in a menu, header, footer, sidebar, notice, advert,
    form or comment element, or outside of article and main are mostly links. A class, id or role tells such an
    element if one of its tokens consists of known words only (``promo-box``, not ``share-price``), but never on
    html, body, article or main. Two more things follow from the host's pages, inside sections and outside:
    a text that most pages with its slot have, five or more, is a template if four in five texts of the slot are
    such, unless these pages are copies or (inside sections) alike in more than they differ, or it lies in a
    heading or table of a section; and a repeated place after other text is reader comments
    if its copies have an author and a date beside a longer text and no heading, and no paragraph or heading
    follows it; a heading right before it goes too. A slot counts 32 texts, so that where a page has
    very many a template may be missed, but no other text is taken for one. Of a page that has article
    (else main) elements, only what lies inside them is content. Elements may be nested to any depth.
    Character references are decoded,
    white space inside a block becomes one blank, line breaks inside a block too. Null and empty pages have an
    empty text; pages without a host share one wrapper; repeated rows get a row each; a null id stays null; an
    empty table gives an empty result; no other column is read.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    wrappers = saved(infer_wrappers(pages, url_col, html_col).select("host", "wrapper"))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        host_of(url_col).alias("host"), F.col(f"`{html_col}`").cast("string").alias("html"),
    )

    def work(batches):
        known: dict[str, Wrapper] = {}
        for batch in slices(batches, "html"):
            texts = []
            for html, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
                if wrapper not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[wrapper] = Wrapper(json.loads(wrapper))
                texts.append("\n".join(known[wrapper].main_blocks(parse(html))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"]
            )

    joined_rows = rows.join(wrappers, "host").select("id", "url", "html", "wrapper")
    return joined_rows.mapInArrow(work, f"id {kind}, url string, text string").toDF(id_col, url_col, "text")
