"""Main text of web pages by wrapper induction (operator 7).

The pages of a host are parsed into trees of block elements, where neighbouring siblings of one kind count as one
repeated node. The trees are aligned by simple tree matching and merged into the host's wrapper, which knows for each
node on how many pages it stands and how much text and link text it holds. A second pass aligns the pages with the
finished wrapper and counts, exactly, on how many pages of the host a node has each of its texts. Nodes whose text is
constant are template, nodes whose text varies are slots; kinds of elements that never belong to an article, and slots
made of links, are left out; what the remaining slots hold under the article's root is the page's text.

Wrappers are built where the pages lie: a task gives one small wrapper for each host, tasks' wrappers are merged in two
rounds, so a host with a third of all pages costs a merge of few small trees. Counts are dealt by host, node and text.
Pages are not moved; the finished
wrappers go to them by a broadcast while their size allows it, else by a join that adaptive execution can split.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, cut, map_batches, narrow

#: All wrappers together may be broadcast up to so many bytes.
BROADCAST_BYTES = 16 << 20
#: Elements nested deeper are read as if they stood side by side.
MAX_DEPTH = 200
#: Counts that a task holds before it passes them on.
HELD_COUNTS = 50_000
#: Page shapes that a task holds before it merges them.
HELD_SHAPES = 1000
#: A text is constant if this share of at least CONSTANT_PAGES pages has it.
CONSTANT_SHARE, CONSTANT_PAGES = 0.8, 4
#: Slots with more link text than this share are menus.
LINK_SHARE = 0.6

# Elements without content, inside a line, with raw text, and with an end that may be left out.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split()
)
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table article section div main body td th".split())

# Elements and words of class, id or role that mark what is no article.
_DROP_TAGS = frozenset(
    "head nav footer aside form script style noscript iframe object svg canvas template button select textarea input dialog menu audio video map".split()
)
_DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion banner cookie cookies consent gdpr notice notices popup modal overlay "
    "sidebar sidenav menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist disqus replies reply respond related recommended share sharing social "
    "newsletter subscribe subscription signup login search pagination pager widget widgets toolbar contentinfo complementary hidden".split()
)
_COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
_ROOT_WORDS = frozenset("article articlebody post entry story content main".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    """An element; ``parts`` are its texts, child elements, and True and False where a link begins and ends.

    ``code`` stands for the element's own text.
    """

    __slots__ = ("code", "group", "label", "parts", "tag")

    def __init__(self, tag: str, label: str) -> None:
        self.tag, self.label, self.parts, self.group, self.code = tag, label, [], None, 0


@lru_cache(maxsize=4096)
def _label(tag: str, attributes: str) -> str:
    """Tag and the words of class, id, role and itemprop; digits and order do not matter."""
    words: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() == "hidden" or (name.lower() == "aria-hidden" and "true" in value.lower()):
            words.add("hidden")
        elif name.lower() != "aria-hidden":
            spaced = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value)
            words.update(_WORDS.findall(spaced.lower()))
    return ".".join([tag, *sorted(words)])


def parse(html: str) -> Node:
    """Tree of the block elements; elements inside a line leave only their text."""
    root = Node("#", "#")
    stack, raw, at = [root], None, 0
    for m in _TAG.finditer(html):
        if m.start() < at:
            continue
        here = stack[-1]
        if m.start() > at:
            here.parts.append(html[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue  # comment or declaration
        tag = name.lower()
        if m[1]:
            if tag in _INLINE:
                if tag == "a":
                    here.parts.append(False)
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if tag == "p" or stack[depth].tag in ("article", "body"):
                    if tag != "body" and tag != "html":
                        break  # a stray end does not close what is around
            continue
        if tag in _INLINE:
            here.parts.append(" " if tag in ("br", "img", "wbr") else True if tag == "a" else "")
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            here.parts.append(Node(tag, tag))
            continue
        if tag in _CLOSES_P and here.tag == "p":
            stack.pop()
        elif tag in _CLOSED_BY:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in _CLOSED_BY[tag]:
                    del stack[depth:]
                    break
                if stack[depth].tag in _SCOPES or (tag in ("td", "th") and stack[depth].tag == "tr"):
                    break
        node = Node(tag, _label(tag, m[3]))
        stack[-1].parts.append(node)
        if tag not in _VOID and not m[3].endswith("/") and len(stack) < MAX_DEPTH:
            stack.append(node)
    if at < len(html):
        stack[-1].parts.append(html[at:])
    return root


class Group:
    """A node of a page's tree or of a wrapper: siblings of one kind, seen together.

    ``seen`` has texts of single elements, by code: on how many pages, and how long in all. A page's tree has them all,
    a wrapper those that are constant.
    """

    __slots__ = ("children", "label", "links", "pages", "role", "seen", "text")

    def __init__(self, label: str) -> None:
        self.label, self.children = label, []
        self.pages = self.text = self.links = 0
        self.seen: dict[int, tuple[int, int]] = {}
        self.role = ""

    def constants(self) -> frozenset[int]:
        """Texts that are the same on nearly all pages."""
        if self.pages < CONSTANT_PAGES:
            return frozenset()
        return frozenset(code for code, (n, _) in self.seen.items() if n >= CONSTANT_SHARE * self.pages)

    def varying(self) -> int:
        """Text that is neither constant nor link."""
        return max(0, self.text - self.links - sum(self.seen[code][1] for code in self.constants()))

    def walk(self) -> Iterator[Group]:
        yield self
        for child in self.children:
            yield from child.walk()


def grouped(node: Node, group: Group | None = None) -> Group:
    """The page's tree with neighbouring siblings of one label as one group; each element points to its group."""
    group = group or Group(node.label)
    group.pages = 1
    node.group = group
    place, in_link, size = 0, False, 0
    for part in node.parts:
        if part is True or part is False:
            in_link = part
        elif isinstance(part, str):
            if own := part.strip():
                size += len(part)
                group.links += len(part) * in_link
                node.code = zlib.crc32(own.encode("utf-8", "replace"), node.code)
        else:
            known = group.children
            while place < len(known) and known[place].label != part.label:
                place += 1  # children of the group's earlier elements may lie in between
            if place == len(known):
                known.append(Group(part.label))
            grouped(part, known[place])
    if size:
        group.text += size
        group.seen[node.code] = 1, size + group.seen.get(node.code, (0, 0))[1]
    return group


def shape(group: Group) -> str:
    return group.label if not group.children else f"{group.label}({' '.join(map(shape, group.children))})"


def _align(a: Group, b: Group, sizes: dict[tuple[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the most pairs of nodes that keep order and ancestry, and the children it pairs."""
    if [c.label for c in a.children] == [c.label for c in b.children] and shape(a) == shape(b):
        return sum(1 for _ in a.walk()), [(i, i) for i in range(len(a.children))]
    ours, theirs = {c.label for c in a.children}, {c.label for c in b.children}
    left = [i for i, c in enumerate(a.children) if c.label in theirs]  # no others can be paired
    right = [j for j, c in enumerate(b.children) if c.label in ours]
    m, n = len(left), len(right)
    best = [array("i", [0]) * (n + 1) for _ in range(m + 1)]
    for i, x in enumerate(a.children[k] for k in left):
        row, above = best[i + 1], best[i]
        for j, k in enumerate(right):
            y = b.children[k]
            pair = above[j] + _matching(x, y, sizes) if x.label == y.label else 0
            row[j + 1] = max(pair, above[j + 1], row[j])
    pairs, i, j = [], m, n
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((left[i], right[j]))
    return best[m][n] + 1, pairs[::-1]


def _matching(a: Group, b: Group, sizes: dict[tuple[int, int], int]) -> int:
    key = id(a), id(b)
    if key not in sizes:
        sizes[key] = _align(a, b, sizes)[0] if a.children and b.children else 1
    return sizes[key]


def merge(wrapper: Group, page: Group, sizes: dict[tuple[int, int], int] | None = None) -> Group:
    """Add a tree of the same root to a wrapper: aligned nodes are summed, others put in at their place; texts are not kept."""
    sizes = {} if sizes is None else sizes
    wrapper.pages += page.pages
    wrapper.text += page.text
    wrapper.links += page.links
    wrapper.seen = {}
    if page.children:
        _, pairs = _align(wrapper, page, sizes) if wrapper.children else (0, [])
        children, i, j = [], 0, 0
        for a, b in [*pairs, (len(wrapper.children), len(page.children))]:
            children += wrapper.children[i:a] + page.children[j:b]
            if a < len(wrapper.children) and b < len(page.children):
                children.append(merge(wrapper.children[a], page.children[b], sizes))
            i, j = a + 1, b + 1
        wrapper.children = children
    return wrapper


def pack(group: Group) -> list:
    return [group.label, group.pages, group.text, group.links, [pack(c) for c in group.children]]


def unpack(packed: list) -> Group:
    group = Group(packed[0])
    group.pages, group.text, group.links = packed[1:4]
    group.children = [unpack(c) for c in packed[4]]
    return group


KEPT = ("keep", "slots")
#: Stands for all texts of a node where counts go by code.
WHOLE = -1


def _words(label: str) -> tuple[str, set[str]]:
    tag, *words = label.split(".")
    return tag, set(words)


def _unwanted(group: Group, in_root: bool) -> bool:
    """By kind alone: elements and class words that mark no article."""
    tag, words = _words(group.label)
    if tag in _DROP_TAGS or (tag == "header" and not in_root) or words & _COMMENT_WORDS:
        return True
    if tag in ("html", "body", "main", "article", "#") or tag[0] == "h" and tag[1:].isdigit():
        return False
    return bool(words & _DROP_WORDS) and not any(_words(g.label)[0] in ("article", "main", "h1") for g in group.walk())


def assign_roles(wrapper: Group) -> Group:
    """Mark each node: keep its own texts but for constant ones (``keep`` under a root named so by its page, else ``slots``), ``pass`` (look below only), or ``drop`` with all below."""
    mass: dict[int, int] = {}  # varying text that is no link, by node

    def weigh(group: Group) -> int:
        mass[id(group)] = 0 if _unwanted(group, False) else group.varying() + sum(map(weigh, group.children))
        return mass[id(group)]

    weigh(wrapper)
    open_nodes, named = [], []

    def collect(group: Group) -> None:
        if _unwanted(group, False):
            return
        open_nodes.append(group)
        for child in group.children:
            collect(child)

    collect(wrapper)
    named = [g for g in open_nodes if _words(g.label)[0] == "article" or "articlebody" in _words(g.label)[1]]
    named = named or [g for g in open_nodes if _words(g.label)[0] == "main" or (_words(g.label)[1] & _ROOT_WORDS and 2 * mass[id(g)] >= mass[id(wrapper)] > 0)]
    if named:
        root = max(named, key=lambda g: mass[id(g)])  # the outermost of equals comes first
    else:
        root = wrapper
        while below := [c for c in root.children if mass.get(id(c), 0) >= 0.8 * mass[id(wrapper)] > 0]:
            root = below[0]

    def mark(group: Group, inside: bool) -> None:
        inside = inside or group is root
        if _unwanted(group, inside):
            role = "drop"
        elif not inside:
            role = "pass"
        elif _words(group.label)[0] == "header":
            role = "pass"  # of an article's header only the headings
        elif not named and group.links > LINK_SHARE * group.text:
            role = "pass"
        else:
            role = "keep" if named else "slots"
        group.role = role
        for child in group.children:
            mark(child, inside)

    mark(wrapper, False)
    return wrapper


def _fitted(page: Group, wrapper: Group | None, sizes: dict[tuple[int, int], int]) -> Iterator[tuple[Group, Group | None]]:
    """The children of a page's node, each with the wrapper's node it aligns with."""
    pairs = {j: i for i, j in _align(wrapper, page, sizes)[1]} if wrapper and page.children else {}
    return ((child, wrapper.children[pairs[j]] if j in pairs else None) for j, child in enumerate(page.children))


def _inherit(page: Group, wrapper: Group | None, above: str, sizes: dict[tuple[int, int], int]) -> Iterator[tuple[str, frozenset[int]]]:
    """Role and constant texts of the page's nodes from the wrapper's nodes they align with; of others by kind and surroundings."""
    role = wrapper.role if wrapper else "drop" if _unwanted(page, above in KEPT) else above
    yield role, wrapper.constants() if wrapper else frozenset()
    for child, fit in _fitted(page, wrapper, sizes):
        yield from _inherit(child, fit, role, sizes)


def _places(page: Group, wrapper: Group | None, numbers: dict[int, int], sizes: dict[tuple[int, int], int]) -> Iterator[int]:
    """Numbers of the wrapper's nodes that the page's nodes align with, -1 for none."""
    yield numbers[id(wrapper)] if wrapper else -1
    for child, fit in _fitted(page, wrapper, sizes):
        yield from _places(child, fit, numbers, sizes)


def blocks(node: Node, roles: dict[int, tuple[str, frozenset[int]]]) -> Iterator[str]:
    """Texts of the kept blocks in page order."""
    role, constants = roles[id(node.group)]
    if role == "drop":
        return
    keep = role in KEPT and node.code not in constants
    line: list[str] = []
    for part in node.parts:
        if isinstance(part, str):
            line.append(part)
        elif isinstance(part, Node):
            if keep:
                yield "".join(line)
            line = []
            yield from blocks(part, roles)
    if keep:
        yield "".join(line)


def cleaned(texts: Iterator[str]) -> str:
    lines = (_SPACE.sub(" ", unescape(text)).strip() for text in texts)
    return "\n".join(line for line in lines if line)


class Counter:
    """Places of pages' nodes in one host's wrapper; pages of one shape share the alignment."""

    def __init__(self, packed: str) -> None:
        self.wrapper = unpack(json.loads(packed))
        self.numbers = {id(group): i for i, group in enumerate(self.wrapper.walk())}
        self.shapes: dict[str, list[int]] = {}

    def places(self, tree: Group) -> list[int]:
        key = shape(tree)
        if key not in self.shapes:
            if len(self.shapes) >= HELD_SHAPES:
                self.shapes.clear()
            self.shapes[key] = list(_places(tree, self.wrapper, self.numbers, {}))
        return self.shapes[key]


@lru_cache(maxsize=64)
def _counter(packed: str) -> Counter:
    return Counter(packed)


class Extractor:
    """Applies one host's wrapper with its counts; pages of one shape share the alignment."""

    def __init__(self, packed: str | None, counts: str | None = None) -> None:
        self.wrapper = unpack(json.loads(packed)) if packed else None
        self.shapes: dict[str, list[tuple[str, frozenset[int]]]] = {}
        if self.wrapper is not None:
            nodes = list(self.wrapper.walk())
            for place, code, pages, size, links in json.loads(counts or "[]"):
                if code == WHOLE:
                    nodes[place].pages, nodes[place].text, nodes[place].links = pages, size, links
                else:
                    nodes[place].seen[code] = pages, size
            assign_roles(self.wrapper)

    def _roles(self, tree: Group) -> list[tuple[str, frozenset[int]]]:
        """The wrapper has every node of its host's pages, so only a page without any in the host's root goes by its own tree."""
        found = list(_inherit(tree, self.wrapper, "pass", {}))
        if not any(role in KEPT for role, _ in found):  # a page of another kind than its host's others
            assign_roles(tree)
            found = [(g.role, constants) for g, (_, constants) in zip(tree.walk(), found, strict=True)]
        return [(role, constants if role in KEPT else frozenset()) for role, constants in found]

    def text(self, html: str) -> str:
        page = parse(html)
        tree = grouped(page)
        key = shape(tree)
        if key not in self.shapes:
            if len(self.shapes) >= HELD_SHAPES:
                self.shapes.clear()
            self.shapes[key] = self._roles(tree)
        roles = dict(zip(map(id, tree.walk()), self.shapes[key], strict=True))
        found = cleaned(blocks(page, roles))
        if not found:  # an article of constant texts alone is a copy of the host's others, not their template
            found = cleaned(blocks(page, {node: (role, frozenset() if role == "keep" else constants) for node, (role, constants) in roles.items()}))
        return found


@lru_cache(maxsize=64)
def _extractor(packed: str | None, counts: str | None) -> Extractor:
    return Extractor(packed, counts)


def pages_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    own = narrow(pages, page_id=id_col, url=url_col, html=html_col)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return own.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))


def induce(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the wrapper of each host's pages, as JSON, from columns host and html of all rows."""

    def work(batches: Batches) -> Batches:
        wrappers: dict[str, Group] = {}
        held: dict[tuple[str, str], Group] = {}

        def settle() -> None:
            for (host, _), tree in held.items():
                wrappers[host] = merge(wrappers[host], tree) if host in wrappers else tree
            held.clear()

        for batch in batches:
            for host, html in zip(*(batch.column(n).to_pylist() for n in ("host", "html")), strict=True):
                tree = grouped(parse(html))
                key = host, shape(tree)
                if key in held:
                    for known, own in zip(held[key].walk(), tree.walk(), strict=True):  # same shape: node by node
                        own.children, children = [], own.children
                        merge(known, own)
                        own.children = children
                else:
                    held[key] = tree
                    if len(held) > HELD_SHAPES:
                        settle()
        settle()
        part = TaskContext.get().partitionId()
        rows = [(host, part, json.dumps(pack(tree))) for host, tree in wrappers.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], ["host", "part", "wrapper"])

    def combine(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")  # the same wrapper whatever order the parts arrive in
        whole = None
        for packed in rows.column("wrapper").to_pylist():
            tree = unpack(json.loads(packed))
            whole = tree if whole is None else merge(whole, tree)
        return pa.table({"host": rows.column("host")[:1], "part": rows.column("part")[:1], "wrapper": pa.array([json.dumps(pack(whole))])})

    schema = "host string, part long, wrapper string"
    parts = map_batches(pages.select("host", "html"), work, schema)
    some = parts.groupBy("host", F.pmod("part", F.lit(64))).applyInArrow(combine, schema)
    return some.groupBy("host").applyInArrow(combine, schema).select("host", "wrapper")


def _with_wrappers(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Pages with the columns of their host's wrapper."""
    size = wrappers.agg(F.sum(sum(F.length(c).cast("long") for c in wrappers.columns))).first()[0] or 0
    return pages.join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, "host", "left")


def count_texts(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, counts): for each node of a host's wrapper, in JSON, [place, WHOLE, pages, text, links] and of each of its constant texts [place, code, pages, text, 0]."""
    names = ("host", "place", "code", "pages", "size", "links")

    def work(batches: Batches) -> Batches:
        held: dict[tuple[str, int, int], list[int]] = {}

        def settle() -> pa.RecordBatch:
            rows = [(*key, *sums) for key, sums in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i else pa.string()) for i in range(6)], names)

        for batch in batches:
            for host, html, packed in zip(*(batch.column(n).to_pylist() for n in ("host", "html", "wrapper")), strict=True):
                tree = grouped(parse(html))
                for group, place in zip(tree.walk(), _counter(packed).places(tree), strict=True):
                    if place < 0:
                        continue
                    for code, n, size, links in ((WHOLE, 1, group.text, group.links), *((code, n, size, 0) for code, (n, size) in group.seen.items())):
                        sums = held.setdefault((host, place, code), [0, 0, 0])
                        sums[0] += n
                        sums[1] += size
                        sums[2] += links
                if len(held) > HELD_COUNTS:
                    yield settle()
        yield settle()

    parts = map_batches(_with_wrappers(pages.select("host", "html"), wrappers), work, "host string, place long, code long, pages long, size long, links long")
    sums = parts.groupBy("host", "place", "code").agg(*(F.sum(n).alias(n) for n in names[3:]))
    # What is on too few pages for any node goes at once, and that is nearly all.
    sums = cut(sums.filter((F.col("code") == WHOLE) | (F.col("pages") >= CONSTANT_SHARE * CONSTANT_PAGES)))
    nodes = sums.filter(F.col("code") == WHOLE)
    least = nodes.filter(F.col("pages") >= CONSTANT_PAGES).select("host", "place", (CONSTANT_SHARE * F.col("pages")).alias("least"))
    constant = sums.filter(F.col("code") != WHOLE).join(least, ["host", "place"]).filter(F.col("pages") >= F.col("least")).select(*names)
    return nodes.unionByName(constant).groupBy("host").agg(F.to_json(F.collect_list(F.array(*names[1:]))).alias("counts"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text): the main text of every page; empty if there is none.

    Pages with a null url, or one without host, share a wrapper. Null html counts as empty. Repeated rows are kept,
    and other columns are not read. An empty table gives no rows. Of texts or roots that weigh the same, the one
    first on the page counts. Constant texts go out of an article too, unless it has no others, as on copies of a page.
    """
    own = pages_of(pages, id_col, url_col, html_col)
    wrappers = cut(induce(own))
    wrappers = cut(wrappers.join(count_texts(own, wrappers), "host", "left"))

    def work(batches: Batches) -> Batches:
        for batch in batches:
            texts = [_extractor(packed, counts).text(html) for html, packed, counts in zip(*(batch.column(n).to_pylist() for n in ("html", "wrapper", "counts")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return map_batches(_with_wrappers(own, wrappers), work, "page_id long, url string, text string")


def counted(texts: DataFrame) -> DataFrame:
    return texts.withColumn("n_chars", F.length("text").cast("long"))
