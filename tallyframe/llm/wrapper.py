"""Main text of pages by wrapper induction: page trees of a host are aligned, what stays is template, what varies is content.

A page becomes a tree of its block elements. Runs of siblings of one structure (paragraphs, list items, comments) fold into
one node. A host's wrapper is its most frequent structure. Every other structure of the host is aligned with it by simple tree matching,
and for each node of the wrapper all pages' texts are compared through mergeable minima and maxima of their
hashes: a leaf with one text on at least ``TEMPLATE_PAGES`` pages of a host whose other text varies is template. The content is the node under
which most of the varying text lies; an ``article`` or ``main`` with a tenth of it comes first. Elements that say what they are by tag, role or class (menus, forms, comments ...) are never content.

No page meets another: pages of a host are joined by aggregates of (host, structure, node). The last join, page to
wrapper, is salted, so that a host with a third of all pages spreads.

Cases: NULL and empty pages have an empty text. A host with one page has no template but that of its tags and classes. Pages without a host share the
empty host. Unclosed, stray and deeply nested tags are accepted (below ``DEPTH`` levels elements no longer make nodes of their own, but are told apart while tags are read). Repeated pages
give repeated rows. Pages that cannot be aligned keep the largest ``article`` or ``main``, or else all that is not excluded.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.url_cascade import host_of

TEMPLATE_PAGES = 3
DEPTH = 64
SALTS = 64

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template noembed noframes xmp svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that a start tag of these closes when they are still open.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: What is never content, by tag, role, and name of a class or id.
TAGS = frozenset("head nav footer aside form button select menu dialog object canvas audio video datalist fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notification overlay pager pagination popup promo promoted recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe toolbar topbar widget".split()
)
#: Last parts that leave a name as it is, as in ``ad-slot`` or ``sidebar-left``, and first parts that turn it around, as in ``has-sidebar``.
HOLDERS = frozenset(
    "area bar block body bottom box button buttons container form group icons inner item items left links list main message meta outer panel posts primary right row secondary section slot "
    "stories strip text thread title top unit wrap wrapper zone".split()
)
TURNED = frozenset("has no non not with without is hide show toggle".split())
#: First parts of a page's own header; other headers, as of an entry, hold titles.
PAGE_HEADERS = frozenset("header site page main global top".split())
MAIN = ("article", "main")
#: A form with one of these is the frame of a page and not a form to fill in.
FRAMED = frozenset((*MAIN, "h1"))

_TAG = re.compile(r"""<(?:!--|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|[!?/][^>]*+>)""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Za-z]+")


def _excluding(token: str, inside_main: bool) -> bool:
    """Whether one class or id names what is never content: as a whole, by its last part, or by its first part before a word for a place."""
    parts = _WORD.findall(token)
    if not parts or (len(parts) > 1 and parts[0] in TURNED):
        return False
    name = parts[-1]
    if name not in NAMES:
        name = parts[0] if parts[0] in NAMES and all(part in HOLDERS for part in parts[1:]) else ""
    if name == "header":
        return parts[0] in PAGE_HEADERS and not inside_main
    return bool(name)


class Element:
    __slots__ = ("tag", "label", "excluded", "parts")

    def __init__(self, tag: str, label: str, excluded: bool):
        self.tag, self.label, self.excluded, self.parts = tag, label, excluded, []


@lru_cache(20_000)
def _describe(tag: str, attributes: str, inside_main: bool) -> tuple[str, bool]:
    """(label, whether it is never content) of an element."""
    excluded = tag in TAGS or (tag == "header" and not inside_main)
    label = tag
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        words = _WORD.findall(value)
        if name.lower() == "role":
            excluded = excluded or value.strip() in ROLES
            continue
        if words and name.lower() == "class":
            label = f"{tag}.{'-'.join(words[:3])}"
        excluded = excluded or (tag not in ("html", "body", *MAIN) and any(_excluding(token, inside_main) for token in value.split()))
    return label, excluded


def parse(text: str) -> Element:
    """The tree of a page's blocks. Parts of an element are elements, texts, and None for a break."""
    root = Element("", "", False)
    stack = [root]
    opened: Counter[str] = Counter()
    at = 0

    def cut(k: int) -> None:
        for element in stack[k:]:
            opened[element.tag] -= 1
        del stack[k:]

    size = len(text)
    while at < size:
        found = _TAG.search(text, at)
        if not found:
            stack[-1].parts.append(text[at:])
            break
        if found.start() > at:
            stack[-1].parts.append(text[at : found.start()])
        at = found.end()
        if found[0] == "<!--":
            close = text.find("-->", at)
            at = size if close < 0 else close + 3
            continue
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            if not attributes.endswith("/"):
                close = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(text, at)
                at = close.end() if close else size
            continue
        if tag in ("br", "hr"):
            stack[-1].parts.append(None)
            continue
        if tag in VOID:
            continue
        if closing:
            if opened[tag]:
                cut(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        label, excluded = _describe(tag, attributes, any(opened[name] for name in MAIN))
        if tag in FRAMED and opened["form"]:
            for element in stack:
                element.excluded = element.excluded and element.tag != "form"
        if tag in INLINE and not excluded:
            continue
        if tag in CLOSES:
            for k in range(len(stack) - 1, max(0, len(stack) - 4), -1):
                if stack[k].tag in CLOSES[tag]:
                    cut(k)
                    break
                if stack[k].tag in ("ul", "ol", "dl", "table"):
                    break
        elif tag not in INLINE and stack[-1].tag == "p":
            cut(len(stack) - 1)
        if attributes.endswith("/"):
            stack[-1].parts.append(None)
            continue
        element = Element(tag, label, excluded)
        stack[-1].parts.append(element)
        stack.append(element)
        opened[tag] += 1
    return root


class Node:
    """A folded node: its label, children, and the (place in the page, text) of its own blocks."""

    __slots__ = ("label", "children", "texts", "form")

    def __init__(self, label: str, children: list, texts: list):
        self.label, self.children, self.texts = label, children, texts
        self.form = f"{label}({','.join(c.form for c in children)})" if children else label

    def preorder(self) -> list:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            out.append(node)
            stack.extend(reversed(node.children))
        return out


def _join(one: Node, other: Node) -> None:
    one.texts += other.texts
    for a, b in zip(one.children, other.children, strict=True):
        _join(a, b)


def fold(element: Element, counter: list[int], level: int = 1) -> Node | None:
    """The folded tree without excluded elements and without nodes that hold no text; None if nothing is left. Below ``DEPTH`` levels, elements pass their parts to the last node."""
    children: list[Node] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            text = "".join(line)
            line.clear()
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                counter[0] += 1
                add(Node("#", [], [(counter[0], text)]))

    def add(node: Node) -> None:
        if children and children[-1].form == node.form:
            _join(children[-1], node)
        else:
            children.append(node)

    waiting = [iter(element.parts)]
    while waiting:
        try:
            part = next(waiting[-1])
        except StopIteration:
            waiting.pop()
            flush()
            continue
        if isinstance(part, str):
            line.append(part)
        elif part is None:
            flush()
        elif part.excluded:
            if part.tag not in INLINE:
                flush()
        else:
            flush()
            if level >= DEPTH:
                waiting.append(iter(part.parts))
            elif (node := fold(part, counter, level + 1)) is not None:
                add(node)
    if not children:
        return None
    if len(children) == 1 and children[0].label == "#":
        return Node(element.label, [], children[0].texts)
    return Node(element.label, children, [])


def page_tree(text: str | None) -> Node | None:
    return fold(parse(text), [0]) if text else None


@lru_cache(2_000)
def _shape(form: str) -> tuple[list[str], list[list[int]]]:
    """(labels, children) of the nodes of a structure in preorder."""
    labels: list[str] = []
    children: list[list[int]] = []
    stack: list[int] = []
    for word, sign in re.findall(r"([^(),]*)([(),]|$)", form):
        if word or (sign == "(" and not labels):
            if stack:
                children[stack[-1]].append(len(labels))
            labels.append(word)
            children.append([])
        if sign == "(":
            stack.append(len(labels) - 1)
        elif sign == ")":
            stack.pop()
    return labels, children


@lru_cache(5_000)
def align(form: str, wrapper: str) -> dict[int, int]:
    """Simple tree matching: for nodes of a structure, the nodes of the wrapper that they match in the largest top-down order-keeping matching."""
    if form == wrapper:
        return {k: k for k in range(len(_shape(form)[0]))}
    (labels, children), (labels_w, children_w) = _shape(form), _shape(wrapper)
    memo: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def match(a: int, b: int) -> tuple[int, list[tuple[int, int]]]:
        if labels[a] != labels_w[b]:
            return 0, []
        if (a, b) not in memo:
            ours, theirs = children[a], children_w[b]
            weight = [[0] * (len(theirs) + 1) for _ in range(len(ours) + 1)]
            for i, x in enumerate(ours, 1):
                for j, y in enumerate(theirs, 1):
                    weight[i][j] = max(weight[i - 1][j], weight[i][j - 1], weight[i - 1][j - 1] + match(x, y)[0])
            i, j, pairs = len(ours), len(theirs), []
            while i and j:
                if weight[i][j] == weight[i - 1][j]:
                    i -= 1
                elif weight[i][j] == weight[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((ours[i], theirs[j]))
            memo[a, b] = 1 + weight[-1][-1], pairs
        return memo[a, b]

    out: dict[int, int] = {}
    open_ = [(0, 0)] if match(0, 0)[0] else []
    while open_:
        a, b = open_.pop()
        out[a] = b
        open_ += match(a, b)[1]
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page its host, structure, and for each leaf (node, hash and length of its text)."""
    leaf = pa.list_(pa.struct([("node", pa.int32()), ("hash", pa.int64()), ("size", pa.int64())]))
    for batch in batches:
        forms, leaves = [], []
        for text in batch.column("html").to_pylist():
            tree = page_tree(text)
            forms.append(tree.form if tree else None)
            found = []
            for k, node in enumerate(tree.preorder() if tree else ()):
                if node.texts:
                    joined = "\n".join(t for _, t in node.texts)
                    found.append({"node": k, "hash": xxhash.xxh3_64_intdigest(joined) - (1 << 63), "size": len(joined)})
            leaves.append(found)
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(forms, pa.string()), pa.array(leaves, leaf)], names=["host", "form", "leaves"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaf statistics of a structure carried to the wrapper's nodes."""
    names = ["host", "wrapper", "node", "low", "high", "pages", "size"]
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            pairs = align(row["form"], row["wrapper"])
            if row["node"] in pairs:
                rows.append((row["host"], row["wrapper"], pairs[row["node"]], row["low"], row["high"], row["pages"], row["size"]))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def induce(pages: DataFrame) -> DataFrame:
    """A row for each host of (host, html): its wrapper and, for each leaf of it, (node, whether its text is constant, pages, length)."""
    features = pages.select("host", "html").mapInArrow(_features, "host string, form string, leaves array<struct<node: int, hash: long, size: long>>")
    leaf = features.where("form IS NOT NULL").select("host", "form", F.explode("leaves").alias("leaf"))
    stats = leaf.groupBy("host", "form", F.col("leaf.node").alias("node")).agg(
        F.min("leaf.hash").alias("low"), F.max("leaf.hash").alias("high"), F.count("*").alias("pages"), F.sum("leaf.size").alias("size")
    )
    # Every structure has a first leaf that all its pages have.
    forms = stats.groupBy("host", "form").agg(F.max("pages").alias("pages"))
    wrappers = forms.groupBy("host").agg(F.max_by("form", F.struct("pages", "form")).alias("wrapper"))
    carried = stats.join(wrappers, "host").mapInArrow(_aligned, "host string, wrapper string, node int, low long, high long, pages long, size long")
    nodes = carried.groupBy("host", "wrapper", "node").agg(
        (F.min("low") == F.max("high")).alias("constant"), F.sum("pages").alias("pages"), F.sum("size").alias("size")
    )
    # A wrapper has a bounded number of nodes: those of one page.
    return nodes.groupBy("host").agg(F.first("wrapper").alias("wrapper"), F.collect_list(F.struct("node", "constant", "pages", "size")).alias("leaves"))


@lru_cache(2_000)
def _plan(wrapper: str, leaves: tuple[tuple[int, bool, int, int], ...]) -> tuple[int, frozenset[int]]:
    """(content node, template leaves) of a wrapper."""
    labels, children = _shape(wrapper)
    template = {node for node, constant, pages, _ in leaves if constant and pages >= TEMPLATE_PAGES}
    size = [0] * len(labels)
    for node, _, _, chars in leaves:
        if node not in template:
            size[node] = chars
    if not any(size):  # all pages are copies: nothing tells template from content
        template = set()
        for node, _, _, chars in leaves:
            size[node] = chars
    for node in reversed(range(len(labels))):
        size[node] += sum(size[c] for c in children[node])
    mains = [k for k, label in enumerate(labels) if label.partition(".")[0] in MAIN]
    best = max(mains, key=lambda k: (size[k], -k), default=None)
    if best is not None and 10 * size[best] >= size[0]:
        return best, frozenset(template)
    at = 0
    while children[at]:
        child = max(children[at], key=lambda k: size[k])
        if 10 * size[child] < 9 * size[at] or not children[child]:
            break
        at = child
    return at, frozenset(template)


def _content(tree: Node, wrapper: str | None, leaves: tuple) -> list[str]:
    nodes = tree.preorder()
    kept = None
    if wrapper is not None:
        target, template = _plan(wrapper, leaves)
        pairs = align(tree.form, wrapper)
        top = next((a for a, b in pairs.items() if b == target), None)
        if top is not None:
            dropped = {id(nodes[a]) for a, b in pairs.items() if b in template}
            kept = [n for n in nodes[top].preorder() if id(n) not in dropped]
    if kept is None:
        mains = [n for n in nodes if n.label.partition(".")[0] in MAIN]
        kept = max(([*n.preorder()] for n in mains), key=lambda ns: sum(len(t) for n in ns for _, t in n.texts), default=nodes)
    return [text for _, text in sorted(t for node in kept for t in node.texts)]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, wrapper, leaves in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), batch.column("leaves").to_pylist(), strict=True):
            tree = page_tree(html)
            told = tuple(sorted((x["node"], x["constant"], x["pages"], x["size"]) for x in leaves or ()))
            texts.append("\n".join(_content(tree, wrapper, told)) if tree else "")
        yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], names=["kept", "text"])


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of the pages (with ``url`` and ``html``) and the main ``text``, which replaces a column of that name."""
    kept = F.struct(*(name for name in keep if name != "text"))
    named = pages.select(kept.alias("kept"), host_of(F.col("url")).alias("host"), F.col("html"))
    salt = F.pmod(F.xxhash64("html", "kept"), F.lit(SALTS))
    wrappers = induce(named).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = named.withColumn("salt", salt).join(wrappers, ["host", "salt"], "left").select("kept", "html", "wrapper", "leaves")
    found = joined.mapInArrow(_extract, f"kept {dict(named.dtypes)['kept']}, text string")
    return found.select("kept.*", "text")
