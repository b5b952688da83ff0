"""The main text of web pages by wrapper induction.

A page becomes a tree of its block elements with the text between their
boundaries as leaves. Each host has one exemplar page, and one for each layout (sequence of
container elements) if it has several; the trees of the pages are aligned with theirs by
simple tree matching. A leaf that says the same on nearly all different pages of the host
or of the layout is template; slots that vary are content, if their place in the
page is not that of a menu, a form, an advert or the like. An article that is all template
is no article.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Generator, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from twinledger.llm.shared import bounded_batches, checkpointed


class Settings(NamedTuple):
    """``share``: of a host's or layout's different pages on which a leaf must say the same to
    be template; ``pages``: how many different pages that takes at least. ``broadcast_bytes``: up to
    here the exemplars are broadcast, beyond they are joined by host."""

    share: float = 0.8
    pages: int = 2
    broadcast_bytes: int = 64 << 20


# Elements by what they do to text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul caption".split()
)
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_CONTENT = frozenset(
    "nav footer aside form head header menu dialog button select svg math canvas object audio video datalist label".split()
)
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice notification popup "
    "modal newsletter subscribe signup comment comments disqus share sharing social related recommended widget "
    "toolbar pagination pager login search copyright".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
#: Their start and end tags in order are a page's layout.
_CONTAINER = r"(?i)<(/?(?:article|aside|center|div|footer|header|main|nav|section|table))\b"
# A start tag of these closes an open one of the list.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
#: The same for pages whose quotes don't pair up: a tag ends at the next bracket.
_LOOSE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S)
_TAG_START = re.compile(r"</?[A-Za-z]")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKENS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    __slots__ = ("tag", "hidden", "children", "text", "number", "unseen", "shape", "size")

    def __init__(self, tag: str, hidden: bool = False, text: str = ""):
        self.tag, self.hidden, self.text = tag, hidden, text
        self.children: list[Node] = []
        self.number = -1  # of a leaf
        self.unseen = 0  # inline elements that are not content and open around it
        self.shape, self.size = 0, 1  # a hash of the tags from here on, and their number


def _not_content(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ("html", "body", "article", "main"):
        return False
    if tag in NOT_CONTENT and not (tag == "header" and in_article):
        return True
    if not attributes.strip():
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            hints = HINTS.intersection(t.lower() for t in _TOKENS.findall(value))
            if hints - ({"header"} if in_article else set()):
                return True
        elif name == "role" and value.lower() in ROLES or name == "hidden" or (name, value) == ("aria-hidden", "true"):
            return True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


class _Tags:
    """The tags of a page in order, read in one go: a tag whose quotes run to the end makes the rest loose."""

    def __init__(self, source: str):
        self.source, self.pattern, self.last = source, _TAG, source.rfind(">")

    def next(self, at: int) -> re.Match | None:
        start = self.source.find("<", at)
        while start >= 0:
            if start < self.last or self.source.startswith("<!--", start):
                found = self.pattern.match(self.source, start)
                if not found and self.pattern is _TAG and _TAG_START.match(self.source, start):
                    self.pattern = _LOOSE
                    found = _LOOSE.match(self.source, start)
                if found:
                    return found
            start = self.source.find("<", start + 1)
        return None


def parse(source: str) -> tuple[Node, list[Node], str]:
    """The page's tree, its text leaves in order, and its shape (the tags alone)."""
    root = Node("#root")
    stack, leaves, shape, pieces = [root], [], [], []
    articles = unseen = 0  # open articles; depth of inline elements that are not content
    loose = False  # after the start of such an element without an end, until the next block
    ends: dict[str, int] = {}  # the last end tag of such elements
    nodes, opened, tags = [root], Counter(), _Tags(source)

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                leaf = Node("#text", stack[-1].hidden, text)
                leaf.number = len(leaves)
                leaves.append(leaf)
                nodes.append(leaf)
                stack[-1].children.append(leaf)
                shape.append("#")

    def close(upto: int) -> None:
        nonlocal articles, unseen
        flush()
        while len(stack) > upto:
            node = stack.pop()
            opened[node.tag] -= 1
            articles -= node.tag == "article"
            unseen = min(unseen, node.unseen)
            shape.append(")")

    at, size = 0, len(source)
    while at < size:
        found = tags.next(at)
        start = found.start() if found else size
        if start > at and not unseen and not loose:
            piece = source[at:start]
            pieces.append(html.unescape(piece) if "&" in piece else piece)
        if not found:
            break
        at = found.end()
        ending, tag, attributes = found[1], found[2], found[3]
        if tag is None:
            continue
        tag = tag.lower()
        loose = loose and tag not in BLOCKS
        if ending:
            if tag in BLOCKS:
                if opened[tag]:
                    close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
                else:
                    flush()
            elif unseen and tag in NOT_CONTENT:
                unseen -= 1
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = source.find(">", end.end()) + 1 if end else size
            at = at or size
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCKS:
            flush()
            if stack[-1].tag == "p":
                close(len(stack) - 1)
            closes = CLOSES.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                if not any(opened[t] for t in closes):
                    break
                if stack[i].tag in closes:
                    close(i)
                elif stack[i].tag in ("ul", "ol", "dl", "table", "tbody", "menu", "div", "article", "section"):
                    break
            if tag not in VOID:
                node = Node(tag, stack[-1].hidden or _not_content(tag, attributes, articles > 0))
                node.unseen = unseen
                stack[-1].children.append(node)
                stack.append(node)
                nodes.append(node)
                opened[tag] += 1
                articles += tag == "article"
                shape.append("(" + tag)
        elif tag in NOT_CONTENT and not attributes.endswith("/"):
            if tag not in ends:
                ends[tag] = max((m.start() for m in re.finditer(rf"</{tag}", source, re.I)), default=-1)
            if ends[tag] < at:
                loose = True
            else:
                unseen += 1
    close(1)
    for node in reversed(nodes):  # children come after their parents
        node.shape = hash((node.tag, *(child.shape for child in node.children)))
        node.size = 1 + sum(child.size for child in node.children)
    return root, leaves, "".join(shape)


#: Children up to which all rows of their table are kept, beyond it as many as the root of them and the others
#: are filled again; weights that are remembered at a time, others are worked out again. Neither changes a match.
PIECE, CELLS = 64, 1_000_000

Pairs = list[tuple[Node, Node]]
#: Asks for the weights of pairs of nodes.
Asking = Generator[tuple[Node, Node], int]


def _trimmed(xs: list[Node], ys: list[Node]) -> tuple[Pairs, list[Node], list[Node]]:
    """Children that certainly face each other, and those between them.

    Equal beginnings and ends are matched first: no other match of them weighs more.
    """
    low, high = 0, 0
    short = min(len(xs), len(ys))
    while low < short and xs[low].shape == ys[low].shape:
        low += 1
    while high < short - low and xs[-1 - high].shape == ys[-1 - high].shape:
        high += 1
    sure = [*zip(xs[:low], ys[:low]), *zip(xs[len(xs) - high :], ys[len(ys) - high :])]
    return sure, xs[low : len(xs) - high], ys[low : len(ys) - high]


class _Table:
    """The most nodes that match below the first children of two lists, a row for each child of the one."""

    def __init__(self, matching: _Matching, xs: list[Node], ys: list[Node]):
        self.matching, self.xs, self.ys = matching, xs, ys
        kinds = {y.shape: y for y in ys}
        place = {shape: n for n, shape in enumerate(kinds)}
        self.kinds, self.kind = list(kinds.values()), np.array([place[y.shape] for y in ys], dtype=np.intp)
        self.known: dict[int, np.ndarray] = {}

    def weights(self, x: Node) -> Generator[tuple[Node, Node], int, np.ndarray]:
        """The weights of ``x`` and each of the other list, those of a shape asked for once."""
        found = self.known.get(x.shape)
        if found is None:
            of = np.zeros(len(self.kinds), dtype=np.int64)
            for n, y in enumerate(self.kinds):
                weight = self.matching.weight(x, y)
                of[n] = (yield x, y) if weight is None else weight
            found = of[self.kind]
            if (len(self.known) + 1) * len(found) > CELLS:
                self.known.clear()
            self.known[x.shape] = found
        return found

    def rows(self, above: np.ndarray, start: int, end: int, every: int) -> Generator[tuple[Node, Node], int, list[np.ndarray]]:
        """``above``, the row before ``start``, then each that many rows further, and the last."""
        rows = [above]
        for i in range(start, end):
            of = yield from self.weights(self.xs[i])
            row = np.empty_like(above)
            row[0] = 0
            np.maximum(above[1:], above[:-1] + of, out=row[1:])
            above = np.maximum.accumulate(row, out=row)
            if (i + 1 - start) % every == 0 or i + 1 == end:
                rows.append(above)
        return rows

    def top(self) -> np.ndarray:
        return np.zeros(len(self.ys) + 1, dtype=np.int64)

    def best(self) -> Generator[tuple[Node, Node], int, int]:
        size = len(self.xs)
        rows = yield from self.rows(self.top(), 0, size, size)
        return int(rows[-1][-1])

    def pairs(self) -> Generator[tuple[Node, Node], int, Pairs]:
        pairs, i, j = [], len(self.xs), len(self.ys)
        every = 1 if i <= PIECE else math.isqrt(i)
        kept = yield from self.rows(self.top(), 0, i, every)
        for n in reversed(range(len(kept) - 1)):
            start = n * every
            rows = kept[n : n + 2] if every == 1 else (yield from self.rows(kept[n], start, i, 1))
            while i > start and j:
                row, above = rows[i - start], rows[i - start - 1]
                if row[j] == above[j]:
                    i -= 1
                elif row[j] == row[j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((self.xs[i], self.ys[j]))
            if not j:
                break
        return pairs


class _Matching:
    """The pairs of children of two trees' nodes that make the most nodes match."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, int], int] = {}

    def weight(self, x: Node, y: Node) -> int | None:
        """Nodes that match below two nodes; None if that is not known yet."""
        if x.tag != y.tag:
            return 0
        if x.shape == y.shape:
            return x.size
        if not x.children or not y.children:
            return 1
        return self.known.get((x.shape, y.shape))

    def settle(self, x: Node, y: Node) -> None:
        """Make the weight of two nodes known."""
        if self.weight(x, y) is None:
            self.told(self.total(x, y))

    def told(self, asking: Asking):
        """What ``asking`` returns, each weight that it asks for worked out without recursion."""
        waiting, weight = [asking], None
        while True:
            try:
                x, y = waiting[-1].send(weight)
            except StopIteration as end:
                waiting.pop()
                weight = end.value
                if not waiting:
                    return weight
            else:
                waiting.append(self.total(x, y))
                weight = None

    def total(self, x: Node, y: Node) -> Generator[tuple[Node, Node], int, int]:
        sure, xs, ys = _trimmed(x.children, y.children)
        weight = 1 + sum(p.size for p, _ in sure)
        if xs and ys:
            weight += yield from _Table(self, xs, ys).best()
        if len(self.known) >= CELLS:
            self.known.clear()
        self.known[x.shape, y.shape] = weight
        return weight

    def pairs(self, x: Node, y: Node) -> Pairs:
        """The children of two nodes that face each other."""
        sure, xs, ys = _trimmed(x.children, y.children)
        return sure + self.told(_Table(self, xs, ys).pairs()) if xs and ys else sure


def align(a: Node, b: Node) -> list[tuple[int, int]]:
    """Simple tree matching: the leaves of ``a`` and ``b`` that face each other.

    Nodes match if their tags do; the children of matched nodes are matched in order so
    that the most nodes match, whatever their number. Equal beginnings and ends of lists and equal subtrees take
    time in proportion to them, what differs up to the product of both pages' nodes.
    """
    matching = _Matching()
    pairs, waiting = [], [(a, b)] if a.tag == b.tag else []
    while waiting:
        x, y = waiting.pop()
        if x.number >= 0:
            pairs.append((x.number, y.number))
        elif x.shape == y.shape:
            waiting += zip(x.children, y.children)
        elif x.children and y.children:
            waiting += matching.pairs(x, y)
    return pairs


def _regions(root: Node, dropped: set[int]) -> list[Node]:
    """The outermost articles, else main elements, else the page; not those of which all is dropped."""
    for wanted in ("article", "main"):
        found, waiting = [], [root]
        while waiting:
            node = waiting.pop()
            if node.tag == wanted and not node.hidden:
                held = [leaf.number for leaf in _inside([node]) if not leaf.hidden] if dropped else []
                if not held or not dropped.issuperset(held):
                    found.append(node)
            else:
                waiting.extend(reversed(node.children))
        if found:
            return found
    return [root]


def _inside(nodes: list[Node]) -> Iterator[Node]:
    waiting = list(reversed(nodes))
    while waiting:
        node = waiting.pop()
        if node.number >= 0:
            yield node
        waiting.extend(reversed(node.children))


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class _Wrapper:
    """Alignments with exemplars, kept by the shape of the page."""

    KEPT = 20_000

    def __init__(self) -> None:
        self.trees: dict[str, Node] = {}
        self.known: dict[tuple[str, str], list[tuple[int, int]]] = {}

    def pairs(self, exemplar: str, root: Node, shape: str) -> list[tuple[int, int]]:
        if len(self.known) > self.KEPT or len(self.trees) > self.KEPT // 10:
            self.known.clear()
            self.trees.clear()
        found = self.known.get((exemplar, shape))
        if found is None:
            if exemplar not in self.trees:
                self.trees[exemplar] = parse(exemplar)[0]
            found = self.known[exemplar, shape] = align(root, self.trees[exemplar])
        return found


def _slots(joined: DataFrame) -> DataFrame:
    """What each page says in each slot of its exemplars, hashed: ``host, layout, slot, said, page``.

    ``layout`` is empty for the host's own exemplar.
    """

    def said(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wrapper = _Wrapper()
        for batch in batches:
            rows = set()
            for host, layout, source, exemplar, closer in zip(*(batch[c] for c in ("host", "layout", "html", "exemplar", "closer"))):
                root, leaves, shape = parse(source)
                page = _digest("\n".join(leaf.text for leaf in leaves))
                digests = [_digest(leaf.text) for leaf in leaves]
                for level, example in (("", exemplar), (layout, closer)):
                    if example is not None:
                        rows.add((host, level, -1, 0, page))
                        for own, slot in wrapper.pairs(example, root, shape):
                            if not leaves[own].hidden:
                                rows.add((host, level, slot, digests[own], page))
            yield pd.DataFrame(list(rows), columns=["host", "layout", "slot", "said", "page"])

    return joined.mapInPandas(said, "host string, layout string, slot int, said long, page long").distinct()


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    settings: Settings = Settings(),
) -> DataFrame:
    """Each page's article text: ``id_col``, ``url_col``, ``text`` (empty if there is none), one row per row.

    Blocks are joined by a line feed; white space within a block is one space.
    Pages without a host in their URL (NULL, empty) count as one host. NULL and
    empty pages have no text. Equal pages count once in what a host's pages say, so
    copies make no text a template.

    Statistics cover every page of a host with two different ones; only sums per slot are
    shuffled, not pages, as long as the exemplars (one page a host, and one a layout of two
    different pages on hosts of several) are within ``broadcast_bytes``. Beyond, pages
    meet their exemplars by joins on host and layout, whose skew Spark splits.
    """
    bounded_batches(pages.sparkSession)
    host = F.coalesce(F.regexp_extract(F.lower(F.col(url_col)), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    source = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        host.alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    layout = F.xxhash64(F.regexp_extract_all(F.lower("html"), F.lit(_CONTAINER), F.lit(1)))
    source = source.withColumn("layout", F.concat(F.lit("#"), layout.cast("string")))
    hashed = source.select("host", "layout", "html", F.xxhash64("html").alias("hash"))
    layouts = checkpointed(
        hashed.groupBy("host", "layout").agg(
            F.min("hash").alias("hash"), F.max("hash").alias("last"), F.max(F.octet_length("html")).alias("bytes")
        )
    )
    hosts = layouts.groupBy("host").agg(
        F.min("hash").alias("hash"), F.max("last").alias("last"), F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("layouts")
    )
    several = hosts.filter("layouts > 1").select("host")
    first = (
        hosts.select("host", F.lit("").alias("level"), "hash", "last", "bytes")
        .unionByName(layouts.join(several, "host").select("host", F.col("layout").alias("level"), "hash", "last", "bytes"))
        .filter("hash < last")
    )
    few = (first.agg(F.sum("bytes")).first()[0] or 0) <= settings.broadcast_bytes
    small = F.broadcast if few else lambda df: df
    exemplars = checkpointed(
        hashed.select("host", "html", "hash")
        .join(small(first.select("host", "level", "hash")), ["host", "hash"])
        .groupBy("host", "level")
        .agg(F.min("html").alias("exemplar"))
    )

    def with_exemplars(found: DataFrame, names: dict[str, str]) -> DataFrame:
        """The pages with what ``found`` has for their host, and under other names for their layout."""
        own = found.filter("level = ''").drop("level")
        closer = found.filter("level <> ''").select("host", F.col("level").alias("layout"), *(F.col(c).alias(n) for c, n in names.items()))
        return source.join(small(own), "host", "left").join(small(closer), ["host", "layout"], "left")

    seen = with_exemplars(exemplars, {"exemplar": "closer"}).filter("exemplar IS NOT NULL")
    said = _slots(seen.select("host", "layout", "html", "exemplar", "closer"))
    said = said.groupBy("host", "layout", "slot", "said").agg(F.count(F.lit(1)).alias("n"))
    total = said.filter("slot = -1").select("host", "layout", F.col("n").alias("total"))
    template = (
        said.filter((F.col("slot") >= 0) & (F.col("n") >= settings.pages))
        .join(total, ["host", "layout"])
        .filter(F.col("n") >= settings.share * F.col("total"))
        .groupBy("host", F.col("layout").alias("level"))
        .agg(F.sort_array(F.collect_list(F.struct("slot", "said"))).alias("template"))
    )
    wrappers = exemplars.join(template, ["host", "level"])

    @F.pandas_udf("string")
    def content(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        wrapper = _Wrapper()
        for sources, *levels in batches:
            texts = []
            for one, exemplar, fixed, closer, closely in zip(sources, *levels):
                root, leaves, shape = parse(one)
                dropped: set[int] = set()
                for example, known in ((exemplar, fixed), (closer, closely)):
                    if known is not None:
                        constant = {(t["slot"], t["said"]) for t in known}
                        pairs = wrapper.pairs(example, root, shape)
                        dropped |= {own for own, slot in pairs if (slot, _digest(leaves[own].text)) in constant}
                kept = (
                    leaf.text for leaf in _inside(_regions(root, dropped)) if not leaf.hidden and leaf.number not in dropped
                )
                texts.append("\n".join(kept))
            yield pd.Series(texts, dtype=object)

    both = with_exemplars(wrappers, {"exemplar": "closer", "template": "closely"})
    return both.select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        content("html", "exemplar", "template", "closer", "closely").alias("text"),
    )


__all__ = ["Settings", "align", "main_text", "parse"]
