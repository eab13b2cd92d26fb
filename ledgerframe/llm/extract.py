"""Main text of web pages by minimum cuts over their blocks."""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/<>]*+)([^<>]*+)>?|<[!?/][^>]*+>?""")
MARK = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SPACE = re.compile(r"\s+")
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video select textarea head title".split())
# to the end of the page if left open; every other silent element ends with its parent
RAW = frozenset("script style".split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table tbody thead tfoot tr body div article section main nav aside footer header form".split())

# the classifier's weights: below zero for boilerplate, above for content
BY_TAG = {"nav": -8.0, "footer": -8.0, "aside": -8.0, "form": -6.0, "button": -6.0, "menu": -8.0, "dialog": -6.0, "header": -5.0, "article": 4.0, "main": 3.0}
BY_BLOCK = {"p": 1.0, "h1": 1.5, "h2": 0.5, "h3": 0.5, "blockquote": 0.5, "pre": 0.5, "li": -0.3}
BOILER_NAMES = frozenset(
    "nav navbar navigation menu menubar footer header masthead sidebar aside ad ads adv advert adverts advertisement "
    "banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay comment "
    "comments reply replies respond discussion disqus share sharing social related recommended breadcrumb breadcrumbs pagination "
    "pager subscribe subscription newsletter login signin signup register widget toolbar copyright legal disclaimer "
    "search skip contentinfo complementary dialog form".split()
)
CONTENT_NAMES = frozenset("article content post entry story main body text".split())
BOILER_WEIGHT, CONTENT_WEIGHT = -8.0, 1.5
SMOOTH = 0.7


# names behind these tell of something else on the page, or that it is missing
ELSEWHERE = frozenset("no not without has with".split())
# an element with so much of the page's plain text is a wrapper, not a menu
WRAPS = 0.8
# and an article with less of it is a teaser
FAIR = 0.2


@dataclass
class Block:
    text: str
    linked: int
    tag: str
    weight: float
    node: int


class Tree:
    """The page's elements, numbered as they open; 0 is the page itself."""

    def __init__(self) -> None:
        self.parents, self.depths, self.tags, self.own, self.plain = [-1], [0], [""], [0.0], [0]

    def add(self, parent: int, tag: str, own: float) -> int:
        self.parents.append(parent)
        self.depths.append(self.depths[parent] + 1)
        self.tags.append(tag)
        self.own.append(own)
        self.plain.append(0)
        return len(self.parents) - 1

    def steps(self, a: int, b: int) -> int:
        """Elements to leave and enter between two. Neighbours in the page are as far apart
        as tags stand between them, so all of them together take one walk over the tree."""
        n = 0
        while a != b:
            if self.depths[a] >= self.depths[b]:
                a = self.parents[a]
            else:
                b = self.parents[b]
            n += 1
        return n

    def weights(self, found: list[Block]) -> list[float]:
        """What each element and those around it speak for, summed.

        Costs of names and tags count for what they wrap only if that is a part of the
        page: not around the longest article or main element, if that has a fair share of
        the plain text, and else not around most of the plain text.
        """
        plain = self.plain
        for block in found:
            plain[block.node] += len(block.text) - block.linked
        for k in range(len(plain) - 1, 0, -1):
            plain[self.parents[k]] += plain[k]
        articles = [k for k, tag in enumerate(self.tags) if tag in ("article", "main") and self.own[k] > 0 and plain[k] > FAIR * plain[0]]
        around = set()
        at = max(articles, key=lambda k: (plain[k], k), default=0)
        while at > 0:
            at = self.parents[at]
            around.add(at)
        total = [0.0] * len(plain)
        for k in range(1, len(plain)):
            own = self.own[k]
            if own < 0 and self.tags[k] not in SILENT:
                wraps = k in around if articles else plain[k] >= WRAPS * plain[0] and plain[k] > 0
                own = 0.0 if wraps else own
            total[k] = total[self.parents[k]] + own
        return total


def _names(value: str) -> set[str]:
    found = set()
    for word in value.split():
        for part in NAME.findall(word):
            if part.lower() in ELSEWHERE:
                break
            found.add(part.lower())
    return found


def _own_weight(tag: str, attributes: str, inside_article: bool) -> float:
    weight = BY_TAG.get(tag, 0.0)
    if tag == "header" and inside_article:
        weight = 0.0  # an article's own head, not the page's
    if attributes and tag not in ("body", "html"):
        boiler = content = False
        for _, a, b, c in MARK.findall(attributes):
            names = _names(a or b or c)
            own = not names.isdisjoint(CONTENT_NAMES)
            # the head of an article is none of the page's
            boiler |= not (names - {"header"} if own else names).isdisjoint(BOILER_NAMES)
            content |= own
        if boiler:
            weight = min(weight, BOILER_WEIGHT)
        elif content:
            weight += CONTENT_WEIGHT
    return weight


class Open(NamedTuple):
    """An open element; what it has inherited saves looking through the stack."""

    tag: str
    block_tag: str
    article: bool
    node: int
    scope: int  # place of the nearest element that ends the reach of optional end tags


def blocks(page: str) -> list[Block]:
    return parsed(page)[0]


def parsed(page: str) -> tuple[list[Block], Tree]:
    """The page's runs of text between block-level tags, in page order, and its elements.

    Scripts, styles, heads and comments are left out. Every block carries the summed
    weights of the elements around it and their numbers from the root down; text within
    links is counted. Elements may be left open: a head ends at the first start tag that
    cannot stand in it, other silent elements but scripts and styles with their parent.
    Time and memory grow with the page, however deep its elements are nested.
    """
    out: list[Block] = []
    tree = Tree()
    parts: list[str] = []
    linked, links, at, size = 0, 0, 0, len(page)
    stack = [Open("", "", False, 0, 0)]
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    lower: str | None = None
    absent: set[str] = set()  # names without a further end tag

    def flush() -> None:
        nonlocal linked
        joined = "".join(parts)
        parts.clear()
        text = SPACE.sub(" ", entities.unescape(joined) if "&" in joined else joined).strip()
        if text:
            out.append(Block(text, linked, stack[-1].block_tag, 0.0, stack[-1].node))
        linked = 0

    def pop(to: int) -> None:
        nonlocal links
        for e in stack[to:]:
            links -= e.tag == "a"
            opened[e.tag].pop()
        del stack[to:]

    def nearest(tags: Iterable[str]) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    while at < size:
        cut = page.find("<", at)
        if cut < 0:
            cut = size
        if cut > at:
            parts.append(page[at:cut])
            if links:
                linked += cut - at
        if cut == size:
            break
        if page.startswith("<!--", cut):
            end = page.find("-->", cut + 4)
            at = size if end < 0 else end + 3
            continue
        found = TAG.match(page, cut)
        if not found:
            parts.append("<")
            at = cut + 1
            continue
        at = found.end()
        closing = found[1] or found[4]
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if not closing and tag not in IN_HEAD and tag != "head":
            for k in range(1, min(len(stack), 4)):  # below nothing, or html and body
                if stack[k][0] == "head":
                    flush()
                    pop(k)
                    break
        if tag in SILENT and not closing:
            flush()
            if tag not in ("head", "svg", "math", "object", "select"):
                lower = page.lower() if lower is None else lower
                source = lower if len(lower) == size else page
                end = -1 if tag in absent else source.find(f"</{tag}", at)
                if end < 0:
                    absent.add(tag)
                parent = stack[-1][0]
                bounds = ("</head", "<body") if parent == "head" else (f"</{parent}",) if parent else ()
                if tag in RAW:
                    at = size if end < 0 else end
                    continue
                if end >= 0 and all(source.find(b, at, end) < 0 for b in bounds):
                    at = end
                    continue
        if tag not in INLINE:
            flush()
        if closing:
            if opened.get(tag):
                pop(opened[tag][-1])
            continue
        if tag in VOID:
            continue
        ends = nearest(CLOSES.get(tag, ("p",))) if tag in CLOSES or tag not in INLINE else 0
        if ends and ends >= stack[-1].scope:
            pop(ends)
        top = stack[-1]
        # a head, a drawing or a list of choices has no text of the article
        own = -100.0 if tag in SILENT else _own_weight(tag, found[3] or found[6], top.article)
        opened.setdefault(tag, []).append(len(stack))
        stack.append(Open(
            tag, top.block_tag if tag in INLINE else tag, top.article or tag == "article",
            tree.add(top.node, tag, own), len(stack) if tag in SCOPE else top.scope,
        ))
        links += tag == "a"
    flush()
    total = tree.weights(out)
    for block in out:
        block.weight = total[block.node]
    return out, tree


def evidence(block: Block) -> float:
    """How much speaks for content (above 0) or boilerplate."""
    words = block.text.count(" ") + 1
    dense = min(1.0, block.linked / len(block.text))
    score = block.weight + BY_BLOCK.get(block.tag, 0.0) + min(2.0, words / 20) - 4.0 * dense
    if block.text[-1] in ".!?:;…。\"'”»)":
        score += 0.5
    elif words < 5:
        score -= 0.7
    return score - 0.3


def _edges(found: list[Block], tree: Tree) -> list[tuple[int, int, float]]:
    """Neighbours in the page, and next blocks below the same element; the nearer two
    blocks are in the tree, the dearer it is to part them."""
    edges, last = [], {}
    for i, block in enumerate(found):
        if i:
            edges.append((i - 1, i, SMOOTH / (1 + tree.steps(found[i - 1].node, block.node))))
        parent = tree.parents[block.node]
        if parent in last and last[parent] != i - 1:
            edges.append((last[parent], i, SMOOTH / 2))
        last[parent] = i
    return edges


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: the labelling of least cost.

    A score above 0 is the cost of not calling a node content, one below 0 that of
    calling it so; an edge costs its weight if its ends differ. The maximum flow is
    found over shortest augmenting paths, level by level.
    """
    n, eps = len(scores), 1e-9
    supply, demand = [max(s, 0.0) for s in scores], [max(-s, 0.0) for s in scores]
    near: list[list[int]] = [[] for _ in scores]
    to, room = [], []
    for a, b, weight in edges:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to += [b, a]
        room += [weight, weight]
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i] > eps)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            reached |= demand[i] > eps
            for e in near[i]:
                if room[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        tried = [0] * n
        for start in range(n):
            path: list[int] = []
            node = start
            while supply[start] > eps and level[start] == 0:
                if demand[node] > eps:
                    flow = min([supply[start], demand[node], *[room[e] for e in path]])
                    supply[start] -= flow
                    demand[node] -= flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    path, node = [], start
                    continue
                while tried[node] < len(near[node]):
                    e = near[node][tried[node]]
                    if room[e] > eps and level[to[e]] == level[node] + 1:
                        path.append(e)
                        node = to[e]
                        break
                    tried[node] += 1
                else:
                    if not path:
                        break
                    node = to[path.pop() ^ 1]
                    tried[node] += 1


def main_text(page: str) -> str:
    """The content blocks of a page, joined by blanks."""
    found, tree = parsed(page)
    scores = [evidence(b) for b in found]
    if not found or max(scores) <= 0:
        return ""
    keep = minimum_cut(scores, _edges(found, tree)) if min(scores) < 0 else [True] * len(found)
    return " ".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text)``: the main text of each whole page, one row per row.

    A page is cut into blocks; what speaks for content or boilerplate becomes the
    capacities to source and sink, neighbourhood in page and tree the edges between, and
    the minimum cut parts them. NULL, empty and pages without content give an empty text.
    Other columns are ignored. A narrow step.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string())], ["page_id", "url", "text"]
            )

    picked = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return picked.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
