"""Main text of web pages: blocks of text labelled by a minimum cut.

A page becomes a row of text blocks. A linear classifier gives each block the cost of
calling it content and of calling it boilerplate; these are the capacities of its edges
to the two terminals. Neighbouring blocks, and blocks under one parent, are tied by
smoothness edges that weaken with their distance in the element tree. The maximum flow
between the terminals leaves the cheapest labelling.

Pages are handled one by one within a task, without a shuffle.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_texts

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
ATTR = re.compile(r"""([^\s=/"'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.S)

#: Elements whose text is not part of a page's text.
SILENT = frozenset("script style noscript template iframe object svg canvas math audio video head title select textarea datalist".split())
#: Of these, the ones whose content is not markup.
RAW = frozenset("script style iframe title textarea".split())
#: What a head may hold; anything else begins the body.
HEAD = frozenset("title meta link script style base basefont bgsound noframes noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
#: A paragraph ends where one of these begins.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
    "section table ul".split()
)
#: An element of the key closes an open one of the value within the nearest list or table.
ENDS_ITEM = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
ITEM_ROOM = frozenset("ul ol dl menu table body article main section div".split())

BOILER_TAGS = frozenset("nav footer aside form menu dialog button".split())
MAIN_TAGS = frozenset("article main".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert newsletter subscribe subscription signup login paywall popup modal overlay comment comments disqus reply replies "
    "respond discussion share sharing social related recommended recommendations trending popular sidebar aside menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager footer masthead toolbar skip search form legal copyright disclaimer "
    "complementary contentinfo".split()
)
#: A class of several words with one of these tells what a wrapper has or has not, not what it is.
LAYOUT_WORDS = frozenset("has have with without no not non".split())
HEADER_WORDS = frozenset("header topbar banner".split())
MAIN_WORDS = frozenset("article articlebody post entry story content main text".split())
PART = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Weights of the classifier: the log odds that a block is content.
WEIGHTS = {
    "bias": -0.8,
    "words": 2.5,  # times the share of 40 words that the block has
    "links": -4.0,  # times the share of its characters inside links
    "stops": 0.9,  # it ends like a sentence
    "heading": 0.5,
    "main": 2.0,
    "outside": -2.5,  # the page has an article and this block is not in it
    "boiler": -9.0,  # an element around it is of a kind or a class that holds no content
}
SMOOTH, REACH = 1.2, 3.0


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    linked: int
    main: bool
    boiler: bool
    heading: bool
    hinted: tuple[int, ...] = ()  # elements around it with a class that holds no content


@dataclass
class Element:
    tag: str
    key: int
    main: bool
    boiler: bool
    link: bool
    heading: bool
    hinted: tuple[int, ...] = ()


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    has_main: bool = False
    holders: set[int] = field(default_factory=set)  # hinted elements around an article


def hints(attrs: str) -> set[str]:
    """Words of class, id, role and itemprop."""
    out: set[str] = set()
    for m in ATTR.finditer(attrs):
        if m[1].lower() in ("class", "id", "role", "itemprop", "aria-label"):
            for name in (m[2] or m[3] or m[4] or "").split():
                said = PART.findall(CAMEL.sub(" ", name).lower())
                out.update(said if LAYOUT_WORDS.isdisjoint(said) else set(said) - BOILER_WORDS - HEADER_WORDS)
        elif m[1].lower() == "aria-hidden" and (m[2] or m[3] or m[4]) == "true":
            out.add("overlay")
    return out


def parse(source: str) -> Page:
    """Blocks of a page in order, however badly its elements are closed."""
    page, stack, pieces, linked = Page(), [], [], 0
    count, at = 0, 0
    ends: dict[int, int] = {}

    def end_block():
        nonlocal pieces, linked
        text = " ".join("".join(pieces).split())
        if text:
            top = stack[-1] if stack else Element("", 0, False, False, False, False)
            page.blocks.append(
                Block(
                    text, tuple(e.key for e in stack if e.tag not in INLINE), linked, top.main, top.boiler, any(e.heading for e in stack),
                    top.hinted,
                )
            )
        pieces, linked = [], 0

    def add(raw: str):
        nonlocal linked
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            pieces.append(raw)
            if stack and stack[-1].link:
                linked += len(raw.strip())

    while True:
        m = TOKEN.search(source, at)
        if not m:
            add(source[at:])
            break
        add(source[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        if m["close"]:
            if any(e.tag == tag for e in stack):
                if tag not in INLINE:
                    end_block()
                while stack.pop().tag != tag:
                    pass
            elif tag in ("p", "br"):
                end_block()
            continue
        if tag in SILENT:
            if not (tag in ("svg", "math") and m["attrs"].endswith("/")):
                at = _skip(source, at, tag, {e.tag for e in stack} - {"html", "body"}, ends)
            if tag not in INLINE:
                end_block()
            continue
        if tag not in INLINE:
            end_block()
            if tag in ENDS_P and any(e.tag == "p" for e in stack):
                while stack.pop().tag != "p":
                    pass
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in ENDS_ITEM.get(tag, ()):
                    del stack[k:]
                elif stack[k].tag in ITEM_ROOM:
                    break
        if tag in VOID:
            continue
        up = stack[-1] if stack else Element("", 0, False, False, False, False)
        said = hints(m["attrs"]) if "=" in m["attrs"] else set()
        count += 1
        main = up.main or tag in MAIN_TAGS or bool(said & {"articlebody", "article"})
        # A header inside the article holds its title; outside it is the page's own.
        boiler = up.boiler or tag in BOILER_TAGS or (tag == "header" and not up.main)
        hinted = up.hinted
        if tag not in ("html", "body", "article", "main"):
            if said & BOILER_WORDS or (not up.main and said & HEADER_WORDS):
                hinted += (count,)
        elif tag in MAIN_TAGS and not said & BOILER_WORDS:
            page.holders.update(hinted)
        page.has_main |= main
        heading = len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"
        stack.append(Element(tag, count, main or (not boiler and not hinted and bool(said & MAIN_WORDS)), boiler, up.link or tag == "a", heading, hinted))
    end_block()
    weigh_hints(page)
    return page


def weigh_hints(page: Page) -> None:
    """Whether hints make a block boilerplate.

    A hint counts in full unless its element wraps the page's content: it holds most words
    outside boilerplate elements, or an article, and no article stands free of hints; or
    it holds both. Such a hint says nothing of what is inside.
    """
    size, total, free = Counter(), 0, False
    for b in page.blocks:
        if not b.boiler:
            n = b.text.count(" ") + 1
            total += n
            size.update(dict.fromkeys(b.hinted, n))
            free = free or (b.main and not b.hinted)
    wraps = {k for k, n in size.items() if (2 * n > total) + (k in page.holders) > free}
    for b in page.blocks:
        b.boiler = b.boiler or any(k not in wraps for k in b.hinted)


def _skip(source: str, at: int, tag: str, around: set[str], ends: dict[int, int]) -> int:
    """Where a silent element's content ends: behind its end tag, or else before the end
    tag of an element around it that is not the whole page. One without either has none.

    ``ends``: of the silent elements met so far, so that no stretch is searched twice.
    """
    if tag in RAW:
        end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
        return end.end() if end else len(source)
    if at in ends:
        return ends[at]
    inner, place = [(tag, at)], at
    while m := TOKEN.search(source, place):
        place = m.end()
        name = (m["tag"] or "").lower()
        if not name:
            continue
        if m["close"]:
            if any(x == name for x, _ in inner):
                while (x := inner.pop())[0] != name:
                    ends[x[1]] = m.start()
                ends[x[1]] = place
                if not inner:
                    return place
            elif name in around:
                return m.start()
        elif tag == "head" and name not in HEAD:
            return m.start()
        elif name in RAW:
            if not m["attrs"].endswith("/") or not {"svg", "math"} & {x for x, _ in inner}:
                place = _skip(source, place, name, around, ends)
        elif name not in VOID and not m["attrs"].endswith("/"):
            inner.append((name, place))
    ends.update((x, x) for _, x in inner)
    return at


def odds(block: Block, has_main: bool) -> float:
    w = WEIGHTS
    words = block.text.count(" ") + 1
    out = w["bias"] + w["words"] * min(words, 40) / 40 + w["links"] * min(1.0, block.linked / max(1, len(block.text)))
    out += w["stops"] * (block.text[-1] in ".!?…:;\"”»") + w["heading"] * block.heading
    out += w["main"] * block.main + w["outside"] * (has_main and not block.main) + w["boiler"] * block.boiler
    return out


def distance(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    """Steps between two elements of the tree."""
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return len(a) + len(b) - 2 * same


def ties(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: to the next block, and to the last block under the same parent."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            out.append((i - 1, i, SMOOTH * math.exp(-distance(blocks[i - 1].path, b.path) / REACH)))
        parent = b.path[:-1]
        before = last.get(parent)
        if before is not None and before < i - 1:
            out.append((before, i, SMOOTH * math.exp(-distance(blocks[before].path, b.path) / REACH)))
        last[parent] = i
    return out


def minimum_cut(costs: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut.

    ``costs``: of a node on the source's side and of one on the sink's side. Augments
    along shortest paths; a node keeps only the difference of its two costs, as the
    smaller of the two flows straight through it. Ties go to the sink's side.
    """
    n = len(costs)
    source = [max(0.0, b - a) for a, b in costs]
    sink = [max(0.0, a - b) for a, b in costs]
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        room[a][b] = room[a].get(b, 0.0) + c
        room[b][a] = room[b].get(a, 0.0) + c
    tiny = 1e-9
    while True:
        came: dict[int, int] = {i: -1 for i in range(n) if source[i] > tiny}
        queue, goal = deque(came), -1
        while queue:
            a = queue.popleft()
            if sink[a] > tiny:
                goal = a
                break
            for b, c in room[a].items():
                if c > tiny and b not in came:
                    came[b] = a
                    queue.append(b)
        if goal < 0:
            return [i in came for i in range(n)]
        flow, b = sink[goal], goal
        while came[b] >= 0:
            flow = min(flow, room[came[b]][b])
            b = came[b]
        flow = min(flow, source[b])
        source[b] -= flow
        sink[goal] -= flow
        b = goal
        while came[b] >= 0:
            a = came[b]
            room[a][b] -= flow
            room[b][a] += flow
            b = a


def costs(value: float) -> tuple[float, float]:
    """Costs of content and of boilerplate: negative logarithms of their probabilities."""
    return math.log1p(math.exp(-value)), math.log1p(math.exp(value))


def content(source: str) -> list[str]:
    """Texts of the blocks that the cut leaves with the content."""
    page = parse(source)
    labels = minimum_cut([costs(odds(b, page.has_main)) for b in page.blocks], ties(page.blocks))
    return [b.text for b, kept in zip(page.blocks, labels, strict=True) if kept]


def with_main_text(pages: DataFrame, source: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add ``text``, the main text of a page, and ``n_blocks``, its number of blocks.

    White space inside a block becomes one blank, blocks are joined by one blank in page
    order. A null or empty page, or one without content, has the empty text. Repeated
    pages are treated alike. Input columns named like an output are replaced.
    """

    def step(texts):
        found = [content(t.as_py().decode("utf-8", "replace")) for t in texts]
        return [[" ".join(f) for f in found], [len(f) for f in found]]

    return map_texts(pages, lambda: step, [("text", "string", pa.string()), ("n_blocks", "bigint", pa.int64())], source, keep)


def digest(pages: DataFrame) -> DataFrame:
    found = with_main_text(pages, keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
