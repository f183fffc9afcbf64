"""Main text of web pages by minimum-cut labelling of text blocks.

A page becomes a list of text blocks with their place in the element tree. A linear classifier
(fixed weights over tag, class and id words, link share, length and punctuation) gives each block
a cost for being called boilerplate or content: its capacities to the two terminals. Neighbouring
blocks, and consecutive blocks of one region of the tree, are tied by smoothness edges. The
minimum cut, found by augmenting paths, is the labelling of least total cost.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.session import read_table

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
#: One attribute: its whole name, then its value in double or single quotes (to the end when the quote stays open) or bare.
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"?+|'([^']*+)'?+|([^\s>]*+)))?+""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# HTML element kinds.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
DROPPED = frozenset("noscript template svg object embed canvas audio video select option datalist button input label head".split())
#: What can stand in a head; anything else ends it, as its end tag can be left out.
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
#: Elements that an implied end does not cross.
BARRIER = frozenset("html body table ul ol dl div section article main aside nav header footer form blockquote td th li".split())

# The attributes that are read.
READ = frozenset("class id role style itemprop hidden aria-hidden".split())

# Words of class, id and role that tell page furniture or the article.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising aside banner bar breadcrumb breadcrumbs byline captcha comment comments "
    "consent contact cookie cookies copyright dialog disclaimer discussion disqus feedback foot footer form gdpr header "
    "hidden legal login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager "
    "pagination paywall popup pp promo promoted promotion recommended related replies reply respond search share sharing "
    "sidebar sidenav signin signup skip social sponsor sponsored subscribe subscription tags teaser toc toolbar topbar "
    "warning widget widgets".split())
ARTICLE = frozenset("article articlebody blogpost body content entry hentry main post story text".split())
FURNITURE_TAGS = frozenset("nav footer aside form header menu dialog fieldset".split())
ARTICLE_TAGS = frozenset("article main".split())
#: First words of names that tell what a wrapper has or how it is laid out (has-sidebar, overflow-hidden), not what it is.
DESCRIBING = frozenset("has have with without no not overflow backface".split())
#: Points for text of an article; costs of a furniture tag, of a name made of furniture words only, of a name that holds
#: one, and of names inside one another. A name's cost can be outweighed by the other evidence, which reaches 240.
IN_ARTICLE, BY_TAG, BY_NAME, BY_PART, BY_NAMES = 320, 320, 200, 120, 220
TAG_WEIGHT = {"p": 60, "blockquote": 60, "pre": 60, "h1": 60, "h2": 40, "h3": 40, "h4": 20, "li": -20, "td": -20, "th": -20,
              "address": -80, "dt": 0, "dd": 10, "figcaption": 10}


#: Cells of a table row that is read as one statement at most.
ROW_CELLS = 4


class _Element:
    __slots__ = ("tag", "hint", "cause", "region", "dropped", "serial")

    def __init__(self, tag, hint, cause, region, dropped, serial):
        self.tag, self.hint, self.cause, self.region, self.dropped, self.serial = tag, hint, cause, region, dropped, serial


class _Stack:
    """Open elements, with the depths of each tag and of all that are not inline, so that no look
    walks over elements that stay: broken pages leave many thousands of tags open."""

    def __init__(self):
        self.items = [_Element("", 0, None, 0, False, 0)]
        self.depths: defaultdict[str, list[int]] = defaultdict(list)
        self.outer: list[int] = [0]

    @property
    def top(self) -> _Element:
        return self.items[-1]

    def push(self, e: _Element) -> None:
        self.depths[e.tag].append(len(self.items))
        if e.tag not in INLINE:
            self.outer.append(len(self.items))
        self.items.append(e)

    def cut(self, depth: int) -> int:
        """Close all elements from ``depth`` on; returns how many of them were links."""
        links = 0
        for _ in range(len(self.items) - depth):
            e = self.items.pop()
            self.depths[e.tag].pop()
            links += e.tag == "a"
            if e.tag not in INLINE:
                self.outer.pop()
        return links

    def last(self, tag: str) -> int:
        """Depth of the innermost open ``tag``; 0 if there is none."""
        return self.depths[tag][-1] if self.depths[tag] else 0

    def ended(self, ends: set[str]) -> int:
        """Depth of the outermost open element of ``ends`` inside the innermost barrier; 0 if none."""
        ends = {t for t in ends if self.depths[t]}
        if not ends:
            return 0
        wall = max(self.last(t) for t in BARRIER if t not in ends)
        inside = [d[bisect_right(d, wall)] for d in (self.depths[t] for t in ends) if d[-1] > wall]
        return min(inside, default=0)


class Block:
    """A run of text between block-level tags. ``row`` is the table row it stands in, if any."""

    __slots__ = ("text", "linked", "tag", "hint", "named", "region", "row")

    def __init__(self, text, linked, tag, hint, named, region, row):
        self.text, self.linked, self.tag, self.hint, self.named, self.region = text, linked, tag, hint, named, region
        self.row = row


def _attributes(text: str) -> dict[str, str]:
    """The attributes of ``READ`` in a start tag by their whole name; of a repeated one the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        if name.lower() in READ:
            found.setdefault(name.lower(), "".join(values))
    return found


def _name_cost(value: str) -> int:
    """Cost of the furniture words in the names of a class, id or role."""
    cost = 0
    for name in value.split():
        parts = [p.lower() for p in _NAME_PARTS.findall(name)]
        if FURNITURE.isdisjoint(parts) or parts[0] in DESCRIBING or "layout" in parts or parts[-1] == "page":
            continue
        cost = max(cost, BY_NAME if all(p in FURNITURE or p.isdigit() for p in parts) else BY_PART)
    return cost


def _child(parent: _Element, tag: str, attributes: str, serial: int) -> _Element:
    """The element's own reading: furniture marks outweigh article marks and go down the tree, up to
    an inner article. ``cause`` is the tag or the cost of the name that made the hint negative."""
    dropped = parent.dropped or tag in DROPPED
    furniture, article = tag in FURNITURE_TAGS, tag in ARTICLE_TAGS
    if tag == "header" and parent.hint > 0:
        furniture = False                                      # an article's own heading
    cost, body = 0, tag == "main"
    if attributes:
        for name, value in _attributes(attributes).items():
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
                dropped = True
            elif name != "style":
                cost = max(cost, _name_cost(value))
                article |= not ARTICLE.isdisjoint(p.lower() for p in _NAME_PARTS.findall(value))
                body |= name == "itemprop" and "articlebody" in value.lower().split()
    inner = body or tag == "article"
    if furniture and not body:
        return _Element(tag, -BY_TAG, tag, serial, dropped, serial)
    if cost and not inner and tag not in ("html", "body"):
        if parent.hint >= 0:
            return _Element(tag, -cost, cost, serial, dropped, serial)
        cause = max(cost, parent.cause) if isinstance(parent.cause, int) else parent.cause
        return _Element(tag, min(parent.hint, -BY_NAMES), cause, serial, dropped, serial)
    if article and parent.hint >= 0:
        return _Element(tag, IN_ARTICLE, None, serial, dropped, serial)
    if body or inner and not cost and parent.cause in ("form", "fieldset", BY_PART):
        return _Element(tag, IN_ARTICLE, None, serial, dropped, serial)
    if inner and not cost and parent.cause == BY_NAME:
        return _Element(tag, 0, None, serial, dropped, serial)     # an article, or one of a list: its text decides
    region = serial if tag in ("div", "section", "table", "ul", "ol", "dl") else parent.region
    return _Element(tag, parent.hint, parent.cause, region, dropped, serial)


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order. Broken markup is read leniently: an unclosed comment or
    raw element runs to the end, a tag cut off at the end is dropped."""
    stack, out = _Stack(), []
    text, linked, links, serial, at, size = [], 0, 0, 0, 0, len(page)
    lowered = None

    def flush():
        nonlocal text, linked
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                top, row = stack.top, stack.last("tr")
                out.append(Block(" ".join(words), linked, stack.items[stack.outer[-1]].tag, top.hint, isinstance(top.cause, int), top.region,
                                 stack.items[row].serial if row else None))
        text, linked = [], 0

    def say(part: str):
        nonlocal linked
        if stack.top.tag == "head" and part.strip():
            stack.cut(len(stack.items) - 1)
        if part and not stack.top.dropped:
            text.append(part)
            if links:
                linked += len(part)

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        if lt > at:
            say(page[at:lt])
        after = page[lt + 1:lt + 2]
        if after in "!?" and after:
            end = page.find("-->", lt + 4) + 3 if page.startswith("<!--", lt) else page.find(">", lt) + 1
            at = end if end > 2 else size
            continue
        found = _TAG.match(page, lt) or _LOOSE_TAG.match(page, lt)
        if not found:
            if not after or after == "/" and lt + 2 >= size or re.match(r"/?[a-zA-Z]", page[lt + 1:lt + 3]):
                gt = page.find(">", lt)
                at = size if gt < 0 else gt + 1                # a cut or broken tag
            elif after == "/":
                gt = page.find(">", lt)
                at = size if gt < 0 else gt + 1
            else:
                say("<")
                at = lt + 1
            continue
        at = found.end()
        closing, tag, attributes = found.group(1), found.group(2).lower(), found.group(3)
        if tag == "br":
            say("\n")
            continue
        if not closing and tag == "head" and len(stack.items) - 1 > len(stack.depths["html"]):
            continue                                           # a second head, or one inside the body
        if stack.top.tag == "head" and (tag in ("body", "html") if closing else tag not in IN_HEAD):
            stack.cut(len(stack.items) - 1)
        elif not closing and tag == "body" and stack.depths["head"]:
            links -= stack.cut(stack.depths["head"][0])        # with an open element in it
        if not closing and tag in RAW:
            lowered = page.lower() if lowered is None else lowered
            end = lowered.find("</" + tag, at) if len(lowered) == size else page.find("</" + tag, at)
            gt = page.find(">", end) if end >= 0 else -1
            at = size if gt < 0 else gt + 1
            continue
        if tag not in INLINE:
            flush()
        if closing:
            depth = stack.last(tag)
            if depth and (tag not in INLINE or depth > stack.outer[-1]):   # else a stray end tag
                links -= stack.cut(depth)
            continue
        if tag in VOID or attributes.endswith("/") and tag in DROPPED:
            continue
        ends = {"p"} if tag not in INLINE else set()
        ends |= CLOSES.get(tag, set())
        if tag == "a":
            ends = {"a"}
        depth = stack.ended(ends) if ends else 0
        if depth:
            links -= stack.cut(depth)
        serial += 1
        stack.push(_child(stack.top, tag, attributes, serial))
        links += tag == "a"
    flush()
    return out


def _unary(b: Block, most: int = BY_NAMES) -> int:
    """Evidence for content (positive) or boilerplate (negative); names cost ``most`` at most."""
    words = b.text.count(" ") + 1
    score = (max(b.hint, -most) if b.named else b.hint) + TAG_WEIGHT.get(b.tag, 0) - 60
    score += min(words, 40) * 5
    if b.text[-1] in ".!?:;\"”»)" and words > 3:
        score += 40
    share = min(1.0, b.linked / max(1, len(b.text)))
    score -= int((260 if words < 60 else 120) * share)
    if "©" in b.text or "all rights reserved" in b.text.lower() and words < 30:
        score -= 120
    return score


def _evidence(blocks: list[Block], most: int = BY_NAMES) -> list[int]:
    """Evidence of all blocks. A short cell beside a sentence belongs to it: in a table row of a
    few cells without links it weighs half as much against content as the best cell weighs for it."""
    unary = [_unary(b, most) for b in blocks]
    rows = defaultdict(list)
    for i, b in enumerate(blocks):
        if b.row is not None:
            rows[b.row].append(i)
    for cells in rows.values():
        best = max(unary[i] for i in cells)
        if best > 0 and 1 < len(cells) <= ROW_CELLS and all(blocks[i].tag in ("td", "th") and not blocks[i].linked for i in cells):
            for i in cells:
                if blocks[i].hint >= 0:
                    unary[i] = max(unary[i], -best // 2)
    return unary


def minimum_cut(unary: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Side of every node in the minimum cut: True where it stays with the content terminal.

    Each node's two terminal capacities first cancel, which leaves an excess or a deficit. Paths
    from excess to deficit are augmented one by one; once a search finds none, all it reached
    belongs to the content side for good and is not searched again.
    """
    n = len(unary)
    to: list[list[int]] = [[] for _ in range(n)]
    cap: list[list[int]] = [[] for _ in range(n)]
    twin: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        twin[a].append(len(to[b]))
        twin[b].append(len(to[a]))
        to[a].append(b)
        to[b].append(a)
        cap[a].append(w)
        cap[b].append(w)
    left, settled = list(unary), [False] * n
    for start in range(n):
        while left[start] > 0 and not settled[start]:
            came: dict[int, tuple[int, int]] = {start: (-1, -1)}
            queue, goal = deque([start]), -1
            while queue:
                u = queue.popleft()
                if left[u] < 0:
                    goal = u
                    break
                for x, v in enumerate(to[u]):
                    if cap[u][x] > 0 and v not in came and not settled[v]:
                        came[v] = (u, x)
                        queue.append(v)
            if goal < 0:
                for u in came:
                    settled[u] = True
                break
            flow, v = min(left[start], -left[goal]), goal
            while v != start:
                u, x = came[v]
                flow = min(flow, cap[u][x])
                v = u
            v = goal
            while v != start:
                u, x = came[v]
                cap[u][x] -= flow
                cap[v][twin[u][x]] += flow
                v = u
            left[start] -= flow
            left[goal] += flow
    return settled


def main_text(page: str | None) -> str:
    """Content blocks joined by an empty line. Where names left no content at all, they were those
    of wrappers of the whole page, and count least."""
    blocks = blocks_of(page) if page else []
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            before = blocks[i - 1]
            same = before.hint == b.hint
            edges.append((i - 1, i, (60 if before.region == b.region else 30) if same else 8))
        if b.region in last and last[b.region] < i - 1:
            edges.append((last[b.region], i, 40))              # consecutive in one region of the tree
        last[b.region] = i
    content = minimum_cut(_evidence(blocks), edges)
    if not any(content) and any(b.named for b in blocks):
        content = minimum_cut(_evidence(blocks, BY_PART), edges)
    return "\n\n".join(b.text for b, c in zip(blocks, content) if c)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    for b in batches:
        texts = [main_text(x) for x in b.column(2).to_pylist()]
        yield packed.batch(schema, [b.column(0), b.column(1).cast(pa.string()), texts, [len(t) for t in texts]])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages`` (page_id, url, html; other
    columns are ignored). Character references are decoded, white space inside a block becomes
    one space, blocks are joined in page order by an empty line. Whole pages, no shuffle.

    Defined cases: a null, empty or text-free page has an empty text; null ids and urls pass
    through; repeated rows are extracted one by one; an empty table gives no rows. Pages of any
    length and depth, also with very many unclosed or stray tags, are read in time that follows
    their length.
    """
    packed.small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(packed.lean(_extract), "page_id long, url string, text string, n_chars long")


def op1_html_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(read_table(spark, sf_dir, "pages"))


QUERIES = {"op1_html_text": op1_html_text}
