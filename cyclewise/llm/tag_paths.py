"""Main text of web pages by tag-path ratios.

A page is read as a stream of tags. Text is gathered into blocks (inline tags belong to
their block), and every block has a root-to-leaf path of block tags with their classes.

1. Aggregate: per path of a page, the mean text length and the mean number of punctuation
   marks of its blocks.
2. Smooth: both series, in page order, over neighbouring blocks, with weights that fall with
   distance and are lower between paths that are not the same or siblings.
3. Fuse: the product of both is the ratio of a path at a block. A block counts for the ratio
   of its path, but for no more than its own length and marks give, and times factors: lower
   for text inside links and for blocks that
   open with a copyright sign, and 0 for parts that tags or class words mark as beside the
   article (menus, headers, footers, sidebars, notices, adverts, forms, comments).
4. Lift: a node's score is the text-weighted mean of the blocks below it, parts beside the
   article left out, or a share of its parent's score if that is more. So headings and short paragraphs share the score of the
   nodes they stand in; ``html`` and ``body`` give nothing, and an ``article`` or a part
   beside the article takes nothing. A heading also has a share of the block it stands above.
5. Threshold: nodes whose score reaches a share of the text-weighted mean of the page are
   content. The text is made of their blocks.

No tag or class is needed to find the article: they only lower the score of other parts.
Paths are numbered, elements know their path, block and depth, and open elements are found
by name, so time and memory grow in proportion to the page, however deep its nesting.

A page is handled by itself, so the job is one pass without a shuffle.

Defined results: null, empty or text-free html gives an empty text of length 0; markup that
is never closed is closed where its parent ends; repeated rows give repeated equal rows; an
empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from cyclewise.llm.common import prepare

SCHEMA = "page_id long, url string, text string, n_chars long"

# Names of HTML elements by their role.
BLOCK_TAGS = set(
    "html head body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody "
    "tfoot tr td th blockquote pre figure figcaption address hr header footer nav aside form fieldset legend "
    "details summary center menu dialog search hgroup".split()
)
RAW_TAGS = set("script style textarea title noscript template iframe xmp noembed noframes svg math canvas object audio video".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
OTHER_TAGS = set("head nav footer aside form fieldset menu dialog search button select option datalist label".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements that an opening tag ends without a closing tag, and where the search stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, {"html"}),
}
#: An open paragraph is not ended across these.
P_WALLS = set("table td th li article section div blockquote body".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words in class or id names that mark parts beside the article.
SIDE_WORDS = set(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs masthead banner header topbar footer bottombar "
    "sidebar sidebars aside ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors "
    "promo promos promotion promoted cookie cookies consent gdpr privacy notice notices notification notifications "
    "alert alerts popup modal overlay lightbox subscribe subscription newsletter signup signin login paywall form "
    "search searchbox comment comments commentlist disqus respond reply replies reactions discussion feedback share "
    "shares sharing social related recommended recommendations trending popular widget widgets toolbar pagination "
    "pager skip copyright legal disclaimer teaser teasers outbrain taboola".split()
)
HEADER_WORDS = {"header"}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>", re.S)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？¿¡]")

#: Blocks on either side, and width of the bell curve, used in smoothing.
RADIUS = 2
SIGMA = 1.0
#: Weight between blocks of the same path, of sibling paths, and of others.
SAME, SIBLING, OTHER = 1.0, 0.5, 0.1
#: Factor for parts that tags or class words mark as beside the article.
SIDE_FACTOR = 0.0
#: Factor for text that is all links, and for text that opens with a copyright sign.
LINK_FACTOR = 0.2
NOTICE_FACTOR = 0.05
#: Share of its parent's score that a node has at least.
LIFT = 0.5
#: A node is content from this share of the text-weighted mean score on.
PATH_SHARE = 0.2
COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b)", re.I)


@dataclass(eq=False)
class Element:
    tag: str
    parent: Element | None
    path: int  # number of its path; inline elements have that of their block
    above: int  # number of the path one step up
    aside: bool  # stands in, or is, a part beside the article
    header: bool = False
    in_article: bool = False
    block: Element | None = None  # the element whose text its own text belongs to
    chars: float = 0.0
    total: float = 0.0
    score: float = 0.0


@dataclass(eq=False)
class Block:
    element: Element
    text: str
    linked: int  # characters inside links

    @property
    def path(self) -> int:
        return self.element.path


def _labels(attributes: str) -> tuple[str, list[str], str]:
    first, words, role = "", [], ""
    for name, a, b, c in NAMED.findall(attributes):
        value = a or b or c
        if name.lower() == "role":
            role = value.lower()
            continue
        if name.lower() == "class" and value.split():
            first = value.split()[0]
        words += [w.lower() for w in WORD.findall(value)]
    return first, words, role


class _Page:
    """Open elements of a page, found by name, and the numbers of its paths."""

    def __init__(self) -> None:
        root = Element("", None, 0, 0, False)
        root.block = root
        self.elements = [root]
        self.stack = [root]
        self.places: dict[str, list[int]] = {}
        self.paths: dict[tuple[int, str], int] = {}

    def nearest(self, names) -> int:
        """Place of the innermost open element of one of the names, 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def close(self, place: int) -> list[Element]:
        closed = self.stack[place:]
        for e in closed:
            self.places[e.tag].pop()
        del self.stack[place:]
        return closed

    def open(self, tag: str, attributes: str) -> Element:
        parent = self.stack[-1]
        first, words, role = _labels(attributes) if "=" in attributes else ("", [], "")
        aside, header = parent.aside, parent.header
        if tag not in ("html", "body", "article", "main"):
            said = SIDE_WORDS.intersection(words)
            if tag == "header" or (said and said <= HEADER_WORDS) or role == "banner":
                header = True
            elif said or tag in OTHER_TAGS or role in ROLES or (attributes and HIDDEN.search(attributes)):
                aside = True
        path, above = parent.path, parent.above
        if tag in BLOCK_TAGS:
            above = parent.path
            path = self.paths.setdefault((above, f"{tag}.{first}"), len(self.paths) + 1)
        inside = parent.in_article or tag in ("article", "main")
        element = Element(tag, parent, path, above, aside, header, inside)
        element.block = element if tag in BLOCK_TAGS or (aside and not parent.aside) else parent.block
        self.elements.append(element)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(element)
        return element

    def end_open(self, tag: str) -> None:
        """Close elements that ``tag`` ends: an open paragraph, and items or cells of the same list or table."""
        ends, stops = ENDS.get(tag, (set(), set()))
        for names, walls in ((ends, stops), ({"p"}, P_WALLS)):
            place = self.nearest(names)
            if place and place > self.nearest(walls):
                self.close(place)


def _read(page: str) -> tuple[list[Element], list[Block]]:
    """All elements in the order of their begin, and the blocks of text in page order."""
    blocks: list[Block] = []
    state = _Page()
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            parts.clear()
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                blocks.append(Block(state.stack[-1].block, text, min(linked, len(text))))
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if state.places.get("a"):
            linked += len(text.strip())

    at, size = 0, len(page)
    last = page.rfind(">") + 1
    while at < size:
        found = TAG.search(page, at, last) if at < last else None
        if found is None:
            comment = page.find("<!--", at)  # a comment that never ends hides the rest
            take(page[at : comment if comment >= 0 else size])
            break
        if found.start() > at:
            take(page[at : found.start()])
        at = found.end()
        if at == last and found[0].startswith("<!--") and not found[0].endswith("-->"):
            break
        tag = (found[2] or "").lower()
        if not tag:
            continue
        closing = bool(found[1])
        if tag == "br":
            parts.append(" ")
        elif tag in RAW_TAGS and not closing:
            if tag in ("title", "object", "svg"):
                flush()
            if not found[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else size
        elif tag in VOID_TAGS:
            if tag == "hr":
                flush()
        elif closing:
            place = state.nearest((tag,))
            if place:
                if any(e.block is e for e in state.stack[place:]):
                    flush()
                state.close(place)
        else:
            if tag in BLOCK_TAGS:
                flush()
                state.end_open(tag)
            owner = state.stack[-1]
            element = state.open(tag, found[3])
            if element.aside and not owner.aside and parts:
                pending = state.stack.pop()  # the text so far belongs to the element around it
                flush()
                state.stack.append(pending)
    flush()
    return state.elements, blocks


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order, each with the element it stands in."""
    return _read(page)[1]


def path_scores(blocks: list[Block]) -> list[float]:
    """Smoothed and fused ratio of every block's path."""
    sums: dict[int, list[float]] = {}
    for b in blocks:
        s = sums.setdefault(b.path, [0.0, 0.0, 0.0])
        s[0] += len(b.text)
        s[1] += len(PUNCTUATION.findall(b.text))
        s[2] += 1
    ratios = [(sums[b.path][0] / sums[b.path][2], sums[b.path][1] / sums[b.path][2]) for b in blocks]
    bell = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(RADIUS + 1)]
    scores = []
    for i, b in enumerate(blocks):
        total = length = marks = 0.0
        for j in range(max(0, i - RADIUS), min(len(blocks), i + RADIUS + 1)):
            w = bell[abs(i - j)] * _alike(b.element, blocks[j].element)
            total += w
            length += w * ratios[j][0]
            marks += w * ratios[j][1]
        scores.append((length / total) * (1 + marks / total))
    return scores


def _alike(a: Element, b: Element) -> float:
    return SAME if a.path == b.path else SIBLING if a.above == b.above else OTHER


def _factor(b: Block, links: dict[int, list[int]]) -> float:
    """1 for plain text; less for links, and ``SIDE_FACTOR`` for what is marked as beside the article."""
    e = b.element
    own_heading = e.header and e.in_article and e.tag in HEADINGS
    if e.aside or (e.header and not own_heading):
        return SIDE_FACTOR
    linked, chars = links[b.path]
    return (1.0 - (1.0 - LINK_FACTOR) * linked / chars) * (NOTICE_FACTOR if COPYRIGHT.match(b.text) else 1.0)


def node_scores(elements: list[Element], blocks: list[Block]) -> tuple[list[float], list[float]]:
    """Lifted score and factor of every block."""
    links: dict[int, list[int]] = {}
    for b in blocks:
        of_path = links.setdefault(b.path, [0, 0])
        of_path[0] += b.linked
        of_path[1] += len(b.text)
    factors = [_factor(b, links) for b in blocks]
    own = []
    for b, ratio, factor in zip(blocks, path_scores(blocks), factors):
        alone = len(b.text) * (1 + len(PUNCTUATION.findall(b.text)))
        own.append(factor * min(ratio, alone))
        if factor:
            b.element.chars += len(b.text)
            b.element.total += len(b.text) * own[-1]
    for e in reversed(elements):  # children come after their parents
        if e.parent is not None:
            e.parent.chars += e.chars
            e.parent.total += e.total
    for e in elements:
        e.score = e.total / e.chars if e.chars and e.tag not in ("", "html", "body") else 0.0
        if e.parent is not None and not e.aside and e.tag != "article":
            e.score = max(e.score, LIFT * e.parent.score)
    lifted = [max(o, b.element.score) if f else o for o, b, f in zip(own, blocks, factors)]
    for i in range(len(blocks) - 2, -1, -1):
        e, following = blocks[i].element, blocks[i + 1].element
        if factors[i] and e.tag in HEADINGS and e.above == following.above:
            lifted[i] = max(lifted[i], LIFT * lifted[i + 1])
    return lifted, factors


def main_text(page: str | None) -> str:
    """The article of a page, blocks joined by an empty line."""
    if not page:
        return ""
    elements, blocks = _read(page)
    scores, factors = node_scores(elements, blocks)
    chars = sum(len(b.text) for b, f in zip(blocks, factors) if f)
    if not chars:
        return ""
    cut = PATH_SHARE * sum(s * len(b.text) for s, b, f in zip(scores, blocks, factors) if f) / chars
    return "\n\n".join(b.text for s, b, f in zip(scores, blocks, factors) if f and s >= cut)


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [main_text(h) for h in frame["html"]]
        yield pd.DataFrame(
            {"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]}
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and its length in code points, for every page."""
    prepare(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInPandas(_extract, SCHEMA)
