"""Main text of a web page by tag-path ratios.

The page is read into text nodes, each with the path of tags from the root to it. Per path, the
text length and the punctuation of all its nodes are added up and divided by the number of nodes:
paragraphs of an article share a path and make it heavy, menu items make theirs light. Both ratios
are smoothed along the page, multiplied, and the nodes of every path that reaches a share of the
spread are content.

The article is put together from these nodes. Its place is the deepest element below which most of the
content lies in one child no more (``MOST``). If that is in an ``article`` or ``main``, all of it is kept. Otherwise
the blocks from the first heading or content to the last content are, without those that are mostly
links. Content outside the place is kept if it may be a lead or a closing part: ``OUTSIDE`` characters or more, no
line on copyright, and not one of more than ``ALIKE`` siblings of a kind, as comments and teasers are.

Elements whose tag or role names them as menu, header, footer, sidebar, advert, form, script, style or
the like take no part in any of it. Class and id names decide less: an element with a name of ``SKIPPED_NAMES`` only is
left out unless it holds an article or most of the content; names of ``DOUBTFUL_NAMES``, and parts of longer names
(``has-sidebar``, ``related-work``) on blocks, only if little of the content is in it by the ratios.

Cases: a NULL or empty page, and one without text in its body, gives the empty text. Unclosed and
misnested tags are read as browsers do for paragraphs, list items and cells; a tag cut off at the
end is dropped. Every element knows its parent and its path by number, so deep nesting takes linear time. Where no path
stands out, all text around the heaviest one is kept. Rows and other columns stay as they are; a column
with the name of the result is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements in HTML and the words that sites use in classes and roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
SKIPPED_TAGS = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea "
    "iframe noembed noframes xmp svg math canvas audio video object menu dialog input label fieldset".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
SKIPPED_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts adsense banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar footer masthead comment comments commentlist respond reply replies discussion "
    "disqus pagination pager".split()
)
DOUBTFUL_NAMES = frozenset(
    "share sharing social related recommended recommendations widget toolbar skip search review reviews user users".split()
)
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
UNITS = frozenset("div section article li td tr dd dl ul ol table".split())  # of which a list of comments or teasers consists
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
JUDGED = frozenset("div section ul ol dl table".split())  # elements that a part of a longer name may name

#: A start tag closes these open elements first, up to the given bounds.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SPREAD = 0.1  # share of the standard deviation of the fused ratio that a path must reach
LITTLE = 0.1  # share of a page's content up to which a block with a doubtful name may go
MOST = 0.75  # share of the content below an element that a child must hold for the article to lie in it
OUTSIDE = 40  # characters of a block outside the article's place that may still belong to it
ALIKE = 2  # siblings of one tag and class, from more of which on they are a list of units such as comments
SMOOTHING = 1.0  # standard deviation of the smoothing window, in text nodes

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*+>"
    r"|</[^a-zA-Z][^>]*+>"
    r"|<[!?/]?[a-zA-Z][^>]*+\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'/=]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'][^\s]*)?)?""")  # whole ones, so that none is found inside a value
_NAME = re.compile(r"[a-z]+")
_RIGHTS = re.compile(r"©|\bcopyright\b|\ball rights reserved\b", re.I)  # a footer's line
_PUNCTUATION = re.compile(r"[.,;:!?。，！？…،؟]")


def _attributes(text: str) -> dict[str, str]:
    """Names and values of a start tag; of attributes with the same name the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value.strip("\"'").lower())
    return found


def _skipped(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is no part of any article, by its tag, its role or because it is hidden."""
    if tag in SKIPPED_TAGS:
        return True
    if tag == "header" and not in_article:
        return True
    if not attributes or tag in ("article", "main", "body", "html"):
        return False
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden") == "true"
        or "display:none" in attributes.get("style", "").replace(" ", "")
        or attributes.get("role") in SKIPPED_ROLES
    )


def _named(tag: str, attributes: dict[str, str]) -> bool | None:
    """Whether a class or the id names an element to be left out: True as a whole, False as a doubtful one."""
    if tag in ("article", "main", "body", "html"):
        return None
    part = None
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = _NAME.findall(name)
        if words and SKIPPED_NAMES.issuperset(words):
            return True
        if words and (SKIPPED_NAMES | DOUBTFUL_NAMES).issuperset(words):
            part = False
        if tag in JUDGED and not SKIPPED_NAMES.isdisjoint(words):
            part = False
    return part


@dataclass
class Element:
    """One element of a page; its number is greater than its parent's."""

    parent: int
    tag: str
    kind: tuple[str, str]  # tag and class: what makes siblings alike
    path: int  # number of the path of tags
    named: bool | None
    skipped: bool
    in_article: bool
    in_link: bool
    in_heading: bool


def _read(html: str) -> tuple[list[Element], list[tuple[int, int, str]]]:
    """Elements of a page, and its text nodes outside skipped elements: block number, element number, text."""
    elements = [Element(0, "", ("", ""), 0, None, False, False, False, False)]
    paths: dict[tuple[int, str], int] = {}
    nodes: list[tuple[int, int, str]] = []
    opened: list[int] = [0]  # numbers of the open elements
    count: Counter = Counter()  # of their tags
    block = at = 0

    def text(part: str) -> None:
        if part and not elements[opened[-1]].skipped and not part.isspace():
            nodes.append((block, opened[-1], unescape(part)))
        elif part and nodes and nodes[-1][0] == block:
            nodes.append((block, nodes[-1][1], " "))

    def close_last(tags, bounds=()) -> None:
        """Close the innermost open element of these tags and all in it, unless one of the bounds comes first."""
        for i in range(len(opened) - 1, 0, -1):
            tag = elements[opened[i]].tag
            if tag in tags:
                for number in opened[i:]:
                    count[elements[number].tag] -= 1
                del opened[i:]
                return
            if tag in bounds:
                return

    while True:
        found = _TAG.search(html, at)
        text(html[at : found.start()] if found else html[at:])
        if not found:
            return elements, nodes
        at = found.end()
        slash, name, attributes = found.groups()
        if not name:
            continue
        name = name.lower()
        if name in BLOCKS:
            block += 1
        if slash:
            if count[name]:
                close_last({name})
            continue
        if name in BLOCKS and count["p"] and name not in ("body", "html", "head"):
            close_last({"p"}, {"table", "button", "td", "th"})
        if name in CLOSES:
            ends, bounds = CLOSES[name]
            for _ in range(2 if name in ("tr", "td", "th") else 1):
                if any(count[t] for t in ends):
                    close_last(ends, bounds)
        if name == "br" and nodes and nodes[-1][0] == block:
            nodes.append((block, nodes[-1][1], " "))
        if name in VOID or attributes.endswith("/") and name not in BLOCKS and name not in RAW:
            continue
        if name in ("html", "body") and count[name]:
            continue
        if name == "body" and count["head"]:
            close_last({"head"})
        above = elements[opened[-1]]
        values = _attributes(attributes) if attributes else {}
        skipped = above.skipped or _skipped(name, values, above.in_article)
        elements.append(
            Element(
                opened[-1], name, (name, values.get("class", "")), paths.setdefault((above.path, name), len(paths) + 1),
                None if skipped else _named(name, values), skipped, above.in_article or name in ("article", "main"),
                above.in_link or name == "a", above.in_heading or name in HEADINGS,
            )
        )
        opened.append(len(elements) - 1)
        count[name] += 1
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)


def _filled(nodes: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return [n for n in nodes if n[2] != " "]


def _summed(elements: list[Element], own: dict[int, int]) -> list[int]:
    """What all elements hold, themselves and below: one pass from the last to the first."""
    total = [own.get(i, 0) for i in range(len(elements))]
    for i in range(len(elements) - 1, 0, -1):
        total[elements[i].parent] += total[i]
    return total


def _weights(elements: list[Element], nodes: list[tuple[int, int, str]], content: set[int] | None) -> list[int]:
    """Characters of text below every element, or of content only."""
    own: Counter = Counter()
    for _, e, text in nodes:
        if content is None or elements[e].path in content:
            own[e] += len(text)
    return _summed(elements, own)


def _without(elements: list[Element], nodes: list[tuple], left_out: set[int]) -> list[tuple]:
    """Nodes outside the given elements; what is left out within a block separates words."""
    if not left_out:
        return nodes
    out = [False] * len(elements)
    for i in range(1, len(elements)):
        out[i] = out[elements[i].parent] or i in left_out
    kept: list[tuple] = []
    for node in nodes:
        if not out[node[1]]:
            kept.append(node)
        elif kept and kept[-1][0] == node[0]:
            kept.append((*kept[-1][:2], " "))
    return kept


def text_nodes(html: str) -> tuple[list[Element], list[tuple[int, int, str]]]:
    """Elements, and text nodes without what tags, roles and names leave out."""
    elements, nodes = _read(html)
    if not _filled(nodes):
        return elements, []
    articles = _summed(elements, {i: 1 for i, e in enumerate(elements) if e.tag in ("article", "main") and not e.skipped})
    for whole in (True, False):
        named = [i for i, e in enumerate(elements) if e.named is whole and not articles[i]]
        if not named:
            continue
        filled = _filled(nodes)
        if not filled:
            return elements, []
        weight, size = _weights(elements, filled, content_paths(elements, filled)), _weights(elements, filled, None)
        if whole:
            left_out = {i for i in named if 2 * weight[i] <= weight[0]}
        else:
            left_out = {i for i in named if 2 * weight[i] < size[i] and weight[i] < LITTLE * weight[0]}
        nodes = _without(elements, nodes, left_out)
    return elements, nodes


def _smoothed(x: np.ndarray) -> np.ndarray:
    reach = np.arange(-2, 3)
    kernel = np.exp(-(reach**2) / (2 * SMOOTHING**2))
    return np.convolve(np.pad(x, 2, mode="edge"), kernel / kernel.sum(), mode="valid")


def content_paths(elements: list[Element], nodes: list[tuple[int, int, str]]) -> set[int]:
    """Paths whose nodes are content by the fused, smoothed ratios of text and punctuation; empty if none stands out."""
    length: Counter = Counter()
    marks: Counter = Counter()
    count: Counter = Counter()
    at = [elements[e].path for _, e, _ in nodes]
    for path, (_, _, text) in zip(at, nodes):
        length[path] += len(text)
        marks[path] += len(_PUNCTUATION.findall(text))
        count[path] += 1
    text_ratio = _smoothed(np.array([length[p] / count[p] for p in at], dtype=float))
    mark_ratio = _smoothed(np.array([marks[p] / count[p] for p in at], dtype=float))
    fused = text_ratio * mark_ratio
    best: dict[int, float] = {}
    for path, value in zip(at, fused):
        best[path] = max(best.get(path, 0.0), value)
    least = SPREAD * float(np.std(fused))
    return {p for p, v in best.items() if v > least and marks[p]}


@dataclass
class Block:
    """Text of one block: its first element, characters in all and in links, whether content or heading is in it."""

    element: int
    parts: list[str]
    size: int = 0
    linked: int = 0
    content: bool = False
    heading: bool = False


def _place(elements: list[Element], weight: list[int]) -> int:
    """The deepest element below which no child holds most of the content, or the article it lies in."""
    heaviest: dict[int, int] = {}
    for i in range(1, len(elements)):
        up = elements[i].parent
        if weight[i] and weight[i] > weight[heaviest.get(up, 0)] * (up in heaviest):
            heaviest[up] = i
    place = 0
    while place in heaviest and weight[heaviest[place]] >= MOST * weight[0]:
        place = heaviest[place]
    outer = place
    while outer:
        if elements[outer].tag in ("article", "main"):
            return outer
        outer = elements[outer].parent
    # A paragraph alone is no place: its neighbours belong to it.
    while place and elements[place].tag not in ("div", "section", "td", "body", "html", "blockquote"):
        place = elements[place].parent
    return place


def main_text(html: str | None) -> str:
    """The article's blocks, joined by empty lines."""
    elements, nodes = text_nodes(html or "")
    filled = _filled(nodes)
    if not filled:
        return ""
    content = content_paths(elements, filled)
    blocks: dict[int, Block] = {}
    for number, e, text in nodes:
        b = blocks.setdefault(number, Block(e, []))
        b.parts.append(text)
        if text != " ":
            one = elements[e]
            b.size += len(text)
            b.linked += len(text) * one.in_link
            b.content |= one.path in content
            b.heading |= one.in_heading
    kept = list(blocks.values())
    if content:
        kept = _article(elements, kept, _weights(elements, [n for n in filled if not _RIGHTS.search(n[2])] or filled, content))
    lines = (" ".join("".join(b.parts).split()) for b in kept)
    return "\n\n".join(line for line in lines if line)


def _article(elements: list[Element], blocks: list[Block], weight: list[int]) -> list[Block]:
    """The blocks of the article's place, and content outside it that belongs to it."""
    place = _place(elements, weight)
    inside = [False] * len(elements)
    inside[place] = True
    for i in range(place + 1, len(elements)):
        inside[i] = inside[elements[i].parent]
    mine = [i for i, b in enumerate(blocks) if inside[b.element]]
    if elements[place].tag in ("article", "main"):
        kept = set(mine)
    else:
        first = next((i for i in mine if blocks[i].content or blocks[i].heading), 0)
        last = max((i for i in mine if blocks[i].content), default=-1)
        kept = {i for i in mine if first <= i <= last and (blocks[i].content or blocks[i].heading or 2 * blocks[i].linked <= blocks[i].size)}
        if last in kept and last != first and _RIGHTS.search("".join(blocks[last].parts)):
            kept.remove(last)
    alike = Counter((e.parent, e.kind) for e in elements[1:])
    above = {place}
    while place:
        place = elements[place].parent
        above.add(place)
    for i, b in enumerate(blocks):
        if i in kept or not b.content or 2 * b.linked > b.size or inside[b.element]:
            continue
        if b.size < OUTSIDE or _RIGHTS.search("".join(b.parts)):
            continue
        e, unit = b.element, False  # up to the child of what the place lies in too
        while True:
            unit |= elements[e].tag in UNITS and alike[elements[e].parent, elements[e].kind] > ALIKE
            if elements[e].parent in above:
                break
            e = elements[e].parent
        if not unit:
            kept.add(i)
    return [blocks[i] for i in sorted(kept)]


def extract(df: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``, the main text of every page."""

    def texts_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(h) for h in pages.to_pylist()], pa.string())

    return df.withColumn(out, F.arrow_udf(texts_of, "string")(F.coalesce(F.col(html_col), F.lit(""))))
