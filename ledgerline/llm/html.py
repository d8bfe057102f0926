"""A small tolerant HTML reader: elements with the hashes of their subtrees, and their text.

Only what extraction needs: void and raw-text elements, implied ends of paragraphs, list items and
table parts, end tags that match nothing, documents that stop anywhere.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html import unescape

import xxhash

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul caption head option select".split()
)
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption body html head option".split())
#: tag -> (tags that it ends, where the search for them stops)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = frozenset("table td th caption button object template html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'<>]+)")


class Element:
    __slots__ = ("tag", "attributes", "parent", "children", "digest")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Element | str] = []
        self.digest = 0

    def attribute(self, *names: str) -> str:
        """The values of these attributes, in lower case, with spaces between."""
        if not self.attributes:
            return ""
        found = []
        for name, a, b, c, bare in _ATTRIBUTE.findall(self.attributes):
            if (name or bare).lower() in names:
                found.append(unescape(a or b or c) or (bare and bare.lower()))
        return " ".join(found).lower()


def parse(html: str) -> Element:
    """The tree of a document; the root is an element without a tag."""
    root = Element("", "", None)
    top, position = root, 0
    end = html.rfind(">") + 1
    search = _TOKEN.search
    opened = [root]
    depths: dict[str, list[int]] = defaultdict(list)  # tag -> where in `opened` it is

    def deepest(tags: Iterable[str]) -> int:
        return max((depths[t][-1] for t in tags if depths[t]), default=0)

    def close(depth: int) -> Element:
        while len(opened) > depth:
            depths[opened.pop().tag].pop()
        return opened[-1]

    while match := search(html, position, end):
        if match.start() > position:
            top.children.append(html[position : match.start()])
        position = match.end()
        slash, tag = match[1], match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if depth := deepest((tag,)):
                top = close(depth)
            continue
        if tag in CLOSES_P and depths["p"] and (depth := depths["p"][-1]) > deepest(P_SCOPE):
            top = close(depth)
        if tag in IMPLIED:
            ended, stop = IMPLIED[tag]
            if (depth := deepest(ended)) > deepest(stop):
                top = close(depth)
        element = Element(tag, match[3], top)
        top.children.append(element)
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, position)
            stop = closing.start() if closing else len(html)
            element.children.append(html[position:stop])
            position = closing.end() if closing else len(html)
            end = max(end, position)
        elif tag not in VOID:
            top = element
            depths[tag].append(len(opened))
            opened.append(element)
    if position < len(html):
        top.children.append(html[position:])
    return root


def walk(root: Element) -> list[Element]:
    """All elements, parents before children."""
    out = [root]
    for element in out:
        out += [c for c in element.children if not isinstance(c, str)]
    return out


def hash_subtrees(elements: list[Element]) -> None:
    """Set the digests: of an element's name, attributes and content, white space made single."""
    digest = xxhash.xxh3_64_intdigest
    for element in reversed(elements):
        parts = [element.tag, element.attributes.strip()]
        for child in element.children:
            parts.append(" ".join(child.split()) if isinstance(child, str) else f"<{child.digest:x}>")
        element.digest = digest("\x00".join(parts)) >> 1


#: Where a block begins or ends; where a marked element ends, which begins with its digest.
BREAK, END = 0, -1


def pieces(element: Element, dropped: set[int], marked: set[int]) -> Iterator[str | int]:
    """The text below an element in page order with the marks of blocks, without dropped elements (by id())."""
    todo: list[Element | str | int] = [element]
    while todo:
        item = todo.pop()
        if isinstance(item, (str, int)):
            yield item
        elif id(item) not in dropped:
            if id(item) in marked:
                yield item.digest
                todo.append(END)
            elif item.tag in BLOCK:
                yield BREAK
                todo.append(BREAK)
            elif item.tag == "br" or item.tag in RAW:
                yield " "
            todo += reversed(item.children)
