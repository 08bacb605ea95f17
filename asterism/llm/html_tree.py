"""A lenient reader of HTML: a tree of elements with their texts."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Element names of the HTML standard by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
# an open element of the key is ended by the start of one of the values
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
        " header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
_CLOSING = frozenset().union(*CLOSED_BY.values())
# what is open outside of such an element isn't ended by a start inside of it
FENCES = frozenset("table ul ol dl select div article section aside nav main header footer form body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass(eq=False, slots=True)
class Node:
    name: str
    attributes: str = ""
    depth: int = 0
    parent: Node | None = None
    # text runs and elements in page order
    items: list[Node | str] = field(default_factory=list)

    def children(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]

    def get(self, name: str) -> str:
        for key, *values in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return html.unescape("".join(values))
        return ""


def parse(source: str) -> Node:
    """The tree of a page. Anything is accepted: what has no end lasts to the end of its
    parent, an end without a start is passed over, and text of raw elements isn't markup.
    Character references are decoded in texts, and left as they are in scripts and styles.
    """
    root = Node("#root")
    top, at, size = root, 0, len(source)
    opened: Counter[str] = Counter()  # so that an end without a start is known without a search

    def text(raw: str) -> None:
        if raw:
            top.items.append(html.unescape(raw) if "&" in raw else raw)

    while at < size:
        found = _TOKEN.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at : found.start()])
        at = found.end()
        ends, name, attributes = found.groups()
        if name is None:
            if found[0].startswith("<![CDATA["):
                top.items.append(found[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if ends:
            while opened[name] and top.name != name:
                opened[top.name] -= 1
                top = top.parent
            if opened[name]:
                opened[name] -= 1
                top = top.parent
            continue
        node = top if name in _CLOSING else root
        while node is not root and name not in CLOSED_BY.get(node.name, ()) and node.name not in FENCES:
            node = node.parent
        if name in CLOSED_BY.get(node.name, ()):
            while top is not node.parent:
                opened[top.name] -= 1
                top = top.parent
        new = Node(name, attributes or "", top.depth + 1, top)
        top.items.append(new)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(source, at)
            stop = end.start() if end else size
            raw = source[at:stop]
            new.items.append(html.unescape(raw) if name in ("title", "textarea") else raw)
            closing = source.find(">", stop)
            at = size if closing < 0 else closing + 1
        elif name not in VOID and not (attributes or "").rstrip().endswith("/"):
            top = new
            opened[name] += 1
    return root
