"""Main text of web pages: boosted trees over the nodes of a page, decoded by its tree.

Each block element gets the probability that its text is main text, from features of
its subtree, its attributes, its depth and its neighbours. Choosing each by itself
could keep a paragraph of a dropped menu. So the choice is made for the tree: a node
is kept whole, dropped whole, or opened, at a price, which leaves the choice to its
children; the most likely such choice is found from the leaves up.

The trees are fitted to invented pages whose main text is known (``page_makers``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from math import log, log1p

import numpy as np
from pyspark.sql import DataFrame

from asterism.llm import boosted_trees
from asterism.llm.common import map_rows
from asterism.llm.html_tree import INLINE, RAW, Node, parse
from asterism.llm.page_makers import training_pages

RESULT = "page_id long, url string, text string, n_chars long"
OPENING = 2.0
PAGES_AT_ONCE = 256

# Tokens of class, id and role attributes, by what they tell.
TOKENS = {
    "main": "article content main post entry story body text page prose paragraph",
    "nav": "nav navigation navbar menu menus breadcrumb breadcrumbs toc tabs pagination pager",
    "head": "header head masthead banner topbar top logo branding hero",
    "foot": "footer foot bottom copyright legal colophon",
    "side": "sidebar side aside rail widget widgets secondary complementary",
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion adsense",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay warning message paywall",
    "form": "form search login signup subscribe newsletter register input contact",
    "comment": "comment comments reply replies respond discussion disqus reader feedback",
    "more": "related share sharing social recommended more trending popular tags tag meta author byline",
}
_GROUPS = {word: group for group, words in enumerate(TOKENS.values()) for word in words.split()}
# elements around a block, at any distance, that tell what it is
_AROUND = ("article", "main", "nav", "header", "footer", "aside", "form")
_BIT = {name: 1 << i for i, name in enumerate(_AROUND)}
_MAIN = _BIT["article"] | _BIT["main"]
# groups that a heading names, for what follows it
_SAID = ("comment", "more")
_NAMES = (
    "article main section div p li ul table td nav footer header aside form h1 h2 h3 blockquote pre figure body"
).split()
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_STOP = re.compile(r"[.!?…]")
_HEADING = re.compile(r"h[1-6]")


@dataclass(slots=True)
class Block:
    name: str
    parent: int
    depth: int
    groups: int  # bits of TOKENS
    above: int  # those of the blocks around it
    within: int = 0  # bits of _AROUND
    holds: int = 0  # the same of what is inside of it
    said: int = 0  # bits of TOKENS that a heading at its beginning names
    own: int = 0  # characters of its own text
    own_stops: int = 0
    links: int = 0  # characters in links
    tags: int = 1
    start: int = 0
    text: int = 0  # with all below, as the next ones
    stops: int = 0
    blocks: int = 1
    paragraphs: int = 0
    children: list[int] = field(default_factory=list)


def _groups(node: Node) -> int:
    if not node.attributes:
        return 0
    return _groups_of(" ".join(node.get(name) for name in ("class", "id", "role")))


def _groups_of(words: str) -> int:
    bits = 0
    for word in _TOKEN.findall(words):
        if (group := _GROUPS.get(word.lower())) is not None:
            bits |= 1 << group
    return bits


def _with_blocks(root: Node) -> set[Node]:
    """Inline elements that hold a block, which therefore count as blocks."""
    found: set[Node] = set()
    stack = [root]
    while stack:
        node = stack.pop()
        for child in node.children():
            stack.append(child)
            if child.name not in INLINE:
                above = node
                while above is not None and above.name in INLINE and above not in found:
                    found.add(above)
                    above = above.parent
    return found


def read_blocks(source: str) -> tuple[list[Block], list[tuple[int, str]]]:
    """The blocks of a page, parents first, and its text runs as (block, text) in page order.

    A run of white space stands at each edge of a block and for each line break.
    Texts of raw elements, scripts and styles among them, are left out.
    """
    root = parse(source)
    also = _with_blocks(root)
    blocks = [Block("#root", -1, 0, 0, 0)]
    runs: list[tuple[int, str]] = []
    total = 0
    stack: list[tuple[object, int, bool]] = [(x, 0, False) for x in reversed(root.items)]
    while stack:
        item, at, linked = stack.pop()
        if isinstance(item, int):  # the end of a block
            runs.append((item, " "))
        elif isinstance(item, str):
            runs.append((at, item))
            length = len(item) if not item.isspace() else 0
            block = blocks[at]
            if _HEADING.fullmatch(block.name) and blocks[block.parent].start == block.start:
                blocks[block.parent].said |= _groups_of(item)
            block.own += length
            block.own_stops += len(_STOP.findall(item))
            block.links += length if linked else 0
            total += length
        elif item.name in RAW:
            continue
        elif item.name in INLINE and item not in also:
            blocks[at].tags += 1
            if item.name == "br":
                runs.append((at, " "))
            stack += [(x, at, linked or item.name == "a") for x in reversed(item.items)]
        else:
            above = blocks[at]
            here = len(blocks)
            around = above.within | _BIT.get(above.name, 0)
            block = Block(item.name, at, above.depth + 1, _groups(item), above.above | above.groups, around, start=total)
            blocks.append(block)
            above.children.append(here)
            runs.append((here, " "))
            stack.append((here, here, False))
            stack += [(x, here, linked or item.name == "a") for x in reversed(item.items)]
    for block in reversed(blocks):
        block.text += block.own
        block.stops += block.own_stops
        if block.parent >= 0:
            above = blocks[block.parent]
            above.holds |= block.holds | _BIT.get(block.name, 0)
            above.text += block.text
            above.stops += block.stops
            above.links += block.links
            above.tags += block.tags
            above.blocks += block.blocks
            above.paragraphs += block.paragraphs + (block.name == "p")
    return blocks, runs


def node_features(blocks: list[Block]) -> np.ndarray:
    total = max(1, blocks[0].text)
    place = [0] * len(blocks)
    for block in blocks:
        for i, child in enumerate(block.children):
            place[child] = i
    said = [0] * len(blocks)  # by headings in the blocks around
    groups = [1 << [*TOKENS].index(name) for name in _SAID]
    has_main = blocks[0].holds & _MAIN != 0
    rows = []
    for i, b in enumerate(blocks):
        if b.parent >= 0:
            said[i] = said[b.parent] | blocks[b.parent].said
        above = blocks[b.parent] if b.parent >= 0 else b
        among = above.children if b.parent >= 0 else [0]
        k = place[i]
        before = blocks[among[k - 1]] if k > 0 else None
        after = blocks[among[k + 1]] if k + 1 < len(among) else None
        around = above.above | above.groups if b.parent >= 0 else 0
        rows.append(
            [
                b.depth,
                log1p(b.text),
                log1p(b.own),
                b.links / max(1, b.text),
                log1p(b.text / b.tags),
                log1p(b.text / b.blocks),
                100 * b.stops / max(1, b.text),
                log1p(b.paragraphs),
                b.text / total,
                b.text / max(1, above.text),
                b.start / total,
                above.links / max(1, above.text),
                log1p(above.paragraphs),
                k,
                len(among) - 1 - k,
                log1p(before.text) if before else -1.0,
                log1p(after.text) if after else -1.0,
                before is not None and before.name == b.name,
                _NAMES.index(above.name) if above.name in _NAMES else -1,
                *(b.name == name for name in _NAMES),
                *(b.groups >> g & 1 for g in range(len(TOKENS))),
                *(around >> g & 1 for g in range(len(TOKENS))),
                *(b.within >> k & 1 for k in range(len(_AROUND))),
                *(b.holds >> k & 1 for k in range(len(_AROUND))),
                *(b.said & g != 0 for g in groups),
                *(said[i] & g != 0 for g in groups),
                has_main,
                has_main and not (b.within | b.holds | _BIT.get(b.name, 0)) & _MAIN,
            ]
        )
    return np.array(rows, np.float32)


def _parts(blocks: list[Block], b: Block) -> int:
    """In how many parts a block's text is, its own and its children's."""
    return (b.own > 0) + sum(blocks[c].text > 0 for c in b.children)


def decode(blocks: list[Block], main: np.ndarray) -> list[bool]:
    """Whether each block's own text is kept, by the most likely choice for the tree.

    Of equally likely ones a block's own probability decides. A block with all its text
    in one child has nothing to choose, so it opens without a price: any number of plain
    elements around a part makes no difference.
    """
    n = len(blocks)
    p = np.clip(main, 1e-4, 1 - 1e-4)
    weight = [1 + log1p(b.text) if b.text else 0.0 for b in blocks]
    inside, outside, best = [0.0] * n, [0.0] * n, [0.0] * n
    choice = [""] * n
    for i in range(n - 1, -1, -1):
        b, yes, no = blocks[i], log(p[i]), log(1 - p[i])
        inside[i] = weight[i] * yes + sum(inside[c] for c in b.children)
        outside[i] = weight[i] * no + sum(outside[c] for c in b.children)
        opened = sum(best[c] for c in b.children) - (OPENING if _parts(blocks, b) > 1 else 0.0)
        opened += (1 + log1p(b.own)) * max(yes, no) if b.own else 0.0
        options = {"in": inside[i], "out": outside[i]} if p[i] > 0.5 else {"out": outside[i], "in": inside[i]}
        options |= {"open": opened} if b.children else {}
        choice[i] = max(options, key=options.__getitem__)
        best[i] = options[choice[i]]
    kept = [False] * n
    settled = [""] * n
    for i, b in enumerate(blocks):
        settled[i] = settled[b.parent] if b.parent >= 0 and settled[b.parent] != "open" else choice[i]
        kept[i] = settled[i] == "in" or settled[i] == "open" and p[i] > 0.5
    return kept


def text_of(runs: list[tuple[int, str]], kept: list[bool]) -> str:
    """The kept text: white space becomes one space, blocks in page order are joined by one."""
    return " ".join("".join(text if kept[at] else " " for at, text in runs).split())


@lru_cache(1)
def trained() -> boosted_trees.Boosted:
    """The trees, fitted to the invented pages; the same in every run."""
    xs, ys, weights = [], [], []
    for source, is_main in training_pages():
        blocks, runs = read_blocks(source)
        good = [0] * len(blocks)
        for at, text in runs:
            good[at] += len(text) if is_main(text) and not text.isspace() else 0
        for i in range(len(blocks) - 1, 0, -1):
            good[blocks[i].parent] += good[i]
        some = [i for i, b in enumerate(blocks) if b.text]
        xs.append(node_features(blocks)[some])
        ys += [good[i] / blocks[i].text for i in some]
        weights += [1.0] * len(some)
    y = np.clip(np.array(ys), 0, 1)
    # text for the most part one or the other has that label; parts count where it is mixed
    return boosted_trees.fit(np.concatenate(xs), y, np.array(weights))


def main_texts(model: boosted_trees.Boosted, sources: list[str | None]) -> list[str]:
    texts = []
    for begin in range(0, len(sources), PAGES_AT_ONCE):
        pages = [read_blocks(s or "") for s in sources[begin : begin + PAGES_AT_ONCE]]
        main = model.probability(np.concatenate([node_features(blocks) for blocks, _ in pages]))
        at = 0
        for blocks, runs in pages:
            texts.append(text_of(runs, decode(blocks, main[at : at + len(blocks)])))
            at += len(blocks)
    return texts


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for each row of ``pages`` (page_id, url, html).

    A null or empty page, or one without main text, has an empty text. Anything is
    read, also what isn't HTML; repeated rows are each extracted.
    """
    model = trained()

    def batch(columns: dict[str, list]) -> dict[str, list]:
        texts = main_texts(model, columns["html"])
        return {
            "page_id": columns["page_id"],
            "url": columns["url"],
            "text": texts,
            "n_chars": [*map(len, texts)],
        }

    return map_rows(pages.select("page_id", "url", "html"), batch, RESULT)
