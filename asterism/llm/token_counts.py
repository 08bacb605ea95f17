"""Token counts of byte-level byte-pair encodings, without making tokens.

A text is cut into pieces by the vocabulary's pattern. A piece starts as one symbol
for each byte; its adjacent pairs lie in a heap by rank and its symbols in a linked
list. The lowest pair is popped and merged, again and again, until no pair of the
vocabulary is left, and the piece has as many tokens as symbols less merges. No
identifier is looked up or written. Counts of pieces are kept in each worker, up to
a bound, as few pieces make up most of a text.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from asterism.llm.common import map_rows

# The pattern of byte-level pieces, and the limit of the contract.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMIT = 512
# distinct pieces whose counts a worker keeps
CACHED_PIECES = 500_000

RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves, the others for the characters
    from U+0100 on in byte order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class PieceCounter(dict):
    """Piece -> number of its tokens; a missing one is merged and kept."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        self.symbols = byte_symbols()
        self.special = sorted((t["content"] for t in whole["added_tokens"]), key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pieces = regex.compile(PIECES)

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHED_PIECES:
            self.clear()
        count = self[piece] = self.merged(piece)
        return count

    def merged(self, piece: str) -> int:
        """Tokens of one piece: its bytes less the merges done."""
        part: list[str | None] = [self.symbols[b] for b in piece.encode()]
        n, ranks = len(part), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(part, part[1:])) if pair in ranks]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if part[i] != left or j >= n or part[j] != right:
                continue  # one of the two was merged meanwhile
            part[i], part[j] = left + right, None
            after[i] = k = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if (rank := ranks.get((part[i], part[k]))) is not None:
                    heapq.heappush(heap, (rank, i, part[i], part[k]))
            if (h := before[i]) >= 0 and (rank := ranks.get((part[h], part[i]))) is not None:
                heapq.heappush(heap, (rank, h, part[h], part[i]))
        return n - merges

    def count(self, text: str) -> int:
        """Tokens of a text; a special string in it is one token and parts what surrounds it."""
        if self.cut and (specials := self.cut.findall(text)):
            return len(specials) + sum(map(self._plain, self.cut.split(text)))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        return sum(map(self.__getitem__, self.pieces.findall(text)))


@lru_cache(2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row of ``docs`` (doc_id, text).

    ``path`` names the vocabulary's file on every executor. A null text counts as
    empty, and an empty one has no tokens. Repeated rows are each counted.
    """

    def batch(columns: dict[str, list]) -> dict[str, list]:
        count = counter(path).count
        texts = [text or "" for text in columns["text"]]
        tokens = [*map(count, texts)]
        return {
            "doc_id": columns["doc_id"],
            "n_bytes": [len(text.encode()) for text in texts],
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
        }

    return map_rows(docs.select("doc_id", "text"), batch, RESULT)
