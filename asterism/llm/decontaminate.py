"""Find passages of benchmark items in documents, also if words were changed.

Texts are sequences of words, lower-cased and without punctuation; in scripts that set
no spaces, such as Han, kana and Thai, each character is a word. A passage is a leak of an item of m words if its edit distance to the item, in words, is at most
``allowed_edits(m)``, a fifth of m. Items of one or two words are looked up as they are.

* Windows. A passage so close to an item keeps at least ``m - 2 - 3 * edits`` of the
  item's three-word runs. Item-sized windows are therefore laid where the document
  has such runs, at each start that one of them implies; a document without enough
  of them has no window, and loses no leak by it.
* Candidates. Windows and items are embedded by random walks (CGK): at each step the
  word under the pointer is put out, and a random bit for step and word tells whether
  the pointer goes on. Texts a few edits apart fall into step again, so edit distance
  becomes Hamming distance. A few sampled places of an embedding make a key; an item
  whose key a window has is a candidate. For each class of item sizes, a power of two
  wide, as many walks are used as a simulation with the items themselves needs to reach
  the target recall at the largest distance. For a class that needs more than MOST_WALKS
  every item that shares enough three-word runs with a window is a candidate.
* Verification. The exact edit distance of the item to the best passage at the window.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import ROWS_AT_ONCE

SIMILARITY = 0.8
RECALL = 0.99
# places in a key, keys from one walk, and walks at most
PLACES, KEYS, MOST_WALKS = 2, 4, 64
# changed items that a simulation tries at least, and numbers of an embedding at once
TRIALS, AT_ONCE = 128, 1 << 22
# bytes of item texts that are searched for in one pass over the documents, and what they
# may take in a worker, as measured; a block that takes more is cut in two
BLOCK_BYTES = 8 << 20
ITEMS_LIMIT = 128 << 20
# implied starts that are looked at together
STARTS_AT_ONCE = 1 << 20
SEED = 17

LEAKS = "array<struct<item_id:long,start:int,n_words:int,distance:int,item_words:int>>"

# Blocks of scripts without spaces between words: Thai and Lao, Burmese, Khmer,
# kana, Han with its extensions and compatibility forms, half-width kana.
_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff"
    "\u3005-\u3007\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af"
)
_WORDS = re.compile(r"\w+")
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORDS_OR_CHARACTERS = re.compile(f"(?=\\w)[{_UNSPACED}]|[^\\W{_UNSPACED}]+")
_BITS = 20


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    if text.isascii() or not _ANY_UNSPACED.search(text):
        return _WORDS.findall(text)
    return _WORDS_OR_CHARACTERS.findall(text)


def allowed_edits(m: int) -> int:
    """Edits at which an item of ``m`` words still counts; some of its runs must be left."""
    return max(0, min(int(m * (1 - SIMILARITY) + 1e-9), (m - 3) // 3))


def _mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def embed(rows: np.ndarray, walks: int, seed: int = SEED) -> np.ndarray:
    """CGK embeddings (rows, walks, 2 * m) of sequences (rows, m); 2**32 - 1 stands for the end.

    With a bit of one half a walk passes m words in 2 * m steps.
    """
    n, m = rows.shape
    end = np.uint64(0xFFFFFFFF)
    padded = np.concatenate([rows.astype(np.uint64), np.full((n, 1), end)], axis=1)
    at = np.zeros((n, walks), np.int64)
    out = np.empty((n, walks, 2 * m), np.uint64)
    walk = _mix(np.arange(walks, dtype=np.uint64) + np.uint64(seed << 20))
    index = np.arange(n)[:, None]
    for step in range(2 * m):
        word = padded[index, at]
        out[:, :, step] = word
        coin = _mix((word << np.uint64(16)) + np.uint64(step) + walk)
        at = np.minimum(at + (coin & np.uint64(1)).astype(np.int64), m)
    return out


def keys_of(rows: np.ndarray, walks: int, seed: int = SEED) -> np.ndarray:
    """LSH keys (rows, walks * KEYS): sampled places of each embedding, with walk and size."""
    n, m = rows.shape
    step = max(1, AT_ONCE // (walks * 2 * max(1, m)))
    if n > step:
        return np.concatenate([keys_of(rows[at : at + step], walks, seed) for at in range(0, n, step)])
    rng = np.random.default_rng([seed, m])
    places = rng.integers(0, 2 * m, (walks, KEYS, PLACES))
    embedded = embed(rows, walks, seed)
    key = np.full((n, walks, KEYS), m, np.uint64)
    which = np.arange(walks * KEYS, dtype=np.uint64).reshape(1, walks, KEYS)
    key = _mix(key * np.uint64(1 << 32) + which)
    for p in range(PLACES):
        key = _mix(key + np.take_along_axis(embedded, places[None, :, :, p], axis=2))
    return key.reshape(n, -1)


def best_passage(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the passage of ``region`` nearest to ``item`` by edit distance.

    Of equally near ones the first to end counts, with its last start.
    """
    width = len(region) + 1
    cost, start = np.zeros(width, np.int64), np.arange(width)
    offsets = np.arange(width)
    for word in item:
        change = cost[:-1] + (region != word)
        drop = cost[1:] + 1
        new = np.concatenate([[cost[0] + 1], np.minimum(change, drop)])
        came = np.concatenate([[start[0]], np.where(change <= drop, start[:-1], start[1:])])
        # inserted words of the region: carry the least cost rightwards, one for each step
        least = np.minimum.accumulate(new - offsets)
        source = np.maximum.accumulate(np.where(new - offsets == least, offsets, 0))
        cost, start = least + offsets, came[source]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


class Runs:
    """The three-word runs of some items, each with its offsets and a tag of its item."""

    def __init__(self, items: Items, members: list[int], tags: list[int]):
        none = np.zeros(0, np.int64)
        codes = [items.codes(items.items[i]) for i in members]
        offset = np.concatenate([none, *(np.arange(len(c)) for c in codes)])
        tag = np.repeat(np.array(tags, np.int64), [len(c) for c in codes])
        code = np.concatenate([none, *codes])
        order = np.lexsort((tag, offset, code))
        code, offset, tag = code[order], offset[order], tag[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (offset[1:] != offset[:-1]) | (tag[1:] != tag[:-1])
        self.offset, self.tag = offset[new].astype(np.int32), tag[new].astype(np.int32)
        self.codes, first = np.unique(code[new], return_index=True)
        self.bounds = np.append(first, new.sum())
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self._bit(self.codes)] = True

    def arrays(self) -> list[np.ndarray]:
        return [self.offset, self.tag, self.codes, self.bounds, self.maybe]

    @staticmethod
    def _bit(codes: np.ndarray) -> np.ndarray:
        return (_mix(codes.astype(np.uint64)) >> np.uint64(64 - _BITS)).astype(np.int64)

    def found(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a document has one of the runs, and which."""
        if not len(codes) or not len(self.codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.maybe[self._bit(codes)] & (codes >= 0))
        place = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        same = self.codes[place] == codes[at]
        return at[same], place[same]

    def implied(self, at: np.ndarray, runs: np.ndarray, unique: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The starts that these runs imply for a passage, and the tags, some at once."""
        if not len(at):
            return
        times = self.bounds[runs + 1] - self.bounds[runs]
        ends = times.cumsum()
        first = 0
        while first < len(at):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + STARTS_AT_ONCE, "right")))
            n = times[first:last]
            index = np.arange(n.sum()) + np.repeat(self.bounds[runs[first:last]] - (n.cumsum() - n), n)
            start, tag = np.repeat(at[first:last], n) - self.offset[index], self.tag[index].astype(np.int64)
            if unique:
                start, tag = np.unique(np.stack([start, tag]), axis=1)
            yield start, tag
            first = last


class Items:
    """A block of items, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str | None]], recall: float = RECALL):
        same: dict[tuple[str, ...], list[int]] = defaultdict(list)
        for item_id, text in items:
            same[tuple(words_of(text))].append(item_id)
        same.pop((), None)
        self.ids = list(same.values())
        self.word_ids = {w: i for i, w in enumerate(sorted({w for words in same for w in words}), 1)}
        self.items = [np.array([self.word_ids[w] for w in words], np.int64) for words in same]
        self.base = len(self.word_ids) + 1
        self.short = [self._short(size) for size in (1, 2)]
        self.walks = self._walks(recall)  # of each class of sizes, 0 for one without keys
        longest = max(map(len, self.items), default=0)
        self.edits = np.array([allowed_edits(m) for m in range(longest + 1)], np.int64)
        with_keys = [i for i, item in enumerate(self.items) if len(item) >= 3 and self.walks[len(item).bit_length()]]
        without = [i for i, item in enumerate(self.items) if len(item) >= 3 and not self.walks[len(item).bit_length()]]
        # for the first the size of an item is kept with each run, for the others the item
        self.runs = Runs(self, with_keys, [len(self.items[i]) for i in with_keys])
        self.exact_runs = Runs(self, without, without)
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for size, members in self._by_size().items():
            walks = self.walks[size.bit_length()]
            if walks:
                rows = keys_of(np.stack([self.items[i] for i in members]), walks)
                keys.append(rows.ravel())
                owners.append(np.repeat(np.array(members, np.int32), rows.shape[1]))
        order = np.argsort(keys := np.concatenate(keys), kind="stable")
        self.table_keys, self.table_items = keys[order], np.concatenate(owners)[order]

    def _short(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the items of one or two words, ascending, and the items."""
        members = np.array([i for i, item in enumerate(self.items) if len(item) == size], np.int64)
        codes = np.array([self._code(self.items[i], size)[0] for i in members], np.int64)
        order = np.argsort(codes)
        return codes[order], members[order]

    def _code(self, words: np.ndarray, size: int) -> np.ndarray:
        """A number for each one or two words in a row, 0 or less for one with an unknown word."""
        if size == 1:
            return words
        return np.where((words[:-1] > 0) & (words[1:] > 0), words[:-1] * self.base + words[1:], -1)

    def bytes(self) -> int:
        """About what this takes in a worker."""
        arrays = [self.table_keys, self.table_items, self.edits, *self.runs.arrays(), *self.exact_runs.arrays()]
        objects = 150 * len(self.word_ids) + sum(item.nbytes + 250 for item in self.items)
        return sum(a.nbytes for a in arrays) + objects

    def _by_size(self) -> dict[int, list[int]]:
        sizes: dict[int, list[int]] = defaultdict(list)
        for i, item in enumerate(self.items):
            if len(item) >= 3:
                sizes[len(item)].append(i)
        return sizes

    def _walks(self, recall: float) -> dict[int, int]:
        """For each class of sizes (bits of the number of words) the walks that find the
        share ``recall`` of items changed as much as is allowed; 0 if MOST_WALKS do not."""
        classes: dict[int, list[np.ndarray]] = defaultdict(list)
        for item in sorted((item for item in self.items if len(item) >= 3), key=len):
            classes[len(item).bit_length()].append(item)
        return {bits: self._walks_of(bits, items, recall) for bits, items in classes.items()}

    @staticmethod
    def _walks_of(bits: int, items: list[np.ndarray], recall: float) -> int:
        """Walks for a class of items, in order of size.

        64 items or more are tried, or all, TRIALS times in all at least, with random
        replaced, left-out and added words.
        """
        rng = np.random.default_rng([SEED, bits])
        some = items[:: max(1, len(items) // 64)]
        changed: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        for item in some:
            for _ in range(max(2, ceil(TRIALS / len(some)))):
                words = item.tolist()
                for _ in range(allowed_edits(len(item))):
                    at, kind = int(rng.integers(len(words))), int(rng.integers(3))
                    words[at : at + (kind != 1)] = [] if kind == 2 else [0]
                words = (words + [0] * len(item))[: len(item)]
                changed[len(item)].append((item, np.array(words)))
        total = sum(map(len, changed.values()))
        walks = 4
        while True:
            found = 0
            for pairs in changed.values():
                ours, theirs = (keys_of(np.stack([p[k] for p in pairs]), walks) for k in (0, 1))
                found += int((ours == theirs).any(axis=1).sum())
            if found >= recall * total:
                return walks
            if walks >= MOST_WALKS:
                return 0
            walks *= 2

    def codes(self, words: np.ndarray) -> np.ndarray:
        """A number for each three-word run of known words, -1 for one with an unknown word."""
        if len(words) < 3:
            return np.zeros(0, np.int64)
        a, b, c = words[:-2], words[1:-1], words[2:]
        return np.where((a > 0) & (b > 0) & (c > 0), (a * self.base + b) * self.base + c, -1)

    def windows(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and sizes of the windows of a document that may hold an item."""
        at, runs = self.runs.found(codes)
        starts, sizes = [], []
        for start, size in self.runs.implied(at, runs):
            edits = self.edits[size]
            low, high = np.searchsorted(at, start - edits), np.searchsorted(at, start + size + edits)
            good = (high - low >= size - 2 - 3 * edits) & (start > -size)
            starts.append(start[good])
            sizes.append(size[good])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate(starts), np.concatenate(sizes)]), axis=1)
        return pairs[0], pairs[1]

    def without_keys(self, codes: np.ndarray) -> Iterator[tuple[int, set[int]]]:
        """The items of classes without keys that share enough runs with a document, with the starts these imply.

        The runs that a passage within the allowed edits keeps imply starts within twice
        these edits of each other.
        """
        at, runs = self.exact_runs.found(codes)
        of: dict[int, list[np.ndarray]] = defaultdict(list)
        for start, item in self.exact_runs.implied(at, runs, unique=False):
            order = np.argsort(item, kind="stable")
            which, first = np.unique(item[order], return_index=True)
            for i, part in zip(which.tolist(), np.split(start[order], first[1:])):
                of[i].append(part)
        for i, parts in of.items():
            start, m = np.sort(np.concatenate(parts)), len(self.items[i])
            edits = allowed_edits(m)
            near = np.searchsorted(start, start + 2 * edits, "right") - np.searchsorted(start, start - 2 * edits)
            if (good := start[(near >= m - 2 - 3 * edits) & (start > -m)]).size:
                yield i, set(good.tolist())

    def short_leaks(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """The items of one or two words that a document has, and where first."""
        for size, (codes, members) in enumerate(self.short, 1):
            if len(codes) and len(words) >= size:
                own = self._code(words, size)
                at = np.flatnonzero(np.isin(own, codes))
                known, first = np.unique(own[at], return_index=True)
                yield from zip(members[np.searchsorted(codes, known)].tolist(), at[first].tolist())

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """The leaks in each text, one for each item, the nearest passage of it."""
        get = self.word_ids.get
        by_size: dict[int, list[tuple[int, int]]] = defaultdict(list)
        kept: dict[int, np.ndarray] = {}
        candidates: dict[tuple[int, int], set[int]] = defaultdict(set)
        for number, text in enumerate(texts):
            words = np.array([get(w, 0) for w in words_of(text)], np.int64)
            codes = self.codes(words)
            starts, sizes = self.windows(codes)
            for start, m in zip(starts.tolist(), sizes.tolist()):
                by_size[m].append((number, start))
                kept[number] = words
            for i, found in self.without_keys(codes):
                candidates[number, i] |= found
                kept[number] = words
            for i, start in self.short_leaks(words):
                candidates[number, i].add(start)
                kept[number] = words
        for m, at in by_size.items():
            for begin in range(0, len(at), 256):
                part = at[begin : begin + 256]
                rows = np.zeros((len(part), m), np.int64)
                for row, (number, start) in zip(rows, part):
                    words = kept[number]
                    a, b = max(start, 0), min(start + m, len(words))
                    row[a - start : b - start] = words[a:b]
                keys = keys_of(rows, self.walks[m.bit_length()])
                low, high = (np.searchsorted(self.table_keys, keys.ravel(), side) for side in ("left", "right"))
                for hit in np.flatnonzero(high > low).tolist():
                    number, start = part[hit // keys.shape[1]]
                    for i in self.table_items[low[hit] : high[hit]].tolist():
                        candidates[number, i].add(start)
        best = {(number, i): self._nearest(i, kept[number], at) for (number, i), at in candidates.items()}
        best = {at: found for at, found in best.items() if found[0] <= allowed_edits(len(self.items[at[1]]))}
        leaks: list[list[dict]] = [[] for _ in texts]
        for (number, i), (distance, first, last) in sorted(best.items()):
            for item_id in self.ids[i]:
                leaks[number].append(
                    {
                        "item_id": item_id, "start": first, "n_words": last - first,
                        "distance": distance, "item_words": len(self.items[i]),
                    }
                )
        return leaks

    def _nearest(self, i: int, words: np.ndarray, starts: set[int]) -> tuple[int, int, int]:
        """(distance, first, last) of the best passage for an item at any of the starts."""
        item = self.items[i]
        m, edits = len(item), allowed_edits(len(item))
        for start in sorted(starts):
            if start >= 0 and np.array_equal(words[start : start + m], item):
                return 0, start, start + m
        # starts whose surroundings overlap are looked at together
        found, ordered = [], sorted(starts)
        first = ordered[0]
        for start, after in zip(ordered, [*ordered[1:], None]):
            if after is None or after - edits > start + m + edits:
                a = max(0, first - edits)
                distance, begin, end = best_passage(item, words[a : max(0, start + m + edits)])
                found.append((distance, a + begin, a + end))
                first = after
        return min(found)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of about BLOCK_BYTES, each a list on the driver, one at a time."""
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(1, ceil(size / BLOCK_BYTES))
    for block in range(number):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == block)
        yield sorted(((r["item_id"], r["text"]) for r in part.toLocalIterator()), key=str)


def _prepared(benchmark: DataFrame) -> Iterator[Items]:
    """The items of each block, ready to be searched for, in parts that take at most ITEMS_LIMIT."""
    for block in _blocks(benchmark):
        parts = [block]
        while parts:
            part = parts.pop()
            items = Items(part)
            if items.bytes() > ITEMS_LIMIT and len(part) > 1:
                parts += [part[len(part) // 2 :], part[: len(part) // 2]]
            else:
                yield items


def _searched(docs: DataFrame, items: Items, text: Column) -> DataFrame:
    """``docs`` with a column ``leaks``."""
    shared = docs.sparkSession.sparkContext.broadcast(items)  # of a measured size

    def of(texts: pd.Series) -> pd.Series:
        parts = (texts.iloc[at : at + ROWS_AT_ONCE].tolist() for at in range(0, len(texts), ROWS_AT_ONCE))
        return pd.Series([leaks for part in parts for leaks in shared.value.search(part)], dtype=object)

    return docs.withColumn("leaks", F.pandas_udf(of, LEAKS)(text))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, n_words, distance and item_words: a row for each row of
    ``docs`` (doc_id, text) and item of ``benchmark`` (item_id, text) that it leaks.

    ``start`` and ``n_words`` give the nearest passage in words. Null and empty texts
    have no leaks and items without a word match nothing. Items with the same words are
    each reported, also repeated ones, as are repeated documents.
    """
    slim = docs.select("doc_id", "text")
    whole = None
    for items in _prepared(benchmark):
        leaks = _searched(slim, items, F.col("text")).select("doc_id", F.inline("leaks"))
        whole = leaks if whole is None else whole.unionAll(leaks)
    return whole


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that leak no item."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    for items in _prepared(benchmark):
        rows = _searched(rows, items, F.col("row.text")).where(F.size("leaks") == 0).drop("leaks")
    return rows.select("row.*")
