"""Phrases whose words stand together more often than their parts would, mined by SON.

The documents are dealt by a hash of their id to SHARDS shards. If a phrase has the wanted
support in all of them, then its support in some shard is at least that share of it, so:

1. each shard is mined completely at the support lowered to its share: phrases are counted
   as 64-bit hashes of (language, words), first those of one and two words, then level by
   level the longer ones whose parts were frequent;
2. the phrases that are frequent in some shard are the candidates;
3. all candidates are counted over all documents, now as texts, which makes the counts
   exact: a collision of hashes can only add a candidate.

A shard is mined by as many tasks as its size asks for. With a task for each shard the
lowered support would soon be one, and every phrase a candidate.

Which phrases need to leave a task at all is decided by a bitmap of the hashes that are
frequent, sized by their measured count. Where that would exceed BITMAP_BITS, the phrases
are not filtered before the exchange; the result is the same.

Within a task words have exact numbers, so phrases are combined before any row is made,
and a common word, phrase or language costs one row a block of texts. No step gathers the rows of a
word or language in one task: parts are looked up by ``lookup_join``, which splits hot keys, and the
best of a language are first found within hashed parts of it.

Null texts count as empty and null languages as ``und``. A null id is dealt like any other
value, repeated rows count each time, an empty table gives an empty result, and no other
column is read. A text is one piece of work: it is never cut, and the memory a task needs
is some fifty times BLOCK_BYTES or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asterism.llm.common import give_back, in_parts, small, to_arrow
from asterism.llm.spans import MULTIPLIERS, mix, span_hashes
from asterism.operators.lookup import lookup_join
from asterism.sources.staging import stage

LONGEST, SUPPORT, COVER_PERCENT, BEST = 3, 10, 50, 2000
# the fewer shards, the higher the support in each, and the fewer the candidates
SHARDS = 2
# low bits of a hash, which hold the shard
SHARD_BITS = 4
BLOCK_BYTES = 8 << 20
# 32 MB, which each Python worker holds once
BITMAP_BITS = 28
BITS_PER_KEY = 16
SEGMENT_BITS = 20
# parts in which the best phrases of a language are found first
PARTS = 64
UNKNOWN = "und"

# What ends a piece, what ends a word, and the letters that are lowered.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
WORD_ENDS = " \t"
_KIND = np.zeros(256, np.uint8)
_KIND[[ord(c) for c in WORD_ENDS]] = 1
_KIND[[ord(c) for c in PIECE_ENDS]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


# -- phrases of a block of texts ------------------------------------------------------------


class Block:
    """The words of some texts, numbered, and where phrases of one more word may begin."""

    def __init__(self, texts: list[str], groups: list[int]) -> None:
        data = _LOWER[np.frombuffer("\n".join([*texts, ""]).encode(), np.uint8)]
        kind = _KIND[data]
        edge = np.zeros(1, np.int8)
        edges = np.diff(np.concatenate([edge, (kind == 0).view(np.int8), edge]))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        sizes = [len(t.encode()) + 1 for t in texts]
        # words have no separators inside, so what is left of the data is the words in a row
        offsets = np.concatenate([[0], (ends - starts).cumsum()]).astype(np.int64)
        letters = data[kind == 0]
        words = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        ).dictionary_encode()
        self.words = words.dictionary
        self.word = words.indices.to_numpy().astype(np.int64)
        self.word_hash = _hashes(self.words)
        text_ends = np.cumsum(sizes)
        self.group = np.asarray(groups, np.int64)[np.searchsorted(text_ends, starts, "right")]

    def levels(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For phrases of 1, 2 ... words: the length, where they begin, the number of the
        phrase that begins there, and for each number one such place."""
        at = np.arange(len(self.word))
        numbers, first = _numbered(self.group * len(self.words) + self.word)
        yield 1, at, numbers, at[first]
        for length in range(2, longest + 1):
            # all words of a phrase lie in one piece; pieces never reach into another text
            longer = at + length - 1 < len(self.word)
            at, numbers = at[longer], numbers[longer]
            same = self.piece[at] == self.piece[at + length - 1]
            at, numbers = at[same], numbers[same]
            numbers, first = _numbered(numbers * len(self.words) + self.word[at + length - 1])
            yield length, at, numbers, at[first]

    def hashes(self, places: np.ndarray, length: int, group_hash: np.ndarray) -> np.ndarray:
        """Hashes of the phrases of ``length`` words at ``places``, with those of their groups."""
        total = group_hash[self.group[places]] + np.uint64(length)
        for k in range(length):
            total = mix(total * MULTIPLIERS[1] + self.word_hash[self.word[places + k]])
        return total

    def phrases(self, places: np.ndarray, length: int) -> pa.Array:
        """The phrases there as texts, their words joined by spaces."""
        parts = [self.words.take(pa.array(self.word[places + k])) for k in range(length)]
        joined = parts[0] if length == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        return joined.cast(pa.large_string()).cast(pa.string())


def _numbered(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers 0, 1, 2 ... in place of equal codes, and where each first stands."""
    numbers, found = pd.factorize(codes)
    first = np.empty(len(found), np.int64)
    first[numbers[::-1]] = np.arange(len(codes))[::-1]
    return numbers.astype(np.int64), first


def _blocks(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[tuple[Block, list[str], list[int]]]:
    """Blocks of texts; the language and the shard of each group."""
    texts: list[str] = []
    groups: list[int] = []
    known: dict[tuple[str, int], int] = {}
    held = 0

    def block() -> tuple[Block, list[str], list[int]]:
        langs, of = zip(*known) if known else ((), ())
        return Block(texts, groups), list(langs), list(of)

    for batch in in_parts(batches):
        for text, lang, shard in zip(*(batch.column(n).to_pylist() for n in ("text", "lang", "shard"))):
            texts.append(text)
            groups.append(known.setdefault((lang, shard if shards > 1 else 0), len(known)))
            held += len(text)
            if held >= BLOCK_BYTES:
                yield block()
                texts, groups, known, held = [], [], {}, 0
    if texts:
        yield block()


def _hashes(texts: pa.Array) -> np.ndarray:
    """Hashes of texts or bytes, as an array with 64-bit offsets."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return span_hashes(np.frombuffer(data or b"", np.uint8), at[:-1], at[1:])


class Bitmap:
    """A set of hashes, as bits of their upper part: it says yes too often, never no."""

    def __init__(self, bits: int, ones: np.ndarray) -> None:
        self.bits, self.ones = bits, ones

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.ones[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(keys: DataFrame) -> Bitmap | None:
    """The bitmap of a staged column ``key``; None if the keys are too many for one."""
    count = keys.count()
    bits = max(SEGMENT_BITS, (count * BITS_PER_KEY - 1).bit_length())
    if bits > BITMAP_BITS:
        bits = BITMAP_BITS
        if count * 4 > 1 << bits:
            return None
    schema = "segment int, ones binary"
    arrow = to_arrow(keys.sparkSession, schema)
    size = 1 << (SEGMENT_BITS - 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task has some of at most 2^(BITMAP_BITS - SEGMENT_BITS) segments of 128 KB
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            segment = (at >> np.uint64(SEGMENT_BITS)).astype(np.int64)
            place = at & np.uint64((1 << SEGMENT_BITS) - 1)
            for k in np.unique(segment).tolist():
                ones = found.setdefault(k, np.zeros(size, np.uint8))
                mine = place[segment == k]
                np.bitwise_or.at(ones, mine >> np.uint64(3), np.uint8(1) << (mine & np.uint64(7)).astype(np.uint8))
        columns = [pa.array([*found], pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    segments = 1 << (bits - SEGMENT_BITS)
    dealt = keys.repartition(segments, F.shiftrightunsigned("key", 64 - bits + SEGMENT_BITS)) if segments > 1 else keys.coalesce(1)
    ones = np.zeros((segments, size), np.uint8)
    for row in dealt.mapInArrow(run, schema).toLocalIterator():
        ones[row["segment"]] |= np.frombuffer(row["ones"], np.uint8)
    return Bitmap(bits, ones.reshape(-1))


# -- the three steps ------------------------------------------------------------------------


def _prepared(docs: DataFrame, shards: int) -> DataFrame:
    return docs.select(
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"),
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
    )


def _shared(spark, bitmap: Bitmap | None):
    return None if bitmap is None else spark.sparkContext.broadcast((bitmap.bits, bitmap.ones))


def _opened(shared) -> Bitmap | None:
    return None if shared is None else Bitmap(*shared.value)


def mine_shards(docs: DataFrame, lengths: range, support: int, shards: int, frequent: Bitmap | None) -> DataFrame:
    """(key) of the phrases of these lengths with their share of the support in some shard.

    With ``frequent``, a phrase counts only where its first and its last words, all but one,
    are in it.
    """
    if not 1 <= shards <= 1 << SHARD_BITS:
        raise ValueError(f"from 1 to {1 << SHARD_BITS} shards")
    spark = docs.sparkSession
    schema = "packed long, n int"
    arrow = to_arrow(spark, schema)
    shared = _shared(spark, frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = _opened(shared)
        for block, langs, of in _blocks(batches, shards):
            group_hash, shard = _hashes(pa.array(langs, pa.large_string())), np.asarray(of, np.uint64)
            for length, _, number, place in block.levels(lengths[-1]):
                if length not in lengths:
                    continue
                n = np.bincount(number, minlength=len(place))
                if bitmap is not None:
                    keep = bitmap.has(block.hashes(place, length - 1, group_hash))
                    keep &= bitmap.has(block.hashes(place + 1, length - 1, group_hash))
                    place, n = place[keep], n[keep]
                packed = (block.hashes(place, length, group_hash) & ~np.uint64((1 << SHARD_BITS) - 1)) | shard[
                    block.group[place]
                ]
                yield from _batches([pa.array(packed.view(np.int64)), pa.array(n.astype(np.int32))], arrow)
        give_back()

    key = F.shiftright("packed", SHARD_BITS)
    dealt = _prepared(docs, shards).mapInArrow(run, schema).repartition(key).sortWithinPartitions("packed")
    return dealt.mapInArrow(_frequent_runs(spark, -(-support // shards)), "key long")


def _frequent_runs(spark, least: int):
    """From rows (packed, n) in order of packed: the keys with ``least`` or more in some shard."""
    arrow = to_arrow(spark, "key long")

    def keys(packed: np.ndarray, n: np.ndarray) -> np.ndarray:
        first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
        found = packed[first][np.add.reduceat(n, first) >= least] & ~np.int64((1 << SHARD_BITS) - 1)
        return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the rows of the last key, which may go on in the next batch
        packed, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            packed = np.concatenate([packed, batch.column("packed").to_numpy()])
            n = np.concatenate([n, batch.column("n").to_numpy()])
            if not len(packed):
                continue
            cut = int(np.searchsorted(packed >> SHARD_BITS, packed[-1] >> SHARD_BITS))
            if cut:
                yield from _batches([pa.array(keys(packed[:cut], n[:cut]))], arrow)
            first = np.flatnonzero(np.concatenate([[True], packed[cut + 1 :] != packed[cut:-1]])) + cut
            packed, n = packed[first], np.add.reduceat(n, first)
        if len(packed):
            yield from _batches([pa.array(keys(packed, n))], arrow)
        give_back()

    return run


def count_phrases(docs: DataFrame, longest: int, candidates: Bitmap | None) -> DataFrame:
    """(lang, phrase, words, f): exact counts of all candidates; words 0 has the language's words."""
    spark = docs.sparkSession
    schema = "lang string, phrase string, words int, n long"
    arrow = to_arrow(spark, schema)
    shared = _shared(spark, candidates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = _opened(shared)
        for block, langs, _ in _blocks(batches, 1):
            group_hash, names = _hashes(pa.array(langs, pa.large_string())), pa.array(langs)
            words = np.bincount(block.group, minlength=len(langs))
            nothing = pa.array([""] * len(langs))
            yield from _batches([names, nothing, pa.array(np.zeros(len(langs), np.int32)), pa.array(words)], arrow)
            for length, _, number, place in block.levels(longest):
                n = np.bincount(number, minlength=len(place))
                if bitmap is not None:
                    keep = bitmap.has(block.hashes(place, length, group_hash))
                    place, n = place[keep], n[keep]
                for at in range(0, len(place), ROWS):
                    part = place[at : at + ROWS]
                    columns = [
                        names.take(pa.array(block.group[part])),
                        block.phrases(part, length),
                        pa.array(np.full(len(part), length, np.int32)),
                        pa.array(n[at : at + ROWS]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        give_back()

    # a block sends a phrase once, and most phrases are in few blocks: to combine them
    # again before the exchange would take more than it saves
    rows = _prepared(docs, 1).mapInArrow(run, schema).repartition("lang", "phrase", "words")
    return rows.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f"))


ROWS = 1 << 16


def _batches(columns: list[pa.Array], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([c.slice(at, ROWS) for c in columns], schema=schema)


def phrase_counts(
    docs: DataFrame, longest: int = LONGEST, support: int = SUPPORT, shards: int = SHARDS
) -> DataFrame:
    """(lang, phrase, words, f) of all phrases up to ``longest`` words with the support, and
    for each language the number of its words, as the row of no words."""
    found = stage(mine_shards(docs, range(1, min(2, longest) + 1), support, shards, None))
    bitmap = bitmap_of(found)
    for length in range(3, longest + 1):
        more = stage(mine_shards(docs, range(length, length + 1), support, shards, bitmap))
        found = stage(found.unionAll(more))
        bitmap = bitmap_of(found)
    counts = count_phrases(docs, longest, bitmap)
    return stage(counts.where((F.col("words") == 0) | (F.col("f") >= support)))


# -- scores ---------------------------------------------------------------------------------


def score_phrases(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the candidates, at their lowest-scoring cut.

    Every part of a candidate is at least as frequent as it, so all parts are in ``counts``.
    """
    candidates = counts.where("words >= 2").withColumnRenamed("f", "a")
    parts = counts.where((F.col("words") >= 1) & (F.col("words") < longest))
    cuts = candidates.withColumn("cut", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', cut)"),
            "right": F.expr("substring_index(phrase, ' ', cut - words)"),
        }
    )
    for side, name in (("left", "l"), ("right", "r")):
        lookup = parts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name))
        cuts = lookup_join(stage(cuts), lookup, [("lang", "_lang"), (side, "_part")]).drop("_lang", "_part", side)
    a, left, right = (F.col(n).cast("decimal(18,0)") for n in ("a", "l", "r"))
    above = F.lit(1_000_000).cast("decimal(7,0)") * (a * a)
    scored = cuts.withColumns({"_above": above, "_below": left * right}).withColumn("score", F.expr("_above div _below"))
    best = F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("best")
    chosen = scored.groupBy("lang", "phrase", "words", "a").agg(best)
    return chosen.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def drop_covered(scored: DataFrame, counts: DataFrame, percent: int = COVER_PERCENT) -> DataFrame:
    """``scored`` without the phrases inside a longer one with at least that share of their count."""
    longer = counts.where("words >= 3").withColumn("w", F.split("phrase", " "))
    inside = longer.withColumn("size", F.explode(F.expr("sequence(2, words - 1)"))).withColumn(
        "at", F.explode(F.expr("sequence(1, words - size + 1)"))
    )
    part = F.array_join(F.slice("w", F.col("at"), F.col("size")), " ")
    most = inside.groupBy("lang", part.alias("phrase")).agg(F.max("f").alias("most"))
    kept = scored.join(most, ["lang", "phrase"], "left")
    covered = F.coalesce(F.col("most"), F.lit(0)).cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * percent
    return kept.where(~covered).drop("most")


def collocations(
    docs: DataFrame,
    best: int = BEST,
    longest: int = LONGEST,
    support: int = SUPPORT,
    percent: int = COVER_PERCENT,
    shards: int = SHARDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``best`` phrases of each language.

    ``docs`` holds doc_id, text and lang. A phrase has 2 to ``longest`` words in one piece
    and occurs ``support`` times or more.
    """
    counts = phrase_counts(docs, longest, support, shards)
    kept = drop_covered(score_phrases(counts, longest), counts, percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = Window.partitionBy("lang", "_part").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    top = kept.withColumn("_part", part).withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= best)
    ranked = top.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= best)
    words = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(small(words), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
