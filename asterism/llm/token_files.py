"""Token files: ids of whole texts, entropy coded in independent blocks.

Format. A file set is a folder of three Parquet tables, so that any store Spark
writes to can hold it and a lost task is simply redone:

* ``blocks``: part, block, first (ids of the part before the block), n_docs,
  n_tokens, payload. The payload is described at ``encode_block``; blocks hold
  whole documents and are decoded on their own.
* ``parts``: part, start (ids of all parts before it), n_tokens. Parts follow
  ascending doc_id.
* ``model``: the frequency table that all blocks share.

Ids are coded by a static range asymmetric numeral system. The ids of a block are
dealt in turn to LANES states; a state gives off its low 32 bits when it would grow
beyond 63. Every SEGMENT ids the states and the place in the words are kept as a
checkpoint, from which a decoder may start: ``decode_block`` runs all segments of a
block side by side.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from asterism.llm.common import map_rows, small, to_arrow
from asterism.llm.spans import PIECE, span_hashes
from asterism.sources.json_tree import dataset_path
from asterism.sources.staging import stage

END = 1
MAGIC = 0x31534E41  # "ANS1"
# frequencies add up to 1 << SCALE; states stay from 1 << LOW up
SCALE, LOW = 18, 31
LANES = 512
SEGMENT = 1 << 16
BLOCK = 1 << 19
# places for pieces that a worker keeps, of which half are filled
SLOTS = 1 << 21

BLOCKS = "part int, block int, first long, n_docs int, n_tokens long, payload binary"
RESULT = "doc_id long, first long, n_tokens long, ids_crc32 long, part int"

# Texts that are cut into pieces here, kinds of bytes in them, and texts
# that show whether a tokenizer cuts alike.
PLAIN = re.compile(r"[\t\n\r !-&(-~À-ÖØ-öø-ÿ]*")
WHITE, LETTER, DIGIT, MARK = range(4)
KINDS = np.full(256, MARK, np.uint8)
KINDS[[0x09, 0x0A, 0x0D, 0x20]] = WHITE
KINDS[ord("0") : ord("9") + 1] = DIGIT
KINDS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = LETTER
PROBES = ("Édith, x12-Ñandú!!", "###$$", "(it", "É", "ÿßÞð", "A.B_c", "", "two words\n3 4\t5", "1a2.3")
# the first bytes of a piece up to eight
HEADS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

U32, U64 = np.dtype("<u4"), np.dtype("<u8")


class PieceTable:
    """Ids of pieces by hash, length and first eight bytes, in arrays with open addresses."""

    def __init__(self, kind: np.dtype):
        self.hash, self.head = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.length, self.at, self.count = (np.zeros(SLOTS, np.int32) for _ in range(3))
        self.ids, self.used, self.filled = np.zeros(1 << 16, kind), 0, 0

    def find(self, pieces: np.ndarray) -> np.ndarray:
        """The slot of each of ``pieces`` (hash, head, length), or -1."""
        out, left = np.full(pieces.shape[1], -1), np.arange(pieces.shape[1])
        slot = (pieces[0] >> np.uint64(1) & np.uint64(SLOTS - 1)).astype(np.int64)
        while len(left):
            here = slot[left]
            found = self.hash[here]
            hash_, head, length = pieces[:, left]
            hit = (found == hash_) & (self.head[here] == head) & (self.length[here] == length.astype(np.int32))
            out[left[hit]] = here[hit]
            left = left[~hit & (found != 0)]
            slot[left] = (slot[left] + 1) & (SLOTS - 1)
        return out

    def add(self, pieces: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Put in pieces that aren't there, each once, with as many of ``ids`` as it has."""
        total = len(ids)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + total] = ids
        at = self.used + np.cumsum(counts) - counts
        self.used += total
        self.filled += len(counts)
        left = np.arange(len(counts))
        slot = (pieces[0] >> np.uint64(1) & np.uint64(SLOTS - 1)).astype(np.int64)
        while len(left):
            free = left[self.hash[slot[left]] == 0]
            here, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.hash[here], self.head[here] = pieces[0, put], pieces[1, put]
            self.length[here], self.at[here], self.count[here] = pieces[2, put], at[put], counts[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & (SLOTS - 1)

    def joined(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after another, and where each piece's begin, and the end."""
        counts = self.count[slots]
        begins = np.concatenate([[0], np.cumsum(counts)])
        index = np.repeat(self.at[slots] - begins[:-1], counts) + np.arange(begins[-1])
        return self.ids[index], begins


class PieceIds:
    """Ids of whole texts by the tokenizers library, with the ids of pieces kept.

    The tokenizer drops white space and no token spans it, so the ids of a text are
    those of its words, and those of a word are those of its pieces: runs of letters,
    single digits and runs of other marks. A text of ASCII and Latin-1 letters and marks
    without apostrophes, which composed forms, odd cases and contractions don't touch,
    is lower-cased and cut here, many texts in one array. The library's model encodes
    each new piece, many in one call, and the ids are kept until the table is full. Any
    other text goes through the library whole, as does one with a run beyond PIECE bytes. ``by_piece`` tells whether the tokenizer
    cuts so, tried on PROBES.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else U32
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.table = PieceTable(self.kind)
        self.by_piece = True
        self.by_piece = self.of_texts([*PROBES]) == [*map(self.whole, PROBES)]

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def of_texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian bytes."""
        out: list[list[bytes]] = [[] for _ in texts]
        some: list[tuple[int, bytes]] = []
        held = 0
        for i, text in enumerate(texts):
            parts = _parts(text) if self.by_piece and PLAIN.fullmatch(text) and "<|" not in text else None
            if parts is None:
                out[i].append(self.whole(text))
                continue
            for part in parts:
                some.append((i, part))
                held += len(part) + 1
                if held > PIECE // 2:
                    self._by_pieces(some, out)
                    some, held = [], 0
        if some:
            self._by_pieces(some, out)
        return [*map(b"".join, out)]

    def _by_pieces(self, texts: list[tuple[int, bytes]], out: list[list[bytes]]) -> None:
        raw = b"\n".join([*(text for _, text in texts), b"\0" * 8])
        data = np.frombuffer(raw, np.uint8).copy()
        data[(data >= 0x80) & (data <= 0x9E)] += 0x20  # the second byte of a capital with an accent
        kind = KINDS[data[:-8]]
        cut = np.flatnonzero((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(kind)]])
        there = kind[starts] != WHITE
        starts, ends = starts[there], ends[there]
        eights = np.ndarray(len(kind), np.dtype("<u8"), data, strides=(1,))
        pieces = np.stack(
            [
                span_hashes(data, starts, ends) | np.uint64(1),
                eights[starts] & HEADS[np.minimum(ends - starts, 8)],
                (ends - starts).astype(np.uint64),
            ]
        )
        slots = self.table.find(pieces)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            _, first = np.unique(pieces[0, missing], return_index=True)
            new = missing[first]
            if self.table.filled + len(new) > SLOTS // 2:
                self.table = PieceTable(self.kind)
                missing, new = np.arange(len(starts)), np.unique(pieces[0], return_index=True)[1]
            lowered = data.tobytes()
            spans = zip(starts[new].tolist(), ends[new].tolist())
            self.table.add(pieces[:, new], *self._encoded([lowered[a:b].decode() for a, b in spans]))
            slots[missing] = self.table.find(pieces[:, missing])
        ids, begins = self.table.joined(slots)
        ids = ids.tobytes()
        edges = np.cumsum([0, *(len(text) + 1 for _, text in texts)])
        at = (begins[np.searchsorted(starts, edges)] * self.kind.itemsize).tolist()
        for (i, _), a, b in zip(texts, at, at[1:]):
            out[i].append(ids[a:b])

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces one after another, and how many each has."""
        parts = []
        for begin in range(0, len(pieces), 1000):
            some = pieces[begin : begin + 1000]
            encoding = self.model.encode(" ".join(some), add_special_tokens=False)
            counts = np.bincount(encoding.word_ids, minlength=len(some))
            parts.append((np.array(encoding.ids, self.kind), counts))
        return tuple(np.concatenate(part) for part in zip(*parts))


def _parts(text: str) -> list[bytes] | None:
    """A text's bytes, lower-cased, in parts of a bounded length that end at white space;
    None where there is none to cut at."""
    raw = text.encode().lower()
    parts, at = [], 0
    while len(raw) - at > PIECE // 2:
        cut = max(raw.rfind(space, at, at + PIECE // 2) for space in (b" ", b"\n"))
        if cut < 0:
            return None
        parts.append(raw[at:cut])
        at = cut + 1
    return [*parts, raw[at:]]


@lru_cache(2)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def encode_ids(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """doc_id and ids of each whole text, closed by ``end``: little-endian unsigned
    16-bit numbers if the vocabulary allows that, else 32-bit.
    """

    def batch(columns: dict[str, list]) -> dict[str, list]:
        library = piece_ids(path)
        last = np.array(end, library.kind).tobytes()
        return {
            "doc_id": columns["doc_id"],
            "ids": [ids + last for ids in library.of_texts([text or "" for text in columns["text"]])],
        }

    return map_rows(docs.select("doc_id", "text"), batch, "doc_id long, ids binary")


# -- frequencies ----------------------------------------------------------------


def count_ids(encoded: DataFrame, kind: np.dtype) -> np.ndarray:
    """How often each id occurs in all documents; one row an id reaches the driver."""
    schema = "id long, n long"
    arrow = to_arrow(encoded.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            got = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(got) > len(total):
                total = np.pad(total, (0, len(got) - len(total)))
            total[: len(got)] += got
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], schema=arrow)

    counted = encoded.select("ids").mapInArrow(run, schema).groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(max([0, *counted["id"].to_pylist()]) + 1, np.int64)
    counts[counted["id"].to_numpy()] = counted["n"].to_numpy()
    return counts


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to add up to 1 << SCALE, each that occurs at least 1.

    The largest remainders get what rounding leaves, and what it takes too much comes
    off the largest frequencies.
    """
    total, there = int(counts.sum()), counts > 0
    if there.sum() >= 1 << SCALE:
        raise ValueError("the scale is too small for so many ids")
    if not total:
        return np.zeros(len(counts), np.uint64)
    exact = counts * ((1 << SCALE) / total)
    freq = np.where(there, np.maximum(1, np.floor(exact)), 0).astype(np.int64)
    left = (1 << SCALE) - int(freq.sum())
    if left > 0:
        order = np.argsort(-(exact - freq) * there, kind="stable")[: there.sum()]
        freq[order] += left // len(order)
        freq[order[: left % len(order)]] += 1
    while left < 0:
        largest = int(freq.argmax())
        take = min(-left, int(freq[largest]) // 2)
        freq[largest] -= take
        left += take
    return freq.astype(np.uint64)


class Model:
    """The shared table: frequency and first slot of each id, and the id of each slot."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        ids = np.arange(len(freq), dtype=np.uint16 if len(freq) <= 1 << 16 else np.uint32)
        self.of_slot = np.repeat(ids, freq.astype(np.int64))


# -- blocks -----------------------------------------------------------------------


def encode_block(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray, model: Model) -> bytes:
    """One block: magic, counts, crc32 of all that follows, then documents, checkpoints and words.

    Header: u32 magic, u32 crc32, u64 documents, u64 ids, u64 words. Then per document
    i64 doc_id, u8 whether it is null and u64 length; per segment LANES u64 states and
    u64 place in the words; last the u32 words in the order a decoder reads them.
    """
    n = len(ids)
    steps = -(-n // LANES)
    per_segment = SEGMENT // LANES
    rows = np.zeros(steps * LANES, np.int64)
    rows[:n] = ids
    rows = rows.reshape(steps, LANES)
    live = n - (steps - 1) * LANES if steps else 0
    state = np.full(LANES, 1 << LOW, np.uint64)
    words: list[np.ndarray] = []
    given = 0
    marks: list[tuple[np.ndarray, int]] = []
    scale, shift, top = np.uint64(SCALE), np.uint64(32), np.uint64(63 - SCALE)
    for step in range(steps - 1, -1, -1):
        row = rows[step]
        x = state if step < steps - 1 else state[:live]
        row = row if step < steps - 1 else row[:live]
        f = model.freq[row]
        full = x >= (f << top)
        if full.any():
            out = x[full]
            words.append((out & np.uint64(0xFFFFFFFF)).astype(U32))
            given += len(out)
            x = np.where(full, x >> shift, x)
        q = x // f
        x = (q << scale) + (x - q * f) + model.first[row]
        if step < steps - 1:
            state = x
        else:
            state = np.concatenate([x, state[live:]])
        if step % per_segment == 0:
            marks.append((state.copy(), given))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, U32)
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    body = b"".join(
        [
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            nulls.tobytes(),
            np.asarray(lengths, U64).tobytes(),
            *(part for x, at in marks[::-1] for part in (x.astype(U64).tobytes(), U64.type(given - at).tobytes())),
            stream.tobytes(),
        ]
    )
    head = np.array([MAGIC, zlib.crc32(body)], U32).tobytes() + np.array([len(doc_ids), n, given], U64).tobytes()
    return head + body


def decode_block(payload: bytes, model: Model) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, lengths and ids of a block; a damaged one raises.

    The segments are decoded side by side, each from its checkpoint.
    """
    magic, crc = np.frombuffer(payload, U32, 2)
    n_docs, n, n_words = map(int, np.frombuffer(payload, U64, 3, 8))
    if magic != MAGIC or zlib.crc32(memoryview(payload)[32:]) != crc:
        raise ValueError("damaged block")
    at = 32
    docs = np.frombuffer(payload, "<i8", n_docs, at)
    at += 8 * n_docs
    nulls = np.frombuffer(payload, np.uint8, n_docs, at)
    at += n_docs
    lengths = np.frombuffer(payload, U64, n_docs, at).astype(np.int64)
    at += 8 * n_docs
    segments = -(-n // SEGMENT)
    marks = np.frombuffer(payload, U64, segments * (LANES + 1), at).reshape(segments, LANES + 1)
    at += 8 * segments * (LANES + 1)
    # words beyond the end are read by lanes that have nothing left, and not used
    stream = np.concatenate([np.frombuffer(payload, U32, n_words, at), np.zeros(LANES, U32)]).astype(np.uint64)
    state, place = marks[:, :LANES].copy(), marks[:, LANES].astype(np.int64)
    steps = SEGMENT // LANES
    out = np.zeros((segments, steps, LANES), np.uint32)
    mask, scale, shift, low = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32), np.uint64(1 << LOW)
    position = np.arange(segments)[:, None] * SEGMENT + np.arange(LANES)[None, :]
    for step in range(steps):
        live = position + step * LANES < n
        if not live.any():
            break
        slot = state & mask
        ids = model.of_slot[slot]
        out[:, step] = ids
        x = model.freq[ids] * (state >> scale) + slot - model.first[ids]
        short = (x < low) & live
        index = place[:, None] + np.cumsum(short, axis=1) - 1
        x = np.where(short, (x << shift) | stream[np.where(short, index, 0)], x)
        state = np.where(live, x, state)
        place += short.sum(axis=1)
    return [None if z else int(d) for d, z in zip(docs, nulls)], lengths, out.reshape(-1)[:n]


# -- files -------------------------------------------------------------------------


def write_token_files(docs: DataFrame, root: str, path: str, end: int = END) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizer file ``path`` and write the file set to ``root``.

    Documents lie in ascending order of doc_id, null first; rows of one doc_id follow
    a hash of their ids. Every row is a document, also a repeated one, and a null or empty text
    has the closing id only. An empty table gives a file set without blocks.
    """
    spark = docs.sparkSession
    kind = piece_ids(path).kind
    numbered = encode_ids(docs, path, end).withColumn("row", F.monotonically_increasing_id())
    encoded = stage(numbered)
    freq = frequencies(count_ids(encoded, kind))
    shared = spark.sparkContext.broadcast(freq)  # a number for each id of the vocabulary
    schema = to_arrow(spark, BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, model = TaskContext.get().partitionId(), Model(shared.value)
        first = block = held = 0
        doc_ids: list[int | None] = []
        chunks: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            lengths = np.array([len(c) for c in chunks])
            payload = encode_block(np.concatenate(chunks), doc_ids, lengths, model)
            row = [part, block, first, len(doc_ids), held, payload]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0), batch.column(1)):
                doc_ids.append(doc_id.as_py())
                chunks.append(np.frombuffer(ids.as_py(), kind))
                held += len(chunks[-1])
                if held >= BLOCK:
                    yield close()
                    first, block, held, doc_ids, chunks = first + held, block + 1, 0, [], []
        if doc_ids:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("row")]
    ordered = encoded.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    ordered.mapInArrow(run, BLOCKS).write.mode("overwrite").parquet(dataset_path(root, "blocks"))
    rows = pa.table({"id": np.flatnonzero(freq), "n": freq[np.flatnonzero(freq)].astype(np.int64)})
    spark.createDataFrame(rows).write.mode("overwrite").parquet(dataset_path(root, "model"))
    blocks = spark.read.schema(BLOCKS).parquet(dataset_path(root, "blocks"))
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    parts = parts.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    parts.write.mode("overwrite").parquet(dataset_path(root, "parts"))


def read_token_files(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    table = spark.read.schema("id long, n long").parquet(dataset_path(root, "model")).toArrow()
    freq = np.zeros(max([0, *table["id"].to_pylist()]) + 1, np.uint64)
    freq[table["id"].to_numpy()] = table["n"].to_numpy().astype(np.uint64)
    shared = spark.sparkContext.broadcast(freq)
    models: dict[int, Model] = {}

    def batch(columns: dict[str, list]) -> dict[str, list]:
        model = models.get(0) or models.setdefault(0, Model(shared.value))
        out: dict[str, list] = {name: [] for name in ("doc_id", "first", "n_tokens", "ids_crc32", "part")}
        for part, first, payload in zip(columns["part"], columns["first"], columns["payload"]):
            doc_ids, lengths, ids = decode_block(payload, model)
            ends = np.cumsum(lengths)
            raw = ids.astype(U32).tobytes()
            out["doc_id"] += doc_ids
            out["first"] += (first + ends - lengths).tolist()
            out["n_tokens"] += lengths.tolist()
            out["ids_crc32"] += [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), lengths.tolist())]
            out["part"] += [part] * len(doc_ids)
        return out

    blocks = spark.read.schema(BLOCKS).parquet(dataset_path(root, "blocks")).select("part", "first", "payload")
    parts = spark.read.schema("part int, n_tokens long, start long").parquet(dataset_path(root, "parts"))
    decoded = map_rows(blocks, batch, RESULT)
    return decoded.join(small(parts.select("part", "start")), "part").select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
