"""Whitening of embeddings, from exact integer covariances.

Every entry becomes a whole number. Within a block of rows each dimension is shifted by
its least value there, and its bits are cut into planes, each plane packed across the rows
into 64-bit words. For two planes of weights 2^a and 2^b the ones of their AND, times
2^(a+b), are their part of a cross-product, so sums of products of any two dimensions are
exact. Blocks are carried to a common origin and added in Python's integers, and tasks in
Spark by decimals. The covariance is centred as integers (n * sum xy - sum x * sum y) before it is
rounded once to double for ``eigh``.

Only a matrix of dimensions times dimensions comes to the driver and, as components, goes
to the tasks: its size doesn't depend on the number of rows. Vectors of more than
``MOST_DIMS`` entries are refused.

Rows whose vector is null or empty or holds null or non-finite entries are dropped, and so
are vectors of another length than the most frequent one (ties: the longer). Entries
beyond about 2^62 / 64 count as that. A null id stays null, repeated rows count each time,
an empty table gives an empty result, and no other column is read. Components along which
nothing varies (eigenvalue within rounding of the largest) whiten to 0.0, are left out of
``identity_error``, and explain their share, 0.0 if nothing varies at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import give_back, to_arrow

SCALE, ORIGIN = 64, 1_000_000
COMPONENTS = 32
# the driver holds a few matrices of so many rows and columns, of some 50 bytes an entry
MOST_DIMS = 4096
# bytes of vectors and of bit planes that are held at once
BLOCK_BYTES = 32 << 20
LARGEST = float(1 << 62)
# digits of a summand, so that sums of 10^9 tasks stay in 38 digits: larger numbers go in pieces
PIECE = 10**28


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """x = floor(64 c) less the origin of a million, which the caller adds where it matters."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)


# -- exact sums of a block ---------------------------------------------------------------


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes packed across the rows into words; the dimension and the bit of each plane."""
    rows, dims = shifted.shape
    bits = [int(v).bit_length() for v in shifted.max(axis=0)]
    words = -(-rows // 64)
    dim = np.repeat(np.arange(dims), bits)
    bit = np.concatenate([np.arange(b) for b in bits]) if dims else np.zeros(0, int)
    planes = np.zeros((len(dim), words * 8), np.uint8)
    for k, (d, b) in enumerate(zip(dim.tolist(), bit.tolist())):
        ones = np.packbits(((shifted[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8))
        planes[k, : len(ones)] = ones
    return planes.view(np.uint64), dim, bit


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and sums of products of the columns of whole numbers, as Python integers."""
    rows, dims = x.shape
    least = x.min(axis=0)
    # the difference of two int64 numbers fits uint64
    shifted = x.astype(np.uint64) - least.astype(np.uint64)
    planes, dim, bit = bit_planes(shifted)
    ones = np.zeros((len(planes), len(planes)), np.int64)
    for k in range(len(planes)):
        ones[k, k:] = np.bitwise_count(planes[k:] & planes[k]).sum(axis=1, dtype=np.int64)
    ones = np.maximum(ones, ones.T)
    weight = np.zeros((dims, len(planes)), object)
    weight[dim, np.arange(len(planes))] = [1 << int(b) for b in bit]
    top = int(bit.max(initial=0)) + 1
    if rows.bit_length() + 2 * top + 2 < 63:  # then 64 bits hold every sum
        weight = weight.astype(np.int64)
    sums = (weight @ ones.diagonal()).astype(object)
    products = (weight @ ones @ weight.T).astype(object)
    shift = least.astype(object)
    products = products + np.outer(shift, sums) + np.outer(sums, shift) + rows * np.outer(shift, shift)
    return sums + rows * shift, products


def _matrix(vectors: pa.ListArray, dims: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a column of lists hold ``dims`` finite numbers (None: any), and these rows."""
    lengths = np.asarray(vectors.value_lengths().fill_null(0))
    entries = vectors.flatten()
    values = entries.cast(pa.float64(), safe=False).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    # flatten leaves out the entries of null lists, and starts with the first list's
    starts = np.concatenate([[0], lengths.cumsum()[:-1]]).astype(np.int64)
    bad = np.concatenate([[0], (~np.isfinite(values)).cumsum()])
    good = (lengths > 0) & (bad[starts + lengths] == bad[starts])
    if dims is None:
        return good, values
    good &= lengths == dims
    at = starts[good][:, None] + np.arange(dims)
    return good, values[at]


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole numbers of the rows that remain, in blocks of bounded size."""
    most = max(64, BLOCK_BYTES // (16 * dims))
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            good, values = _matrix(part.column("embedding"), dims)
            if good.any():
                yield part.column("vec_id").filter(pa.array(good)), whole_numbers(values)


# -- model -------------------------------------------------------------------------------


@dataclass
class Whitening:
    """What the tasks need: exact sums, unit components (a column each) and eigenvalues."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole numbers, centred and projected, with unit variance."""
        spread = np.where(self.values > 0, self.values, np.inf)
        return (self.deviations(x).astype(np.float64) / self.n) @ self.vectors / np.sqrt(spread)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        high = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums))
        kind = np.int64 if high < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def squared(self, x: np.ndarray) -> list[int]:
        """Sums over the dimensions of (n * x - S)^2, exact."""
        d = self.deviations(x)
        if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 1 << 63:
            d = d.astype(object)
        return (d * d).sum(axis=1).tolist()


def usual_length(embeddings: DataFrame) -> int | None:
    """The most frequent length of a vector without null or non-finite entries; None without rows."""
    arrow = to_arrow(embeddings.sparkSession, "dims int, rows long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = np.asarray(vectors.value_lengths().fill_null(0))
            for length, n in zip(*np.unique(lengths[_matrix(vectors, None)[0]], return_counts=True)):
                counts[int(length)] = counts.get(int(length), 0) + int(n)
        yield pa.RecordBatch.from_pydict({"dims": list(counts), "rows": list(counts.values())}, schema=arrow)

    found = embeddings.select("embedding").mapInArrow(run, "dims int, rows long").groupBy("dims").agg(
        F.sum("rows").alias("rows")
    )
    top = found.orderBy(F.desc("rows"), F.desc("dims")).first()
    return top["dims"] if top else None


def exact_sums(embeddings: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """Number of rows, sums and sums of products (less the origin), exact.

    Each task sends one row for each pair of dimensions; Spark adds them.
    """
    schema = "i int, j int, high decimal(38,0), low decimal(38,0)"
    arrow = to_arrow(embeddings.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for _, x in _blocks(batches, dims):
            part, cross = cross_products(x)
            n, sums, products = n + len(x), sums + part, products + cross
        if not n:
            return
        i, j = np.triu_indices(dims)
        numbers = [n, *sums.tolist(), *products[i, j].tolist()]
        high, low = zip(*(divmod(v, PIECE) for v in numbers))
        at_i, at_j = [-1, *[-1] * dims, *i.tolist()], [-1, *range(dims), *j.tolist()]
        for k in range(0, len(numbers), 1 << 16):
            part = slice(k, k + (1 << 16))
            columns = [at_i[part], at_j[part], _decimals(high[part]), _decimals(low[part])]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
        give_back()

    parts = embeddings.select("vec_id", "embedding").mapInArrow(run, schema)
    added = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    n, sums, products = 0, [0] * dims, np.zeros((dims, dims), object)
    for row in added.toLocalIterator():
        value = int(row["high"]) * PIECE + int(row["low"])
        if row["j"] < 0:
            n = value
        elif row["i"] < 0:
            sums[row["j"]] = value
        else:
            products[row["i"], row["j"]] = products[row["j"], row["i"]] = value
    return n, sums, products


def _decimals(values) -> list:
    from decimal import Decimal

    return [Decimal(v) for v in values]


def covariance(n: int, sums: list[int], products: np.ndarray) -> np.ndarray:
    """Covariances, centred as integers and then rounded once."""
    found = np.empty(products.shape)
    for i, s in enumerate(sums):
        found[i] = [(n * p - s * t) / (n * n) for p, t in zip(products[i].tolist(), sums)]
    return found


def fit_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit to all rows that remain; None if none does.

    Reads the vectors three times: their length, the sums, and the covariance of what was
    whitened, which gives ``identity_error``.
    """
    dims = usual_length(embeddings)
    if dims is None:
        return None
    if dims > MOST_DIMS:
        raise ValueError(f"vectors of {dims} entries: more than {MOST_DIMS} need more memory than a driver may be asked for")
    n, sums, products = exact_sums(embeddings, dims)
    v = covariance(n, sums, products)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    trace = float(np.trace(v))
    noise = max(values[0], 0) * dims * np.finfo(np.float64).eps * 4
    kept = slice(0, components)
    found = Whitening(
        n,
        sums,
        vectors[:, kept],
        np.where(values > noise, values, 0.0)[kept],
        (np.maximum(values, 0) / trace if trace > 0 else np.zeros(dims))[kept],
    )
    found.identity_error = identity_error(embeddings, found)
    return found


def identity_error(embeddings: DataFrame, model: Whitening) -> float:
    """Largest entry, taken absolutely, of the whitened rows' covariance minus the identity."""
    dims, width = model.vectors.shape
    arrow = to_arrow(embeddings.sparkSession, "i int, j int, value double")
    pairs = [*zip(*np.triu_indices(width))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(width), np.zeros((width, width))
        for _, x in _blocks(batches, dims):
            w = model.whiten(x)
            total += w.sum(axis=0)
            products += w.T @ w
        i = [-1] * width + [int(a) for a, _ in pairs]
        j = [*range(width)] + [int(b) for _, b in pairs]
        values = [*total.tolist(), *(float(products[a, b]) for a, b in pairs)]
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "value": values}, schema=arrow)

    parts = embeddings.select("vec_id", "embedding").mapInArrow(run, "i int, j int, value double")
    added = {(r["i"], r["j"]): r["v"] for r in parts.groupBy("i", "j").agg(F.sum("value").alias("v")).collect()}
    varies = model.values > 0
    mean = np.array([added[-1, k] for k in range(width)]) / model.n
    errors = [
        abs(added[a, b] / model.n - mean[a] * mean[b] - (a == b)) for a, b in pairs if varies[a] and varies[b]
    ]
    return float(max(errors, default=0.0))


# -- rows --------------------------------------------------------------------------------

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double, deviation_digits string"
)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each remaining row of ``embeddings`` (vec_id, embedding) and component.

    ``deviation`` is the exact sum of (n * x - S)^2; where 64 bits don't hold it, it is
    null and only ``deviation_digits`` has it.
    """
    spark = embeddings.sparkSession
    model = fit_whitening(embeddings, components)
    if model is None:
        return spark.createDataFrame([], RESULT)
    arrow = to_arrow(spark, RESULT)
    dims, width = model.vectors.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, dims):
            for at in range(0, len(x), 1024):
                yield _rows(ids.slice(at, 1024), x[at : at + 1024])
        give_back()

    def _rows(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        rows = len(x)
        deviations = model.squared(x)
        each = pa.array(np.repeat(np.arange(rows), width))
        columns = [
            ids.take(each),
            pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
            pa.array(np.full(rows * width, model.n)),
            pa.array([d if d < 1 << 63 else None for d in deviations], pa.int64()).take(each),
            pa.array(model.whiten(x).reshape(-1)),
            pa.array(np.tile(model.explained, rows)),
            pa.array(np.full(rows * width, model.identity_error)),
            pa.array([str(d) for d in deviations]).take(each),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    return embeddings.select("vec_id", "embedding").mapInArrow(run, RESULT)
