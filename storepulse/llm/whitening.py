"""Whitening of embeddings: exact covariance from bit planes, then a symmetric eigensolver."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.scratch import stage
from storepulse.llm.vectors import whole_rows

#: Entries are held within this, so that the sums below fit decimals of 38 digits.
_LARGEST = 2**31


def quantised(rows: np.ndarray, scale: float, shift: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(rows * scale), -_LARGEST - shift, _LARGEST - shift).astype(np.int64) + shift


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative integers (rows x dimensions), 64 rows to a word.

    Returns the words (planes x words), each plane's weight, and the first plane of each
    dimension. A dimension has as many planes as its largest value has bits, at least one."""
    widths = [max(1, int(m).bit_length()) for m in values.max(axis=0)]
    starts = np.cumsum([0, *widths[:-1]])
    words = np.zeros((sum(widths), -(-len(values) // 64)), np.uint64)
    for d, (width, at) in enumerate(zip(widths, starts)):
        bits = (values[:, d] >> np.arange(width)[:, None]) & 1
        packed = np.packbits(bits.astype(np.uint8), axis=1)
        words[at:at + width].view(np.uint8)[:, :packed.shape[1]] = packed
    return words, np.concatenate([2 ** np.arange(w, dtype=np.int64) for w in widths]), starts


def cross_products(values: np.ndarray) -> np.ndarray:
    """Sums over rows of the products of every two dimensions, as exact Python integers.

    The product of two dimensions is the sum over their planes of weight times weight
    times the number of rows in which both bits are set: a popcount of the AND."""
    words, weights, starts = bit_planes(values)
    dims, largest = values.shape[1], int(weights.max())
    if 4 * largest * largest * len(values) >= 2**63:  # sums that could pass 64 bits
        weights = np.array([int(w) for w in weights], object)
    found = np.zeros((dims, dims), object)
    for i, (first, end) in enumerate(zip(starts, [*starts[1:], len(words)])):
        for p in range(first, end):
            both = np.bitwise_count(words[first:] & words[p]).sum(axis=1, dtype=np.int64)
            found[i, i:] += np.add.reduceat(both * weights[first:], starts[i:] - first) * weights[p]
        found[i + 1:, i] = found[i, i + 1:]
    return found


class Scatter:
    """Number, sums and cross-products of vectors, all exact; vectors are taken in blocks."""

    def __init__(self, size: int, block: int):
        self.n, self.block, self.waiting, self.held = 0, block, [], 0
        self.sums, self.products = np.zeros(size, object), np.zeros((size, size), object)

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.held += len(values)
        if self.held >= self.block:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        values = np.concatenate(self.waiting)
        self.waiting, self.held = [], 0
        for at in range(0, len(values), self.block):
            part = values[at:at + self.block]
            low = part.min(axis=0)  # shifts every dimension to start at zero
            above, low, n = part - low, low.astype(object), len(part)
            sums = above.sum(axis=0).astype(object)
            self.n += n
            self.sums += sums + n * low
            self.products += (cross_products(above) + np.outer(low, sums) + np.outer(sums, low)
                              + n * np.outer(low, low))


def _scatters(vectors: DataFrame, scale: float, shift: int, block: int) -> dict[int, Scatter]:
    """The scatter of the vectors of each length. A task returns its sums once; those of all
    tasks are added by Spark. What reaches the driver is bounded by the squared length."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Scatter] = {}
        for batch in batches:
            for _, rows in whole_rows(batch.column(0)):
                size = rows.shape[1]
                found.setdefault(size, Scatter(size, block)).add(quantised(rows, scale, shift))
        for size, scatter in found.items():
            scatter.flush()
            i, j = np.triu_indices(size)
            zeros = np.zeros(size, int)
            numbers = [scatter.n, *scatter.sums, *scatter.products[i, j]]
            yield pa.record_batch({
                "size": pa.array(np.full(len(numbers), size), pa.int32()),
                "i": pa.array(np.concatenate([[-1], np.arange(size), i]), pa.int32()),
                "j": pa.array(np.concatenate([[-1], zeros - 1, j]), pa.int32()),
                "s": pa.array([Decimal(int(x)) for x in numbers], pa.decimal128(38, 0))})

    parts = vectors.select("embedding").mapInArrow(gather, "size int, i int, j int, s decimal(38,0)")
    found: dict[int, Scatter] = {}
    for row in parts.groupBy("size", "i", "j").agg(F.sum("s").alias("s")).toLocalIterator():
        scatter = found.setdefault(row.size, Scatter(row.size, block))
        if row.i < 0:
            scatter.n = int(row.s)
        elif row.j < 0:
            scatter.sums[row.i] = int(row.s)
        else:
            scatter.products[row.i, row.j] = scatter.products[row.j, row.i] = int(row.s)
    return found


@dataclass(frozen=True)
class Whitener:
    """Means, as whole part and remainder, and scaled components of vectors of one length."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    axes: np.ndarray
    explained: list[float | None]

    def apply(self, values: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Whitened vectors, and exact squared deviations scaled by n * n."""
        centred = values - self.whole
        with np.errstate(invalid="ignore"):
            white = (centred - self.rest / self.n) @ self.axes
        reach = self.n * (int(np.abs(centred).max(initial=0)) + 1)
        if reach * reach * values.shape[1] < 2**63:
            far = pa.array(((centred * self.n - self.rest) ** 2).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
        else:
            exact = ((centred.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1)
            far = pa.array([Decimal(int(x)) if x < 10**38 else None for x in exact], pa.decimal128(38, 0))
        return white, far


def fit(scatter: Scatter, components: int) -> Whitener:
    """Components by falling variance, from the covariance centred in integers.

    A component with no variance to double precision has no scale: its values are null."""
    n, size = scatter.n, len(scatter.sums)
    centred = n * scatter.products - np.outer(scatter.sums, scatter.sums)  # n * n * covariance
    covariance = np.array([[c / (n * n) for c in row] for row in centred], np.float64)
    trace = sum(int(centred[i, i]) for i in range(size)) / (n * n)
    variances, axes = np.linalg.eigh(covariance)
    order = np.argsort(-variances, kind="stable")[:components]
    variances, axes = np.maximum(variances[order], 0.0), axes[:, order]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    flat = variances <= size * np.finfo(float).eps * trace
    scaled = axes / np.sqrt(np.where(flat, np.nan, variances))
    whole = np.array([int(s // n) for s in scatter.sums], np.int64)
    rest = np.array([int(s % n) for s in scatter.sums], np.int64)
    return Whitener(n, whole, rest, scaled, [float(v / trace) if trace else None for v in variances])


def whiten(vectors: DataFrame, components: int = 8, scale: float = 1024.0, shift: int = 100_000,
           block: int = 16_384) -> DataFrame:
    """One row per vector and component: `vec_id`, `component` (from 1), `n`, `deviation`
    (decimal), `whitened`, `explained`, `identity_error`.

    `vectors` has vec_id and embedding; other columns are ignored. Vectors that are null,
    empty, or hold a null or non-finite entry are left out. Entries become
    x = floor(scale * c) + shift, held within 2**31. All remaining vectors of a length are
    fitted together (vectors of different length have no common covariance; normally there
    is one length): `n` is their number, `deviation` the sum over dimensions of
    (n * x - S) ** 2 with the dimension's sum S, null from 38 digits on. `whitened` is the
    centred vector's projection on the component, divided by its standard deviation;
    `explained` is the component's share of the variance; `identity_error` is the largest
    deviation of the covariance of all whitened vectors from the identity. A component
    without variance has null `whitened`, as have all components if vectors are equal or
    alone. Rows that repeat an id or a vector count as often as they occur; a null id is
    kept. An empty table gives an empty result.

    Two passes: the scatter, and the projection, which is written once. Only sums, which do
    not grow with the number of vectors, go through the driver.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    models = {size: fit(scatter, components) for size, scatter in _scatters(vectors, scale, shift, block).items()}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in whole_rows(batch.column(1)):
                size = rows.shape[1]
                white, far = models[size].apply(quantised(rows, scale, shift))
                flat = pa.array(white.ravel(), from_pandas=True)  # NaN: no variance
                ends = pa.array(np.arange(len(at) + 1) * white.shape[1], pa.int32())
                yield pa.record_batch({
                    "vec_id": batch.column(0).take(pa.array(at)), "size": pa.array(np.full(len(at), size), pa.int32()),
                    "deviation": far, "white": pa.ListArray.from_arrays(ends, flat)})

    rows = stage(vectors.mapInArrow(project, "vec_id long, size int, deviation decimal(38,0), white array<double>"),
                 "whitened")
    pairs = list(combinations_with_replacement(range(components), 2))
    errors = [F.abs(F.covar_pop(F.get("white", F.lit(a)), F.get("white", F.lit(b))) - F.lit(float(a == b)))
              for a, b in pairs]
    error = rows.groupBy("size").agg(F.greatest(*errors, F.lit(None)).alias("identity_error"))
    facts = spark.createDataFrame([(s, m.n, m.explained) for s, m in models.items()],
                                  "size int, n long, shares array<double>")
    return (rows.join(F.broadcast(facts.join(error, "size", "left")), "size")
            .select("*", F.posexplode(F.arrays_zip("white", "shares")).alias("p", "c"))
            .select("vec_id", (F.col("p") + 1).cast("int").alias("component"), "n", "deviation",
                    F.col("c.white").alias("whitened"), F.col("c.shares").alias("explained"), "identity_error"))
