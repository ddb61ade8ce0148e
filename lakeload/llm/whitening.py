"""Vectors projected on the leading components of their covariance, each scaled to unit variance.

Entries are whole numbers of a stated step, and the covariance is over the distinct vectors. These
are stored once, as blocks of matrices in as few bytes as their entries need. The leading
eigenvectors come from Chebyshev-filtered subspace iteration: each pass over the blocks multiplies
their centred covariance with a narrow matrix of vectors, a recurrence of such products is a
polynomial of the covariance that is small over the unwanted part of its spectrum, and after each
few passes QR and a Rayleigh-Ritz step give the best eigenvectors so far. It ends when their
residuals certify them. Only matrices of that width leave the tasks, and they are summed by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from lakeload.llm.storage import stored
from lakeload.names import column

#: Entries are counted in steps of this size.
STEP = 1 / 256
#: Vectors iterated on beside the wanted ones. More make the wanted ones stand out sooner.
GUARD = 28
#: Products in a row between two Rayleigh-Ritz steps.
DEGREE = 8
#: Residuals, in parts of the largest eigenvalue, that certify the wanted pairs.
TOLERANCE = 1e-13
#: Rayleigh-Ritz steps after which the number of vectors doubles; all dimensions need none.
PATIENCE = 12

_BLOCK_BYTES = 1 << 20
_WIDTHS = (1, 2, 4, 8)


def whiten(
    rows: DataFrame,
    *,
    components: int = 4,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    step: float = STEP,
) -> DataFrame:
    """Each usable row's place on the leading components of the vectors' covariance.

    A vector is used if it is not null, nor any entry null or not finite, and if it is as long as
    most distinct ones are (of equally many, as the longest). Its entries c become whole numbers
    x = floor(c / step), at most 2**63 - 1 either way. With the ``n`` distinct x, their sums S and
    their covariance V (divisor n), the result has for each such row and each of the first
    ``components`` unit eigenvectors of V, by falling eigenvalue e: the ``vec_id`` column,
    ``component`` (from 1), ``n``, ``deviation`` (sum of (n x - S)^2, exact; null beyond a long),
    ``whitened`` ((x - S / n) on the eigenvector, over sqrt(e)), ``explained`` (e over V's trace)
    and ``identity_error`` (the largest entry of whitened's covariance minus the identity).

    An eigenvector's sign, and the choice among eigenvectors of equal e, are arbitrary but the same
    for all rows. Where V has no variance left, ``whitened`` is null; without any, so are
    ``explained`` and ``identity_error``. There are no more components than dimensions. Repeated
    rows all appear; other columns are not kept; without usable rows the result is empty.
    """
    spark = rows.sparkSession
    given = rows.select(column(vec_id), column(vector).cast("array<double>"))
    schema = StructType(
        [
            StructField(vec_id, rows.schema[vec_id].dataType),
            StructField("component", IntegerType()),
            StructField("n", LongType()),
            StructField("deviation", LongType()),
            StructField("whitened", DoubleType()),
            StructField("explained", DoubleType()),
            StructField("identity_error", DoubleType()),
        ]
    )
    fit = _fit(spark, given, components, step)
    if fit is None:
        return spark.createDataFrame([], schema)
    known = spark.sparkContext.broadcast(fit)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _placed(batch, known.value, step, schema.names)

    return given.mapInArrow(placed, schema)


@dataclass(frozen=True)
class Fit:
    """The components of a table."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one a column
    trace: float
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scaled(self) -> np.ndarray:
        """What projects on the components that have variance and scales them."""
        some = self.values > len(self.sums) * np.finfo(float).eps * self.trace
        return self.vectors[:, some] / np.sqrt(self.values[some])


def _fit(spark: SparkSession, given: DataFrame, components: int, step: float) -> Fit | None:
    """The components of the distinct vectors."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _usable(batch.column(1), step):
                yield pa.RecordBatch.from_arrays([_packed(x)], ["x"])

    distinct = given.mapInArrow(packed, "x binary").distinct()
    fields = "dimensions int, n bigint, width int, data binary"
    blocks = stored(distinct.mapInArrow(_blocks, fields), "vectors")
    sizes = blocks.groupBy("dimensions").agg(F.sum("n").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("dimensions")).first()
    if most is None:
        return None
    blocks = blocks.filter(F.col("dimensions") == most.dimensions)
    covariance = Covariance(blocks, most.dimensions, most.n)
    values, vectors = leading(covariance, components)
    fit = Fit(most.n, covariance.sums, values, vectors, covariance.trace)
    scaled = fit.scaled
    if not scaled.shape[1]:
        return fit
    whitened = covariance.of_projections(scaled)
    error = float(np.abs(whitened - np.eye(len(whitened))).max())
    return Fit(fit.n, fit.sums, fit.values, fit.vectors, fit.trace, error)


def _usable(vectors: pa.Array, step: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their whole numbers as a matrix, for each length of vectors."""
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        flat = vectors.take(pa.array(rows)).flatten()
        entries = flat.to_numpy(zero_copy_only=False).reshape(len(rows), length)
        good = np.isfinite(entries).all(axis=1)  # a null is nan here
        with np.errstate(over="ignore"):
            x = np.floor(entries[good] / step)
        over = np.abs(x) >= 2.0**63
        whole = np.where(over, 0, x).astype(np.int64)
        whole[over] = np.where(x[over] > 0, 2**63 - 1, -(2**63 - 1))
        if len(whole):
            yield rows[good], whole


def _packed(x: np.ndarray) -> pa.Array:
    """Rows as bytes: the width of an entry, the least that holds all of the row's, and the entries."""
    most, dimensions = np.abs(x).max(axis=1), x.shape[1]
    out = np.empty(len(x), object)
    least = 0
    for width in _WIDTHS:
        bound = 2 ** (8 * width - 1) - 1
        rows = np.flatnonzero((most >= least) & (most <= bound))
        data, size = x[rows].astype(f"<i{width}").tobytes(), width * dimensions
        head = bytes([width])
        out[rows] = [head + data[k * size : (k + 1) * size] for k in range(len(rows))]
        least = bound + 1
    return pa.array(out, pa.binary())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the same length and width put together."""
    gathered: dict[tuple[int, int], list[bytes]] = {}
    for batch in batches:
        for value in batch.column(0):
            data = value.as_py()
            key = (len(data), data[0])
            rows = gathered.setdefault(key, [])
            rows.append(data[1:])
            if len(rows) * len(data) >= _BLOCK_BYTES:
                yield _block(*key, gathered.pop(key))
    for key, rows in gathered.items():
        yield _block(*key, rows)


def _block(size: int, width: int, rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([(size - 1) // width], pa.int32()),
            pa.array([len(rows)], pa.int64()),
            pa.array([width], pa.int32()),
            pa.array([b"".join(rows)], pa.binary()),
        ],
        ["dimensions", "n", "width", "data"],
    )


class Covariance:
    """The covariance of stored vectors, known by its products."""

    def __init__(self, blocks: DataFrame, dimensions: int, n: int) -> None:
        self.blocks = blocks.select("width", "data")
        self.dimensions = dimensions
        self.n = n
        self.sums = self._sums()
        self.mean = np.array([s / n for s in self.sums])
        self.passes = 0
        self.trace = float(self._summed(lambda x: np.square(x).sum(keepdims=True), None, (1,))[0]) / n

    def __matmul__(self, vectors: np.ndarray) -> np.ndarray:
        """One pass: the covariance times some columns."""
        shape = (self.dimensions, vectors.shape[1])
        return self._summed(lambda x, q: x.T @ (x @ q), vectors, shape) / self.n

    def of_projections(self, vectors: np.ndarray) -> np.ndarray:
        """One pass: the covariance of the vectors' projections on some columns."""
        k = vectors.shape[1]

        def moments(x, q):
            y = x @ q
            return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

        found = self._summed(moments, vectors, (k * k + k,)) / self.n
        return found[: k * k].reshape(k, k) - np.outer(found[k * k :], found[k * k :])

    def _sums(self) -> tuple[int, ...]:
        """Exact sums of each entry."""
        dimensions = self.dimensions

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [0] * dimensions
            for x in _matrices(batches, dimensions):
                # Halves of 32 bits, so that no sum of a block leaves a long.
                high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
                sums = [s + (h << 32) + v for s, h, v in zip(sums, high, low, strict=True)]
            values = pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(dimensions), pa.int32()), values], ["at", "s"])

        parts = self.blocks.mapInArrow(total, "at int, s decimal(38,0)")
        found = parts.groupBy("at").agg(F.sum("s").alias("s")).collect()
        return tuple(int(s) for _, s in sorted((row["at"], row.s) for row in found))

    def _summed(self, work, vectors: np.ndarray | None, shape: tuple[int, ...]) -> np.ndarray:
        """The sum of ``work`` over all blocks, centred: added up in tasks, then cell by cell."""
        told = self.blocks.sparkSession.sparkContext.broadcast((self.mean, vectors))
        dimensions, cells = self.dimensions, int(np.prod(shape))

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mean, q = told.value
            total = np.zeros(cells)
            for x in _matrices(batches, dimensions):
                centred = x - mean
                total += (work(centred) if q is None else work(centred, q)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["part"])

        parts = self.blocks.mapInArrow(part, "part array<double>")
        each = parts.select(F.posexplode("part").alias("at", "v"))
        found = each.groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(cells)
        out[found["at"].to_numpy()] = found["v"].to_numpy()
        told.destroy()
        self.passes += 1
        return out.reshape(shape)


def _matrices(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for width, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield np.frombuffer(data.as_buffer(), f"<i{width}").astype(np.int64).reshape(-1, dimensions)


def leading(
    matrix, components: int, *, guard: int = GUARD, degree: int = DEGREE, tolerance: float = TOLERANCE
) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues, falling, and unit eigenvectors of a positive semidefinite matrix
    that is known by ``matrix @ columns`` and ``matrix.dimensions``.

    With as many vectors as dimensions one product is exact. With fewer, the filter damps what lies
    below the least Ritz value, down to half of the least seen so far; should there be
    something lower, the filter lets it grow, so that the next step sees it. Where eigenvalues lie
    so close that this does not get on, the number of vectors doubles.
    """
    size = matrix.dimensions
    wanted = min(components, size)
    chance = np.random.default_rng(64)
    width = min(size, wanted + guard)
    q = np.linalg.qr(chance.standard_normal((size, width)))[0] if width < size else np.eye(size)
    low = np.inf
    steps = 0
    while True:
        product = matrix @ q
        ritz = q.T @ product
        values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        residuals = np.linalg.norm(product - q * values, axis=0)[:wanted]
        if width == size or residuals.max() <= tolerance * values[0]:
            return np.maximum(values[:wanted], 0), q[:, :wanted]
        steps += 1
        if steps % PATIENCE == 0:
            width = min(size, 2 * width)
            more = chance.standard_normal((size, width - q.shape[1]))
            q = np.linalg.qr(np.concatenate([q, more], axis=1))[0] if width < size else np.eye(size)
            continue
        low = min(low, max(values[-1], 0) / 2)
        q = np.linalg.qr(_filtered(matrix, q, product, values, low, degree))[0]


def _filtered(
    matrix, q: np.ndarray, product: np.ndarray, values: np.ndarray, low: float, degree: int
) -> np.ndarray:
    """A Chebyshev polynomial of the matrix times ``q``: small from ``low`` to the last of
    ``values``, scaled to 1 at the first. ``product`` is the matrix times ``q``."""
    half, centre = (values[-1] - low) / 2, (values[-1] + low) / 2
    if half <= 0:
        return product
    first = half / (values[0] - centre)
    scale = first
    before, now = q, (product - centre * q) * (first / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        new = (matrix @ now - centre * now) * (2 * after / half) - before * (scale * after)
        before, now, scale = now, new, after
    return now


def _placed(batch: pa.RecordBatch, fit: Fit, step: float, names: list[str]) -> pa.RecordBatch:
    """The rows of the result for some rows of the table."""
    rows, x = np.empty(0, np.int64), np.empty((0, len(fit.sums)), np.int64)
    for found, matrix in _usable(batch.column(1), step):
        if matrix.shape[1] == len(fit.sums):
            rows, x = found, matrix
    k, scaled = len(fit.values), fit.scaled
    whitened = np.full((len(rows), k), np.nan)
    whitened[:, : scaled.shape[1]] = (x - fit.mean) @ scaled
    explained = fit.values / fit.trace if fit.trace > 0 else np.full(k, np.nan)
    deviation = pa.array(_deviations(x, fit), pa.int64())
    again = pa.array(np.repeat(np.arange(len(rows)), k))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(pa.array(rows)).take(again),
            pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
            pa.array(np.full(k * len(rows), fit.n), pa.int64()),
            deviation.take(again),
            pa.array(whitened.ravel(), pa.float64(), from_pandas=True),
            pa.array(np.tile(explained, len(rows)), pa.float64(), from_pandas=True),
            pa.array([fit.identity_error] * (k * len(rows)), pa.float64()),
        ],
        names,
    )


def _deviations(x: np.ndarray, fit: Fit) -> list[int | None]:
    """The exact sum of (n x - S)^2 of each row; None beyond a long."""
    if not len(x):
        return []
    far = max(int(np.abs(x).max()) * fit.n + max(map(abs, fit.sums)), 1)
    if far * far * len(fit.sums) < 2**63:
        away = x * fit.n - np.array(fit.sums, np.int64)
        return np.square(away).sum(axis=1).tolist()
    sums = np.array(fit.sums, object)
    return [total if total < 2**63 else None for total in ((x.astype(object) * fit.n - sums) ** 2).sum(axis=1)]
