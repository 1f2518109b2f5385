"""Whitening of embeddings by polarisation covariance.

An entry c of a vector becomes the whole number x = floor(1024 * c) + 100000. The centred value n * x - S of a dimension
(n vectors, S the dimension's sum) is a whole number too. Only squares are aggregated: of the centred values of every
dimension, and of the sums of every pair of dimensions. Differences of those give all products, as
2ab = (a + b)^2 - a^2 - b^2, and with them the covariance, exactly, before the one division. A centred value is taken in
two parts, n * y + r: y = x less the whole part of the mean, small, differs by row, and r is one number of a dimension.
So tasks square and add small whole numbers, and parts are put together in whole numbers of any size on the driver,
which holds dims * (dims + 1) / 2 of them and no more, however many vectors there are.

Defined cases. A vector that is null or holds a null or an entry that is not finite is dropped. Entries that a shorter
vector lacks count as 0; without any entry at all there are no rows. 1024 * c is held within 2^52. Rows with a null
vec_id or a repeated one are rows like others. Components of no variance (all vectors equal, fewer vectors than
components) have explained 0 and whitened null, and take no part in identity_error, which is null if none is left.
deviation is null where it exceeds 38 digits. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Steps of an entry's unit, what is added, the bound of either side.
STEPS, ADDED, MOST = 1024, 100_000, float(1 << 52)
#: Whole numbers below this can be squared, paired and added up over ROWS rows within 63 bits.
SMALL, ROWS = 1 << 20, 1 << 18
#: Variance below this share of the largest is that of rounding: whole numbers of no variance give exactly 0.
LEAST = 1e-13


def whole(embedding: Column) -> Column:
    """x of each entry as a long; null if the vector takes no part."""
    good = F.forall(embedding, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    held = lambda c: F.greatest(F.least(F.floor(c.cast("double") * STEPS).cast("double"), F.lit(MOST)), F.lit(-MOST)).cast("long") + ADDED
    return F.when(good, F.transform(embedding, held))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a list column as rows; what is missing counts as an entry of 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if (sizes == dims).all():
        return flat.reshape(len(column), dims)
    out = np.full((len(column), dims), ADDED, dtype=np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(flat.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """dim, n, total: the task's vectors and the sum of each dimension, in whole numbers of any size."""
    n, total = 0, [0] * dims
    for batch in batches:
        x = matrix(batch.column(0), dims)
        n += len(x)
        high, low = np.divmod(x, 1 << 26)
        total = [t + (int(a) << 26) + int(b) for t, a, b in zip(total, high.sum(axis=0), low.sum(axis=0), strict=True)]
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["dim", "n", "total"])


def squares(y: np.ndarray) -> list[tuple[int, int]]:
    """Of every dimension and then of every pair's sum (i < j, in order): the sum, and the sum of squares; exact."""
    dims = y.shape[1]
    if y.size and int(np.abs(y).max()) >= SMALL:
        y = y.astype(object)  # whole numbers of any size
    out = [(int(y[:, i].sum()), int((y[:, i] * y[:, i]).sum())) for i in range(dims)]
    for i in range(dims - 1):
        both = y[:, i : i + 1] + y[:, i + 1 :]
        out += zip(map(int, both.sum(axis=0)), map(int, (both * both).sum(axis=0)), strict=True)
    return out


def _squares(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """at, total, square: sums over the task's vectors, at counts dimensions and then their pairs."""
    sums: list[tuple[int, int]] = []
    for batch in batches:
        y = matrix(batch.column(0), centre.size) - centre
        for a in range(0, len(y), ROWS):
            some = squares(y[a : a + ROWS])
            sums = [(p + q, r + s) for (p, r), (q, s) in zip(sums, some, strict=True)] if sums else some
    if sums:
        big = lambda k: pa.array([Decimal(s[k]) for s in sums], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), big(0), big(1)], names=["at", "total", "square"])


@dataclass(frozen=True)
class Whitening:
    """n, per dimension the whole part of the mean (centre) and rest (S - n * centre), the components with a variance, as columns, and all variances and their total."""

    n: int
    centre: np.ndarray
    rest: tuple[int, ...]
    axes: np.ndarray
    variances: np.ndarray
    total: float

    @property
    def shares(self) -> list[float]:
        return [float(e / self.total) if self.total > 0 else 0.0 for e in self.variances]


def covariance(n: int, rest: list[int], sums: list[tuple[int, int]]) -> tuple[list[list[int]], np.ndarray]:
    """The sums of products of centred values (n * x - S), whole numbers; and the covariance of x, divisor n."""
    dims = len(rest)
    # n * y - r squared, for y of a dimension or of a pair's sum, whose r is the sum of both.
    full = lambda r, total, square: n * n * square - 2 * n * r * total + n * r * r
    own = [full(rest[i], *sums[i]) for i in range(dims)]
    products = [[own[i] if i == j else 0 for j in range(dims)] for i in range(dims)]
    at = dims
    for i in range(dims):
        for j in range(i + 1, dims):
            products[i][j] = products[j][i] = (full(rest[i] + rest[j], *sums[at]) - own[i] - own[j]) // 2
            at += 1
    return products, np.array([[p / n**3 for p in row] for row in products])


def fit(rows: DataFrame, components: int) -> Whitening | None:
    """The whitening of rows (x: arrays of whole numbers); None without rows or entries."""
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return None
    found = rows.select("x").mapInArrow(lambda b: _sums(b, dims), "dim int, n long, total decimal(38,0)").groupBy("dim").agg(F.sum("n"), F.sum("total")).toPandas().sort_values("dim")
    n, total = int(found.iloc[0, 1]), [int(t) for t in found.iloc[:, 2]]
    centre = [t // n for t in total]
    rest = [t - n * c for t, c in zip(total, centre, strict=True)]
    held = np.array(centre, dtype=np.int64)
    squared = rows.select("x").mapInArrow(lambda b: _squares(b, held), "at int, total decimal(38,0), square decimal(38,0)").groupBy("at").agg(F.sum("total"), F.sum("square")).toPandas().sort_values("at")
    _, v = covariance(n, rest, [(int(a), int(b)) for a, b in zip(squared.iloc[:, 1], squared.iloc[:, 2], strict=True)])
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    values[values <= LEAST * max(values.max(initial=0.0), 0.0)] = 0.0
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)  # the largest entry is positive
    return Whitening(n, held, tuple(rest), vectors[:, values > 0], values, float(np.trace(v)))


def _whitened(batches: Iterator[pa.RecordBatch], w: Whitening) -> Iterator[pa.RecordBatch]:
    """The batch's first column, the deviation and the whitened components."""
    rest = np.array(w.rest, dtype=object)
    part = np.array([r / w.n for r in w.rest])
    scale = np.sqrt(w.variances[w.variances > 0])
    constant = int((rest * rest).sum())
    for batch in batches:
        y = matrix(batch.column(1), w.centre.size) - w.centre
        exact = y if not y.size or (int(np.abs(y).max()) < SMALL and w.n < 1 << 31) else y.astype(object)
        square, cross = (exact * exact).sum(axis=1), (exact * np.array(w.rest, dtype=exact.dtype)).sum(axis=1)
        deviation = [w.n * w.n * int(s) - 2 * w.n * int(c) + constant for s, c in zip(square, cross, strict=True)]
        values = (y - part) @ w.axes / scale
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * scale.size, pa.int32()), pa.array(values.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([Decimal(d) if d < 10**38 else None for d in deviation], pa.decimal128(38, 0)), lists], names=[batch.schema.names[0], "deviation", "whitened"])


def identity_error(table: DataFrame, k: int) -> Column | None:
    """One row, error: the largest absolute entry of the covariance of whitened's k components, less the identity."""
    if not k:
        return table.sparkSession.range(1).select(F.lit(None).cast("double").alias("error"))
    entry = lambda i, j: F.abs(F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))) - F.lit(float(i == j)))
    return table.agg(F.array_max(F.array(*[entry(i, j) for i in range(k) for j in range(i, k)])).alias("error"))


def whiten(vectors: DataFrame, components: int = 8, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error of every vector that takes part."""
    out = f"{id_column} {vectors.schema[id_column].dataType.simpleString()}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = vectors.select(id_column, whole(F.col(column)).alias("x")).where("x is not null")
    w = fit(rows, components)
    if w is None:
        return vectors.sparkSession.createDataFrame([], out)
    kind = vectors.schema[id_column].dataType.simpleString()
    table = written(rows.mapInArrow(lambda b: _whitened(b, w), f"{id_column} {kind}, deviation decimal(38,0), whitened array<double>"))
    error = identity_error(table, w.axes.shape[1])
    shares = F.array(*map(F.lit, w.shares))
    each = F.explode(F.arrays_zip(F.sequence(F.lit(1), F.lit(len(w.shares))).alias("component"), shares.alias("explained"))).alias("c")
    # One row, so its broadcast is bounded.
    done = table.select(id_column, "deviation", "whitened", each).join(F.broadcast(error))
    return done.select(id_column, F.col("c.component").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", F.get("whitened", F.col("c.component") - 1).alias("whitened"), F.col("c.explained").alias("explained"), F.col("error").alias("identity_error"))
