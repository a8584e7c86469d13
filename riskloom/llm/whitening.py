"""Whitening of embeddings; the covariance comes from variances alone (polarisation).

1. Every entry becomes an integer, ``floor(SCALE * c) + SHIFT``. Each distinct integer vector is one row of the fit list,
   so copies, however many, count once. The list is made by a partial aggregate and a shuffle of distinct vectors.
2. A first pass sums each dimension exactly. A second one centres every entry by its dimension's mean, rounded down to an
   integer, and sums the exact squares of each centred dimension and of each sum of two centred dimensions.
3. What rounding left over is known exactly, so the driver gets from these ``d (d + 1) / 2`` numbers the exact sums of
   ``(n x_i - S_i)**2`` and ``(n (x_i + x_j) - (S_i + S_j))**2``. The difference of the variance of a sum and those of its
   parts is twice their covariance. Only then is anything rounded: the matrix goes to ``eigh`` in double precision.
4. A last pass projects the centred vectors on the leading components and divides by the root of their variance.
   ``identity_error`` is measured on the fit list's whitened vectors.

No task holds more than a batch, and tasks send sums only: their number grows with the dimensions, not with the rows.

Defined cases: vectors that are null, empty or hold null or non-finite entries are left out, and so are those of another
length than most have (ties: the longer). Entries beyond ``LIMIT`` / SCALE count as ``LIMIT``. A ``deviation`` beyond a long
is null. Components whose variance is not above rounding have a null ``whitened``, and do not count for ``identity_error``;
without any variance ``explained`` is null as well. A null id stays; repeated rows each give theirs; an empty table gives no
rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
LIMIT = 2**62
COMPONENTS = 16
BLOCK = 1024
LIMB = 62


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & finite, F.lit(False))


def integers(vec: Column) -> Column:
    """``floor(SCALE * c) + SHIFT`` of every entry."""
    bound = F.lit(float(LIMIT))
    return F.transform(vec, lambda c: F.floor(F.greatest(F.least(c * F.lit(float(SCALE)), bound), -bound)) + F.lit(SHIFT).cast("long"))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def blocks(batches: Iterator[pa.RecordBatch], column: int, dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield matrix(batch.column(column).slice(at, BLOCK), dim)


def centred(x: np.ndarray, floor: list[int]) -> np.ndarray:
    """``x`` less its dimensions' rounded means; Python integers where a long does not hold the squares of sums."""
    wide = x.astype(object) - np.array(floor, object)
    if max(abs(int(wide.max())), abs(int(wide.min()))) >= 2**25:
        return wide
    return wide.astype(np.int64)


def _sums(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = [0] * dim, 0
        for x in blocks(batches, 0, dim):
            rows += len(x)
            high, low = (x >> np.int64(31)).sum(0).tolist(), (x & np.int64(2**31 - 1)).sum(0).tolist()
            total = [t + (h << 31) + m for t, h, m in zip(total, high, low, strict=True)]
        yield _numbers([(-1, -1, rows), *((i, i, t) for i, t in enumerate(total))])
    return run


def _numbers(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    """Rows of whole numbers of any size, as two parts."""
    i, j, value = zip(*rows, strict=True)
    parts = [[Decimal(v >> LIMB) for v in value], [Decimal(v & (1 << LIMB) - 1) for v in value]]
    return pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(p, pa.decimal128(38)) for p in parts)],
                           names=["i", "j", "high", "low"])


NUMBERS = "i int, j int, high decimal(38,0), low decimal(38,0)"


def _collected(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Sums over the tasks; one number for each (i, j)."""
    rows = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(r["i"], r["j"]): (int(r["high"]) << LIMB) + int(r["low"]) for r in rows}


def square_sums(y: np.ndarray) -> np.ndarray:
    """Sums of squares of each column (on the diagonal) and of each sum of two columns (above it)."""
    dim = y.shape[1]
    out = np.zeros((dim, dim), y.dtype)
    for i in range(dim):
        out[i, i] = (y[:, i] * y[:, i]).sum()
        both = y[:, i + 1:] + y[:, i:i + 1]
        out[i, i + 1:] = (both * both).sum(0)
    return out


def _squares(dim: int, floor: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object)
        for x in blocks(batches, 0, dim):
            total += square_sums(centred(x, floor)).astype(object)
        yield _numbers([(i, j, int(total[i, j])) for i in range(dim) for j in range(i, dim)])
    return run


@dataclass
class Whitening:
    """What the fit list says: ``n``, the sums as ``n * floor + rest``, and the components with their variances."""

    n: int
    floor: list[int]
    rest: list[int]
    values: np.ndarray
    explained: np.ndarray
    basis: np.ndarray

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n x - S)**2`` over the dimensions."""
        y = centred(x, self.floor)
        if y.dtype != object and x.shape[1] * (self.n * (int(np.abs(y).max()) + 1)) ** 2 < 2**63:
            off = y * np.int64(self.n) - np.array(self.rest, np.int64)
            return (off * off).sum(1).tolist()
        off = y.astype(object) * self.n - np.array(self.rest, object)
        return [v if v < 2**63 else None for v in (off * off).sum(1).tolist()]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values, (rows, components); NaN for components without variance."""
        y = centred(x, self.floor).astype(np.float64) - np.array([r / self.n for r in self.rest])
        root = np.sqrt(self.values)
        return np.where(root > 0, (y @ self.basis) / np.where(root > 0, root, 1), np.nan)


def covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix, from exact variances of dimensions and of their sums."""
    dim = len(rest)
    one = [n * n * squares[i, i] - n * rest[i] ** 2 for i in range(dim)]
    out = np.zeros((dim, dim))
    for i in range(dim):
        out[i, i] = one[i] / n**3
        for j in range(i + 1, dim):
            both = n * n * squares[i, j] - n * (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = ((both - one[i] - one[j]) // 2) / n**3
    return out


def _components(cov: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    noise = len(values) * np.finfo(float).eps * max(values[0], 0)
    trace = np.trace(cov)
    explained = np.maximum(values, 0) / trace if trace > 0 else np.full(len(values), np.nan)
    return np.where(values > noise, values, 0)[:count], explained[:count], basis[:, :count]


def fit(lists: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """Fits on distinct integer vectors (``x``) of length ``dim``."""
    sums = _collected(lists.mapInArrow(_sums(dim), NUMBERS))
    n = sums[-1, -1]
    total = [sums[i, i] for i in range(dim)]
    floor = [s // n for s in total]
    rest = [s % n for s in total]
    squares = _collected(lists.mapInArrow(_squares(dim, floor), NUMBERS))
    return Whitening(n, floor, rest, *_components(covariance(n, rest, squares), min(components, dim)))


def _products(model: Whitening, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.flatnonzero(model.values > 0)
        second, first = np.zeros((len(used), len(used))), np.zeros(len(used))
        for x in blocks(batches, 0, dim):
            w = model.project(x)[:, used]
            second += w.T @ w
            first += w.sum(0)
        i, j = np.triu_indices(len(used))
        yield pa.record_batch([pa.array(np.append(i, np.arange(len(used))).astype(np.int32)),
                               pa.array(np.append(j, np.full(len(used), -1)).astype(np.int32)),
                               pa.array(np.append(second[i, j], first))], names=["i", "j", "value"])
    return run


def identity_error(lists: DataFrame, model: Whitening, dim: int) -> float | None:
    """Largest entry of the whitened fit list's covariance less the identity. The vectors are centred before they are
    multiplied; the mean that rounding leaves is taken off as well."""
    parts = lists.mapInArrow(_products(model, dim), "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    found = {(r["i"], r["j"]): r["value"] / model.n for r in parts.collect()}
    return max((abs(v - found[i, -1] * found[j, -1] - (i == j)) for (i, j), v in found.items() if j >= 0), default=None)


def _whitener(model: Whitening, dim: int, error: float | None):
    count = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x, rows = matrix(part.column(1), dim), part.num_rows
                row = np.repeat(np.arange(rows), count)
                yield pa.record_batch([
                    part.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, model.n)), pa.array(model.deviations(x), pa.int64()).take(pa.array(row)),
                    pa.array(model.project(x).reshape(-1), from_pandas=True),
                    pa.array(np.tile(model.explained, rows), from_pandas=True), pa.array([error] * (rows * count), pa.float64())],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per usable row and component: id, component, n, deviation, whitened, explained and identity_error."""
    kind = vectors.schema[id_col].dataType
    shape = T.StructType([T.StructField("id", kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                          T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                          T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), vec.alias("vec")).where(usable(F.col("vec"))).select("id", integers(F.col("vec")).alias("x"))
    length = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).head()
    if length is None:
        return vectors.sparkSession.createDataFrame([], shape).withColumnRenamed("id", id_col)
    dim = length["dim"]
    rows = rows.where(F.size("x") == dim)
    lists = stored(rows.select("x").distinct(), "fit-list")
    model = fit(lists, dim, components)
    out = rows.mapInArrow(_whitener(model, dim, identity_error(lists, model, dim)), shape)
    return out.withColumnRenamed("id", id_col)
