"""Whitening of embeddings with exact cross-products from bit-sliced words.

Every component c becomes the whole number floor(256 * c). The fit list holds each distinct vector once. Tasks shift each dimension
by its minimum, so that numbers are not negative, and pack every bit of it across rows into words of 64: a plane. The
cross-product of two dimensions is the sum over their planes of 2**(a + b) times the number of ones in the AND of both. A last dimension of
ones gives the sums and the number of rows by the same rule. Products are kept in 32-bit limbs, so nothing is rounded whatever the numbers
are, and a task's result is one row per pair of dimensions, which Spark adds up.

The driver gets those d * (d + 1) / 2 sums, whatever the number of rows; ``max_dims`` bounds d. There the covariance is centred in whole
numbers, n * G - S * S, before anything becomes a float. ``eigh`` finds the components, and Jacobi rotations in extended precision
refine them, so that small eigenvalues next to large ones keep their digits.

Defined results: rows whose vector is null or holds null, NaN or infinite components are left out; rows with a null id stay. Numbers beyond a
long become the nearest double that fits one. Shorter vectors are filled with zeros to the longest. Repeated rows are whitened each and fitted
once. ``whitened`` and ``explained`` are 0 for components without variance (a single vector, constant or dependent dimensions),
which ``identity_error`` leaves out. A deviation that no long can hold becomes the largest long. The sign of a component makes its largest entry positive.
There are as many components as dimensions, ``components`` at most; without any, or for an empty table, there are no rows. Other columns aren't used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.shared import Tables

_LIMB = 32
#: The ends of a long as doubles: the lowest one, and the largest double below 2**63.
_LOW, _HIGH = -(2.0**63), 9223372036854774784.0
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, x: the vectors that take part, as whole numbers."""
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * 256, F.lit(_LOW)), F.lit(_HIGH))).cast("long"))
    return given.where(finite).select("vec_id", scaled.alias("x"))


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list column as a matrix of longs, filled with zeros to ``dims`` columns."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def planes(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes of the shifted columns, dimension by dimension from the lowest bit, then the plane of ones: (planes, words)."""
    rows, words = len(x), -(-len(x) // 64)
    shifted = x.view(np.uint64) - low.view(np.uint64)  # wraps to the true difference, which fits 64 bits
    out = np.zeros((int(bits.sum()) + 1, words * 8), np.uint8)
    at = 0
    for i, n in enumerate(bits):
        for a in range(n):
            packed = np.packbits((shifted[:, i] >> np.uint64(a)) & np.uint64(1) != 0)
            out[at, : len(packed)] = packed
            at += 1
    ones = np.packbits(np.ones(rows, bool))
    out[at, : len(ones)] = ones
    return out.view(np.uint64)


def carried(limbs: np.ndarray) -> np.ndarray:
    """Limbs of 32 bits again: what is above goes to the next one."""
    for k in range(len(limbs) - 1):
        limbs[k + 1] += limbs[k] >> _LIMB
        limbs[k] &= (1 << _LIMB) - 1
    return limbs


def scatter(p: np.ndarray, bits: np.ndarray, limbs: np.ndarray) -> None:
    """Add the cross-products of all pairs i <= j of the shifted columns and the ones to ``limbs`` (limb, i, j)."""
    width = np.append(bits, 1)
    starts = np.cumsum(width) - width
    weight = np.concatenate([np.arange(w) for w in width])
    for i, n in enumerate(width):
        live = [j for j in range(i, len(width)) if width[j]]
        cuts = starts[live] - starts[i]
        for a in range(n):
            ones = np.bitwise_count(p[starts[i] + a] & p[starts[i] :]).sum(axis=1, dtype=np.int64)
            shift = weight[starts[i] :] + a
            for limb in np.unique(shift // _LIMB):
                part = np.where(shift // _LIMB == limb, ones << (shift % _LIMB), 0)
                limbs[limb, i, live] += np.add.reduceat(part, cuts)
    carried(limbs)


def sums_in_task(dims: int, low: np.ndarray, bits: np.ndarray, block_rows: int):
    n_limbs = int(2 * bits.max(initial=1) + 64) // _LIMB + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limbs = np.zeros((n_limbs, dims + 1, dims + 1), np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(matrix(batch.column(0), dims))
            if sum(map(len, held)) >= block_rows:
                scatter(planes(np.concatenate(held), low, bits), bits, limbs)
                held = []
        if held and sum(map(len, held)):
            scatter(planes(np.concatenate(held), low, bits), bits, limbs)
        i, j = np.triu_indices(dims + 1)
        if limbs.any():
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(x[i, j], pa.int64()) for x in limbs]], ["i", "j", *[f"g{k}" for k in range(n_limbs)]])

    return run, n_limbs


def ranges_in_task(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0), dims)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(low), pa.array(high)], ["i", "low", "high"])

    return run


def refined(v: np.ndarray, vectors: np.ndarray, sweeps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of ``v`` by cyclic Jacobi rotations in extended precision, from ``eigh``'s vectors on."""
    q = _orthonormal(vectors.astype(np.longdouble))
    a = q.T @ v @ q
    a = (a + a.T) / 2
    small = np.finfo(np.longdouble).eps
    for _ in range(sweeps):
        d = np.abs(np.diag(a))
        off = np.abs(np.triu(a, 1))
        pairs = np.argwhere(off > small * np.sqrt(np.outer(d, d)) + np.finfo(np.longdouble).tiny)
        pairs = [(i, j) for i, j in pairs if off[i, j] > small * small * d.max()]
        if not pairs:
            break
        for i, j in pairs:
            if a[i, j] == 0:
                continue
            t = (a[j, j] - a[i, i]) / (2 * a[i, j])
            t = (1 if t >= 0 else -1) / (abs(t) + np.sqrt(t * t + 1))
            c = 1 / np.sqrt(t * t + 1)
            turn = np.array([[c, t * c], [-t * c, c]])
            a[:, [i, j]] = a[:, [i, j]] @ turn
            a[[i, j]] = turn.T @ a[[i, j]]
            a[i, j] = a[j, i] = 0
            q[:, [i, j]] = q[:, [i, j]] @ turn
    return np.diag(a).copy(), q


def _orthonormal(q: np.ndarray) -> np.ndarray:
    """Gram-Schmidt in extended precision; the columns are orthonormal to double precision already."""
    q = q.copy()
    for i in range(q.shape[1]):
        for _ in range(2):
            q[:, i] -= q[:, :i] @ (q[:, :i].T @ q[:, i])
        q[:, i] /= np.sqrt(q[:, i] @ q[:, i])
    return q


def long_double(values: list[int]) -> np.ndarray:
    """Whole numbers of any size to extended precision: their leading 64 bits and a power of two."""
    out = np.empty(len(values), np.longdouble)
    for k, x in enumerate(values):
        drop = max(0, abs(x).bit_length() - 63)
        out[k] = np.ldexp(np.longdouble(np.int64((abs(x) >> drop) * (1 if x >= 0 else -1))), drop)
    return out


class Model:
    """Components of the covariance of n vectors with sums ``s`` and cross-products ``g`` (whole numbers, (i, j) for i <= j)."""

    def __init__(self, n: int, s: list[int], g: dict[tuple[int, int], int], components: int):
        dims = len(s)
        centred = [n * g[min(i, j), max(i, j)] - s[i] * s[j] for i in range(dims) for j in range(dims)]
        v = long_double(centred).reshape(dims, dims) / (np.longdouble(n) * np.longdouble(n))
        trace = np.trace(v)
        self.n, self.s = n, s
        unit = v / trace if trace > 0 else v
        values, vectors = refined(unit, np.linalg.eigh(unit.astype(float))[1])
        order = np.argsort(-values, kind="stable")[:components]
        if (values[order] < 1e-9).any():  # Jacobi from the matrix itself keeps small eigenvalues, which eigh's vectors would blur
            values, vectors = refined(unit, np.eye(dims))
            order = np.argsort(-values, kind="stable")[:components]
        vectors = vectors[:, order]
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(order))] < 0, -1, 1)
        # An eigenvalue that rounding can't tell from zero is zero: cancellation among the variances it is made of leaves nothing.
        live = values[order] > 8 * dims * np.finfo(np.longdouble).eps * (np.diag(unit) @ vectors**2)
        self.live = live
        self.explained = np.where(live, values[order], 0).astype(float)
        scale = np.where(live, np.sqrt(np.where(live, values[order], 1) * (trace if trace > 0 else 1)), 1)
        self.projection = np.where(live, vectors / scale, 0).astype(float)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: as longs where they can't overflow, else as whole numbers of any size."""
        if (int(np.abs(x.astype(float)).max(initial=0)) + 1) * self.n + max(map(abs, self.s), default=0) < 2**62:
            return x * np.int64(self.n) - np.array(self.s, np.int64)
        return x.astype(object) * self.n - np.array(self.s, object)

    def deviation(self, y: np.ndarray) -> np.ndarray:
        if y.dtype != object and float(np.abs(y.astype(float)).max(initial=0)) ** 2 * max(1, y.shape[1]) < 2.0**62:
            return (y * y).sum(1)
        y = y.astype(object)
        return np.array([min(int(d), 2**63 - 1) for d in (y * y).sum(1)], np.int64)

    def whiten(self, y: np.ndarray) -> np.ndarray:
        return (y.astype(float) / self.n) @ self.projection


def moments_in_task(model: Model, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.live)
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whiten(model.centred(matrix(batch.column(0), dims)))
            first += w.sum(0)
            second += w.T @ w
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.full(k, -1), i), pa.int32()), pa.array(np.append(np.arange(k), j), pa.int32()), pa.array(np.append(first, second))], ["i", "j", "s"])

    return run


def rows_in_task(model: Model, dims: int, identity_error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.live)
        for batch in batches:
            y = model.centred(matrix(batch.column(1), dims))
            rows = np.repeat(np.arange(len(y)), k)
            repeated = lambda v: pa.array(np.tile(v, len(y)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), repeated(np.arange(1, k + 1, dtype=np.int32)), pa.array(np.full(len(rows), model.n, np.int64)), pa.array(model.deviation(y)[rows]), pa.array(model.whiten(y).ravel()), repeated(model.explained), pa.array(np.full(len(rows), identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(embeddings: DataFrame, *, vector: str = "embedding", components: int = 4, block_rows: int = 65_536, max_dims: int = 2048) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    x = whole_numbers(embeddings, vector)
    tables = Tables(spark, "whitening")
    fit, seen = tables.keep(x.select("x").distinct(), dims=F.max(F.size("x")))
    dims = seen["dims"] or 0
    if not dims:
        tables.drop()
        return spark.createDataFrame([], WHITENED)
    if dims > max_dims:
        raise ValueError(f"a vector has {dims} dimensions; max_dims is {max_dims}")
    ranges = {r["i"]: (r["low"], r["high"]) for r in fit.mapInArrow(ranges_in_task(dims), "i int, low long, high long").groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()}
    low = np.array([ranges[i][0] for i in range(dims)], np.int64)
    bits = np.array([(ranges[i][1] - ranges[i][0]).bit_length() for i in range(dims)])
    task, n_limbs = sums_in_task(dims, low, bits, block_rows)
    limbs = [f"g{k}" for k in range(n_limbs)]
    summed = fit.mapInArrow(task, "i int, j int, " + ", ".join(f"{g} long" for g in limbs)).groupBy("i", "j").agg(*[F.sum(g).alias(g) for g in limbs])
    shifted = {(r["i"], r["j"]): sum(r[g] << (_LIMB * k) for k, g in enumerate(limbs)) for r in summed.collect()}
    n, m = shifted[dims, dims], [int(v) for v in low]
    sums = [shifted[i, dims] + n * m[i] for i in range(dims)]
    products = {(i, j): shifted[i, j] + m[i] * shifted[j, dims] + m[j] * shifted[i, dims] + n * m[i] * m[j] for i in range(dims) for j in range(i, dims)}
    model = Model(n, sums, products, components)
    found = fit.mapInArrow(moments_in_task(model, dims), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    k = len(model.live)
    first, second = np.zeros(k), np.zeros((k, k))
    for r in found:
        if r["i"] < 0:
            first[r["j"]] = r["s"] / n
        else:
            second[r["i"], r["j"]] = r["s"] / n
    error = np.abs(second - np.outer(first, first) - np.eye(k))[np.ix_(model.live, model.live)]
    tables.drop()
    return x.select("vec_id", "x").mapInArrow(rows_in_task(model, dims, float(error.max(initial=0.0))), WHITENED)
