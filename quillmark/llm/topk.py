"""Exact top-k inner products: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz residual bounds.

Vectors are ordered by descending length and cut into blocks of ``block_rows``; queries into blocks of ``query_rows``. The
right singular vectors of the data come from its d x d Gram matrix, which tasks sum up from their rows, so only d * d
numbers reach the driver. A rotation keeps inner products and moves most of the mass into the first coordinates.

Every query block meets every vector block by an equi-join on the grid of blocks. First the block of the longest vectors gives each query
a lower bound on its k-th best score. Then in any block a query is dropped when its length times the block's largest
length can't reach the bound, and a vector is dropped when the partial sum over the leading rotated coordinates plus the product of
the residual lengths can't. Whatever is left is scored exactly in whole numbers. A window per query merges the blocks' best.

Bounds are computed in floating point and compared with a margin far above rounding. Scores are exact: in floating point while the
lengths prove them below 2**53, and in whole numbers of any size for the vectors beyond that. A score that no long can hold is
returned as the nearest one; such scores rank by their doubles.

Defined results: vectors that are null or hold null, NaN or infinite components take no part, neither do null ids. Shorter vectors are filled
with zeros. Rows that repeat an id are vectors of their own as candidates, except for queries with that id; equal
query rows are asked once. Ties go to the smaller id. With fewer
than k other vectors all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.llm.shared import checkpointed

_MARGIN = 1e-6


def quantized(vectors: DataFrame, column: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): whole-numbered components, only of vectors that take part."""
    v = F.col(column).cast("array<double>")
    fine = v.isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: _floor(scale * x)).alias("v"))


def _floor(x: Column) -> Column:
    """Doubles from 2**53 on are whole already, and may be too large for the long that ``floor`` gives."""
    return F.when(F.abs(x) < float(2**53), F.floor(x).cast("double")).otherwise(x)


def _lengths(x: np.ndarray) -> np.ndarray:
    """Row lengths; scaled first, so that squares don't overflow."""
    most = np.abs(x).max(1, initial=1.0)
    with np.errstate(over="ignore"):
        return most * np.sqrt(((x / most[:, None]) ** 2).sum(1))


def exact_scores(x: np.ndarray, q: np.ndarray, longest: float) -> np.ndarray:
    """Inner products of whole-numbered rows with ``q``, as floats where they are exact and as Python's whole numbers beyond."""
    if longest < 2**53:
        return x @ q
    whole = [int(c) for c in q.tolist()]
    return np.array([sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in x.tolist()], object)


def _as_long(scores: np.ndarray) -> np.ndarray:
    return np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in scores], "int64") if scores.dtype == object else scores.astype("int64")


def _beyond(scores: np.ndarray) -> np.ndarray:
    """What ranks scores that no long can hold; zero for others."""
    most = 2**1000
    return np.array([0.0 if -(2**63) <= s < 2**63 else float(min(max(int(s), -most), most)) for s in scores]) if scores.dtype == object else np.zeros(len(scores))


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores, ties by id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], int)
    return np.lexsort((ids, -scores))[:k]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.diff(column.offsets.to_numpy())
    if (ends == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(ends), dims))
    at = 0
    for i, n in enumerate(ends):
        out[i, :n] = flat[at : at + n]
        at += n
    return out


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of the data, strongest first."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            x = x[_lengths(x) < 2**53]  # any rotation is right; huge vectors would only swamp the sums
            total += x.T @ x
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()), "g": pa.array(total.ravel())})

    out = np.zeros((dims, dims))
    for r in vectors.select("v").mapInArrow(gram, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        out[r["i"], r["j"]] = r["g"]
    return np.linalg.eigh(out)[1][:, ::-1].copy() if dims else out


def _blocks(rows: DataFrame, dims: int, size: int, order: list[Column]) -> DataFrame:
    """(block, ids, data): rows in their order, ``size`` to a block, packed as bytes; range partitioning deals them evenly."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, data, have = [], [], 0

        def block():
            i, x = np.concatenate(ids), np.concatenate(data)
            return [(i[a : a + size].tobytes(), x[a : a + size].tobytes(), float(_lengths(x[a : a + size]).max())) for a in range(0, len(i), size)]

        def out(blocks: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"ids": pa.array([b[0] for b in blocks], pa.binary()), "data": pa.array([b[1] for b in blocks], pa.binary()), "longest": pa.array([b[2] for b in blocks], pa.float64())})

        for batch in batches:
            if batch.num_rows:
                ids.append(batch.column(0).to_numpy())
                data.append(_matrix(batch.column(1), dims))
                have += batch.num_rows
            if have >= size:
                yield out(block())
                ids, data, have = [], [], 0
        if have:
            yield out(block())

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "v").mapInArrow(pack, "ids binary, data binary, longest double")


def _pruned(q: np.ndarray, x: np.ndarray, rotate: np.ndarray, lead: int, k: int, bound: np.ndarray, own: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of the block's vectors that may be among the query's k best; at most k of them."""
    qn, xn = _lengths(q), _lengths(x)
    # Comparisons are turned so that sums which overflow to no number keep their vectors.
    with np.errstate(over="ignore", invalid="ignore"):
        live = np.flatnonzero(~(qn * xn.max(initial=0) * (1 + _MARGIN) + _MARGIN < bound))
        if not len(live):
            return
        qr, xr = q[live] @ rotate, x @ rotate
        rest_q, rest_x = _lengths(qr[:, lead:]), _lengths(xr[:, lead:])
        bound = bound[live].copy()
        best = [(np.empty(0, "int64"), np.empty(0))] * len(live)
        for at in range(0, len(x), 1024):  # by descending length: later stretches meet higher bounds
            part = slice(at, at + 1024)
            reach = qr[:, :lead] @ xr[part, :lead].T
            reach += rest_q[:, None] * rest_x[None, part]
            most = qn[live] * xn[part].max()
            rows, columns = np.nonzero(~(reach < (bound - _MARGIN * (1 + most))[:, None]))
            if not len(rows):
                continue
            starts = np.searchsorted(rows, np.arange(len(live) + 1))
            for r in np.unique(rows):
                c = columns[starts[r] : starts[r + 1]] + at
                c = c[ids[c] != own[live[r]]]
                got_ids, got = np.concatenate([best[r][0], ids[c]]), np.concatenate([best[r][1], exact_scores(x[c], q[live[r]], most[r])])
                first = _first(got_ids, got, k)
                best[r] = got_ids[first], got[first]
                if len(first) == k:
                    bound[r] = max(bound[r], float(min(max(best[r][1][-1], -(2**1000)), 2**1000)))
    for r, (i, s) in enumerate(best):
        if len(i):
            yield int(live[r]), i, s


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, column: str = "embedding", scale: int = 256, block_rows: int = 16_384, query_rows: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k largest inner products with other vectors."""
    rows = checkpointed(quantized(vectors, column, scale).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    rotate = rotation(rows, dims)
    lead = max(1, dims // 3)
    longest_first = [F.desc("norm"), F.asc("vec_id")]
    candidates = checkpointed(_blocks(rows, dims, block_rows, longest_first).withColumn("block", F.monotonically_increasing_id()))
    asked = rows.where(is_query).dropDuplicates(["vec_id", "v"])
    n_blocks = max(1, -(-asked.count() // query_rows))
    dealt = asked.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).alias("query_block")).agg(F.collect_list("vec_id").alias("ids"), F.collect_list("v").alias("v"))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, v in zip(*batch.columns, strict=True):
                own, q = ids.values.to_numpy(), _matrix(pa.array([x.as_py() for x in v.values], pa.list_(pa.float64())), dims)
                row = (block.as_py(), own.tobytes(), q.tobytes(), _kth(q, own, head_ids, head, k).tobytes())
                yield pa.RecordBatch.from_pydict({n: pa.array([x], pa.int64() if n == "query_block" else pa.binary()) for n, x in zip(("query_block", "q_ids", "q", "bound"), row, strict=True)})

    first = candidates.orderBy(F.desc("longest"), "block").select("block").first()
    head_row = first and candidates.where(F.col("block") == first["block"]).select(F.substring("ids", 1, 8 * 1024).alias("i"), F.substring("data", 1, 8 * 1024 * max(1, dims)).alias("x")).first()
    head_ids = np.frombuffer(bytes(head_row["i"]), "int64") if head_row else np.empty(0, "int64")
    head = np.frombuffer(bytes(head_row["x"]), "float64").reshape(len(head_ids), dims) if head_row else np.empty((0, dims))
    queries = checkpointed(dealt.mapInArrow(bounds, "query_block long, q_ids binary, q binary, bound binary"))
    # The grid: each vector block goes once to every query block.
    grid = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))
    met = candidates.select(F.col("ids").alias("x_ids"), F.col("data").alias("x"), grid.alias("query_block")).join(queries, "query_block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x_ids, x, q_ids, q, bound in zip(*(batch.column(n).to_pylist() for n in ("x_ids", "x", "q_ids", "q", "bound")), strict=True):
                ids, own = np.frombuffer(x_ids, "int64"), np.frombuffer(q_ids, "int64")
                found = list(_pruned(np.frombuffer(q).reshape(len(own), dims), np.frombuffer(x).reshape(len(ids), dims), rotate, lead, k, np.frombuffer(bound), own, ids))
                if found:
                    yield pa.RecordBatch.from_pydict({"query_id": pa.array(np.concatenate([np.full(len(i), own[r]) for r, i, _ in found]), pa.int64()), "vec_id": pa.array(np.concatenate([i for _, i, _ in found]), pa.int64()), "score": pa.array(np.concatenate([_as_long(s) for _, _, s in found]), pa.int64()), "beyond": pa.array(np.concatenate([_beyond(s) for _, _, s in found]), pa.float64())})

    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    hits = met.repartition(F.xxhash64("query_block", "x_ids")).mapInArrow(search, "query_id long, vec_id long, score long, beyond double")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _kth(query: np.ndarray, own: np.ndarray, head_ids: np.ndarray, head: np.ndarray, k: int) -> np.ndarray:
    """A lower bound on each query's k-th best score from the longest vectors; minus infinity where they are too few."""
    with np.errstate(over="ignore", invalid="ignore"):
        scores = query @ head.T
    scores[~np.isfinite(scores)] = -np.inf
    scores[own[:, None] == head_ids[None, :]] = -np.inf
    return np.sort(scores, 1)[:, -k].copy() if scores.shape[1] >= k else np.full(len(own), -np.inf)
