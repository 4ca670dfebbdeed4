"""Exact top-k by inner product over vector-approximation files.

Components become integers floor(scale * x).  Vectors are packed in blocks: a file of
approximations (the cell of each component, ``cell`` integers wide) and the exact integers.
For each block of queries and each block of vectors, the approximations are scanned first:
with v = cell * c + r and 0 <= r < cell, the score q.v lies between cell * q.c plus
(cell - 1) * (sum of q's negative components) and cell * q.c plus (cell - 1) * (sum of its
positive ones).  Exact vectors are then read in the order of these bounds (best first),
until the k-th exact score is above every remaining bound.  Each block pair gives its k
best; the k best of those are the answer.

Every query block meets every vector block once (an equi-join on the vector block number);
blocks have fixed sizes, so memory does not grow with the table.

Cases: vectors that are null or hold null, NaN or infinite components, and rows with a null id
take no part; a component or a score that does not fit 64 bits fails the job, it never wraps
(products that may come near are made with Python's integers, without the approximations);
vectors of another length than the query are no candidates of it; repeated rows are candidates
each; a query row's own id is never its candidate; fewer than k candidates give all; of equal
scores the smaller id comes first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow

VECTORS_PER_BLOCK = 16384
QUERIES_PER_BLOCK = 256
CELL = 4
FIRST_READS = 4  # times k exact vectors are read first
READ = 256  # then so many at a time
_PACKED = "block long, dim int, ids binary, cells binary, exact binary"


def _integers(column: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rows that take part, their integer vectors)."""
    rows, out = [], []
    offsets, values = column.offsets.to_numpy(), column.values
    x = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    with np.errstate(over="ignore"):  # a finite component may grow infinite by the scale
        scaled = np.floor(scale * x)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
    ok = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    rows = np.flatnonzero(ok)
    out = [scaled[a:b] for a, b in zip(offsets[rows].tolist(), offsets[rows + 1].tolist())]
    if any(len(v) and np.abs(v).max() >= 2.0**63 for v in out):
        raise OverflowError("an embedding component does not fit 64 bits")
    return rows, [v.astype(np.int64) for v in out]


def _pack(df: DataFrame, scale: float, per_block: int, cell: int) -> DataFrame:
    """Blocks of at most ``per_block`` vectors of one length each; block numbers are made
    of the partition and a counter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, tuple[list, list]] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, vectors = held.pop(dim)
            exact = np.array(vectors, np.int64).reshape(len(ids), dim)
            if len(exact) and dim and np.abs(exact).max() < 1 << 15:
                exact = exact.astype(np.int16)
            cells = np.floor_divide(exact, cell)
            if not cells.size or np.abs(cells).max() < 1 << 7:
                cells = cells.astype(np.int8)
            number += 1
            width = lambda a: bytes([a.dtype.itemsize]) + a.tobytes()
            return pa.RecordBatch.from_pydict({
                "block": pa.array([number], pa.int64()), "dim": pa.array([dim], pa.int32()),
                "ids": pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                "cells": pa.array([width(cells)], pa.binary()),
                "exact": pa.array([width(exact)], pa.binary()),
            })

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rows, vectors = _integers(batch.column(1), scale)
            for i, v in zip(rows, vectors):
                kept = held.setdefault(len(v), ([], []))
                kept[0].append(ids[i])
                kept[1].append(v)
                if len(kept[0]) >= per_block:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)

    return map_arrow(df, run, _PACKED)


def _matrix(data: bytes, dim: int, rows: int) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 8: np.int64}[data[0]]
    return np.frombuffer(data, kind, offset=1).reshape(rows, dim)


def _dot(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products (float64 BLAS while they fit, else int64)."""
    if not (q.size and v.size):
        return np.zeros((len(q), len(v)), np.int64)
    if _top(q, v) < 2**53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ v.astype(np.int64).T


def _top(q: np.ndarray, v: np.ndarray) -> float:
    """No product of these rows, nor a partial sum of one, is larger in size."""
    if not (q.size and v.size):
        return 0.0
    return float(np.abs(q.astype(float)).max()) * float(np.abs(v.astype(float)).max()) * q.shape[1]


def _wide_top_k(
    q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, exact: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``block_top_k`` by exact integers of any size; an error if a score fits no long."""
    scores = q.astype(object) @ exact.astype(object).T
    for i in range(len(q)):
        others = np.flatnonzero(ids != q_ids[i])
        own = scores[i, others].tolist()
        if any(not -(1 << 63) < s < 1 << 63 for s in own):
            raise OverflowError("a score does not fit 64 bits")
        if own:
            yield i, *_best(ids[others], np.array(own, np.int64), k)


def block_top_k(
    q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, cells: np.ndarray, exact: np.ndarray,
    cell: int, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of each query's k best in a block, by bounds then exact reads."""
    q = q.astype(np.int64)
    if _top(q, exact) >= 2.0**62:
        yield from _wide_top_k(q_ids, q, ids, exact, k)
        return
    upper = _dot(q, cells) * cell + ((cell - 1) * np.maximum(q, 0).sum(1))[:, None]
    lowest = -np.iinfo(np.int64).max  # can be negated
    for i in range(len(q)):
        bound = np.where(ids == q_ids[i], lowest, upper[i])
        others = np.flatnonzero(ids != q_ids[i])
        if not len(others):
            continue
        # first the vectors of the best bounds: their k-th score rules out most others
        if len(others) > FIRST_READS * k:
            part = np.argpartition(-bound, FIRST_READS * k - 1)[: FIRST_READS * k]
        else:
            part = others
        scores = _dot(q[i : i + 1], exact[part])[0]
        best_ids, best = _best(ids[part], scores, k)
        bound[part] = lowest
        if len(best) == k:
            # a bound equal to the k-th score may still hold a smaller id
            rest = np.flatnonzero(bound >= max(best[-1], lowest + 1))
            rest = rest[np.argsort(-bound[rest], kind="stable")]
            for at in range(0, len(rest), READ):
                part = rest[at : at + READ]
                if bound[part[0]] < best[-1]:
                    break  # certain: no unread bound reaches the k-th score
                scores = _dot(q[i : i + 1], exact[part])[0]
                best_ids, best = _best(
                    np.concatenate((best_ids, ids[part])), np.concatenate((best, scores)), k
                )
        yield i, best_ids, best


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    top = np.lexsort((ids, -scores))[:k]
    return ids[top], scores[top]


def top_k(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = 20, scale: float = 64.0, vectors_per_block: int = VECTORS_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK, cell: int = CELL,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each row that ``is_query`` marks, against all
    rows: the k highest scores, ties to the smaller id."""
    id_ = F.col(id_col).cast("long").alias("_id")
    vector = F.col(vector_col).cast("array<double>").alias("_vector")
    rows = df.where(F.col(id_col).isNotNull())
    total = rows.agg(F.count("*"), F.count_if(is_query)).first()
    n_blocks = max(1, -(-total[0] // vectors_per_block))
    n_queries = max(1, -(-total[1] // queries_per_block))
    vectors = _pack(rows.select(id_, vector).repartition(n_blocks), scale, 2 * vectors_per_block, cell)
    queries = _pack(
        rows.where(is_query).select(id_, vector).repartition(n_queries), scale,
        2 * queries_per_block, cell,
    )
    # a round-robin share is one block (per vector length): its partition is its number
    part = F.shiftright("block", 32)
    pairs = queries.select(
        F.col("block").alias("q_block"), F.col("dim").alias("q_dim"),
        F.col("ids").alias("q_ids"), F.col("exact").alias("q_exact"),
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("part"),
    ).join(
        vectors.withColumn("v_part", part), (F.col("part") == F.col("v_part"))
        & (F.col("q_dim") == F.col("dim")),
    ).select("q_block", "dim", "q_ids", "q_exact", "ids", "cells", "exact")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_block, dim, q_ids, q_exact, ids, cells, exact = (
                    c[i].as_py() for c in batch.columns
                )
                q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                found = list(block_top_k(
                    q_ids, _matrix(q_exact, dim, len(q_ids)), ids,
                    _matrix(cells, dim, len(ids)), _matrix(exact, dim, len(ids)), cell, k,
                ))
                sizes = [len(s) for _, s, _ in found]
                at = np.repeat([j for j, _, _ in found], sizes).astype(np.int64)
                empty = [np.zeros(0, np.int64)]
                yield pa.RecordBatch.from_pydict({
                    "q_block": pa.array(np.full(len(at), q_block, np.int64)), "query": pa.array(at),
                    "query_id": pa.array(q_ids[at]),
                    "vec_id": pa.array(np.concatenate([x for _, x, _ in found] or empty)),
                    "score": pa.array(np.concatenate([x for _, _, x in found] or empty)),
                })

    found = map_arrow(pairs, run, "q_block long, query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("q_block", "query").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
