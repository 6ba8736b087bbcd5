"""Exact top-k by inner product with multi-resolution segment bounds.

Vectors are cut into segments. The mean and the deviation of each segment give a
bound without the vector itself: for a segment of length L

    q . x  <=  L * mean(q) * mean(x)  +  |q - mean(q)| * |x - mean(x)|

(equivalently a lower bound on the distance). Starting with few long segments,
candidates whose bound is below the query's current k-th score are dropped, the
rest goes to the next, finer resolution, and survivors get their exact integer
score. Bounds are widened by a margin for rounding, so nothing is lost and
the result is exact.

Vectors are packed into blocks of rows; every block of queries meets every block
of rows once (a stated query set against all rows, in blocks). A first pass
scores the queries against one block and hands each query a k-th score that is
already reached, so pruning starts warm. Each block pair returns at most k rows
per query; the final ranking keeps the k best.

Values become floor(scale * x) as integers. Vectors that are null, or hold a
null or non-finite component, or have a null id, take no part; a shorter vector
counts as padded with zeros; ids that repeat are candidates of their own. Queries
that repeat in id and vector count once; those that share an id only are answered
each on its own (``query_id`` then has several lists). Scores beyond 64 bits are
clipped. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SCALE = 1024
ROWS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 2048
#: Segments per vector, coarse to fine.
LEVELS = (4, 16)
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1

_BLOCKS = "side string, block long, n int, dims int, ids binary, values binary"


def _quantised(rows: list[list[float]], scale: int) -> np.ndarray:
    """floor(scale * x), rows padded with zeros: exact in float64 up to 2**53."""
    dims = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), dims))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return np.floor(out * scale)


def _blocks(scale: int, side: str):
    """Blocks of one side: ``row`` or ``query``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        ids: list = []
        rows: list = []
        most = {"row": ROWS_PER_BLOCK, "query": QUERIES_PER_BLOCK}[side]

        def flush():
            nonlocal made, ids, rows
            q = _quantised(rows, scale)
            # One number per block, unique over all partitions.
            block, made = (part << 24) + made, made + 1
            out = pa.RecordBatch.from_pydict({
                "side": pa.array([side]), "block": pa.array([block], pa.int64()),
                "n": pa.array([q.shape[0]], pa.int32()), "dims": pa.array([q.shape[1]], pa.int32()),
                "ids": pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                "values": pa.array([q.tobytes()], pa.binary())})
            ids, rows = [], []
            return out

        for batch in batches:
            for i, v in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(i)
                rows.append(v)
                if len(ids) == most:
                    yield flush()
        if ids:
            yield flush()
    return run


def _segments(x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row sqrt(L) * mean and the deviation's norm of each segment."""
    cuts = np.unique(np.linspace(0, x.shape[1], min(count, max(x.shape[1], 1)) + 1).astype(int))[:-1]
    if not x.shape[1]:
        return np.zeros((len(x), 1)), np.zeros((len(x), 1))
    length = np.diff(np.append(cuts, x.shape[1]))
    total = np.add.reduceat(x, cuts, axis=1)
    square = np.add.reduceat(x * x, cuts, axis=1)
    return total / np.sqrt(length), np.sqrt(np.maximum(square - total * total / length, 0.0))


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of one query with rows."""
    top = np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * max(len(q), 1)
    if top < _EXACT:
        return (x @ q).astype(np.int64)
    qi = [int(v) for v in q]
    return np.array([min(max(sum(a * int(b) for a, b in zip(qi, r)), -_LONG - 1), _LONG)
                     for r in x], np.int64)


def search_block(qids: np.ndarray, q: np.ndarray, kth: np.ndarray, ids: np.ndarray,
                 x: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's number, row ids, scores): at most k per query, none below ``kth``."""
    dims = max(q.shape[1], x.shape[1])
    q, x = (np.pad(a, ((0, 0), (0, dims - a.shape[1]))) for a in (q, x))
    levels = []
    for count in LEVELS:
        (mq, dq), (mx, dx) = _segments(q, count), _segments(x, count)
        levels.append((np.hstack([mq, dq]), np.hstack([mx, dx])))
    # Rounding of the bounds, far below the distance between two integers unless
    # values are huge.
    slack = 1.0 + 1e-9 * np.sqrt((q * q).sum(1).max(initial=0.0) * (x * x).sum(1).max(initial=0.0))
    coarse = levels[0][0] @ levels[0][1].T + slack
    for i in range(len(q)):
        own = ids != qids[i]
        bound = np.where(own, coarse[i], -np.inf)
        least = float(kth[i])
        if own.sum() > k:  # the exact scores of the k likeliest rows raise the bar
            first = np.argpartition(-bound, k - 1)[:k]
            least = max(least, float(_exact(q[i], x[first]).min()))
        left = np.flatnonzero(own & (bound >= least))
        for a, b in levels[1:]:
            left = left[b[left] @ a[i] + slack >= least]
        score = _exact(q[i], x[left])
        keep = score >= least
        left, score = left[keep], score[keep]
        best = np.lexsort((ids[left], -score))[:k]
        yield i, ids[left[best]], score[best]


def _pairs(k: int):
    def run(key, qdf: pd.DataFrame, xdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q in qdf.itertuples():
            qids = np.frombuffer(q.ids, np.int64)
            qv = np.frombuffer(q.values, np.float64).reshape(q.n, q.dims)
            kth = (np.frombuffer(q.kth, np.float64) if q.kth is not None
                   else np.full(q.n, -np.inf))
            for x in xdf.itertuples():
                for i, ids, score in search_block(
                        qids, qv, kth, np.frombuffer(x.ids, np.int64),
                        np.frombuffer(x.values, np.float64).reshape(x.n, x.dims), k):
                    out.append(pd.DataFrame({"block": q.block, "number": i, "query_id": qids[i],
                                             "vec_id": ids, "score": score}))
        return (pd.concat(out) if out else pd.DataFrame(
            {c: [] for c in ("block", "number", "query_id", "vec_id", "score")}, dtype="int64"))
    return run


_HITS = "block long, number long, query_id long, vec_id long, score long"


def _warm(k: int):
    """Per query block the k-th score against one block of rows (-inf: fewer)."""
    def run(key, qdf: pd.DataFrame, xdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for q in qdf.itertuples():
            kth = np.full(q.n, -np.inf)
            for x in xdf.itertuples():
                found = search_block(np.frombuffer(q.ids, np.int64),
                                     np.frombuffer(q.values, np.float64).reshape(q.n, q.dims), kth,
                                     np.frombuffer(x.ids, np.int64),
                                     np.frombuffer(x.values, np.float64).reshape(x.n, x.dims), k)
                kth = np.array([float(s[-1]) if len(s) == k else -np.inf for _, _, s in found],
                               np.float64)
                # Never above the integer it stands for.
                kth = np.where(np.abs(kth) < _EXACT, kth, np.nextafter(kth, -np.inf))
            rows.append((q.block, kth.tobytes()))
        return pd.DataFrame(rows, columns=["of", "kth"])
    return run


def top_k(df: DataFrame, query_filter, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k best rows by inner product of
    the quantised vectors for every row that ``query_filter`` (a condition) holds
    for; a query's own id is no candidate; ties go to the smaller id."""
    v = F.col(vector_col).cast("array<double>")
    ok = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    src = df.filter(ok).select(F.col(id_col).cast("long").alias("i"), v.alias("v"),
                               F.coalesce(query_filter, F.lit(False)).alias("q"))
    asked = src.filter("q").select("i", "v").dropDuplicates(["i", "v"])
    blocks = stage(src.select("i", "v").mapInArrow(_blocks(scale, "row"), _BLOCKS).union(
        asked.mapInArrow(_blocks(scale, "query"), _BLOCKS)), "topk_blocks")
    rows, queries = blocks.filter("side = 'row'"), blocks.filter("side = 'query'")
    # Warm start: one block of rows (bounded) meets all query blocks.
    first = rows.orderBy("block").limit(1)
    meets = queries.select(F.col("block").alias("cell")).join(F.broadcast(first))
    warm = queries.groupBy("block").cogroup(meets.groupBy("cell")).applyInPandas(
        _warm(k), "of long, kth binary")
    queries = stage(queries.join(warm, F.col("block") == F.col("of"), "left").drop("of"),
                    "topk_queries")
    # Every (query block, row block) pair is a cell of its own; the pairs are
    # made of block numbers only.
    cells = stage(queries.select(F.col("block").alias("qb")).join(
        F.broadcast(rows.select(F.col("block").alias("xb")))), "topk_cells")
    left = cells.join(queries, F.col("qb") == F.col("block"))
    right = cells.select(F.col("qb").alias("rq"), F.col("xb").alias("rx")).join(
        rows, F.col("rx") == F.col("block"))
    hits = left.groupBy("qb", "xb").cogroup(right.groupBy("rq", "rx")).applyInPandas(
        _pairs(k), _HITS)
    # A query is its place in its block: ids may repeat.
    w = Window.partitionBy("block", "number").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
