"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are cut into segments. With a segment's mean and deviation kept per vector, the
part of an inner product that falls into a segment is at most
``n * mean_q * mean_x + n * dev_q * dev_x``, which bounds the squared distance
``|q|^2 + |x|^2 - 2 q.x`` from below. Blocks of queries meet blocks of candidates; within a
pair of blocks bounds go from few segments to many, and only candidates that some query
of the block cannot rule out get exact products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates and queries of a block; both bound a task's memory.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 512
#: Segments per vector, coarse to fine.
LEVELS = (4, 8, 16)

RESULT = "query_id long, vec_id long, score long"


def quantized(rows: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """``vec_id, v``: components as floor(scale * x), x as double.

    Rows with a null id, a null vector, or a null or non-finite component are left out.
    """
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("bigint"))
    return rows.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).where(~bad).select(F.col(id_column).cast("bigint").alias("vec_id"), whole.alias("v"))


def segment_statistics(m: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations per segment, scaled so that the product of two rows bounds their inner product."""
    edges = np.linspace(0, m.shape[1], min(segments, m.shape[1]) + 1).astype(int)
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        part = m[:, a:b]
        mean = part.mean(axis=1)
        out += [mean * np.sqrt(b - a), np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(out, axis=1)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where every sum is exact there, else in integers."""
    if q.size and x.size and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2**52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the places of its k best, higher scores and then smaller ids first; below the floor nothing."""
    floor = np.iinfo(np.int64).min
    out = []
    for row in scores:
        if len(row) > k:
            kth = np.partition(row, len(row) - k)[len(row) - k]
            places = np.flatnonzero(row >= kth)
        else:
            places = np.arange(len(row))
        places = places[row[places] > floor]
        out.append(places[np.lexsort((ids[places], -row[places]))][:k])
    return out


def search_block(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int, levels=LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, vector ids and scores of each query's k best in one block; ties beyond k go by smaller id."""
    floor = np.iinfo(np.int64).min
    alive = np.arange(len(x_ids))
    # A first floor under each query's k-th score: exact products with the block's coarsely best vectors.
    least = np.full(len(q_ids), -np.inf)
    for level in levels:
        if not q.shape[1] or len(alive) <= 4 * k:
            break
        sq, sx = segment_statistics(q.astype(np.float64), level), segment_statistics(x[alive].astype(np.float64), level)
        bound = sq @ sx.T
        slack = 1e-9 * (np.abs(sq) @ np.abs(sx).T) + 1e-6
        if not np.isfinite(least).any():
            top = np.unique(np.argpartition(-bound, 2 * k, axis=1)[:, : 2 * k])
            seed = _products(q, x[alive[top]])
            own = q_ids[:, None] == x_ids[alive[top]][None, :]
            seed[own] = floor
            if len(top) > k:
                least = np.partition(seed, len(top) - k, axis=1)[:, len(top) - k].astype(np.float64)
        alive = alive[((bound + slack) >= least[:, None]).any(axis=0)]
    scores = _products(q, x[alive])
    scores[q_ids[:, None] == x_ids[alive][None, :]] = floor
    picked = _best(scores, x_ids[alive], k)
    counts = [len(p) for p in picked]
    rows = np.repeat(np.arange(len(q_ids)), counts)
    cols = np.concatenate(picked) if picked else np.empty(0, dtype=np.int64)
    return q_ids[rows], x_ids[alive][cols.astype(np.int64)], scores[rows, cols.astype(np.int64)]


def _matrix(lists: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    rows = lists.values
    ids = rows.field("vec_id").to_numpy(zero_copy_only=False)
    flat = rows.field("v").flatten().to_numpy(zero_copy_only=False)
    return ids.astype(np.int64), flat.astype(np.int64).reshape(len(ids), -1)


def _blocks(rows: DataFrame, count: int, name: str) -> DataFrame:
    dealt = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(count)).alias(name), F.size("v").alias("dims"), F.struct("vec_id", "v").alias("r"))
    return dealt.groupBy("dims", name).agg(F.collect_list("r").alias(f"{name}_rows"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest inner products, ties to the smaller id.

    Both sides are ``vec_id, v`` with whole components. Rows under the query's own id are no
    candidates; vectors meet only those of as many components. Every block of queries is sent
    to every block of candidates by an equality join on the block's number; blocks are
    hashed by id and hold a bounded number of rows. Rows that repeat an id ask and answer side by side. Empty
    sides: no rows.
    """
    n, m = vectors.count(), queries.count()
    x_count, q_count = max(1, -(-n // block_rows)), max(1, -(-m // block_queries))
    candidates = _blocks(vectors, x_count, "x_block")
    asked = _blocks(queries, q_count, "q_block").withColumn("x_block", F.explode(F.expr(f"sequence(0L, {x_count - 1}L)")))
    pairs = asked.join(candidates, ["dims", "x_block"]).select("q_block_rows", "x_block_rows")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_rows, x_rows in zip(batch.column(0), batch.column(1), strict=True):
                found = search_block(*_matrix(q_rows), *_matrix(x_rows), k)
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(search, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
