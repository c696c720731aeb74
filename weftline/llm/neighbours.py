"""Nearest neighbours of a query set by a block matrix join.

Vectors are scaled to 8-bit integers, each with its own scale and with the exact norm of what rounding lost. Queries
and candidates are dealt to blocks of bounded size, and every pair of blocks is one tile: an integer product gives
all inner products of the tile within a proven error, candidates whose upper bound is below a query's twentieth
lower bound go, and the rest are worked out from the original vectors in double precision, component by
component in order. Each tile gives its nearest, heaps merge them. So the result is exact.

Equal vectors of a block are one column of the tile that stands for its smallest ids, so that a group of copies of any
size costs no more than one vector.

Vectors that are null, empty or zero, or hold null or non-finite components, and rows with null ``vec_id``, take no
part. Vectors of different length are not compared. Of rows that repeat a ``vec_id`` the least vector takes part.
Ties go to the smaller ``vec_id``. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAREST = 20
QUERIES, CANDIDATES = 2048, 8192
CHUNK = 256


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """8-bit components (as floats, whose products are exact), scale, norm of what they stand for, norm of the loss."""
    scale = np.abs(x).max(1) / 127
    scale = np.where(scale > 0, scale, 1)
    whole = np.rint(x / scale[:, None])
    kept = whole * scale[:, None]
    return whole.astype(np.int8), scale, np.linalg.norm(kept, axis=1), np.linalg.norm(x - kept, axis=1)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def _vectors(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1).astype(np.float64)


def _tile(key: tuple, rows: pa.Table) -> pa.Table:
    left, right = (rows.filter(pc.equal(rows.column("is_query"), flag)) for flag in (True, False))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if left.num_rows and right.num_rows:
        q_id, c_id = (t.column("vec_id").to_numpy() for t in (left, right))
        q, c = _vectors(left.column("embedding"), len(q_id)), _vectors(right.column("embedding"), len(c_id))
        order = np.argsort(c_id)
        c, c_id = c[order], c_id[order]
        _, first, place = np.unique(np.ascontiguousarray(c).view([("", c.dtype)] * c.shape[1]).ravel(), return_index=True, return_inverse=True)
        distinct = c[first]
        # The smallest ids of each distinct vector; one more than are asked for, as one may be the query's own.
        group = np.argsort(place, kind="stable")
        starts = np.searchsorted(place[group], np.arange(len(first)))
        sizes = np.minimum(np.diff(np.append(starts, len(group))), NEAREST + 1)
        qi, q_scale, q_norm, q_loss = quantised(q)
        ci, c_scale, c_norm, c_loss = quantised(distinct)
        columns = ci.astype(np.float32).T
        for at in range(0, len(q), CHUNK):
            part = slice(at, at + CHUNK)
            about = (qi[part].astype(np.float32) @ columns).astype(np.float64) * q_scale[part, None] * c_scale
            error = q_norm[part, None] * c_loss + q_loss[part, None] * (c_norm + c_loss) + 1e-9 * (q_norm[part, None] + q_loss[part, None]) * (c_norm + c_loss)
            if about.shape[1] > NEAREST + 1:
                least = np.partition(about - error, -(NEAREST + 1), axis=1)[:, -(NEAREST + 1)]
                i, j = np.nonzero(about + error >= least[:, None])
            else:
                i, j = (x.ravel() for x in np.indices(about.shape))
            score = inner(q[part][i], distinct[j])
            each = sizes[j]
            step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            ids = c_id[group[np.repeat(starts[j], each) + step]]
            i, score = np.repeat(i, each), np.repeat(score, each)
            own = q_id[part][i] == ids
            i, score, ids = i[~own], score[~own], ids[~own]
            order = np.lexsort((ids, -score, i))
            i, score, ids = i[order], score[order], ids[order]
            near = np.arange(len(i)) - np.searchsorted(i, i) < NEAREST
            out.append((q_id[part][i[near]], ids[near], score[near]))
    a, b, s = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.table({"query_id": a, "vec_id": b, "score": s})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest of each query of a partition, by a heap of bounded size for each."""
    heaps: dict[int, list[tuple[float, int]]] = defaultdict(list)
    for batch in batches:
        for query, vec, score in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score")), strict=True):
            (heapq.heappush if len(heaps[query]) < NEAREST else heapq.heappushpop)(heaps[query], (score, -vec))
    rows = [(q, rank, -v, s) for q, heap in heaps.items() for rank, (s, v) in enumerate(sorted(heap, reverse=True), 1)]
    for at in range(0, len(rows), 50_000):
        columns = zip(*rows[at : at + 50_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], ["query_id", "rank", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """For each row of ``vectors`` (vec_id, embedding) where ``is_query``: query_id, rank, vec_id, score of its nearest."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.max("is_query").alias("is_query"))
    n, n_queries = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("is_query").cast("int")), F.lit(0))).first()
    across, down = -(-n // CANDIDATES) or 1, -(-n_queries // QUERIES) or 1
    block = lambda k: F.pmod(F.xxhash64("vec_id"), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    candidates = rows.withColumn("is_query", F.lit(False)).withColumn("across", block(across)).withColumn("down", every(down))
    queries = rows.where("is_query").withColumn("down", block(down)).withColumn("across", every(across))
    tiles = candidates.unionByName(queries).groupBy(F.size("embedding").alias("length"), "across", "down")
    found = tiles.applyInArrow(_tile, "query_id long, vec_id long, score double")
    return found.repartition("query_id").mapInArrow(_merge, "query_id long, rank int, vec_id long, score double")


SQL = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q, v c
  WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= {NEAREST}
"""
