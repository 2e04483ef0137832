"""Exact top-k by inner product of integer vectors: columnar branch and bound.

Vectors lie in blocks, dimension by dimension. For a block of queries and one of candidates the first ``STEP``
dimensions are accumulated for all pairs; each query gets a threshold from the full scores of the most promising few,
or its k-th best score so far if that is higher; then, query by query, candidates whose score so far plus the product
of both vectors' remaining norms (the most that the rest can add) is under the threshold go, the survivors are packed
together, and the next dimensions are added for them only. What is left at the end has exact scores.

Queries and candidates are laid out as a grid: candidate blocks are dealt to ``groups``, query blocks to ``strips``, and
each cell of the grid is one task, in which a query block passes over the group's candidate blocks with its k best
so far and gives k rows a query at the end. The numbers of both follow from the tables' sizes, so that copies of
queries and of candidates are about as large, and a group's candidates fit ``GROUP_BYTES``. No pair of rows ever becomes a row.

Defined results. A vector that is null or empty, or holds null, NaN or an infinity, and a null vec_id, take no part. Scores need
vectors of one length. Rows repeated among the candidates are each ranked; of rows repeated among the queries the one
with the smallest vector asks. Rows with the query's own vec_id are no candidates. Components and scores beyond the
range of long are set to its end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import shuffle_partitions

K, SCALE = 10, 1024
ROWS, STEP, BLOCK_BYTES, GROUP_BYTES = 2048, 16, 8 << 20, 64 << 20
_BLOCK = "dim int, ids binary, matrix binary"
_EXACT = float(1 << 53)


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and vector (array<long>) = floor(scale * x) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    fine = F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("vector"))


def rows_of_block(dim: int) -> int:
    return max(16, min(ROWS, BLOCK_BYTES // (8 * max(1, dim))))


def _packed(ids: np.ndarray, lists: pa.Array) -> Iterator[dict]:
    lengths = np.diff(lists.offsets.to_numpy())
    flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        rows = rows_of_block(int(dim))
        for i in range(0, len(at), rows):
            some = at[i : i + rows]
            matrix = flat[offsets[some][:, None] + np.arange(dim)].T
            yield {"dim": int(dim), "ids": ids[some].astype("<i8").tobytes(), "matrix": np.ascontiguousarray(matrix, "<i8").tobytes()}


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary())])
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_pylist(list(_packed(batch.column("vec_id").to_numpy(), batch.column("vector"))), schema)


def _query_block(t: pa.Table) -> pa.Table:
    """A group of queries as blocks."""
    schema = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary())])
    t = t.sort_by("vec_id").combine_chunks()
    return pa.Table.from_pylist(list(_packed(t.column("vec_id").to_numpy(), t.column("vector").chunk(0))), schema)


def best_of_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int = K, floor: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its best k candidates of the block: query id, candidate ids, scores. q and c: [dimension, row].

    Those that score under the query's ``floor`` may be left out.
    """
    dim = len(q)
    top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * dim
    if top >= _EXACT:  # sums might not be whole in floats: exact Python integers, without bounds
        scores = np.clip(q.T.astype(object) @ c.astype(object), -(2**63), 2**63 - 1).astype(np.int64)
        for i, own in enumerate(q_ids):
            yield own, *_ranked(c_ids[c_ids != own], scores[i][c_ids != own], k)
        return
    q, c = q.astype(np.float64), c.astype(np.float64)
    ends = list(range(STEP, dim, STEP)) + [dim]
    rest_q = [np.sqrt((q[e:] ** 2).sum(axis=0)) for e in ends]
    rest_c = [np.sqrt((c[e:] ** 2).sum(axis=0)) for e in ends]
    so_far = q[: ends[0]].T @ c[: ends[0]]
    few = min(2 * k + 1, c.shape[1])
    promising = np.argpartition(-so_far, few - 1, axis=1)[:, :few]
    full, some = np.empty(promising.shape), max(1, BLOCK_BYTES // (8 * dim * few))
    for i in range(0, len(full), some):
        full[i : i + some] = np.einsum("dq,dqf->qf", q[:, i : i + some], c[:, promising[i : i + some]])
    full[c_ids[promising] == q_ids[:, None]] = -np.inf
    threshold = np.partition(full, few - k, axis=1)[:, few - k] if few > k else np.full(len(q_ids), -np.inf)
    threshold = threshold if floor is None else np.maximum(threshold, floor)
    for i, own in enumerate(q_ids):
        scores, alive = so_far[i], None
        for b, e in enumerate(ends):
            if b:
                scores = scores + q[ends[b - 1] : e, i] @ c[ends[b - 1] : e][:, alive]
            reach = scores + rest_q[b][i] * (rest_c[b] if alive is None else rest_c[b][alive]) * (1 + 1e-9) + 0.5
            stay = np.flatnonzero(reach >= threshold[i])
            alive, scores = stay if alive is None else alive[stay], scores[stay]
        other = c_ids[alive] != own
        yield own, *_ranked(c_ids[alive][other], np.rint(scores[other]).astype(np.int64), k)


def _ranked(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class _Best:
    """A block of queries and the k best of each so far."""

    def __init__(self, dim: int, ids: bytes, matrix: bytes, k: int):
        self.name, self.k, self.ids = (dim, ids), k, np.frombuffer(ids, "<i8")
        self.matrix = np.frombuffer(matrix, "<i8").reshape(dim, -1)
        none = np.zeros(0, np.int64)
        self.best, self.floor = [(none, none)] * len(self.ids), np.full(len(self.ids), -np.inf)

    def meet(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        for i, (_, found, scores) in enumerate(best_of_block(self.ids, self.matrix, ids, matrix, self.k, self.floor)):
            if len(found):
                self.best[i] = _ranked(np.concatenate((self.best[i][0], found)), np.concatenate((self.best[i][1], scores)), self.k)
                if len(self.best[i][0]) == self.k:
                    self.floor[i] = self.best[i][1][-1]

    def rows(self) -> pa.RecordBatch:
        owners = np.repeat(self.ids, [len(x) for x, _ in self.best]).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(owners), *(pa.array(np.concatenate([x[j] for x in self.best]).astype(np.int64)) for j in (0, 1))], ["query_id", "vec_id", "score"])


def _search(k: int):
    """Passes over pairs of blocks; those of one query block follow each other, so that its rows come once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Best | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                dim, q_ids = batch.column("dim")[i].as_py(), batch.column("q_ids")[i].as_py()
                if now is None or now.name != (dim, q_ids):
                    if now is not None:
                        yield now.rows()
                    now = _Best(dim, q_ids, batch.column("q_matrix")[i].as_py(), k)
                now.meet(np.frombuffer(batch.column("ids")[i].as_py(), "<i8"), np.frombuffer(batch.column("matrix")[i].as_py(), "<i8").reshape(dim, -1))
        if now is not None:
            yield now.rows()

    return run


def grid(n: int, n_asked: int, dim: int, tasks: int) -> tuple[int, int]:
    """Groups of candidates and strips of queries: at least ``tasks`` cells if there are so many blocks, groups within their
    size, and about as many bytes of copied queries as of copied candidates.
    """
    rows = rows_of_block(dim)
    blocks, asked = max(1, math.ceil(n / rows)), max(1, math.ceil(n_asked / rows))
    least = math.ceil(n * dim * 8 / GROUP_BYTES)
    groups = min(blocks, max(least, round(math.sqrt(tasks * blocks / asked)), 1))
    return groups, max(1, min(asked, math.ceil(tasks / groups)))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best, ties to the smaller vec_id."""
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, scale)
    asked = whole.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n, n_asked, dim = vectors.agg(F.count("*"), F.count_if(is_query), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    groups, strips = grid(n, n_asked, max(1, dim), shuffle_partitions(spark))
    parts = max(strips, math.ceil(n_asked / rows_of_block(dim)))
    to_all = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = whole.mapInArrow(_to_blocks, _BLOCK).select("*", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int").alias("g"), to_all(strips).alias("strip"))
    queries = asked.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("part")).applyInArrow(_query_block, _BLOCK)
    queries = queries.select("dim", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.pmod(F.xxhash64("ids"), F.lit(strips)).cast("int").alias("strip"), to_all(groups).alias("g"))
    met = queries.hint("merge").join(candidates, ["dim", "g", "strip"]).select("dim", "q_ids", "q_matrix", "ids", "matrix")
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
