"""Exact nearest neighbours by a block matrix join over int8 tiles.

Method.  Vectors are cut into blocks by a hash of their id, and each block of
queries meets each block of candidates once: a tile.  Both sides of a tile are
rounded to int8 with a scale per vector; one matrix product gives all inner
products approximately, and the rounding errors' lengths bound how far each is
from the truth.  A pair whose upper bound is below the query's k-th best lower
bound is out; the pairs that survive are computed again in double precision.
Each task keeps a heap of k per query over its tiles, so later tiles are
pruned by earlier ones; heaps of different tasks are merged by rank.

Queries are a stated set against all rows, in blocks; nothing is a cross join
of rows.  A tile's two blocks are bounded by their row counts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import materialize

K, QUERY_STEP = 20, 20
CANDIDATE_ROWS, QUERY_ROWS = 4_096, 512  # about, by hash
SLACK = 1e-9  # relative; far above what rounding of doubles can add


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components, and not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(lists) -> np.ndarray:
    flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(lists), -1)


def _packed(ids: str, vectors: str):
    """One row per block: its ids and vectors as bytes."""
    def run(batch):
        block = batch.column("block")[0].as_py()
        order = np.argsort(batch.column(ids).to_numpy(), kind="stable")
        matrix = _matrix(batch.column(vectors).combine_chunks())[order]
        return pa.table({"block": pa.array([block], pa.int64()), "dim": pa.array([matrix.shape[1]], pa.int32()),
                         "ids": pa.array([batch.column(ids).to_numpy()[order].astype("<i8").tobytes()], pa.binary()),
                         "vectors": pa.array([matrix.astype("<f8").tobytes()], pa.binary())})
    return run


BLOCK = "block bigint, dim int, ids binary, vectors binary"


def _rounded(x: np.ndarray):
    """int8 values as floats, scales, and the lengths of the rounding errors and of the rounded vectors."""
    scale = np.abs(x).max(axis=1) / 127
    whole = np.rint(x / scale[:, None])
    near = whole * scale[:, None]
    return whole.astype(np.int8), scale, np.linalg.norm(x - near, axis=1), np.linalg.norm(near, axis=1)


class _Heaps:
    """The k best of each query of a block: (score, -id), least first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.whole, self.scale, self.error, self.length = _rounded(vectors)
        self.heaps = [[] for _ in ids]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        whole, scale, error, length = _rounded(vectors)
        # products of int8 are exact in float32 up to 2 ** 24: a thousand dimensions at a time
        product = np.zeros((len(self.ids), len(ids)))
        for d in range(0, vectors.shape[1], 1_000):
            product += self.whole[:, d: d + 1_000].astype(np.float32) @ whole[:, d: d + 1_000].astype(np.float32).T
        about = product * self.scale[:, None] * scale[None, :]
        # q.c - q'.c' = q'.(c - c') + (q - q').c' + (q - q').(c - c')
        bound = self.length[:, None] * error + self.error[:, None] * length + self.error[:, None] * error
        bound += SLACK * (np.abs(about) + bound) + 1e-300
        own = self.ids[:, None] == ids[None, :]
        about[own] = -np.inf
        low = about - bound
        n = low.shape[1]
        floor = np.partition(low, n - self.k, axis=1)[:, n - self.k] if n > self.k else np.full(len(low), -np.inf)
        kept = np.array([h[0][0] if len(h) == self.k else -np.inf for h in self.heaps])
        floor = np.maximum(floor, kept)
        q, c = np.nonzero((about + bound >= floor[:, None]) & ~own)
        for a in range(0, len(q), 100_000):
            i, j = q[a: a + 100_000], c[a: a + 100_000]
            exact = np.einsum("ij,ij->i", self.vectors[i], vectors[j])
            for row, score, other in zip(i.tolist(), exact.tolist(), ids[j].tolist()):
                heap, entry = self.heaps[row], (score, -other)
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)

    def rows(self) -> pa.RecordBatch:
        found = [(int(q), -i, s) for q, h in zip(self.ids, self.heaps) for s, i in h]
        return pa.RecordBatch.from_arrays([pa.array([x[n] for x in found], t) for n, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                                          ["query_id", "vec_id", "score"])


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heaps = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("q_block", "q_ids", "q_vectors", "dim", "ids", "vectors")}
                if row["q_block"] != now:
                    if heaps:
                        yield heaps.rows()
                    ids = np.frombuffer(row["q_ids"], "<i8")
                    now, heaps = row["q_block"], _Heaps(ids, np.frombuffer(row["q_vectors"], "<f8").reshape(len(ids), -1), k)
                ids = np.frombuffer(row["ids"], "<i8")
                heaps.add(ids, np.frombuffer(row["vectors"], "<f8").reshape(len(ids), -1))
        if heaps:
            yield heaps.rows()

    return run


def nearest(vectors: DataFrame, queries: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query, ties to the smaller id.

    vectors: vec_id, embedding; queries: a condition on its columns.  A query's
    own id is no candidate.  Rows with a null id, or a vector that is null, zero or
    has null or non-finite components, take no part; vectors of different lengths
    are not compared.  Rows that repeat an id count once, by their least vector.
    All candidates are returned if there are fewer than k.
    """
    good = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), queries.alias("asked"))
    good = good.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    good = good.groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.max("asked").alias("asked"))
    good = materialize(good.withColumn("dim", F.size("embedding")), "vectors")
    counts = {r["dim"]: (r["n"], r["q"]) for r in good.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.col("asked").cast("int")).alias("q")).collect()}
    n = max((c for c, _ in counts.values()), default=0)
    c_blocks, q_blocks = max(1, -(-n // CANDIDATE_ROWS)), max(1, -(-max((q or 0 for _, q in counts.values()), default=0) // QUERY_ROWS))
    h = F.xxhash64("vec_id")
    cut = lambda rows, m: rows.withColumn("block", F.col("dim").cast("bigint") * F.lit(1 << 32) + F.pmod(h, F.lit(m)))
    candidates = materialize(cut(good, c_blocks).groupBy("block").applyInArrow(_packed("vec_id", "embedding"), BLOCK), "candidates")
    asked = materialize(cut(good.where("asked"), q_blocks).groupBy("block").applyInArrow(_packed("vec_id", "embedding"), BLOCK), "queries")
    # a query block meets every candidate block of its dimension: an equi-join on block numbers
    meets = asked.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), "dim",
                         F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("i"))
    tiles = (meets.withColumn("block", F.col("dim").cast("bigint") * F.lit(1 << 32) + F.col("i")).join(candidates.drop("dim"), "block")
             .select("q_block", "q_ids", "q_vectors", "dim", "ids", "vectors").sortWithinPartitions("q_block"))
    found = tiles.mapInArrow(_tiles(k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
