"""Exact nearest neighbours by a block matrix join: int8 tile products, error bounds, float recomputation, heaps.

Queries and candidates are dealt to a grid of blocks of bounded size; a tile is one query block against one
candidate block of vectors of equal length. A candidate is sent once for each query block, so these are large, as many
rows as a worker's memory takes; a tile is worked off in strips. Every vector v is v' + e with v' = scale * int8. The integer product q'.c' is
computed for the whole tile; |q.c - q'.c'| <= |q'| |e_c| + |e_q| |c| bounds its error. A pair survives if
its upper bound reaches the k-th best lower bound of its query so far, which loses no true neighbour.
Survivors are recomputed in double precision from the original vectors; a tile sends the k best of each
query, and the final merge ranks the tiles' heaps. The answer equals brute force, so recall is 1.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .vectors import matrix

#: Bytes of a query block's vectors in double precision, and rows of a block of candidates. Each block of queries costs a copy
#: of the candidates: 64 numbers a vector make 131,072 rows, so 1e8 candidates and 5e6 queries are sent 39 times.
QUERY_BYTES = 64 << 20
CANDIDATE_BLOCK = 16384
STRIP = 2048


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes as float32, scale, norm of the coded vector, norm of the error) of each row."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    codes = np.rint(x / scale[:, None])
    coded = codes * scale[:, None]
    return (
        codes.astype(np.float32 if x.shape[1] * 127**2 < 1 << 24 else np.float64),  # sums of products are exact
        scale,
        np.linalg.norm(coded, axis=1),
        np.linalg.norm(x - coded, axis=1),
    )


def tile_top(
    q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int
) -> list[tuple[int, int, float]]:
    """The k best candidates of each query in one tile: (query, candidate, score)."""
    if not len(q_ids) or not len(c_ids):
        return []
    out = []
    for at in range(0, len(q_ids), STRIP):
        out += strip_top(q_ids[at : at + STRIP], q[at : at + STRIP], c_ids, c, k)
    return out


def strip_top(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    q_codes, q_scale, q_norm, q_err = quantise(q)
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]
    floor = np.full(len(q_ids), -np.inf)
    for at in range(0, len(c_ids), STRIP):
        part, ids = c[at : at + STRIP], c_ids[at : at + STRIP]
        c_codes, c_scale, _, c_err = quantise(part)
        c_norm = np.linalg.norm(part, axis=1)
        approx = (q_codes @ c_codes.T).astype(np.float64) * q_scale[:, None] * c_scale[None, :]
        # a little more for rounding in double precision
        bound = (q_norm[:, None] * c_err[None, :] + q_err[:, None] * c_norm[None, :]) * (1 + 1e-9) + 1e-12
        own = q_ids[:, None] == ids[None, :]
        lower = np.where(own, -np.inf, approx - bound)
        if lower.shape[1] > k:
            kth = -np.partition(-lower, k - 1, axis=1)[:, k - 1]
            cut = np.maximum(floor, kth)
        else:
            cut = floor
        for i, j in enumerate(((approx + bound >= cut[:, None]) & ~own)):
            js = np.flatnonzero(j)
            if not len(js):
                continue
            scores = np.add.accumulate(part[js] * q[i], axis=1)[:, -1]  # from the first component to the last
            heap = heaps[i]
            if len(js) > k:
                best = np.lexsort((ids[js], -scores))[:k]
                js, scores = js[best], scores[best]
            for s, v in zip(scores.tolist(), ids[js].tolist()):
                item = (s, -v)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
            if len(heap) == k:
                floor[i] = heap[0][0]
    return [(int(q_ids[i]), -v, s) for i, heap in enumerate(heaps) for s, v in heap]


def nearest(
    spark: SparkSession,
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 20,
    query_block: int | None = None,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest candidates of each query by inner product.

    Inputs have ``vec_id`` and ``embedding``. Null, zero or non-finite vectors and rows of null id take no
    part; a candidate with the query's own id is left out; ties go to the smaller vec_id; with fewer
    candidates than k all are returned. A query meets the candidates of its own length. Rows that repeat an id are
    candidates each. An empty side gives no row. Other columns are ignored.
    """
    q = queries.select("vec_id", "embedding").where("vec_id is not null and size(embedding) > 0")
    c = candidates.select("vec_id", "embedding").where("vec_id is not null and size(embedding) > 0")
    n_q, longest = q.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    n_c = c.count()
    query_block = query_block or max(STRIP, QUERY_BYTES // (8 * (longest or 1)))
    rows, cols = max(1, math.ceil(n_q / query_block)), max(1, math.ceil(n_c / candidate_block))
    cols = max(cols, min(6, math.ceil(n_c / STRIP)))
    q_block = F.pmod(F.xxhash64("vec_id"), F.lit(rows)).cast("int")
    c_block = F.pmod(F.xxhash64("vec_id"), F.lit(cols)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sent = q.select("*", q_block.alias("r"), F.lit(True).alias("is_query")).select("*", every(cols).alias("s")).unionByName(
        c.select("*", c_block.alias("s"), F.lit(False).alias("is_query")).select("*", every(rows).alias("r"))
    )
    tile = (F.col("r").cast("long") * cols + F.col("s")).alias("tile")
    sent = sent.select(tile, F.size("embedding").alias("width"), "is_query", "vec_id", "embedding")

    def step(table: pa.Table) -> pa.Table:
        kept, x = matrix(table["embedding"])
        ids = table["vec_id"].to_numpy()[kept]
        is_q = table["is_query"].to_numpy(zero_copy_only=False)[kept].astype(bool)
        found = tile_top(ids[is_q], x[is_q], ids[~is_q], x[~is_q], k) if len(kept) else []
        a, b, s = zip(*found) if found else ([], [], [])
        return pa.table(
            {"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(s, pa.float64())}
        )

    heaps = sent.groupBy("tile", "width").applyInArrow(step, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op7_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 20 against all others, 20 nearest each."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(spark, vectors.where("vec_id % 20 = 0"), vectors)
