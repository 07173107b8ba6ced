"""Exact top-k search by inner product with block-at-a-time pruning.

Every component x counts as the integer floor(scale * x), a weight of the term that its position is. Vectors are kept in
blocks of consecutive ids with a forward index (the block's rows) and each term's greatest and least weight in the block.
For a query, a block's bound is the sum over the terms of the query's weight times the term's extreme in the block, and no
vector of the block scores higher. A query goes through the blocks in descending order of bounds, scores a block through its forward index, and stops when the next bound
is below its kth best score. Equal scores go to the smaller id, so blocks whose bound equals the kth score are still scored.

Blocks are grouped into slabs and queries into chunks; a task searches one slab for one chunk, and a query's best of all
slabs are merged. Slabs and chunks have a fixed size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curlew.llm.embedding_dedup import matrix
from curlew.llm.workspace import Workspace

SCALE = 256
BLOCK = 256
SLAB = 8192
CHUNK = 4096


def search_slab(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query positions, positions, scores) of each query's k best in the slab, and how many (query, block) pairs were scored.

    ids are ascending; all values are integers held as doubles, whose products and sums are exact below 2**53.
    """
    cuts = np.arange(0, len(ids), block)
    most, least = np.maximum.reduceat(vectors, cuts), np.minimum.reduceat(vectors, cuts)
    bound = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
    order = np.argsort(-bound, axis=1, kind="stable")
    best = np.full((len(queries), k), -np.inf)  # ascending
    going = np.arange(len(queries))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    scored = 0
    for r in range(len(cuts)):
        now = order[going, r]
        going = going[bound[going, now] >= best[going, 0]]
        if not len(going):
            break
        now = order[going, r]
        by_block = np.argsort(now, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], now[by_block][1:] != now[by_block][:-1], [True]]))
        for a, b in zip(edges, edges[1:], strict=False):
            q = going[by_block[a:b]]
            c = now[by_block[a]]
            start, end = cuts[c], min(cuts[c] + block, len(ids))
            scores = queries[q] @ vectors[start:end].T
            scored += len(q)
            scores[ids[start:end][None] == query_ids[q][:, None]] = -np.inf
            i, j = np.nonzero((scores >= best[q, 0][:, None]) & (scores > -np.inf))
            found.append((q[i], start + j, scores[i, j]))
            both = np.concatenate([best[q], scores], axis=1)
            best[q] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)
    if not found:
        return (*(np.zeros(0, np.int64) for _ in range(3)), scored)
    q, at, score = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = score >= best[q, 0]
    q, at, score = q[keep], at[keep], score[keep]
    rank = np.lexsort((ids[at], -score, q))
    q, at, score = q[rank], at[rank], score[rank]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return q[keep], at[keep], score[keep], scored


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, query_every: int = 50, scale: int = SCALE, slab: int = SLAB, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by query_every, the k highest of all other rows.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do rows with a null id. Vectors of
    different length aren't compared. Rows that repeat an id are candidates of their own, but no candidate has its query's
    id; a repeated query id is one query, with the least of its vectors.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark, "top-k")
    values = F.col("v")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fine = values.isNotNull() & (F.size(values) > 0) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))
    total = rows.count()
    slabs = max(1, math.ceil(total / slab))
    # ranges of ids; a range's rows are numbered by its partition, so the numbers are written down
    ranged = ws.write(rows.repartitionByRange(slabs, "id").select(F.spark_partition_id().alias("slab"), F.size("v").alias("dim"), "id", "v"), "slabs")
    asked = ranged.filter(F.pmod("id", F.lit(query_every)) == 0).groupBy("id", "dim").agg(F.min("v").alias("v"))
    chunks = max(1, math.ceil(asked.count() / chunk))
    asked = asked.select(F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), "dim", "id", "v")
    everywhere = ranged.select("slab", "dim").distinct()
    seats = ranged.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).select("slab", "chunk", "dim", F.lit(False).alias("asks"), "id", "v")
    seats = seats.union(asked.join(everywhere, "dim").select("slab", "chunk", "dim", F.lit(True).alias("asks"), "id", "v"))

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        ids = table.column("id").to_numpy()
        own, ask = np.flatnonzero(~asks), np.flatnonzero(asks)
        own = own[np.argsort(ids[own], kind="stable")]
        q = at = score = np.zeros(0, np.int64)
        if len(own) and len(ask):
            x = matrix(table.column("v"))
            q, at, score, _ = search_slab(ids[own], x[own], ids[ask], x[ask], k)
        return pa.table({"query_id": pa.array(ids[ask][q], pa.int64()), "vec_id": pa.array(ids[own][at], pa.int64()), "score": pa.array(score.astype(np.int64), pa.int64())})

    found = seats.groupBy("slab", "chunk", "dim").applyInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH good AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
