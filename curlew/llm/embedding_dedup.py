"""Embedding near-dedup: all pairs of vectors with a cosine of at least `threshold`, in double precision.

Method: int8 quantised tile products. A unit vector x is s * q + e with int8 q; the norm of e is computed for each vector, so
that |cos(x, y) - s_x s_y q_x . q_y| has a rigorous bound per pair. Products of int8 tiles are exact integers; only pairs
that may reach the threshold under the bound are computed again in double precision.

Which tiles. Equal vectors are collapsed first and counted, so that a group of copies costs one row. Vectors are assigned to
their nearest of a bounded number of pivots. If x is nearest to p and y to q and their angle is at most d, then the angle of
x and q is at most that of x and p plus 2 d: so x has to meet the vectors of q only then, and otherwise the pair is ruled
out exactly. Whether cells rule out enough is measured on a bounded sample; where they don't, all vectors are one cell, so that
none is written once a cell. Each pair of cells is cut into tiles of about `tile` rows a side, to which vectors go as bytes of the
type that they came in. Vectors without such structure all meet; then the work is that of all pairs, in tiles whose size doesn't grow.

A tile returns, for its linked vectors only, how many they link with and the least member of their connected part of the
tile, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.llm.components import connected_components
from curlew.llm.workspace import Workspace

THRESHOLD = 0.95
TILE = 8192
MOST_PIVOTS = 256
SAMPLE = 2048
WORTH = 0.25
SLACK = 1e-7


def usable(vector: Column) -> Column:
    """Not null, not empty, without null, NaN or infinite components, and not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose rows are equally long, as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows -> int8 values (as float32 for exact products), scales, and bounds on the norms of what is left."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None])
    rest = np.linalg.norm(x - q * scale[:, None], axis=1) + SLACK
    return q.astype(np.float32), scale, rest


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows of int8 values: sums of 1024 products stay below 2**24."""
    if a.shape[1] <= 1024:
        return (a @ b.T).astype(np.float64)
    return sum((a[:, k : k + 1024] @ b[:, k : k + 1024].T).astype(np.float64) for k in range(0, a.shape[1], 1024))


def links(x: np.ndarray, y: np.ndarray, same: bool, threshold: float, strip: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of x, j of y) with a cosine of at least the threshold; with same, i < j."""
    qx, sx, ex = quantise(x)
    qy, sy, ey = (qx, sx, ex) if same else quantise(y)
    found_i, found_j = [], []
    for a in range(0, len(x), strip):
        s = slice(a, a + strip)
        near = products(qx[s], qy) * sx[s, None] * sy
        # the quantised vectors' norms are at most 1 + rest
        near += (1 + ex[s])[:, None] * ey + ex[s][:, None] * (1 + ey) + ex[s][:, None] * ey + SLACK
        i, j = np.nonzero(near >= threshold)
        i = i + a
        if same:
            i, j = i[i < j], j[i < j]
        for b in range(0, len(i), 1 << 16):
            p, q = i[b : b + (1 << 16)], j[b : b + (1 << 16)]
            exact = np.einsum("nd,nd->n", x[p], y[q]) >= threshold
            found_i.append(p[exact])
            found_j.append(q[exact])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(found_i or empty), np.concatenate(found_j or empty)


def least_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of nodes 0..n-1 the least one that each reaches by the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _tile(threshold: float, kind: str):
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        order = np.lexsort((table.column("rep").to_numpy(), side))
        table = table.take(pa.array(order))
        side, rep, copies = side[order], table.column("rep").to_numpy(), table.column("copies").to_numpy()
        x = unit(np.frombuffer(b"".join(table.column("vector").to_pylist()), kind).reshape(len(rep), -1).astype(np.float64))
        same = side[0] == side[-1]
        cut = 0 if same else int(np.searchsorted(side, 1))
        if same and not table.column("own")[0].as_py():  # a side whose partners have no rows in this tile
            i = j = np.zeros(0, np.int64)
        else:
            i, j = links(x if same else x[:cut], x if same else x[cut:], same, threshold)
            j = j + cut
        n = len(rep)
        count = np.bincount(i, copies[j], minlength=n) + np.bincount(j, copies[i], minlength=n)
        rank = np.argsort(np.argsort(rep, kind="stable"), kind="stable")
        root = np.sort(rep)[least_reached(n, rank[i], rank[j])][rank]
        has = np.flatnonzero(count)
        return pa.table({"rep": pa.array(rep[has]), "links": pa.array(count[has].astype(np.int64)), "root": pa.array(root[has])})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE, most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing and are their own component.
    Vectors of different length don't link. Rows that repeat an id with the same vector are its copies; different vectors under one id count as linked
    through the id where it is the first of both. Rows with a null id link with nothing and have null in component_id and kept.
    """
    ws = Workspace(vectors.sparkSession, "embedding-dedup")
    kind = "<f4" if "float" in vectors.schema[vector_col].dataType.simpleString() else "<f8"
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    good = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    # adding zero turns -0.0 into 0.0, so that equal vectors have equal hashes
    good = good.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))).withColumn("key", F.sha2(F.concat_ws(",", F.transform("vector", lambda x: x.cast("string"))), 256))
    classes = ws.write(good.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("copies"), F.first("vector").alias("vector")), "classes")
    classes = classes.withColumnRenamed("first", "rep")
    total = classes.count()
    dims = [r["d"] for r in classes.select(F.size("vector").alias("d")).distinct().collect()]

    parts = []
    for dim in dims:
        own = classes.filter(F.size("vector") == dim)
        wanted = max(1, min(most_pivots, total // tile))
        some = unit(np.array([r["vector"] for r in own.orderBy(F.xxhash64("key"), "key").limit(wanted + (SAMPLE if wanted > 1 else 0)).collect()], float))
        pivots = some[:wanted]
        if len(some) > wanted and visits(some[wanted:], pivots, threshold)[1].sum() > WORTH * wanted * (len(some) - wanted):
            pivots = some[:1]
        parts.append(_cells(own.select("rep", "copies", "vector"), pivots, dim, threshold, kind))
    if not parts:
        met = ws.write(classes.select("rep", F.col("copies").alias("links"), F.col("rep").alias("root")).limit(0), "tiles")
    else:
        cells = parts[0]
        for p in parts[1:]:
            cells = cells.union(p)
        cells = ws.write(cells, "cells")
        # rows of home that meet visit: a bounded table of pivots by pivots, and its cuts into tiles
        cuts = cells.groupBy("dim", "home", "visit").agg(F.ceil(F.count("*") / tile).cast("int").alias("cuts"))
        table = cells.join(F.broadcast(cuts), ["dim", "home", "visit"])
        back = cuts.select("dim", F.col("home").alias("visit"), F.col("visit").alias("home"), F.col("cuts").alias("facing"))
        table = table.join(F.broadcast(back), ["dim", "home", "visit"])
        part = F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int")
        seats = table.withColumn("own_part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("facing") - 1)))
        inner = F.col("home") == F.col("visit")
        lower = F.col("home") < F.col("visit")
        seats = seats.select(
            "dim", F.least("home", "visit").alias("p"), F.greatest("home", "visit").alias("q"),
            F.when(inner, F.least("own_part", "other")).when(lower, F.col("own_part")).otherwise(F.col("other")).alias("s"),
            F.when(inner, F.greatest("own_part", "other")).when(lower, F.col("other")).otherwise(F.col("own_part")).alias("t"),
            F.when(inner, (F.col("own_part") > F.col("other")).cast("int")).otherwise((~lower).cast("int")).alias("side"),
            (inner & (F.col("own_part") == F.col("other"))).alias("own"), "rep", "copies", "vector",
        )
        met = ws.write(seats.groupBy("dim", "p", "q", "s", "t").applyInArrow(_tile(threshold, kind), "rep long, links long, root long"), "tiles")
        ws.drop(cells)
    component = connected_components(ws, met.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    counted = met.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.select("key", "rep", "copies").join(counted, "rep", "left").join(component, classes["rep"] == component["node"], "left")
    known = known.select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"))
    keyed = rows.withColumn("fine", F.col("id").isNotNull() & usable(F.col("vector")))
    keyed = keyed.select("id", F.when(F.col("fine"), F.sha2(F.concat_ws(",", F.transform("vector", lambda x: (x + F.lit(0.0)).cast("string"))), 256)).alias("key"))
    out = keyed.join(known, "key", "left").select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def visits(x: np.ndarray, pivots: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Per unit vector its nearest pivot, and which pivots' cells it has to meet."""
    reach = 2 * math.acos(max(-1.0, min(1.0, threshold))) + 1e-6
    angle = np.arccos(np.clip(x @ pivots.T, -1, 1))
    home = angle.argmin(1)
    return home, angle <= angle[np.arange(len(x)), home][:, None] + reach


def _cells(own: DataFrame, pivots: np.ndarray, dim: int, threshold: float, kind: str) -> DataFrame:
    """A row for each vector and each cell that it has to meet, its own among them; vectors as bytes."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            vectors = matrix(batch.column(2))
            home, meets = visits(unit(vectors), pivots, threshold)
            at, visit = np.nonzero(meets)
            raw = pa.array([v.tobytes() for v in vectors.astype(kind)], pa.binary())
            for a in range(0, len(at), 4096):
                x = at[a : a + 4096]
                took = batch.take(pa.array(x))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), dim, np.int32)), pa.array(home[x].astype(np.int32)), pa.array(visit[a : a + 4096].astype(np.int32)), took.column(0), took.column(1), raw.take(pa.array(x))],
                    names=["dim", "home", "visit", "rep", "copies", "vector"],
                )

    return own.mapInArrow(run, "dim int, home int, visit int, rep long, copies long, vector binary")


ORACLE = """
WITH RECURSIVE good AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
linked AS (SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(vec_id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.v FROM reach r JOIN linked l ON l.u = r.c),
least AS (SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM linked WHERE u = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM least
"""
