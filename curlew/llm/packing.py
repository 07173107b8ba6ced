"""Conflict-constrained best-fit packing of documents into bins of a fixed number of tokens.

Documents are cut into pieces of at most a bin's capacity; pieces are placed longest first. Each goes to the bin with the
least room that holds it and has neither a piece of its source nor of its duplicate cluster, or to a new bin. Bins are kept
by their room; every bin carries a bitmap of its sources and one of its duplicate clusters. The search goes through the bins
in order of room, from the tightest that holds the piece, until it finds a compatible one. A tree over the rooms holds the
common bits of the source bitmaps below each node, so that rooms whose bins all have the piece's source are passed at once.

Bins are packed in shards of about `shard_pieces` pieces, dealt by a hash of id and copy; only ids, lengths, sources and
clusters are shuffled for it, never texts. A shard's size doesn't grow with the input, and neither do the numbers of sources
or clusters that a shard's bitmaps tell apart.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curlew.llm.workspace import Workspace

CAPACITY = 2048
SHARD_PIECES = 20_000


class Bins:
    """Bins by room 0..capacity, searched from a given room up."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.everything = -1  # all bits set: no bins below
        self.common = [self.everything] * (2 * self.leaves)
        self.by_room: list[dict[int, list[int]]] = [{} for _ in range(self.leaves)]  # room -> source bitmap -> bins
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.room: list[int] = []

    def _update(self, room: int) -> None:
        common = self.common
        now = self.everything
        for bitmap in self.by_room[room]:
            now &= bitmap
        node = self.leaves + room
        while node and common[node] != now:
            common[node] = now
            node >>= 1
            now = common[2 * node] & common[2 * node + 1]

    def put(self, b: int) -> None:
        room, bitmap = self.room[b], self.sources[b]
        bins = self.by_room[room].get(bitmap)
        if bins is None:
            self.by_room[room][bitmap] = [b]
            self._update(room)
        else:
            insort(bins, b)

    def take(self, b: int) -> None:
        room, bitmap = self.room[b], self.sources[b]
        bins = self.by_room[room][bitmap]
        del bins[bisect_left(bins, b)]
        if not bins:
            del self.by_room[room][bitmap]
            self._update(room)

    def next_room(self, room: int, source: int) -> int:
        """The least room of at least `room` with a bin that lacks the source bit, or -1."""
        node = self.leaves + room
        if not self.common[node] & source:
            return room
        while True:
            while node & 1:  # a right child: up
                node >>= 1
                if node == 0:
                    return -1
            if node <= 1:
                return -1
            node += 1
            if not self.common[node] & source:
                while node < self.leaves:
                    node = 2 * node if not self.common[2 * node] & source else 2 * node + 1
                return node - self.leaves


    def find(self, length: int, source: int, cluster: int) -> int:
        """The tightest compatible bin, the oldest of equals, or -1."""
        room = self.next_room(length, source) if length < self.leaves else -1
        while room >= 0:
            best = -1
            for bitmap, bins in self.by_room[room].items():
                if bitmap & source:
                    continue
                for b in bins:
                    if not self.clusters[b] & cluster:
                        if best < 0 or b < best:
                            best = b
                        break
            if best >= 0:
                return best
            room = self.next_room(room + 1, source) if room + 1 < self.leaves else -1
        return -1


def pack(lengths: list[int], sources: list, clusters: list, capacity: int, apart: bool = True) -> tuple[list[int], list[int]]:
    """Per piece, in the given order, its bin and its offset in it. Null sources and clusters conflict with nothing."""
    bins = Bins(capacity)
    source_bits: dict = {}
    seen: dict = {}
    for c in clusters:
        seen[c] = seen.get(c, 0) + 1
    cluster_bits: dict = {}
    where, start = [], []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        s = 0 if source is None or not apart else 1 << source_bits.setdefault(source, len(source_bits))
        # a cluster of one piece can't conflict
        c = 0 if cluster is None or seen[cluster] < 2 else 1 << cluster_bits.setdefault(cluster, len(cluster_bits))
        b = bins.find(length, s, c)
        if b < 0:
            b = len(bins.room)
            bins.room.append(capacity)
            bins.sources.append(0)
            bins.clusters.append(0)
        else:
            bins.take(b)
        where.append(b)
        start.append(capacity - bins.room[b])
        bins.room[b] -= length
        bins.sources[b] |= s
        bins.clusters[b] |= c
        bins.put(b)
    return where, start


def best_fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, apart: bool = True
) -> DataFrame:
    """(doc_id, copy, piece, piece_start, n_tokens, shard, bin, bin_start) with a row for every piece of every row of docs.

    Tokens are the words between white space; piece_start and bin_start are counted in tokens. copy numbers the rows of one id
    from 1, and equal rows of a null id. Rows with the same cluster_col, or else with the same text up to white space and case,
    are a duplicate cluster. Documents without words have one piece of no tokens, and no bin. Null ids are kept; null sources
    conflict with none.
    """
    ws = Workspace(docs.sparkSession, "packing")
    words = F.filter(F.split(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cluster = F.xxhash64(F.lower(F.array_join(words, " "))) if cluster_col is None else F.xxhash64(F.col(f"`{cluster_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), F.size(words).alias("size"), cluster.alias("cluster"))
    # equal rows are counted before they are numbered, so that an id that is repeated often stays one row until then
    same = F.xxhash64("doc_id", "source", "size", "cluster")
    grouped = rows.groupBy("doc_id", "source", "size", "cluster").agg(F.count("*").cast("int").alias("n"))
    before = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), same)).orderBy("source", "size", "cluster").rowsBetween(Window.unboundedPreceding, -1)
    grouped = grouped.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int"))
    copies = grouped.withColumn("copy", F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("n"))))
    pieces = copies.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("size") / capacity).cast("int") - 1))))
    pieces = pieces.select("doc_id", "copy", "source", "cluster", "piece", (F.col("piece") * capacity).alias("piece_start"), F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity).cast("int").alias("n_tokens"), same.alias("same"))
    pieces = ws.write(pieces, "pieces")
    shards = max(1, math.ceil(pieces.count() / shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("same", "copy", "piece"), F.lit(shards)).cast("int"))

    def shard(table: pa.Table) -> pa.Table:
        ids, tokens = table.column("doc_id").combine_chunks(), table.column("n_tokens").to_numpy()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        order = np.lexsort((table.column("same").to_numpy(), table.column("piece").to_numpy(), table.column("copy").to_numpy(), ids.fill_null(0).to_numpy(), ~known, -tokens))
        table = table.take(pa.array(order))
        full = int((tokens > 0).sum())  # pieces without tokens come last
        where, start = pack(*(table.column(c).slice(0, full).to_pylist() for c in ("n_tokens", "source", "cluster")), capacity, apart)
        none = [None] * (table.num_rows - full)
        out = table.select(["doc_id", "copy", "piece", "piece_start", "n_tokens", "shard"])
        return out.append_column("bin", pa.array(where + none, pa.int64())).append_column("bin_start", pa.array(start + none, pa.int64()))

    schema = "doc_id long, copy int, piece int, piece_start int, n_tokens int, shard int, bin long, bin_start long"
    return dealt.groupBy("shard").applyInArrow(shard, schema)


def check(rows: Iterator[dict], capacity: int) -> None:
    """Raises ValueError if a bin is over its capacity or pieces in it overlap."""
    bins: dict = {}
    for r in rows:
        if r["bin"] is not None:
            bins.setdefault((r["shard"], r["bin"]), []).append((r["bin_start"], r["n_tokens"]))
    for key, spans in bins.items():
        at = 0
        for s, n in sorted(spans):
            if s < at or s + n > capacity:
                raise ValueError(f"bin {key}: {sorted(spans)}")
            at = s + n
