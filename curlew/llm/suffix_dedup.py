"""Exact substring dedup: cut every byte that lies in a `length`-byte string which also starts earlier in the corpus.

Method: suffix arrays of shards by induced sorting, with permuted common prefixes (suffix.py). Suffixes that share `length`
bytes are neighbours in the array; in each such run all but the earliest start are repeats.

How strings are dealt to shards. Every `length`-byte window has an anchor: its leftmost least-hashed 32-byte piece. Equal
windows have equal anchors, so all windows around the same anchor go to one shard, as one segment of text. Only segments
whose anchor occurs in different surroundings reach a suffix array. Segments that are equal as a whole are settled before:
all but the earliest are repeats, first within a task, then over all tasks, so that copies and common passages are dealt
once a task at most.

What is open then is mostly text that shares an anchor and nothing more, and grows faster than the corpus. Its bytes are kept
as runs, and cut and settled once more by pieces of four fifths of the length; only segments of that second cut whose piece occurs
in different surroundings reach a suffix array. Windows of such a piece with very many different segments are dealt one by one,
by their own hash.

Texts are UTF-8 bytes, null counts as empty, and matches never cross documents. The order is by id, then by start. Rows with
a null id come back uncut and cut nothing else. Equal rows under one id are one document and get the same result; different texts
under one id are documents of their own, in the order of a hash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm import suffix, textbytes
from curlew.llm.workspace import Workspace, bounded_batches
from curlew.operators.splits import global_sums, range_bucket

PIECE_BYTES = 32
CHUNK = 1 << 19
HELD = 1 << 21
FEW = 8192
SHARD_BYTES = 1 << 21

SEGMENT = "kind byte, key long, seg long, doc long, lo long, cnt long"
RUNS = "doc long, at array<long>, size array<long>, data binary"


def _segments_of(data: np.ndarray, offsets: np.ndarray, length: int, piece: int = PIECE_BYTES) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, segment hash, row, first window's start in the row, windows) for all windows of the rows."""
    width = length - piece + 1
    ends = offsets[1:]
    for c in range(0, max(0, len(data) - length + 1), CHUNK):
        e = min(c + CHUNK, len(data) - length + 1)
        part = data[c : e + length - 1]
        p = textbytes.prefix_hash(part)
        _, down = textbytes.powers(len(part))
        m = len(part) - piece + 1
        pieces = textbytes.mix((p[piece:] - p[:-piece]) * down[:m])
        least = (pieces & ~np.uint64((1 << 20) - 1)) | np.arange(m, dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        least = np.minimum(least[: e - c], least[width - size : width - size + e - c])
        anchor = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        row = np.searchsorted(ends, np.arange(c, e), "right")
        whole = np.arange(c, e) + length <= ends[row]
        breaks = np.ones(e - c, bool)
        breaks[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(whole)
        if not len(at):
            continue
        # windows of a row that are whole come before those that are not
        firsts = np.flatnonzero(breaks[at] | np.concatenate([[True], at[1:] != at[:-1] + 1]))
        lo = at[firsts]
        hi = at[np.concatenate([firsts[1:], [len(at)]]) - 1]
        seg = textbytes.mix((p[hi + length] - p[lo]) * down[lo] + (hi - lo).astype(np.uint64))
        yield pieces[anchor[lo]], seg, row[lo], lo + c - offsets[row[lo]], hi - lo + 1


def _merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans joined where they touch or overlap within a document."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    ids = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])
    reach = int(end.max()) + 1
    far = np.maximum.accumulate(end + ids * reach) - ids * reach
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > far[:-1])
    firsts = np.flatnonzero(new)
    return doc[firsts], start[firsts], far[np.concatenate([firsts[1:], [len(doc)]]) - 1]


def _batch(kind: int, key: np.ndarray, seg: np.ndarray, doc: np.ndarray, lo: np.ndarray, cnt: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(doc), kind, np.int8)), *(pa.array(x.astype(np.int64)) for x in (key, seg, doc, lo, cnt))],
        names=["kind", "key", "seg", "doc", "lo", "cnt"],
    )


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    doc, start, end = _merge(doc, start, end)
    return _batch(1, textbytes.mix(doc.astype(np.uint64)).view(np.int64), np.zeros(len(doc)), doc, start, end)


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Rows (doc, text): documents, where in them the strings start, the strings' bytes and offsets. Null ids are left out."""
    known = batch.column(0).is_valid()
    if not known.to_numpy(zero_copy_only=False).all():
        batch = batch.filter(known)
    return batch.column(0).to_numpy(), np.zeros(batch.num_rows, np.int64), *textbytes.text_buffer(batch.column(1))


def _flat(lists: pa.Array, *fields: str) -> tuple[np.ndarray, ...]:
    """Bounds of the rows' lists, and their values: those of the fields, if they are structs."""
    bounds = lists.offsets.to_numpy()
    values = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
    return bounds - bounds[0], *((values.field(f) if f else values).to_numpy(zero_copy_only=False) for f in fields or ("",))


def _runs(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """The same of rows of RUNS."""
    bounds, at = _flat(batch.column(1))
    _, size = _flat(batch.column(2))
    data, _ = textbytes.text_buffer(batch.column(3))
    return np.repeat(batch.column(0).to_numpy(), np.diff(bounds)), at, data, np.concatenate([[0], np.cumsum(size)])


def _cut_segments(length: int, piece: int, strings=_texts):
    """Task: kind 0, the earliest of each different segment of the task; kind 1, spans (lo to cnt) of those that follow it."""

    def settle(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        key, seg, doc, lo, cnt = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((lo, doc, seg))
        key, seg, doc, lo, cnt = key[order], seg[order], doc[order], lo[order], cnt[order]
        new = np.ones(len(seg), bool)
        new[1:] = (seg[1:] != seg[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = ~new & ((doc != doc[first]) | (lo != lo[first]))
        for a in range(0, int(new.sum()), 1 << 17):
            x = np.flatnonzero(new)[a : a + (1 << 17)]
            yield _batch(0, key[x], seg[x], doc[x], lo[x], cnt[x])
        if later.any():
            yield _spans(doc[later], lo[later], lo[later] + cnt[later] - 1 + length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids, at, data, offsets = strings(batch)
            for key, seg, row, lo, cnt in _segments_of(data, offsets, length, piece):
                held.append((key.view(np.int64), seg.view(np.int64), ids[row], at[row] + lo, cnt))
                n += len(key)
                if n > HELD:
                    yield from settle(held)
                    held, n = [], 0
        if held:
            yield from settle(held)

    return run


def _meet_segments(length: int):
    """Task: rows sorted by (kind, key, seg, doc, lo). Spans pass; equal segments after the first become spans; of the anchors
    with two or more different segments, the earliest of each stays as kind 0 with a part number in seg."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, seg, doc, lo of the earliest of the last segment
        alone = None  # the only segment so far of the last anchor
        count = 0  # its segments so far
        for batch in batches:
            kind, *columns = (batch.column(x).to_numpy() for x in range(6))
            if (kind == 1).any():
                key, seg, doc, lo, cnt = (x[kind == 1] for x in columns)
                yield _batch(1, key, seg, doc, lo, cnt)
            key, seg, doc, lo, cnt = (x[kind == 0] for x in columns)
            if not len(key):
                continue
            if last is not None:
                key, seg, doc, lo = (np.concatenate([[a], b]) for a, b in zip(last, (key, seg, doc, lo), strict=True))
                cnt = np.concatenate([[0], cnt])
            new = np.ones(len(key), bool)
            new[1:] = (seg[1:] != seg[:-1]) | (key[1:] != key[:-1])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = ~new & ((doc != doc[first]) | (lo != lo[first]))
            if later.any():
                yield _spans(doc[later], lo[later], lo[later] + cnt[later] - 1 + length)
            f = int(first[-1])
            carried = last is not None
            last = (key[f], seg[f], doc[f], lo[f])
            firsts = np.flatnonzero(new)[1 if carried else 0 :]
            if not len(firsts):
                continue
            k = key[firsts]
            change = np.ones(len(k), bool)
            change[1:] = k[1:] != k[:-1]
            goes_on = carried and k[0] == key[0]
            group = np.cumsum(change) - 1
            index = np.arange(len(k)) - np.flatnonzero(change)[group] + np.where((group == 0) & goes_on, count, 0)
            sizes = np.bincount(group)
            if goes_on:
                sizes[0] += count
            keep = sizes[group] > 1
            if goes_on and alone is not None:
                yield _batch(0, *(np.array([x]) for x in alone))
            if keep.any():
                x = firsts[keep]
                yield _batch(0, k[keep], index[keep] // FEW, doc[x], lo[x], cnt[x])
            count = int(sizes[-1])
            x = firsts[-1]
            alone = (key[x], 0, doc[x], lo[x], cnt[x]) if count == 1 else None

    return run


def _open_runs(length: int):
    """Task: (doc, text, segments (lo, cnt)) -> RUNS, the bytes of a text's open segments; those that follow each other are one run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textbytes.text_buffer(batch.column(1))
            bounds, lo, cnt = _flat(batch.column(2), "lo", "cnt")
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            order = np.lexsort((lo, row))
            row, lo, end = row[order], lo[order], (lo + cnt)[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (lo[1:] != end[:-1])
            firsts = np.flatnonzero(new)
            row, lo, end = row[firsts], lo[firsts], end[np.append(firsts[1:], len(new)) - 1] - 1 + length
            size = np.minimum(end, np.diff(offsets)[row]) - lo
            row, lo, size = (x[size >= length] for x in (row, lo, size))
            start, view = offsets[row] + lo, memoryview(data)
            kept = b"".join([view[a:b] for a, b in zip(start.tolist(), (start + size).tolist(), strict=True)])
            parts = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            upto = np.concatenate([[0], np.cumsum(size)])[parts].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.ListArray.from_arrays(pa.array(parts), pa.array(x.astype(np.int64))) for x in (lo, size)),
                    pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(upto), pa.py_buffer(kept)]),
                ],
                names=["doc", "at", "size", "data"],
            )

    return run


def _slices(length: int, shards: int):
    """Task: (shard, doc, lo, bytes) of the segments of each row of RUNS; those of crowded anchors window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            _, at, data, offsets = _runs(batch)
            runs, _ = _flat(batch.column(1))
            bounds, key, lo, cnt, crowded = _flat(batch.column(4), "key", "lo", "cnt", "crowded")
            out: list[tuple] = []
            held = 0
            for q in range(len(ids)):
                own = runs[q] + np.searchsorted(at[runs[q] : runs[q + 1]], lo[bounds[q] : bounds[q + 1]], "right") - 1
                starts = offsets[own] + lo[bounds[q] : bounds[q + 1]] - at[own]
                for s in range(bounds[q], bounds[q + 1]):
                    start = starts[s - bounds[q]]
                    part = data[start : start + cnt[s] - 1 + length]
                    if crowded[s]:
                        p = textbytes.prefix_hash(part)
                        _, down = textbytes.powers(len(part))
                        windows = textbytes.mix((p[length:] - p[:-length]) * down[: len(part) - length + 1])
                        out += [(int(w % np.uint64(shards)), ids[q], lo[s] + x, part[x : x + length].tobytes()) for x, w in enumerate(windows)]
                    else:
                        out.append((int(np.uint64(key[s].view(np.uint64)) % np.uint64(shards)), ids[q], lo[s], part.tobytes()))
                    held += len(part)
                    if held > 1 << 22:
                        yield _sliced(out)
                        out, held = [], 0
            yield _sliced(out)

    return run


def _sliced(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.binary())],
        names=["shard", "doc", "lo", "bytes"],
    )


def repeats(docs: np.ndarray, starts: np.ndarray, strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of the windows that equal an earlier one; the strings come in order of (doc, start)."""
    sizes = np.array([len(s) for s in strings])
    where = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.full(where[-1] + 1, suffix.SEPARATOR, np.int64)
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    text[:-1] = raw.astype(np.int64) + 2
    text[where[1:] - 1] = suffix.SEPARATOR
    text[-1] = suffix.END
    order = suffix.suffix_array(text, length)
    data = np.concatenate([raw, np.zeros(1, np.uint8)])
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    inside = np.concatenate([np.arange(where[-1]) + length < where[1:][owner], [False]])  # the window ends before its separator
    prefixes = suffix.shared_prefixes(data, order, length)
    order = order[inside[order]]
    same = np.zeros(len(order), bool)
    # between two windows with a common prefix of this length stand only windows that have it too
    same[1:] = prefixes[order[1:]] >= length
    runs = np.cumsum(~same) - 1
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    earliest = np.minimum.reduceat(order, np.flatnonzero(~same))
    later = order[order != earliest[runs]]
    return docs[owner[later]], starts[owner[later]] + later - where[:-1][owner[later]]


def _sort_shards(length: int):
    """Task: rows sorted by (shard, doc, lo) -> spans of repeats."""

    def one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        doc, lo = table.column("doc").to_numpy(), table.column("lo").to_numpy()
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] != lo[:-1])
        strings = [s for s, x in zip(table.column("bytes").to_pylist(), new.tolist(), strict=True) if x]
        d, s = repeats(doc[new], lo[new], strings, length)
        return _spans(d, s, s + length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if held and shard[a] != now:
                    yield one(held)
                    held = []
                now = shard[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield one(held)

    return run


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textbytes.text_buffer(batch.column(1))
            lists = batch.column(2)
            spans = lists.to_pylist()
            size, removed, runs, digests, kept = [], [], [], [], []
            for q in range(batch.num_rows):
                text = data[offsets[q] : offsets[q + 1]].tobytes()
                found = spans[q] or []
                start = np.array([s["s"] for s in found], np.int64)
                end = np.minimum(np.array([s["e"] for s in found], np.int64), len(text))
                _, start, end = _merge(np.zeros(int((start < end).sum()), np.int64), start[start < end], end[start < end])
                left, at = [], 0
                for s, e in zip(start.tolist(), end.tolist(), strict=True):
                    left.append(text[at:s])
                    at = e
                left = b"".join([*left, text[at:]])
                size.append(len(text))
                removed.append(len(text) - len(left))
                runs.append(len(start))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_text else None)
            columns = [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _met(ws: Workspace, cut: DataFrame, length: int, name: str) -> DataFrame:
    """Segments of all tasks -> spans (kind 1), and the open segments (kind 0)."""
    return ws.write(cut.repartition("key").sortWithinPartitions("kind", "key", "seg", "doc", "lo").mapInArrow(_meet_segments(length), SEGMENT), name)


def repeated_spans(docs: DataFrame, ws: Workspace, length: int = 100) -> DataFrame:
    """docs (doc long, text string) -> (doc, s, e): byte spans that repeat earlier strings; spans may touch or overlap."""
    found = _met(ws, docs.mapInArrow(_cut_segments(length, PIECE_BYTES), SEGMENT), length, "met")
    asked = found.filter("kind = 0").groupBy("doc").agg(F.collect_list(F.struct("lo", "cnt")).alias("asked"))
    runs = ws.write(docs.join(asked, "doc").select("doc", "text", "asked").mapInArrow(_open_runs(length), RUNS), "runs")
    again = _met(ws, runs.mapInArrow(_cut_segments(length, max(PIECE_BYTES, length * 4 // 5), _runs), SEGMENT), length, "met-again")
    open_segments = again.filter("kind = 0").select("key", F.col("seg").alias("part"), "doc", "lo", "cnt")
    crowds = open_segments.filter("part > 0").select("key").distinct().withColumn("crowded", F.lit(True))
    marked = open_segments.join(crowds, "key", "left").select("key", "doc", "lo", "cnt", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    size = marked.agg(F.sum(F.when(F.col("crowded"), F.col("cnt") * (length + 1)).otherwise(F.col("cnt") + length))).first()[0] or 0
    shards = max(1, math.ceil(size / SHARD_BYTES))
    asked = marked.groupBy("doc").agg(F.collect_list(F.struct("key", "lo", "cnt", "crowded")).alias("asked"))
    slices = runs.join(asked, "doc").select("doc", "at", "size", "data", "asked").mapInArrow(_slices(length, shards), "shard int, doc long, lo long, bytes binary")
    sorted_ = slices.repartition("shard").sortWithinPartitions("shard", "doc", "lo").mapInArrow(_sort_shards(length), SEGMENT)
    both = found.filter("kind = 1").union(again.filter("kind = 1")).union(sorted_)
    return ws.write(both.select("doc", F.col("lo").alias("s"), F.col("cnt").alias("e")), "spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of docs; with_text adds the bytes that are left."""
    bounded_batches(docs.sparkSession)
    ws = Workspace(docs.sparkSession, "suffix-dedup")
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = _numbered(docs, ws)
    spans = repeated_spans(docs.select("doc", "text"), ws, length).groupBy("doc").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return docs.join(spans, "doc", "left").select("id", "text", "spans").mapInArrow(_cut(with_text), schema)


def _numbered(docs: DataFrame, ws: Workspace) -> DataFrame:
    """docs (id, text) with doc: the id, or, where an id has different texts, numbers in the order of ids that tell these apart."""
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    several = docs.filter("id is not null").groupBy("id").agg(F.min(hashed).alias("a"), F.max(hashed).alias("b")).filter("a <> b")
    if several.isEmpty():
        return docs.withColumn("doc", F.col("id"))
    marked = docs.withColumn("h", hashed)
    ids = ws.write(marked.filter("id is not null").select("id", "h").distinct(), "ids")
    ranked = ws.write(global_sums(ids, ["id", "h"], F.lit(1), "doc", range_bucket(ids, "id")), "numbers")
    return marked.join(ranked, ["id", "h"], "left").select("id", "text", F.col("doc").cast("long"))
