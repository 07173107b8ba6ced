"""N-gram Jaccard join: documents whose sets of k-word shingles have a Jaccard similarity of at least `num / den`.

Method: a count-vector R-tree. The shingles of a document are hashed into groups; the counts per group are a point; the sum
of coordinate minima bounds the overlap of two sets, and of a set with every set below a tree node. Pairs that survive the
bound are verified on the whole sets.

How the trees are dealt to tasks. One tree over all documents can't be split without reading most of it for each query, so
each tree holds documents that have rare shingles in common. If shingles are put in one order for all documents, two linked
sets share one among the first n - ceil(n * num / den) + 1 of each, so nothing is lost. The order is by counts over all
documents in a fixed number of buckets, so that passages which many documents share come last. A tenth of the set more is
dealt, so that a set has to share about a fourteenth of its shingles there to be linked with any: what only quotes a common
passage drops out before the trees.

Groups of copies. Exact copies of a set link to their first document and go no further. In a group with a common rare
shingle each member is first compared with one group's first member only; what is linked is then one component, and the trees
look for pairs between components. A group of near copies therefore costs as many comparisons as it has members.
Shingles that a large share of the documents has are counted beforehand and dealt to several tasks (salted).

Rows with the same id count as one document that holds every text given for it. Null ids link with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curlew.llm import rtree, textbytes
from curlew.llm.components import connected_components
from curlew.llm.workspace import Workspace, bounded_batches

BUCKETS = 1 << 21
BLOCK = 512
MORE = 10
FEW_TARGETS = 50_000
CROWD = 4096
CROWDS_FEW = 100_000


def _first_of_sets(h: np.ndarray, bounds: np.ndarray, seen: set[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: two sums that identify the set, and whether this task sees the set for the first time; rows that aren't known
    neither see nor count."""
    sums = []
    for factor in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textbytes.mix(h * np.uint64(factor)), dtype=np.uint64)])
        sums.append(total[bounds[1:]] - total[bounds[:-1]])
    a, b = sums
    new = np.zeros(len(a), bool)
    for x, key in enumerate(np.column_stack([a, b]).astype(np.uint64)):
        if bounds[x] < bounds[x + 1] and (known is None or known[x]) and (key := key.tobytes()) not in seen:
            seen.add(key)
            new[x] = True
    return a.view(np.int64), b.view(np.int64), new


def _describe(k: int, share: float):
    """Task: a row for each document with its set's size, identity and count vector; at the end the counts of the buckets that are
    fuller than by chance, and the shingles that more than `share` of the task's documents have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, often, docs, total = np.zeros(BUCKETS, np.int64), {}, 0, 0
        for batch in batches:
            ids = batch.column(0)
            recent, at = [], 0
            for i, j, h, r, bounds in textbytes.shingle_sets(batch.column(1), k):
                n = np.diff(bounds)
                a, b, _ = _first_of_sets(h, bounds, set())
                vectors = rtree.counts(h, bounds)
                buckets += np.bincount((h & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
                recent.append(h)
                total += len(h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(j - i, np.int8)), ids.slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(a), pa.array(b), pa.array(vectors, pa.binary())],
                    names=["kind", "doc", "n", "a", "b", "vec"],
                )
                at += j - i
            docs += batch.num_rows
            if recent:
                h, c = np.unique(np.concatenate(recent), return_counts=True)
                # a shingle above the share over the task is above it in one of its batches
                for x, y in zip(h[c >= max(8, share * at)].tolist(), c[c >= max(8, share * at)].tolist(), strict=True):
                    often[x] = often.get(x, 0) + y
        # what chance puts into a bucket of the task tells nothing
        usual = total / BUCKETS
        full = np.flatnonzero(buckets > usual + 4 * usual**0.5 + 2)
        hot = np.array(list(often), np.uint64)
        for kind, key, count in ((1, full, buckets[full]), (2, hot.view(np.int64), np.array(list(often.values()), np.int64))):
            m = len(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, kind, np.int8)), pa.nulls(m, pa.int64()), pa.array(count), pa.array(key.astype(np.int64)), pa.array(np.zeros(m, np.int64)), pa.nulls(m, pa.binary())],
                names=["kind", "doc", "n", "a", "b", "vec"],
            )
        if docs or len(full):
            yield pa.RecordBatch.from_arrays(
                [pa.array([3], pa.int8()), pa.nulls(1, pa.int64()), pa.array([docs]), pa.array([0]), pa.array([0]), pa.nulls(1, pa.binary())],
                names=["kind", "doc", "n", "a", "b", "vec"],
            )

    return run


def _prefixes(k: int, num: int, den: int, level: np.ndarray, hot: np.ndarray, salts: np.ndarray):
    """Task: (shingle, salt, document) for the first shingles of each set in the common order. Of equal sets in a task one is dealt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for i, j, h, r, bounds in textbytes.shingle_sets(batch.column(1), k):
                _, _, new = _first_of_sets(h, bounds, seen, known[i:j])
                n = np.diff(bounds)
                length = np.where(new, n - (n * num + den - 1) // den + np.maximum(1, n // MORE), 0)
                order = np.lexsort((h, level[(h & np.uint64(BUCKETS - 1)).astype(np.int64)], r))
                rank = np.arange(len(h)) - bounds[r]
                take = order[rank < length[r]]
                key, doc = h[take], ids[i:j][r[take]]
                salt = np.zeros(len(key), np.int64)
                if len(hot) and len(key):
                    at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                    spread = textbytes.mix(doc.astype(np.uint64)) % salts[at].astype(np.uint64)
                    salt = np.where(hot[at] == key, 1 + spread.astype(np.int64), 0)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(doc)], names=["h", "salt", "doc"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (h, salt, doc) -> (h, doc) of the groups of two or more. Of a salted group every row stays."""
    held: tuple | None = None  # the last row's group, and its document if that waits for a second one
    for batch in batches:
        h, salt, doc = (batch.column(x).to_numpy(zero_copy_only=False) for x in range(3))
        if not len(h):
            continue
        wait = held is not None and held[2] is not None
        if wait:
            h, salt, doc = np.concatenate([[held[0]], h]), np.concatenate([[held[1]], salt]), np.concatenate([[held[2]], doc])
        begins = np.ones(len(h), bool)
        begins[1:] = (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])
        goes_on = not wait and held is not None and held[0] == h[0] and held[1] == salt[0]
        group = np.cumsum(begins)
        keep = (np.bincount(group)[group] > 1) | (salt > 0) | ((group == 1) & goes_on)
        held = (h[-1], salt[-1], None if keep[-1] else doc[-1])
        yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(doc[keep])], names=["h", "doc"])


def _sets(k: int):
    """Task: (x, y, side, salt, set) with the whole set of document x for each row (text, targets); a target is (y, side, salt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            targets = batch.column(1)
            if isinstance(targets, pa.ChunkedArray):
                targets = targets.combine_chunks()
            starts = targets.offsets.to_numpy()
            flat = targets.values
            y, salt, x = (flat.field(f) for f in ("y", "salt", "x"))
            for i, j, h, _, bounds in textbytes.shingle_sets(batch.column(0), k):
                a, b = starts[i], starts[j]
                row = np.repeat(np.arange(j - i), np.diff(starts[i : j + 1]))
                for c in range(a, b, 256):
                    d = min(b, c + 256)
                    yield pa.RecordBatch.from_arrays(
                        [y.slice(c, d - c), salt.slice(c, d - c), x.slice(c, d - c), pa.array([h[bounds[q] : bounds[q + 1]].tobytes() for q in row[c - a : d - a]], pa.binary())],
                        names=["y", "salt", "x", "set"],
                    )

    return run


def _verify(num: int, den: int):
    """Task: rows sorted by (y, salt, x), y's own set first (x null): the pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, []
        for batch in batches:
            y, salt = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            x, sets = batch.column(2).to_pylist(), batch.column(3)
            out = []
            for q in range(len(y)):
                other = np.frombuffer(sets[q].as_buffer(), np.uint64)
                if (y[q], salt[q]) != key:
                    key, own = (y[q], salt[q]), []
                if x[q] is None:
                    own.append(other)
                    continue
                for mine in own:
                    small, large = (mine, other) if len(mine) < len(other) else (other, mine)
                    if not len(small) or len(small) * den < num * len(large):
                        continue
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[at] == small).sum())
                    if both * den >= num * (len(mine) + len(other) - both):
                        out.append((x[q], y[q]))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], names=["u", "v"])

    return run


def _linked(ws: Workspace, docs: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """pairs (u, v) of documents -> those whose sets are similar enough. Documents with many pairs are dealt in several parts."""
    many = pairs.groupBy("v").agg(F.count("*").alias("m")).select("v", F.ceil(F.col("m") / F.lit(4 * BLOCK)).cast("int").alias("parts"))
    dealt = pairs.join(many, "v").select("u", "v", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int").alias("salt"))
    sides = dealt.select(F.col("u").alias("doc"), F.struct(F.col("v").alias("y"), "salt", F.col("u").alias("x")).alias("to")).union(
        dealt.select("v", "salt").distinct().select(F.col("v").alias("doc"), F.struct(F.col("v").alias("y"), "salt", F.lit(None).cast("long").alias("x")).alias("to"))
    )
    # a document's targets are bounded by the parts above on one side, and by a group's components on the other
    targets = ws.write(sides.groupBy("doc").agg(F.collect_list("to").alias("targets")), "targets")
    # a checked size: beyond it the texts are shuffled
    if sides.count() <= FEW_TARGETS:
        targets = F.broadcast(targets)
    rows = docs.join(targets, "doc").select("text", "targets").mapInArrow(_sets(k), "y long, salt int, x long, set binary")
    return rows.repartition("y", "salt").sortWithinPartitions("y", "salt", F.asc_nulls_first("x")).mapInArrow(_verify(num, den), "u long, v long").distinct()


def _bounded(num: int, den: int):
    """Task: rows (u, v, n and vector of each) -> the pairs that pass the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_u, n_v = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            vec_u, vec_v = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            keep = [rtree.may_link(a, b, m, n, num, den) for a, b, m, n in zip(vec_u, vec_v, n_u, n_v, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _pairs_batch(out: list[tuple[int, int]], unfinished: int | None = None) -> pa.RecordBatch:
    u, v, h = [o[0] for o in out], [o[1] for o in out], [None] * len(out)
    if unfinished is not None:
        u, v, h = [*u, None], [*v, None], [*h, unfinished]
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(h, pa.int64())], names=["u", "v", "h"])


def _tree_pairs(num: int, den: int, whole: bool):
    """Task: the members of one tree in sorted runs of (h, i, j); side tells blocks i and j apart. Emits pairs of different
    components that pass the bound; unless whole, only the best ones that would join all that such pairs can join, and the
    tree's h if there are others."""

    def pairs(run: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(run)
        doc, comp, n = (table.column(c).to_numpy() for c in ("doc", "comp", "n"))
        side = table.column("side").to_numpy()
        two = side.max() != side.min()
        out: list = []
        for i, js, bounds in rtree.join(table.column("vec").to_pylist(), n, comp, num, den):
            if two:
                js, bounds = js[side[js] != side[i]], bounds[side[js] != side[i]]
            if whole:
                out += [(max(doc[i], doc[j]), min(doc[i], doc[j])) for j in js]
            else:
                out += [(b, i, j) for b, j in zip(bounds.tolist(), js.tolist(), strict=True)]
            if whole and len(out) > 1 << 16:
                yield _pairs_batch(out)
                out = []
        if not whole:
            tree = rtree.forest([(b, comp[i], comp[j], i, j) for b, i, j in out])
            rest = len(out) - len(tree)
            yield _pairs_batch([(max(doc[i], doc[j]), min(doc[i], doc[j])) for _, _, _, i, j in tree], int(table.column("h")[0].as_py()) if rest else None)
        else:
            yield _pairs_batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys = np.column_stack([batch.column(x).to_numpy() for x in range(3)])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if held and (keys[a] != key).any():
                    yield from pairs(held)
                    held = []
                key = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from pairs(held)

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs: the size of the set, and the smallest id reachable by links.

    Documents without words have an empty set, link with nothing and are their own component. Null texts count as empty; rows
    with a null id get a null component. Other columns of docs play no part, whatever their names.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    ws = Workspace(spark, "ngram-join")
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    share = 0.005

    facts = ws.write(docs.mapInArrow(_describe(k, share), "kind byte, doc long, n long, a long, b long, vec binary"), "facts")
    about = facts.filter("kind = 0")
    total = facts.filter("kind = 3").agg(F.sum("n")).first()[0] or 0
    level = np.zeros(BUCKETS, np.uint8)
    for row in facts.filter("kind = 1").groupBy("a").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        level[row["a"]] = min(255, int(4 * np.log2(1 + row["n"])))
    # at most (shingles per document) / share shingles can be this frequent
    often = facts.filter("kind = 2").groupBy("a").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(8 * BLOCK, share * total)).toArrow()
    hot = often.column("a").to_numpy().view(np.uint64)
    order = np.argsort(hot)
    hot, salts = hot[order], np.ceil(often.column("n").to_numpy()[order] / (4 * BLOCK)).astype(np.int64)

    # exact copies of a set: a forest of depth one
    valid = about.filter("doc is not null and n > 0")
    first = ws.write(valid.groupBy("a", "b").agg(F.min("doc").alias("v"), F.count("*").alias("m")).filter("m > 1"), "first-of-copies")
    # large groups of copies aren't shuffled to one task; they are few (a checked count), and their firsts are broadcast
    crowds = first.filter(F.col("m") > CROWD)
    if 0 < crowds.count() <= CROWDS_FEW:
        rest = valid.join(F.broadcast(crowds), ["a", "b"], "left_anti").join(first.filter(F.col("m") <= CROWD), ["a", "b"])
        copies = valid.join(F.broadcast(crowds), ["a", "b"]).unionByName(rest)
    else:
        copies = valid.join(first, ["a", "b"])
    copies = copies.filter("doc <> v").select(F.col("doc").alias("u"), "v")

    points = about.filter("doc is not null").select("doc", "n", "vec")
    dealt = docs.mapInArrow(_prefixes(k, num, den, level, hot, salts), "h long, salt int, doc long")
    members = ws.write(dealt.repartition("h", "salt").sortWithinPartitions("h", "salt", "doc").mapInArrow(_shared, "h long, doc long"), "members")
    # linked sets of m and n shingles share the first min(m // MORE, n // MORE) or more of what is dealt, and one at least
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * num / den) / MORE))
    for _ in range(2):
        own = members.withColumn("c", F.count("*").over(Window.partitionBy("doc"))).join(points.select("doc", "n"), "doc").filter(F.col("c") >= least).select("h", "doc")
        groups = own.groupBy("h").agg(F.min("doc").alias("center"), F.count("*").alias("m")).filter("m > 1")
        members = ws.write(own.join(groups, "h").select("h", "doc", "center"), "members")

    # groups with the same first document make one tree, in which each of their members has one place
    seats = ws.write(members.groupBy("center", "doc").agg(F.count("*").alias("c")), "seats")

    # each document against the first of the groups that it shares most rare shingles with, copies aside
    best = seats.filter("doc <> center").groupBy("doc").agg(F.max_by("center", F.struct("c", -F.col("center"))).alias("center"))
    checked = ws.write(best.select(F.col("doc").alias("u"), F.col("center").alias("v")).join(copies, ["u", "v"], "left_anti"), "first-pairs")
    near = checked.join(points.toDF("u", "nu", "wu"), "u").join(points.toDF("v", "nv", "wv"), "v").select("u", "v", "nu", "nv", "wu", "wv").mapInArrow(_bounded(num, den), "u long, v long")
    near = ws.write(near.distinct(), "first-near")
    links = ws.write(_linked(ws, docs, near, k, num, den).union(copies), "links")
    known = connected_components(ws, links)

    # trees in which more than one component is left: first the pairs that may join most, then all others
    rows = seats
    for whole in (False, True):
        placed = rows.select("center", "doc").join(known.withColumnRenamed("node", "doc"), "doc", "left").select(F.col("center").alias("h"), "doc", F.coalesce("component", "doc").alias("comp"))
        trees = placed.groupBy("h").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("low <> high").select("h", "blocks")
        seat = placed.join(trees, "h").withColumn("b", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
        seat = seat.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        seat = seat.select("h", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), F.col("b").alias("side"), "doc", "comp")
        found = seat.join(points, "doc").select("h", "i", "j", "side", "doc", "comp", "n", "vec").repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
        found = ws.write(found.mapInArrow(_tree_pairs(num, den, whole), "u long, v long, h long").distinct(), "tree-pairs")
        rows = seats.join(found.filter("h is not null").select(F.col("h").alias("center")), "center", "left_semi")
        pairs = ws.write(found.filter("h is null").select("u", "v").join(checked, ["u", "v"], "left_anti"), "new-pairs")
        checked = checked.union(pairs)
        new = ws.write(_linked(ws, docs, pairs, k, num, den), "new-links")
        if new.isEmpty():
            continue
        links = new.union(links)
        known = connected_components(ws, links)

    component = known
    out = about.join(component, about["doc"] == component["node"], "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )
    return out


ORACLE = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
),
s AS (
    SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w
),
n AS (SELECT doc_id, len(sh) AS n FROM s),
g AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.v FROM reach r JOIN l ON l.u = r.c),
least AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id FROM n JOIN least USING (doc_id)
"""
