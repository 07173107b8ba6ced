"""Toxicity by class-conditional Kneser-Ney models of text.

A toxic and an ordinary model are counted over all labelled documents of the learning folds. Both predict a text symbol by symbol
(letters without case, ends of words, classes of other bytes) from what stands before in the word, ORDER - 1 symbols at most. The
grams of this level have their raw counts, by class. Below, both classes back off to shared counts of grams of SHARED symbols
and fewer: continuation counts, that is the number of different longer grams that end so (grams that begin a word keep their raw
counts, as is usual). So what neither class has seen more of than the other tells nothing, and rare expressions are smoothed
alike. Every class and level has its own three discounts, from its counts of counts (Chen and Goodman's modified Kneser-Ney
smoothing). Counts have no upper end, and no gram is left out.

A word's evidence is its log-likelihood under the toxic model less that under the ordinary one. A document has the mean of its
words' evidence, the means of its most telling spans of a few lengths, and the excess of its words' evidence over a few
thresholds. A logistic map turns these into a score. It is fitted on one fold by a model that is counted without it; the model
of the scores is counted with it. One count gives both.

How it is spread. A task sums up the grams of its texts; grams meet by a hash of their context. Only the shared level
(at most 64**SHARED numbers) and the counts of counts pass the driver. The model comes down to one number a gram (the logarithm
of the ratio of both probabilities) and one a context (that of both backoff weights), a table that grows with the corpus. Up to
`most` numbers it is broadcast, and no text is shuffled. Beyond, documents are dealt to chunks of bounded size; a chunk asks
for its different grams, a join with the table answers. Both ways give the same scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.llm import textbytes
from curlew.llm.workspace import Workspace, bounded_batches

ORDER = 8
SHARED = 3
SPANS = (1, 4, 16)
EXCESS = (2.0, 4.0)
FIT_ROWS = 20000
LABELS_FEW = 2_000_000
CHUNK_BYTES = 32 << 20
TABLE_MOST = 1 << 22
HELD = 1 << 22

# Symbols of six bits: 0 ends a word, 1 stands before its first letter, 2 to 27 are letters, 28 digits, 29 to 31 other ASCII
# bytes in three classes, 32 to 63 the other bytes by their last five bits.
END, BEGIN, BITS = 0, 1, 6
SYMBOL = np.array([END if textbytes.SPACE[b] else 2 + (b | 32) - 97 if 97 <= (b | 32) <= 122 and b < 128 else 28 if 48 <= b <= 57 else 29 + b % 3 if b < 128 else 32 + b % 32 for b in range(256)], np.uint64)
CONTEXT = np.uint64(1 << 60)  # marks the number of a context

GRAMS = "bucket int, grams binary, counts binary"
MET = "kind byte, key long, x long, y long, grams binary, counts binary"
ENTRY = "k long, v float"


def _mask(n: int) -> np.uint64:
    return np.uint64((1 << BITS * n) - 1)


MASKS = np.array([_mask(n) for n in range(ORDER + 1)])


def _grams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, the gram that ends at each symbol, whether a word begins there, the symbol's row) for groups of rows.
    Every text ends with an end of a word."""
    data, offsets = textbytes.text_buffer(column)
    for i, j in textbytes.row_groups(offsets):
        own = offsets[i : j + 1] - offsets[i]
        rows = np.repeat(np.arange(j - i), np.diff(own) + 1)
        text = np.ones(len(rows), bool)
        text[own[1:] + np.arange(j - i)] = False
        padded = np.full(len(rows) + ORDER - 1, END, np.uint64)
        padded[ORDER - 1 :][text] = SYMBOL[data[offsets[i] : offsets[j]]]
        begins = np.concatenate([[True], padded[ORDER - 1 : -1] == END])
        at = np.arange(len(rows))
        length = np.minimum(at - np.maximum.accumulate(np.where(begins, at, 0)) + 1, ORDER)
        key = np.zeros(len(rows), np.uint64)
        for k in range(ORDER):
            key <<= np.uint64(BITS)
            key |= padded[k : k + len(rows)]
        key &= MASKS[length]
        short = length < ORDER
        key[short] |= np.uint64(BEGIN) << (np.uint64(BITS) * length[short].astype(np.uint64))
        yield i, j, key, begins, rows


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    firsts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[firsts], np.add.reduceat(n, firsts)


def _bucket(gram: np.ndarray, buckets: int) -> np.ndarray:
    return (textbytes.mix(gram >> np.uint64(BITS)) % np.uint64(buckets)).astype(np.int32)


def _count(buckets: int):
    """Task: (text, class, 2 more in the fold of the map) -> per bucket the task's grams, with the class and fold in two bits, and
    their counts."""

    def rows_of(code: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        bucket = _bucket(code >> np.uint64(2), buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, code, n = bucket[order], code[order], n[order].astype(np.uint32)
        firsts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(code))
        for a, b in _slices(firsts):
            edges = firsts[a : b + 1]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]), _lists(code, edges), _lists(n, edges)], names=["bucket", "grams", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            mark = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)
            for i, j, key, _, rows in _grams(batch.column(0)):
                code, n = np.unique(key << np.uint64(2) | mark[i:j][rows], return_counts=True)
                held.append((code, n.astype(np.int64)))
                size += len(code)
                if size > 2 * HELD:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > HELD:
                        yield from rows_of(*held.pop())
                        size = 0
        if size:
            yield from rows_of(*_summed(held))

    return run


def _slices(edges: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of lists, given the edges of all, of `most` elements or one list."""
    a, n = 0, len(edges) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(edges, edges[a] + most, "right")) - 1))
        yield a, b
        a = b


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Rows values[edges[i]:edges[i + 1]] as binary."""
    own = np.ascontiguousarray(values[edges[0] : edges[-1]])
    width = own.dtype.itemsize * int(np.prod(own.shape[1:]))
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(((edges - edges[0]) * width).astype(np.int32)), pa.py_buffer(own)])


def _unlisted(column: pa.Array, dtype) -> np.ndarray:
    """All values of binary rows."""
    return np.frombuffer(textbytes.text_buffer(column)[0].tobytes(), dtype)


def _variants(counts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Counts by class of all learning folds (0), and without the fold of the map (1)."""
    yield 0, counts[:, :2] + counts[:, 2:]
    yield 1, counts[:, :2]


def _times(gram: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ends of n symbols of ascending grams, and how many grams end so; grams that are no longer have their counts."""
    ends, place = np.unique(gram & _mask(n), return_inverse=True)
    return ends, np.bincount(place, np.where(gram <= _mask(n), counts, 1), len(ends)).astype(np.int64)


def _meet(buckets: int):
    """Task: all rows of its buckets -> kind 0, per bucket its grams with their counts; kind 1, counts of counts (key: variant,
    class, count up to 4, or 0 for all grams; x); kind 2, the longest shared grams and their continuation counts (x, y by variant)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, limit = 0, 2 * HELD
        for batch in batches:
            held.append((_unlisted(batch.column(1), np.uint64), _unlisted(batch.column(2), np.uint32).astype(np.int64)))
            size += len(held[-1][0])
            if size > limit:
                held = [_summed(held)]
                size = len(held[0][0])
                limit = max(2 * HELD, 2 * size)
        if not size:
            return
        code, n = _summed(held)
        del held
        gram = code >> np.uint64(2)
        new = np.concatenate([[True], gram[1:] != gram[:-1]])
        counts = np.zeros((int(new.sum()), 4), np.int64)  # by class outside the fold of the map, then within
        counts[np.cumsum(new) - 1, (code & np.uint64(3)).astype(np.int64)] = n
        gram = gram[new]
        codes, sums, ends = [], [], {}
        for variant, own in _variants(counts):
            for c in (0, 1):
                codes += [(variant * 2 + c) * 8 + r for r in range(5)]
                sums += [int((own[:, c] > 0).sum()), *np.bincount(np.minimum(own[:, c], 5), minlength=6)[1:5].tolist()]
            known = own.any(1)
            for end, times in zip(*(x.tolist() for x in _times(gram[known], own[known].sum(1), SHARED)), strict=True):
                ends.setdefault(end, [0, 0])[variant] = times
        yield _met(1, np.array(codes), np.array(sums), np.zeros(len(codes)))
        both = np.array(list(ends.values())).reshape(-1, 2)
        yield _met(2, np.array(list(ends), np.int64), both[:, 0], both[:, 1])
        bucket = _bucket(gram, buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, gram, counts = bucket[order], gram[order], counts[order]
        edges = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(gram))
        for a, b in _slices(edges):
            x = edges[a : b + 1]
            yield _met(0, bucket[x[:-1]], np.zeros(b - a), np.zeros(b - a), _lists(gram, x), _lists(counts, x))

    return run


def _met(kind: int, key: np.ndarray, x: np.ndarray, y: np.ndarray, grams: pa.Array | None = None, counts: pa.Array | None = None) -> pa.RecordBatch:
    n = len(key)
    none = pa.nulls(n, pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), *(pa.array(v.astype(np.int64)) for v in (key, x, y)), none if grams is None else grams, none if counts is None else counts], names=["kind", "key", "x", "y", "grams", "counts"])


def discounts(of: list[int]) -> np.ndarray:
    """What counts of 0, 1, 2, 3 and more are discounted by, from how many grams have a count of 1, 2, 3 and 4."""
    n1, n2, n3, n4 = of
    share = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = [0.0]
    for r, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        out.append(min(max(r - (r + 1) * share * b / a if a else share, 0.1), r - 0.05))
    return np.array(out)


def smoothed(count: np.ndarray, context: np.ndarray, below: np.ndarray, discount: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interpolated probabilities of the grams of one level and class, and the weight of the level below after each context.
    context: numbers from 0, ascending; below: the probabilities of the grams' ends."""
    off = discount[np.minimum(count, 3)]
    total, left = np.bincount(context, count), np.bincount(context, off)
    seen = total > 0
    weight = np.where(seen, left / np.where(seen, total, 1), 1.0)
    return (count - off) / np.where(seen, total, 1)[context] + weight[context] * below, weight


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending values: the different ones, and the place of each among them."""
    new = np.concatenate([[True], values[1:] != values[:-1]])
    return values[new], np.cumsum(new) - 1


def shared_level(grams: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Probabilities of the last symbol of each gram of SHARED symbols (ascending) from continuation counts of both classes."""
    at = [(grams, times)]
    for n in range(SHARED - 1, 0, -1):
        at.append(_times(*at[-1], n))
    p = np.full(len(at[-1][0]), 1 / (1 << BITS))
    for n, (key, count) in enumerate(reversed(at), 1):
        if n > 1:
            p = p[np.searchsorted(at[SHARED - n + 1][0], key & _mask(n - 1))]
        p, _ = smoothed(count, _numbered(key >> np.uint64(BITS))[1], p, discounts([int((count == r).sum()) for r in range(1, 5)]))
    return p


def numbers(gram: np.ndarray, counts: np.ndarray, shared: tuple[np.ndarray, np.ndarray], discount: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The model's keys and numbers from ascending grams, with all grams of their contexts, and their counts by class."""
    below = shared[1][np.searchsorted(shared[0], gram & _mask(SHARED))]
    contexts, number = _numbered(gram >> np.uint64(BITS))
    (p0, weight0), (p1, weight1) = (smoothed(counts[:, c], number, below, discount[c]) for c in (0, 1))
    return np.concatenate([gram, contexts | CONTEXT]), np.concatenate([np.log(p1 / p0), np.log(weight1 / weight0)]).astype(np.float32)


class Table:
    """Numbers by key: mixed keys in order, found by their first bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = textbytes.mix(keys)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __getstate__(self):
        return self.keys, self.values

    def __setstate__(self, state):
        self.keys, self.values = state

    def _starts(self) -> tuple[np.ndarray, np.uint64]:
        if not hasattr(self, "starts"):
            bits = max(1, len(self.keys).bit_length())
            self.shift = np.uint64(64 - bits)
            self.starts = np.append(np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << self.shift), len(self.keys)).astype(np.int32)
        return self.starts, self.shift

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether the key is there, its number or 0)."""
        starts, shift = self._starts()
        keys = textbytes.mix(keys)
        has, value = np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
        first = (keys >> shift).astype(np.int64)
        at, end = starts[first], starts[first + 1]
        todo = np.flatnonzero(at < end)
        at, end, keys = at[todo], end[todo], keys[todo]
        while len(todo):
            hit = self.keys[at] == keys
            has[todo[hit]] = True
            value[todo[hit]] = self.values[at[hit]]
            on = ~hit & (at + 1 < end)
            todo, at, end, keys = todo[on], at[on] + 1, end[on], keys[on]
        return has, value


def evidence(gram: np.ndarray, table: Table) -> np.ndarray:
    """log P(symbol | toxic) - log P(symbol | ordinary) of the last symbol of every gram."""
    has, value = table.get(gram)
    out = value.astype(np.float64)
    # not in the model: the shared level, weighted by the context
    out[~has] = table.get(gram[~has] >> np.uint64(BITS) | CONTEXT)[1]
    return out


def features(column: pa.Array, table: Table) -> np.ndarray:
    """Per row with words: the words' mean evidence, the logarithm of their number, the best mean over spans of each length in
    SPANS (or the text, if shorter), and for each value in EXCESS what words have more than that, and how many do."""
    out = np.zeros((len(column), 2 + len(SPANS) + 3 * len(EXCESS)))
    for i, j, gram, begins, rows in _grams(column):
        starts = np.flatnonzero(begins)
        e = np.add.reduceat(evidence(gram, table), starts)
        real = np.diff(np.append(starts, len(gram))) > 1  # more than an end
        e, row = e[real], rows[starts][real]
        if not len(e):
            continue
        n = np.bincount(row, minlength=j - i)
        has = np.flatnonzero(n)
        total, first = np.concatenate([[0.0], np.cumsum(e)]), np.concatenate([[0], np.cumsum(n)])
        columns = [(total[first[1:]] - total[first[:-1]])[has] / n[has], np.log1p(n[has])]
        at = np.arange(len(e))
        for span in SPANS:
            # spans that end in their row; a shorter row is one span
            ends = np.minimum(at + span, first[row + 1])
            whole = (ends - at == span) | (at == first[row])
            columns.append(np.maximum.reduceat(np.where(whole, (total[ends] - total[at]) / (ends - at), -np.inf), first[has]))
        for least in EXCESS:
            over = np.bincount(row, np.maximum(0, e - least), j - i)[has]
            columns += [np.log1p(over), over / np.sqrt(n[has]), np.log1p(np.bincount(row, e > least, j - i)[has])]
        out[i:j][has] = np.column_stack(columns)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method with a ridge on scaled columns: (means, scales, weights with the intercept last)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + ridge * w
        curve = (z * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return mean, scale, w


def _columns(told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    if not told.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.float32)
    return told.column("k").to_numpy().view(np.uint64), told.column("v").to_numpy()


Finish = Callable[[pa.Table, np.ndarray], pa.Table]


class Model:
    """The numbers of one variant of the counts (0: of all learning folds, 1: without the fold of the map)."""

    def __init__(self, counts: DataFrame, stats: dict[int, int], shared: tuple[np.ndarray, np.ndarray], variant: int, ws: Workspace, most: int):
        self.spark: SparkSession = counts.sparkSession
        discount = [discounts([stats.get((variant * 2 + c) * 8 + r, 0) for r in range(1, 5)]) for c in (0, 1)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                gram = _unlisted(batch.column(0), np.uint64)
                own = dict(_variants(_unlisted(batch.column(1), np.int64).reshape(-1, 4)))[variant]
                order = np.argsort(gram)
                order = order[own.any(1)[order]]
                if len(order):
                    k, v = numbers(gram[order], own[order], shared, discount)
                    for a in range(0, len(k), 1 << 17):
                        yield pa.RecordBatch.from_arrays([pa.array(k[a : a + (1 << 17)].view(np.int64)), pa.array(v[a : a + (1 << 17)])], names=["k", "v"])

        table = counts.filter("kind = 0").select("grams", "counts").mapInArrow(run, ENTRY)
        # a checked bound on the size: there are no more contexts than grams
        size = 2 * sum(stats.get((variant * 2 + c) * 8, 0) for c in (0, 1))
        if size > most:
            table = ws.write(table, "model")
            size = table.count()
        self.table = self.rows = None
        if size <= most:
            self.table = self.spark.sparkContext.broadcast(Table(*_columns(table.toArrow())))
            pa.default_memory_pool().release_unused()
        else:
            self.rows = table

    def drop(self) -> None:
        """Frees what driver and executors hold of it; nothing may read it any more."""
        if self.table is not None:
            self.table.destroy()

    def over(self, docs: DataFrame, head: list[str], finish: Finish, schema: str) -> DataFrame:
        """finish(the head columns and text of a batch of docs (doc, text and others), the texts' features) of all docs."""
        if self.table is None:
            return self._over_chunks(docs, head, finish, schema)
        table = self.table

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = pa.Table.from_batches([batch])
                yield from finish(rows, features(rows.column("text"), table.value)).to_batches()

        return docs.select(*head, "text").mapInArrow(run, schema)

    def _over_chunks(self, docs: DataFrame, head: list[str], finish: Finish, schema: str) -> DataFrame:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        chunks = 1 + size // CHUNK_BYTES
        parts = int(min(chunks, 1 << 20))
        docs = docs.select(*head, "text", F.pmod(F.xxhash64("doc", "text"), F.lit(chunks)).alias("chunk")).repartition(parts, "chunk")

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list[np.ndarray]] = {}
            size = 0
            for batch in batches:
                chunk = batch.column(1).to_numpy()
                for i, j, gram, _, rows in _grams(batch.column(0)):
                    own = chunk[i:j][rows]
                    for c in np.unique(own).tolist():
                        held.setdefault(c, []).append(np.unique(gram[own == c]))
                        size += len(held[c][-1])
                    if size > 2 * HELD:
                        held = {c: [np.unique(np.concatenate(x))] for c, x in held.items()}
                        size = sum(len(x[0]) for x in held.values())
                        if size > HELD:
                            yield from told_of(held)
                            held, size = {}, 0
            yield from told_of(held)

        def told_of(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for c, found in held.items():
                gram = np.unique(np.concatenate(found))
                k = np.concatenate([gram, np.unique(gram >> np.uint64(BITS)) | CONTEXT]).view(np.int64)
                for a in range(0, len(k), 1 << 17):
                    x = k[a : a + (1 << 17)]
                    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(np.full(len(x), c))], names=["k", "chunk"])

        def answer(rows: pa.Table, told: pa.Table) -> pa.Table:
            return finish(rows, features(rows.column("text"), Table(*_columns(told))))

        told = docs.select("text", "chunk").mapInArrow(ask, "k long, chunk long").join(self.rows, "k").repartition(parts, "chunk")
        return docs.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(answer, schema)


def learn(docs: DataFrame, labels: DataFrame, ws: Workspace, fit_rows: int = FIT_ROWS, most: int = TABLE_MOST):
    """docs (doc, text, part) with part = crc32 mod 5, labels (doc, toxic): the model and the logistic map, or None without
    labels of both classes. Part 0 is never read, parts 1 to 4 are counted; part 4 fits the map, by the model of parts 1 to 3."""
    known = labels.filter("doc is not null and toxic in (0, 1)").groupBy("doc").agg(F.max("toxic").alias("toxic"))
    known = known.filter(F.crc32(F.col("doc").cast("string")) % 5 != 0)
    n = known.count()
    # a checked size: beyond it both sides are shuffled
    lookup = F.broadcast(known) if n <= LABELS_FEW else known
    marked = docs.filter("part <> 0").join(lookup, "doc")
    # lists of grams to shuffle, some for every task that they meet in
    buckets = max(256, 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    grams = marked.select("text", F.expr("toxic + if(part = 4, 2, 0)").alias("code")).mapInArrow(_count(buckets), GRAMS)
    counts = ws.write(grams.repartition("bucket").mapInArrow(_meet(buckets), MET), "counts")
    stats = {r["key"]: r["x"] for r in counts.filter("kind = 1").groupBy("key").agg(F.sum("x").alias("x")).collect()}
    # at most 64 ** SHARED grams, whatever the corpus
    ends = counts.filter("kind = 2").groupBy("key").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).orderBy("key").toArrow()

    def model_of(variant: int) -> Model | None:
        if not all(stats.get((variant * 2 + c) * 8, 0) for c in (0, 1)):
            return None
        times = ends.column("y" if variant else "x").to_numpy()
        key = ends.column("key").to_numpy().view(np.uint64)[times > 0]
        return Model(counts, stats, (key, shared_level(key, times[times > 0])), variant, ws, most)

    without = model_of(1)
    fit = fit_map(docs, known, without, fit_rows) if without else None
    model = model_of(0)
    return model and (model, fit)


def fit_map(docs: DataFrame, known: DataFrame, without: Model, fit_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The logistic map on part 4, by the model without it; null if part 4 doesn't have both classes."""

    def measure(rows: pa.Table, x: np.ndarray) -> pa.Table:
        return pa.table({"x": pa.array(list(x), pa.list_(pa.float64())), "toxic": rows.column("toxic")})

    chosen = known.filter(F.crc32(F.col("doc").cast("string")) % 5 == 4).orderBy(F.xxhash64("doc"), "doc").limit(fit_rows).select("doc", "toxic")
    sample = docs.filter("part = 4").join(F.broadcast(chosen), "doc").select("doc", "text", F.col("toxic").cast("int"))
    rows = without.over(sample, ["toxic"], measure, "x array<double>, toxic int").limit(fit_rows).toPandas()
    without.drop()
    if rows["toxic"].nunique() < 2:
        return None
    rows = rows.sort_values(["x", "toxic"], key=lambda c: c.map(tuple) if c.name == "x" else c)  # the fit doesn't depend on the order of tasks
    return fit_logistic(np.array(rows["x"].tolist()), rows["toxic"].to_numpy(float))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS, most: int = TABLE_MOST) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs; labels (doc_id, toxic 0/1).

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out: their labels are never read. Null texts count as empty; empty
    texts get the score of no evidence. A null id is not held out and has no label. A document with several labels counts as
    toxic if one says so; a row that is repeated counts, and is scored, as often as it is there. Without labels of both classes
    every score is 0. Other columns of docs and labels play no part, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    ws = Workspace(docs.sparkSession, "toxicity")
    held_out = F.coalesce(F.crc32(F.col("doc").cast("string")) % 5, F.lit(1)) == 0
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = docs.withColumn("part", F.coalesce(F.crc32(F.col("doc").cast("string")) % 5, F.lit(1)))
    labels = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col("toxic").cast("int"))
    learned = learn(docs, labels, ws, fit_rows, most)
    docs = docs.select("doc", "text", held_out.alias("held_out"))
    if learned is None:
        return docs.select(F.col("doc").alias("doc_id"), "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    model, fit = learned

    def score(rows: pa.Table, x: np.ndarray) -> pa.Table:
        if fit is None:
            s = 1 / (1 + np.exp(-np.clip(x[:, 0], -30, 30)))
        else:
            mean, scale, w = fit
            s = 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)))
        return pa.table({"doc_id": rows.column("doc"), "held_out": rows.column("held_out"), "score": pa.array(s), "predicted": pa.array((s >= 0.5).astype(np.int32))})

    return model.over(docs, ["doc", "held_out"], score, "doc_id long, held_out boolean, score double, predicted int")
