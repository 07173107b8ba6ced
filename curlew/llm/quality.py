"""Quality classifier: ordinal cumulative-link regression of graded ratings on hashed text.

P(grade <= k | x) = sigmoid(threshold_k - w . x) with one weight vector for all grades and ascending thresholds. x holds the
shares of hashed byte trigrams and of hashed words in the whole text. A text gets its expected grade and the probability of
the tail, that is of a grade of at least `tail_from`, by which it is selected.

The model is fitted on the driver on at most `fit_rows` labelled documents, taken in an order of id hashes; everything else
covers all documents, row by row and without a shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm import textbytes
from curlew.llm.workspace import bounded_batches

BUCKETS = 1 << 16
FIT_ROWS = 4096
SCALE = 30.0
#: Features that are multiplied at once in the fit.
BLOCK = 1 << 18


def _hashed(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, buckets, rows) of all trigrams (lower half) and words (upper half) of groups of rows."""
    data, offsets = textbytes.text_buffer(column)
    half = np.uint64(BUCKETS // 2 - 1)
    for i, j in textbytes.row_groups(offsets):
        part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        words, word_rows = textbytes.word_hashes(part, own)
        n = len(part)
        if n >= 3:
            code = part[:-2].astype(np.uint64) | part[1:-1].astype(np.uint64) << np.uint64(8) | part[2:].astype(np.uint64) << np.uint64(16)
            row = np.repeat(np.arange(j - i), np.diff(own))
            inside = row[:-2] == row[2:]
            grams = (textbytes.mix(code + np.uint64(1)) & half)[inside].astype(np.int64)
            gram_rows = row[:-2][inside]
        else:
            grams = gram_rows = np.zeros(0, np.int64)
        yield i, j, np.concatenate([grams, (words & half).astype(np.int64) + BUCKETS // 2]), np.concatenate([gram_rows, word_rows])


def _collect_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: (text, grade) -> (grade, buckets, shares) as arrays."""
    for batch in batches:
        out = []
        for i, j, buckets, rows in _hashed(batch.column(0)):
            key, count = np.unique(rows * BUCKETS + buckets, return_counts=True)
            row = key // BUCKETS
            share = count * SCALE / np.bincount(rows, minlength=j - i)[row]
            cut = np.searchsorted(row, np.arange(j - i + 1))
            out += [((key[a:b] % BUCKETS).astype(np.int32).tobytes(), share[a:b].astype(np.float32).tobytes()) for a, b in zip(cut, cut[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())], names=["grade", "buckets", "shares"])


def fit_ordinal(rows: np.ndarray, buckets: np.ndarray, shares: np.ndarray, y: np.ndarray, grades: int, steps: int = 250, rate: float = 0.3, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by Adam on the whole sample; y in 0..grades-1, each present. rows ascend; sums are taken in blocks
    of whole rows, so that no array beside the three is as long as they are."""
    n = len(y)
    starts = np.append(np.searchsorted(rows, rows[::BLOCK]), len(rows))
    cuts = [slice(a, b) for a, b in zip(starts, starts[1:], strict=False) if a < b]
    upto = np.cumsum(np.bincount(y, minlength=grades))[:-1] / n
    first = np.log(upto / (1 - upto))
    # thresholds are the first one and logarithms of the gaps, so that they stay in order
    params = [np.zeros(BUCKETS), np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-3))])]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    for step in range(1, steps + 1):
        w, raw = params
        gaps = np.exp(raw[1:])
        edges = np.concatenate([[-np.inf], raw[0] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        score = np.zeros(n)
        for x in cuts:
            at = rows[x.start]
            part = np.bincount(rows[x] - at, shares[x] * w[buckets[x]])
            score[at : at + len(part)] = part
        low, high = 1 / (1 + np.exp(-np.clip(edges[y] - score, -40, 40))), 1 / (1 + np.exp(-np.clip(edges[y + 1] - score, -40, 40)))
        low[y == 0], high[y == grades - 1] = 0.0, 1.0
        p = np.maximum(high - low, 1e-9)
        d_low, d_high = low * (1 - low) / p, high * (1 - high) / p
        slope = (d_high - d_low) / n
        g_w = ridge * w
        for x in cuts:
            g_w += np.bincount(buckets[x], shares[x] * slope[rows[x]], minlength=BUCKETS)
        g_edge = (np.bincount(y, d_low, minlength=grades)[1:] - np.bincount(y, d_high, minlength=grades)[:-1]) / n
        after = np.cumsum(g_edge[::-1])[::-1]
        g_raw = np.concatenate([after[:1], after[1:] * gaps])
        for k, g in enumerate((g_w, g_raw)):
            m = moments[k]
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            params[k] = params[k] - rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8) * (0.1 if k else 1) / np.sqrt(step)
    w, raw = params
    return w, raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
    """docs (doc, text), labels (doc, grade): (grades, weights, thresholds); weights are None with fewer than two grades."""
    known = labels.filter("doc is not null and grade is not null").groupBy("doc").agg(F.max("grade").alias("grade"))
    chosen = known.orderBy(F.xxhash64("doc"), "doc").limit(fit_rows)
    sample = docs.join(F.broadcast(chosen), "doc").select("text", "grade").mapInArrow(_collect_features, "grade int, buckets binary, shares binary").limit(fit_rows).toArrow()
    graded = sample.column("grade").to_numpy()
    grades = np.unique(graded).tolist()
    if len(grades) < 2:
        return grades or [0], None, None
    buckets, shares = (np.concatenate([textbytes.text_buffer(c)[0].view(kind) for c in sample.column(name).chunks]) for name, kind in (("buckets", np.int32), ("shares", np.float32)))
    rows = np.repeat(np.arange(len(graded), dtype=np.int32), pc.binary_length(sample.column("buckets")).to_numpy() // 4)
    del sample
    w, thresholds = fit_ordinal(rows, buckets, shares, np.searchsorted(grades, graded), len(grades))
    pa.default_memory_pool().release_unused()
    return grades, w, thresholds


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "quality", tail_from: int = 1, fit_rows: int = FIT_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, expected_grade, tail_probability) for every row of docs, and the columns named in keep.

    Null and empty texts have no features and get the grades' probabilities at w . x = 0. Null grades and ids of labels are
    left out; of several grades of one document the highest counts. Without two grades to tell apart, every text gets the
    one grade there is, or grade 0. Repeated rows are scored each; other columns play no part unless keep names them, and keep's
    columns may have any names but those of the result.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    ratings = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{grade_col}`").cast("int").alias("grade"))
    grades, w, thresholds = fit(texts, ratings, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            column = batch.column(batch.schema.get_field_index("__text"))
            total = np.zeros(n)
            if w is not None:
                for i, j, buckets, rows in _hashed(column):
                    size = np.maximum(1, np.bincount(rows, minlength=j - i))
                    total[i:j] = np.bincount(rows, w[buckets], minlength=j - i) * SCALE / size
            if w is None:
                above = np.ones((n, 1))
            else:
                above = np.column_stack([np.ones(n), 1 / (1 + np.exp(-np.clip(total[:, None] - thresholds[None], -40, 40)))])
            values = np.array(grades, float)
            expected = values[0] + above[:, 1:] @ np.diff(values)
            at = int(np.searchsorted(values, tail_from))
            tail = above[:, at] if at < len(values) else np.zeros(n)
            rest = [c for c, f in zip(batch.columns, batch.schema.names, strict=True) if f != "__text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(expected), pa.array(tail)], names=[*(f for f in batch.schema.names if f != "__text"), "expected_grade", "tail_probability"])

    own = docs.select(F.col(f"`{id_col}`").alias("__id"), *(F.col(f"`{c}`").alias(f"__keep{x}") for x, c in enumerate(keep)), F.col(f"`{text_col}`").cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields if f.name != "__text")
    out = own.mapInArrow(run, f"{fields}, expected_grade double, tail_probability double")
    return out.select(F.col("__id").alias("doc_id"), "expected_grade", "tail_probability", *(F.col(f"__keep{x}").alias(c) for x, c in enumerate(keep)))
