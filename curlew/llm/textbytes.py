"""Array code over the UTF-8 bytes of Arrow string columns: words, word n-grams, rolling hashes.

All hashes are 64-bit polynomials modulo 2**64 over a table of random byte values, finished with a mixing step, so that
equal bytes have equal hashes in every task. Nothing here depends on a row's partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240501)
BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 2**64)
PIECE = 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i <= n."""
    if len(_POWERS.get("up", ())) <= n:
        for key, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """p with p[j] - p[i] = the polynomial of data[i:j] times BASE**i."""
    up, _ = powers(max(PIECE, len(data)))
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=out[1:])
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `limit` bytes each, or of one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def _word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    is_word = ~SPACE[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    after = np.empty(len(data), bool)
    after[:1] = False
    after[1:] = is_word[:-1]
    starts = np.flatnonzero(is_word & (~after | begins[:-1]))
    before = np.empty(len(data), bool)
    before[-1:] = False
    before[:-1] = is_word[1:]
    ends = np.flatnonzero(is_word & (~before | begins[1:])) + 1
    p = prefix_hash(table[data])
    _, down = powers(len(data))
    words = mix((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return words, starts


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the row it is in. Rows longer than PIECE are read in pieces that end at white space."""
    table = LOWER if lower else np.arange(256, dtype=np.uint8)
    words, rows = [], []
    for i, j in row_groups(offsets):
        a, b = int(offsets[i]), int(offsets[j])
        if b - a <= PIECE:
            w, starts = _word_hashes(data[a:b], offsets[i : j + 1] - a, table)
            words.append(w)
            rows.append(i + np.searchsorted(offsets[i + 1 : j + 1] - a, starts, "right"))
            continue
        while a < b:
            c = min(b, a + PIECE)
            while c < b:
                gaps = np.flatnonzero(SPACE[data[a:c]])
                if len(gaps):
                    c = a + int(gaps[-1]) + 1
                    break
                c = min(b, c + PIECE)
            w, _ = _word_hashes(data[a:c], np.array([0, c - a]), table)
            words.append(w)
            rows.append(np.full(len(w), i))
            a = c
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(words), np.concatenate(rows).astype(np.int64)


GRAM_FACTORS = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the k-word shingles and their rows; a row of 1 to k-1 words has its whole sequence as its one shingle."""
    words, rows = word_hashes(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    long = np.flatnonzero(rows[k - 1 :] == rows[: len(rows) - k + 1]) if len(rows) >= k else np.zeros(0, np.int64)
    total = np.full(len(long), k, np.uint64)
    for j in range(k):
        total += words[long + j] * GRAM_FACTORS[j]
    short = np.flatnonzero((counts > 0) & (counts < k))
    rest = counts[short].astype(np.uint64)
    for j in range(k - 1):
        has = counts[short] > j
        rest[has] += words[first[short[has]] + j] * GRAM_FACTORS[j]
    return mix(np.concatenate([total, rest])), np.concatenate([rows[long], short])


def distinct_sets(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's distinct hashes in ascending order: hashes, rows, and the n + 1 bounds of the rows."""
    if n < 1 << 20:  # one key: the row, then the hash's first 44 bits; whole hashes are compared below
        order = np.argsort((rows.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    else:
        order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[keep], r[keep]
    return h, r, np.searchsorted(r, np.arange(n + 1))


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, hashes, rows from the first, bounds) for groups of rows of a text column."""
    data, offsets = text_buffer(column)
    for i, j in row_groups(offsets):
        part = data[offsets[i] : offsets[j]]
        h, r = shingles(part, offsets[i : j + 1] - offsets[i], k)
        yield i, j, *distinct_sets(h, r, j - i)
