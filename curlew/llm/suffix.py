"""Suffix arrays of shards of text by induced sorting, in array code, and their permuted common prefixes.

A shard is a row of short strings over bytes (as letters from 2 up) with a separator after each and an end mark. Suffixes are classified as S (smaller than the next
suffix) or L; the leftmost S of each run (LMS) cut the text into substrings. Induction from unsorted LMS positions sorts the
LMS substrings; their names form a shorter text, whose suffixes are sorted by naming pairs of names recursively; induction
from the sorted LMS suffixes gives all suffixes. Induction goes through the byte buckets in order and moves a whole bucket at
a time, so that its cost is linear in the text with few interpreted steps.

Suffixes are in order by at least their first `depth` bytes; the order beyond is of no use to a search for repeats of that
length, and the recursion stops there.
"""

from __future__ import annotations

import numpy as np

from curlew.llm import textbytes

END, SEPARATOR, LETTERS = 0, 1, 258


def classify(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S. The end mark counts as S."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1].astype(np.int32))
    step[-1] = 1
    differs = np.flatnonzero(step)
    return step[differs[np.searchsorted(differs, np.arange(n))]] > 0


class _Buckets:
    def __init__(self, text: np.ndarray):
        sizes = np.bincount(text, minlength=LETTERS)
        self.start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.end = np.cumsum(sizes)
        self.used = np.flatnonzero(sizes)

    @staticmethod
    def deal(out: np.ndarray, at: np.ndarray, who: np.ndarray, letters: np.ndarray, sign: int) -> None:
        """Append suffixes, in order, to the fronts (sign 1) or backs (-1) of their letters' buckets."""
        order = np.argsort(letters, kind="stable")
        who, letters = who[order], letters[order]
        firsts = np.flatnonzero(np.concatenate([[True], letters[1:] != letters[:-1]]))
        sizes = np.diff(np.concatenate([firsts, [len(letters)]]))
        rank = np.arange(len(letters)) - np.repeat(firsts, sizes)
        if sign > 0:
            out[at[letters] + rank] = who
            at[letters[firsts]] += sizes
        else:
            out[at[letters] - 1 - rank] = who
            at[letters[firsts]] -= sizes


def induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, buckets: _Buckets) -> np.ndarray:
    """All suffixes from LMS suffixes in the given order: L suffixes from the front, then S suffixes from the back."""
    out = np.full(len(text), -1, np.int64)
    by_letter = lms[np.argsort(text[lms], kind="stable")]
    bounds = np.searchsorted(text[by_letter], np.arange(LETTERS + 1))
    front = buckets.start.copy()
    for c in buckets.used:
        done = buckets.start[c]
        while done < front[c]:  # L suffixes of this bucket, which may lead to others of it
            now = out[done : front[c]]
            done = front[c]
            p = now[now > 0] - 1
            p = p[~is_s[p]]
            if len(p):
                _Buckets.deal(out, front, p, text[p], 1)
        p = by_letter[bounds[c] : bounds[c + 1]]
        p = p[p > 0] - 1  # what stands before an LMS suffix is of type L
        if len(p):
            _Buckets.deal(out, front, p, text[p], 1)
    back = buckets.end.copy()
    for c in buckets.used[::-1]:
        done = buckets.end[c]
        while back[c] < done:  # S suffixes of this bucket
            now = out[back[c] : done][::-1]
            done = back[c]
            p = now[now > 0] - 1
            p = p[is_s[p]]
            if len(p):
                _Buckets.deal(out, back, p, text[p], -1)
        now = out[buckets.start[c] : front[c]][::-1]
        p = now[now > 0] - 1
        p = p[is_s[p]]
        if len(p):
            _Buckets.deal(out, back, p, text[p], -1)
    out[0] = len(text) - 1
    return out


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings (by position in the text) from their sorted order: equal substrings have equal names."""
    ends = np.concatenate([lms[1:] + 1, [len(text)]])
    up, down = textbytes.powers(max(textbytes.PIECE, len(text)))
    values = np.concatenate([textbytes.mix(np.arange(1, 3, dtype=np.uint64)), textbytes.BYTE_VALUE])
    p = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[text] * up[: len(text)], dtype=np.uint64)])
    whole = textbytes.mix((p[ends] - p[lms]) * down[lms] + (ends - lms).astype(np.uint64))
    at = np.searchsorted(lms, ordered)
    new = np.concatenate([[0], (whole[at[1:]] != whole[at[:-1]]).astype(np.int64)])
    names = np.empty(len(lms), np.int64)
    names[at] = np.cumsum(new)
    return names


def _order_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the reduced text in suffix order: names of 1, 2, 4, ... letters, until they differ or cover the depth."""
    span = 1
    n = len(names)
    while True:
        order = np.argsort(names, kind="stable")
        # a name covers two bytes or more
        if names[order[-1]] == n - 1 or span * 2 > depth + 2:
            return order
        second = np.zeros(n, np.int64)
        if span < n:
            second[: n - span] = names[span:] + 1
        pair = names * (n + 1) + second
        order = np.argsort(pair, kind="stable")
        new = np.concatenate([[0], (pair[order[1:]] != pair[order[:-1]]).astype(np.int64)])
        names = np.empty(n, np.int64)
        names[order] = np.cumsum(new)
        span *= 2


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """text: integers below LETTERS, of which only the last is END. Suffixes in order by their first `depth` letters at least."""
    if len(text) < 2:
        return np.arange(len(text))
    is_s = classify(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    buckets = _Buckets(text)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    rough = induce(text, is_s, lms, buckets)
    ordered = rough[rough >= 0]
    ordered = ordered[is_lms[ordered]]
    return induce(text, is_s, lms[_order_names(_names(text, lms, ordered), depth)], buckets)


def shared_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Permuted common prefixes: for each position, the bytes that its suffix shares with the one before it in order, up to length.

    data: bytes; positions whose suffix is shorter than the length have 0.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(n, np.uint64)
    for k in range(8):
        words |= padded[k : n + k].astype(np.uint64) << np.uint64(8 * k)
    going = np.flatnonzero((before >= 0) & (np.arange(n) + length <= n) & (before + length <= n))
    for k in range(0, length, 8):
        k = min(k, length - 8)
        going = going[words[going + k] == words[before[going] + k]]
        out[going] = k + 8
    return out
