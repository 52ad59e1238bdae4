"""Suffix arrays by induced sorting, with permuted common prefixes, in numpy.

Suffixes are classed as smaller or larger than their successor.  The leftmost-smaller (LMS) substrings are
sorted by one round of induction and named; where names repeat, the string of names is sorted by the same
procedure, recursively; a second round of induction from the sorted LMS suffixes gives the whole array.

Induction runs over the buckets of first symbols instead of single suffixes: what a bucket induces is
found in one vector operation, appended to the target buckets in order, and repeated while the bucket
feeds itself (as often as its symbol stands in a row).  Strings of names have many small buckets; there
the same scan runs suffix by suffix.
"""

from __future__ import annotations

import numpy as np

#: Buckets with fewer suffixes than this on average are scanned one suffix at a time.
SMALL_BUCKETS = 24


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor (the sentinel at the end counts as smaller)."""
    n = len(s)
    smaller = np.zeros(n, dtype=bool)
    smaller[-1] = True
    if n > 1:
        differs = s[:-1] != s[1:]
        # each run of equal symbols takes the type of its last one
        last = np.flatnonzero(differs)
        kind = s[last] < s[last + 1]
        smaller[:-1] = np.repeat(kind, np.diff(np.append(-1, last)))
    return smaller


def _induce_vector(s: np.ndarray, sa: np.ndarray, smaller: np.ndarray, starts: np.ndarray) -> None:
    """Both induction scans, a bucket at a time; ``sa`` holds LMS suffixes at their buckets' ends, else -1."""
    n_symbols = len(starts) - 1
    heads = starts[:-1].copy()
    present = np.flatnonzero(np.diff(starts))

    def spread(found: np.ndarray, at: np.ndarray, up: bool) -> None:
        """Append suffixes to their buckets in order (from the head upwards or the tail downwards)."""
        symbols = s[found]
        order = np.argsort(symbols, kind="stable")
        symbols, found = symbols[order], found[order]
        first = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
        counts = np.diff(np.append(first, len(symbols)))
        rank = np.arange(len(symbols)) - np.repeat(first, counts)
        which = symbols[first]
        if up:
            sa[np.repeat(at[which], counts) + rank] = found
            at[which] += counts
        else:
            sa[np.repeat(at[which], counts) - 1 - rank] = found
            at[which] -= counts

    lms = [None] * n_symbols
    for c in present:  # they only induce; the second scan finds their places anew
        part = sa[starts[c]:starts[c + 1]]
        lms[c] = part[part >= 0]
    sa[:] = -1
    # larger suffixes, from the smallest bucket up
    for c in present:
        lo = starts[c]
        done = lo
        while True:  # the larger suffixes of a bucket come first, and may induce more of them
            upto = heads[c]
            if upto == done:
                break
            new = sa[done:upto]
            done = upto
            prev = new[new > 0] - 1
            prev = prev[~smaller[prev]]
            if len(prev):
                spread(prev, heads, True)
        prev = lms[c][lms[c] > 0] - 1
        prev = prev[~smaller[prev]]
        if len(prev):
            spread(prev, heads, True)
    # smaller suffixes, from the largest bucket down
    tails = starts[1:].copy()
    for c in present[::-1]:
        hi = starts[c + 1]
        done = hi
        while True:
            upto = tails[c]
            if upto == done:
                break
            new = sa[upto:done][::-1]
            done = upto
            prev = new[new > 0] - 1
            prev = prev[smaller[prev]]
            if len(prev):
                spread(prev, tails, False)
        larger = sa[starts[c]:heads[c]][::-1]
        prev = larger[larger > 0] - 1
        prev = prev[smaller[prev]]
        if len(prev):
            spread(prev, tails, False)


def _induce_scan(s: np.ndarray, sa: np.ndarray, smaller: np.ndarray, starts: np.ndarray) -> None:
    """The same scans, suffix by suffix."""
    n = len(s)
    # the symbol before a suffix if that one is larger (smaller) than its successor, else -1; place -1 has none
    before = np.full((2, n + 1), -1, dtype=np.int64)
    before[0, 1:n] = np.where(smaller[:-1], -1, s[:-1])
    before[1, 1:n] = np.where(smaller[:-1], s[:-1], -1)
    up, down = before[0].tolist(), before[1].tolist()
    heads, tails = starts[:-1].tolist(), starts[1:].tolist()
    placed = [-1] * n
    # both loops read a list that they fill ahead of themselves
    for j, lms in zip(placed, sa.tolist()):
        # larger suffixes lie before the LMS suffixes of their bucket, which only lend their places here
        if j < 0:
            j = lms
        c = up[j]
        if c >= 0:
            k = heads[c]
            placed[k] = j - 1
            heads[c] = k + 1
    for j in reversed(placed):
        c = down[j]
        if c >= 0:
            k = tails[c] - 1
            placed[k] = j - 1
            tails[c] = k
    sa[:] = placed


def _induce(s, sa, smaller, starts) -> None:
    if len(s) >= SMALL_BUCKETS * (len(starts) - 1):
        _induce_vector(s, sa, smaller, starts)
    else:
        _induce_scan(s, sa, smaller, starts)
    sa[0] = len(s) - 1  # nothing induces the sentinel


def _at_ends(n: int, suffixes: np.ndarray, s: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """An empty array with the given suffixes, in order, at the ends of their buckets."""
    sa = np.full(n, -1, dtype=np.int64)
    symbols = s[suffixes]
    order = np.argsort(symbols, kind="stable")
    symbols, suffixes = symbols[order], suffixes[order]
    counts = np.bincount(symbols, minlength=len(starts) - 1)
    rank = np.arange(len(symbols)) - np.repeat(np.cumsum(counts) - counts, counts)
    sa[starts[symbols + 1] - counts[symbols] + rank] = suffixes
    return sa


def suffix_array(s: np.ndarray, n_symbols: int | None = None) -> np.ndarray:
    """Suffix array of ``s`` (whole numbers from 0), whose last symbol must be its only 0."""
    s = np.ascontiguousarray(s, dtype=np.int64)
    n = len(s)
    if n <= 1:
        return np.arange(n)
    n_symbols = n_symbols or int(s.max()) + 1
    smaller = _types(s)
    starts = np.append(0, np.cumsum(np.bincount(s, minlength=n_symbols)))
    is_lms = np.append(False, smaller[1:] & ~smaller[:-1])
    lms = np.flatnonzero(is_lms)
    if len(lms) > 1:
        sa = _at_ends(n, lms, s, starts)
        _induce(s, sa, smaller, starts)
        order = sa[is_lms[sa]] if n else sa
        names, n_names = _names(s, order, lms)
        if n_names == len(lms):
            order = lms[np.argsort(names)]
        else:
            order = lms[suffix_array(names, n_names)]
    else:
        order = lms
    sa = _at_ends(n, order, s, starts)
    _induce(s, sa, smaller, starts)
    return sa


def _names(s: np.ndarray, order: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each LMS substring (in text order); equal substrings share one.

    ``order`` has the LMS suffixes sorted by their LMS substrings.
    """
    end = np.append(lms[1:], len(s) - 1)  # a substring runs to the next LMS position
    length = np.zeros(len(s), dtype=np.int64)
    length[lms] = end - lms + 1
    a, b = order[:-1], order[1:]
    equal = length[a] == length[b]
    open_ = np.flatnonzero(equal)
    step = 0
    while len(open_):
        x, y = a[open_], b[open_]
        inside = step < length[x]
        same = np.ones(len(open_), dtype=bool)
        same[inside] = s[x[inside] + step] == s[y[inside] + step]
        equal[open_[~same]] = False
        open_ = open_[same & inside]
        step += 1
    name = np.append(0, np.cumsum(~equal))
    out = np.zeros(len(s), dtype=np.int64)
    out[order] = name
    return out[lms], int(name[-1]) + 1


def permuted_lcp(s: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For symbols that fit in a byte: in text order, the common prefix (up to ``limit``) of each suffix with its predecessor in the array.

    All positions are compared at once, eight bytes a step, and leave as they differ.
    """
    n = len(s)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, dtype=np.int64)
    padded = np.append(s.astype(np.uint8), np.zeros(16, dtype=np.uint8))
    words = np.zeros(n + 8, dtype=np.uint64)
    for k in range(8):
        words |= padded[k:k + n + 8].astype(np.uint64) << np.uint64(8 * k)
    pos = np.flatnonzero(before >= 0)
    other = before[pos]
    at = 0
    while len(pos):
        x = words[np.minimum(pos + at, n + 7)] ^ words[np.minimum(other + at, n + 7)]
        differ = x != 0
        bits = x[differ]
        first = np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1)) // 8
        out[pos[differ]] = np.minimum(at + first, limit)
        pos, other = pos[~differ], other[~differ]
        at += 8
        if at >= limit:
            out[pos] = limit
            break
    return out
