"""Content-defined anchors of fixed-length strings.

Every string of ``length`` bytes has one anchor: the ``gram`` bytes in it of least hash (leftmost on ties).
Equal strings have equal anchors at equal places, so strings can only be equal if their anchors' hashes
are, and neighbouring strings mostly share one anchor, so a text falls into few runs of strings with a
common anchor.
"""

from __future__ import annotations

import numpy as np

_TABLE = np.random.default_rng(11).integers(0, 2 ** 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` (a power of two) bytes from each position; wraps past the end."""
    h = _TABLE[data]
    step, factor = 1, int(_MIX)
    while step < gram:
        h = h * np.uint64(factor) + np.roll(h, -step)
        h ^= h >> np.uint64(29)
        factor = (factor * int(_MIX) + 2 * step) % 2 ** 64
        step *= 2
    return h


def window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for every i with a whole window."""
    n = len(x)
    if n < width:
        return x[:0]
    pad = -n % width
    blocks = np.append(x, np.full(pad, np.iinfo(x.dtype).max, dtype=x.dtype)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with a common anchor: (anchor hash, text number, first start, number of starts).

    ``data`` holds the texts one after another, ``ends`` their bounds; starts count from the text's own.
    """
    return runs_of(gram_hashes(data, gram) if len(data) >= length else np.zeros(len(data), dtype=np.uint64), ends, length, gram)


def runs_of(h: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same over symbols of any kind, given the hash ``h`` of the ``gram`` symbols from each position."""
    nothing = np.zeros(0, dtype=np.int64)
    if len(h) < length:
        return nothing, nothing, nothing, nothing
    # upper half: hash, lower half: place; the same halves for any data, so equal strings choose alike
    half = np.uint64(32)
    place = np.arange(len(h), dtype=np.uint64)
    least = window_minimum(((h >> half) << half) | place, length - gram + 1)[:len(h) - length + 1]
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    size = np.diff(ends)
    text = np.repeat(np.arange(len(size)), size)[:len(anchor)]
    whole = np.arange(len(anchor)) + length <= ends[text + 1]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    first = first[whole[first]]
    # a run ends where the next one begins or the last whole string of its text starts
    upto = np.append(np.flatnonzero(new), len(anchor))
    upto = upto[np.searchsorted(upto, first, side="right")]
    last = np.minimum(upto, ends[text[first] + 1] - length + 1)
    return h[anchor[first]].view(np.int64), text[first], first - ends[text[first]], last - first
