"""Vectorised work on the bytes and words of whole Arrow string columns.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. All numbers
are 64-bit and wrap. Windows never cross documents: every function takes the documents' bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # documents are handled together up to this many bytes; a longer one is handled alone

_RANDOM = np.random.default_rng(20240229)
BYTE_KEYS = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        for name, factor in (("up", int(BASE)), ("down", _inverse(int(BASE)))):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document bounds of a string or binary array; a null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes together, or one row."""
    _, bounds = raw(column)
    first = 0
    for row in range(1, len(bounds)):
        if row == len(bounds) - 1 or bounds[row + 1] - bounds[first] > limit:
            yield first, row
            first = row


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums with a leading zero."""
    out = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=out[1:])
    return out


def spans_hash(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of keys[start:end] for every span, the same wherever the span stands."""
    up, down = _powers(len(keys) + 1)
    total = sums(keys * up[:len(keys)])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * BASE)


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the words' bounds per document."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~IS_SPACE[data]
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    # A word that touches a document's edge ends there even if the next document begins with a word.
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    joined = edges[inside[edges] & inside[edges + 1]]
    begins[joined] = True
    stops[joined] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return spans_hash(BYTE_KEYS[data], starts, ends)


def windows_hash(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values; empty if there are fewer."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    starts = np.arange(n)
    return spans_hash(values, starts, starts + k)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    done, have = values, 1
    while have < width:
        step = min(have, width - have)
        done = np.minimum(done[:len(done) - step], done[step:])
        have += step
    return done


def anchored_runs(values: np.ndarray, bounds: np.ndarray, k: int, window: int):
    """Runs of consecutive window starts that share their anchor.

    The anchor of a window is its leftmost k values with the smallest hash, so equal windows have equal anchors at equal places.
    Returns document, first start (from the document's beginning), number of starts, anchor hash and the anchor's place after the first
    start, of every run.
    """
    empty = np.zeros(0, np.int64)
    n = len(values) - window + 1
    if n <= 0:
        return empty, empty, empty, np.zeros(0, np.uint64), empty
    grams = windows_hash(values, k)
    bits = np.uint64(max(1, int(len(grams)).bit_length()))
    place = np.arange(len(grams), dtype=np.uint64)
    least = sliding_min((grams >> bits << bits) | place, window - k + 1)[:n]
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    whole = np.arange(n) + window <= bounds[1:][doc]
    first = np.ones(n, dtype=bool)
    first[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    begins = np.flatnonzero(first)
    lengths = np.diff(np.append(begins, n))
    counts = np.add.reduceat(whole, begins)
    keep = counts > 0
    begins, counts = begins[keep], counts[keep]
    d = doc[begins]
    return d, begins - bounds[d], counts.astype(np.int64), grams[at[begins]], at[begins] - begins
