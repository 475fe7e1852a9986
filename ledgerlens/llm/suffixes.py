"""Exact substring removal with suffix arrays built by grouping.

``suffix_array`` sorts in linear time without renaming or recursion. Phase 1 keeps suffixes in groups that share a Lyndon prefix and visits the
groups in descending order: the pointer of each suffix to its previous smaller suffix tells which suffix is prolonged by the group's prefix, and those are split off
the top of their own group, more repetitions higher. Phase 2 reads the array from the left and puts every suffix whose Lyndon
prefix ends where the current suffix starts at the next free place of its group.

The corpus is never one string: pieces of text that may repeat meet under their common anchor (see ``repeats``), and arrays are built
over the pieces that differ. Pieces of one anchor are aligned at it, so they are read as strings of 8-byte characters counted from
the anchor; suffixes that share as many of these as any repeated window holds stand together in the array, and the exact bytes of their windows decide.

Defined cases: a null text is empty; texts shorter than the window lose nothing; rows repeated with one id count as separate places, so both
lose their text; ties do not arise, since all occurrences go; nulls elsewhere, empty tables and additional columns change nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm import text as T
from ledgerlens.llm.frames import fields, numbered_packed, small_batches, unpacked
from ledgerlens.llm.repeats import Kind, Marks, Piece, _intervals, covered, marked

WINDOW = 200
ANCHOR = 64
BLOCK = 8
LIMIT = 20_000


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Start places of all suffixes in ascending order; a suffix precedes those it is a prefix of."""
    n = len(symbols)
    if n == 0:
        return []
    # Groups by first symbol. group[s] is the first place of the group of suffix s, size[g] its size.
    counts = np.asarray(symbols)
    order = np.argsort(counts, kind="stable")
    ordered = counts[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    begins = np.flatnonzero(new)
    first_of = begins[np.cumsum(new) - 1]
    array: list[int] = order.tolist()
    place_of = np.empty(n, np.int64)
    place_of[order] = np.arange(n)
    group_of = np.empty(n, np.int64)
    group_of[order] = first_of
    sizes = np.zeros(n + 1, np.int64)
    sizes[begins] = np.diff(np.append(begins, n))
    place, group, size = place_of.tolist(), group_of.tolist(), sizes.tolist()
    previous = [-1] * n
    length = [1] * n  # of the Lyndon prefix
    top = n
    while top > 0:
        g = group[array[top - 1]]
        members = array[g:top]
        top = g
        prolonged: dict[int, int] = {}
        if len(members) == 1:
            s = members[0]
            p = s - 1
            while p >= 0 and group[p] > g:
                p = previous[p]
            previous[s] = p
            if p < 0:
                continue
            # One suffix in front, once: it moves to the top of its group.
            length[p] += length[s]
            old = group[p]
            rest = size[old] - 1
            if rest:
                size[old] = rest
                tail = old + rest
                other, at = array[tail], place[p]
                array[at], place[other] = other, at
                array[tail], place[p] = p, tail
                group[p] = tail
                size[tail] = 1
            continue
        members.sort(reverse=True)
        repeats: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] > g:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                times = repeats.get(s, 0) + 1
                if group[p] == g:
                    repeats[p] = times
                else:
                    prolonged[p] = times
        if not prolonged:
            continue
        by_times: dict[int, list[int]] = {}
        for p, times in prolonged.items():
            by_times.setdefault(times, []).append(p)
        own = length[members[0]]
        for times in sorted(by_times, reverse=True):
            chosen = by_times[times]
            for p in chosen:
                length[p] += times * own
                old = group[p]
                size[old] -= 1
                tail = old + size[old]
                other, at = array[tail], place[p]
                array[at], place[other] = other, at
                array[tail], place[p] = p, tail
            for p in chosen:
                tail = group[p] + size[group[p]]
                group[p] = tail
            for p in chosen:
                size[group[p]] = 0
            for p in chosen:
                size[group[p]] += 1
    # Phase 2. Suffixes by the place where their Lyndon prefix ends.
    ends = np.arange(n) + np.array(length)
    by_end = np.argsort(ends, kind="stable")
    bounds = np.searchsorted(ends[by_end], np.arange(n + 2)).tolist()
    by_end = by_end.tolist()
    free = list(range(n))  # next free place of the group that starts here
    out = [0] * n
    for s in by_end[bounds[n]:bounds[n + 1]]:
        g = group[s]
        out[free[g]] = s
        free[g] += 1
    for i in range(n):
        e = out[i]
        for s in by_end[bounds[e]:bounds[e + 1]]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
    return out


def _repeated_blocks(pieces: list[Piece], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, byte place) of the aligned 8-byte characters from which as many agree with another piece as a window holds."""
    per_window = (window - BLOCK + 1) // BLOCK
    bodies, owner, start = [], [], []
    for i, piece in enumerate(pieces):
        skip = piece.offset % BLOCK
        blocks = (len(piece.body) - skip) // BLOCK
        bodies.append(np.frombuffer(piece.body, np.uint8, blocks * BLOCK, skip).view(np.uint64))
        owner.append(np.full(blocks, i))
        start.append(skip + BLOCK * np.arange(blocks))
    lengths = np.array([len(b) for b in bodies])
    owner, start = np.concatenate(owner), np.concatenate(start)
    _, symbols = np.unique(np.concatenate(bodies), return_inverse=True)
    # A smallest symbol ends every piece.
    ends = np.cumsum(lengths)
    joined = np.insert(symbols + 1, ends, 0)
    at = np.arange(len(symbols)) + np.repeat(np.arange(len(lengths)), lengths)
    back = np.full(len(joined), -1)
    back[at] = np.arange(len(symbols))
    array = back[np.array(suffix_array(joined.tolist()))]
    array = array[array >= 0]
    array = array[np.repeat(ends, lengths)[array] - array >= per_window]
    if len(array) < 2:
        return owner[:0], start[:0]
    same = np.ones(len(array) - 1, dtype=bool)
    for step in range(per_window):
        same &= symbols[array[1:] + step] == symbols[array[:-1] + step]
    together = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    chosen = array[together]
    return owner[chosen], start[chosen]


def settle(groups: list[list[Piece]], window: int = WINDOW) -> Iterator[tuple[Piece, Marks]]:
    """Mark every window that occurs more than once among the pieces of a group."""
    mixed: list[Piece] = []
    for group in groups:
        for piece in group:
            if len(piece.rows) > 1:
                whole = [(0, piece.starts)]
                yield piece, (whole, whole)
        # A piece with one occurrence can only repeat inside another one.
        if len(group) > 1 and any(len(piece.rows) == 1 for piece in group):
            mixed += group
    if not mixed:
        return
    owner, start = _repeated_blocks(mixed, window)
    # Exact check: windows that hold these characters, compared byte by byte.
    bounds = T.sums(np.array([len(p.body) for p in mixed], np.int64))
    data = np.frombuffer(b"".join(p.body for p in mixed), np.uint8)
    candidate = np.zeros(len(data), dtype=bool)
    starts = np.array([p.starts for p in mixed])
    for back in range(BLOCK):
        place = start - back
        good = (place >= 0) & (place < starts[owner])
        candidate[bounds[owner[good]] + place[good]] = True
    places = np.flatnonzero(candidate)
    if not len(places):
        return
    values = T.BYTE_KEYS[data]
    hashes = T.spans_hash(values, places, places + window)
    order = np.argsort(hashes, kind="stable")
    places, hashes = places[order], hashes[order]
    begins = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    leader = places[np.flatnonzero(begins)[np.cumsum(begins) - 1]]
    equal = np.ones(len(places), dtype=bool)
    for step in range(window):
        equal &= data[places + step] == data[leader + step]
    if not equal.all():
        raise ArithmeticError("two different windows share a 64-bit hash; choose another base")
    counts = np.bincount(np.cumsum(begins) - 1)
    repeated = np.zeros(len(data), dtype=bool)
    repeated[places[counts[np.cumsum(begins) - 1] > 1]] = True
    for i, piece in enumerate(mixed):
        if len(piece.rows) == 1:
            runs = _intervals(repeated[bounds[i]:bounds[i] + piece.starts])
            if runs:
                yield piece, (runs, runs)


def without_repeats(docs: DataFrame, window: int = WINDOW, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, ``kept`` (the remaining bytes) and kept_sha256 of every text.

    Every byte in a string of ``window`` bytes that also starts anywhere else in the corpus is removed.
    """
    kind = Kind(by_words=False, window=window, k=min(ANCHOR, max(1, window // 3)))
    found = marked(numbered_packed(docs, "doc_id"), kind, partial(settle, window=window), keep_first=False, limit=limit)

    def run(batches):
        for batch in batches:
            sizes, removed, spans, rest, digest = [], [], [], [], []
            texts, marks = unpacked(batch.column("packed")), batch.column("marks")
            for i in range(batch.num_rows):
                data, _ = T.raw(texts.slice(i, 1))
                gone = covered(marks[i], len(data), window)
                left = data[~gone].tobytes()
                sizes.append(len(data))
                removed.append(int(gone.sum()))
                spans.append(len(_intervals(gone)))
                rest.append(left)
                digest.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(rest, pa.binary()),
                 pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return small_batches(found).mapInArrow(
        run, fields(docs, ["doc_id"], "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"))
