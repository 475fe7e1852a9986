"""Substring dedup with prefix-partitioned suffix trees over words.

Suffixes are split by variable-length prefixes: a suffix's prefix runs from its first word through its anchor, the run of words with
the smallest hash among its first ``WINDOW`` words (see ``repeats``), so prefixes are between ``ANCHOR`` and ``WINDOW`` words long and all suffixes that
can agree for ``WINDOW`` words have the same one. The suffixes of many prefixes make a memory-sized batch, whose subtrees are built together from the top: each
round reads the next few words of all suffixes that still have company and branches their nodes; a suffix left alone is a leaf and
drops out. Nodes that are ``WINDOW`` words deep are the repeats. Of the suffixes below one, the earliest stays and all others are marked.
A prefix with more suffixes than a batch may hold is made longer, up to ``WINDOW`` words, where a group is itself such a node.

Defined cases: a null text is empty; texts shorter than the window lose nothing; documents come in the order of doc_id, nulls last, rows
with one id in the order of the scan, so of repeated rows the first keeps its words; extra columns and nulls elsewhere change
nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm import text as T
from ledgerlens.llm.frames import fields, numbered_packed, small_batches, unpacked
from ledgerlens.llm.repeats import Kind, Marks, Piece, _intervals, covered, marked

WINDOW = 20
ANCHOR = 6
STEP = 5  # words read in one round
LIMIT = 20_000


def deep_nodes(words: np.ndarray, suffixes: np.ndarray, prefix: np.ndarray, depth: int, step: int = STEP) -> np.ndarray:
    """Node of every suffix at ``depth`` words, -1 for suffixes that are alone before that.

    ``words`` are word hashes, ``suffixes`` places in them with ``depth`` words each, ``prefix`` the group of each suffix.
    """
    out = np.full(len(suffixes), -1)
    alive = np.arange(len(suffixes))
    node = prefix
    read = 0
    while read < depth and len(alive):
        take = min(step, depth - read)
        ahead = T.spans_hash(words, suffixes[alive] + read, suffixes[alive] + read + take)
        order = np.lexsort((ahead, node))
        branch = np.concatenate(([True], (node[order][1:] != node[order][:-1]) | (ahead[order][1:] != ahead[order][:-1])))
        label = np.empty(len(alive), np.int64)
        label[order] = np.cumsum(branch) - 1
        shared = np.bincount(label)[label] > 1
        alive, node = alive[shared], label[shared]
        read += take
    out[alive] = node
    return out


def settle(groups: list[list[Piece]], window: int = WINDOW) -> Iterator[tuple[Piece, Marks]]:
    """Mark all but the earliest occurrence of every window that occurs more than once in a group."""
    mixed: list[Piece] = []
    family: list[int] = []
    for number, group in enumerate(groups):
        if len(group) == 1:
            # One piece, many times: all but its first occurrence go.
            yield group[0], ([], [(0, group[0].starts)])
        else:
            mixed += group
            family += [number] * len(group)
    if not mixed:
        return
    bounds = T.sums(np.array([len(p.body) for p in mixed], np.int64))
    data = np.frombuffer(b"".join(p.body for p in mixed), np.uint8)
    begins, ends, word_bounds = T.word_spans(data, bounds)
    words = T.word_hashes(data, begins, ends)
    starts = np.array([p.starts for p in mixed])
    owner = np.repeat(np.arange(len(mixed)), starts)
    place = np.arange(len(owner)) - np.repeat(T.sums(starts)[:-1], starts)
    # The prefix ends with the anchor: same anchor and same distance to it.
    prefix = np.array(family)[owner] * (window + 1) + np.array([p.offset for p in mixed])[owner] - place
    node = deep_nodes(words, word_bounds[owner] + place, prefix, window)
    # The earliest suffix below each node. A node's suffixes stand at one distance from the anchor, so pieces ranked by their first
    # occurrence's document, row and anchor place rank their suffixes too.
    heads = [p.order(p.first()) for p in mixed]
    heads = [(*head[:3], head[3] + p.offset) for head, p in zip(heads, mixed)]
    rank = np.empty(len(mixed), np.int64)
    rank[sorted(range(len(mixed)), key=heads.__getitem__)] = np.arange(len(mixed))
    deep = node >= 0
    keeper = np.zeros(len(owner), dtype=bool)
    if deep.any():
        best = np.full(node.max() + 1, len(mixed))
        np.minimum.at(best, node[deep], rank[owner[deep]])
        keeper[deep] = rank[owner[deep]] == best[node[deep]]
    at = T.sums(starts)
    for i, piece in enumerate(mixed):
        part = slice(at[i], at[i + 1])
        for_first = _intervals(deep[part] & ~keeper[part])
        for_others = [(0, piece.starts)] if len(piece.rows) > 1 else for_first
        if for_first or for_others:
            yield piece, (for_first, for_others)


def without_repeats(docs: DataFrame, window: int = WINDOW, limit: int = LIMIT, keep: tuple[str, ...] = ("doc_id",),
                    with_text: bool = False) -> DataFrame:
    """``keep``, n_words, n_removed, kept_sha256, ``kept``, the remaining words joined by one space, and on demand the whole text."""
    kind = Kind(by_words=True, window=window, k=min(ANCHOR, max(1, window // 3)))
    texts = numbered_packed(docs, *dict.fromkeys(["doc_id", *keep]))
    found = marked(texts, kind, partial(settle, window=window), keep_first=True, limit=limit)

    def run(batches):
        for batch in batches:
            sizes, removed, rest, digest, whole = [], [], [], [], []
            texts, marks = unpacked(batch.column("packed")), batch.column("marks")
            for i in range(batch.num_rows):
                words = texts[i].as_py().split()  # bytes are split at the same six characters
                data, bounds = T.raw(texts.slice(i, 1))
                n = len(T.word_spans(data, bounds)[0])
                gone = covered(marks[i], n, window)
                left = b" ".join(words) if not gone.any() else b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                sizes.append(n)
                removed.append(int(gone.sum()))
                rest.append(left.decode())
                whole.append(texts[i].as_py().decode() if with_text else None)
                digest.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), *(pa.array(x, pa.int64()) for x in (sizes, removed)),
                 pa.array(digest, pa.string()), pa.array(rest, pa.string()), pa.array(whole, pa.string())],
                names=[*keep, "n_words", "n_removed", "kept_sha256", "kept", "text"])

    out = small_batches(found).mapInArrow(
        run, fields(found, keep, "n_words bigint, n_removed bigint, kept_sha256 string, kept string, text string"))
    return out if with_text else out.drop("text")


def remove_substrings(docs: DataFrame, window: int = WINDOW, limit: int = LIMIT) -> DataFrame:
    """The documents with their own columns; a text that repeats earlier ones is cut down to its remaining words.

    A column ``n_chars`` follows the text.
    """
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"])
    cut = without_repeats(docs.select(others.alias("_doc"), "doc_id", "text"), window, limit, keep=("_doc",), with_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    changed = {"text": text, **({"n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})}
    return cut.select(*[changed[name].alias(name) if name in changed else F.col(f"_doc.`{name}`").alias(name) for name in docs.columns])
