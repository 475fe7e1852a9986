"""Byte-level BPE encoding and decoding by monoid tree reduction.

Encodings of byte strings form a monoid under ``join``: two neighbouring encodings are joined by re-encoding a window of tokens around
the seam, which grows until the tokens outside are proven stable. Proof: a token sequence is the encoding of its bytes exactly when every two
neighbouring tokens are the encoding of their own bytes; so only the two pairs at the window's edges need a look. A long string is
halved down to short leaves, which are merged directly, and joined up the tree; decoding concatenates up the tree.

The same holds one level up. A text is split into matches of a pattern, each encoded by itself. A space between two characters
that are not white space always starts a new match, so two halves of a text are joined by re-encoding from the last such place of
the left half to the first one of the right half.

Defined cases: a null text is empty and has no tokens; very long texts and texts without any space go through the same tree; nulls in
other columns, repeated rows, empty tables and additional columns change nothing: one row out per row in.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerlens.llm.frames import fields, small_batches

LEAF_BYTES = 6
SHORT_BYTES = 32  # up to this length pairs are searched, beyond it they are queued
LEAF_CHARS = 1 << 14
NONE = 1 << 40
MARKS = ",.;:!?"
KNOWN = 500_000  # remembered encodings of frequent words per worker; forgetting them costs time only


class ByteBPE:
    def __init__(self, rank_file: bytes, pattern: str):
        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern)
        self._known: dict[str, tuple[int, ...]] = {}
        self._seams: dict[int, tuple[int, ...]] = {}
        self._leaves: dict[bytes, list[int]] = {}

    # Byte strings

    def merge(self, data: bytes) -> list[int]:
        """Merge neighbouring parts, the lowest rank first and the leftmost among equals, until none can be merged."""
        ranks = self.ranks
        n = len(data)
        if n <= SHORT_BYTES:
            return self._merge_short(data)
        end = list(range(1, n + 1))  # end of the part that starts here
        before = list(range(-1, n - 1))  # start of the part before
        queue = [(rank, i) for i in range(n - 1) if (rank := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(queue)
        alive = [True] * n
        while queue:
            rank, i = heapq.heappop(queue)
            if not alive[i] or (j := end[i]) >= n or ranks.get(data[i:end[j]]) != rank:
                continue  # one of its two parts has been merged meanwhile
            alive[j] = False
            end[i] = end[j]
            if end[i] < n:
                before[end[i]] = i
                if (r := ranks.get(data[i:end[end[i]]])) is not None:
                    heapq.heappush(queue, (r, i))
            if (b := before[i]) >= 0 and (r := ranks.get(data[b:end[i]])) is not None:
                heapq.heappush(queue, (r, b))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def _merge_short(self, data: bytes) -> list[int]:
        rank_of = self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [rank_of(data[i:i + 2], NONE) for i in range(len(data) - 1)]
        while pairs and (least := min(pairs)) < NONE:
            i = pairs.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank_of(parts[i] + parts[i + 1], NONE)
            if i:
                pairs[i - 1] = rank_of(parts[i - 1] + parts[i], NONE)
        return [self.ranks[part] for part in parts]

    def seam(self, left: int, right: int) -> tuple[int, ...]:
        """Encoding of the bytes of two tokens."""
        key = left << 32 | right
        found = self._seams.get(key)
        if found is None:
            if len(self._seams) >= KNOWN:
                self._seams.clear()
            found = self._seams[key] = tuple(self.merge(self.bytes_of[left] + self.bytes_of[right]))
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes."""
        return self.seam(left, right) == (left, right)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the concatenation of two encoded strings."""
        if not left or not right:
            return left or right
        window = list(self.seam(left[-1], right[0]))
        if window == [left[-1], right[0]]:
            return left + right
        a = b = 1
        while True:
            left_stable = a >= len(left) or self.fits(left[-a - 1], window[0])
            right_stable = b >= len(right) or self.fits(window[-1], right[b])
            if left_stable and right_stable:
                return left[:-a] + window + right[b:]
            if not left_stable:
                a = min(2 * a, len(left))
            if not right_stable:
                b = min(2 * b, len(right))
            window = self.merge(b"".join(self.bytes_of[t] for t in left[-a:] + right[:b]))

    def encode_bytes(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            found = self._leaves.get(data)
            if found is None:
                if len(self._leaves) >= KNOWN:
                    self._leaves.clear()
                found = self._leaves[data] = self.merge(data)
            return found
        half = len(data) // 2
        return self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    # Texts

    def _matches(self, text: str) -> list[int]:
        out: list[int] = []
        for match in self.split.findall(text):
            data = match.encode()
            token = self.ranks.get(data)  # a match that is a token is that token
            if token is None:
                out += self.encode_bytes(data)
            else:
                out.append(token)
        return out

    def _word(self, word: str) -> tuple[int, ...] | None:
        """Encoding of a space and ``word``, None unless the word starts and ends with something other than white space."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        if len(self._known) >= KNOWN:
            self._known.clear()
        stem = word[:-1]
        if word[-1] in MARKS and stem.isalpha():
            # Letters and one mark are two matches; the letters are often known already.
            ids = self._known.get(stem) or tuple(self._letters(stem))
            found = (*ids, self.ranks[word[-1].encode()])
        elif word.isalpha():
            found = tuple(self._letters(word))
        else:
            found = tuple(self._matches(" " + word))
        self._known[word] = found
        return found

    def _letters(self, word: str) -> list[int]:
        """Encoding of a space and letters, which are one match."""
        data = b" " + word.encode()
        token = self.ranks.get(data)
        return self.encode_bytes(data) if token is None else [token]

    def _leaf(self, text: str) -> list[int]:
        """Encode a short text word by word; stretches around unusual white space are matched as a whole."""
        words = text.split(" ")
        out: list[int] = []
        stretch: list[str] | None = [words[0]]
        known = self._known
        for i in range(1, len(words)):
            word = words[i]
            ids = known.get(word)
            if ids is None:
                ids = self._word(word)
            if ids is not None:
                if stretch is None:
                    out += ids
                elif stretch[-1] and not stretch[-1][-1].isspace():
                    out += self._matches(" ".join(stretch))
                    stretch = None
                    out += ids
                else:
                    stretch.append(word)
            elif stretch is not None:
                stretch.append(word)
            else:
                # The word before is already encoded, but white space follows it that may belong to its stretch.
                del out[len(out) - len(self._word(words[i - 1])):]
                stretch = ["", words[i - 1], word]
        return out if stretch is None else out + self._matches(" ".join(stretch))

    def _seam(self, text: str, places: Iterator[int]) -> int | None:
        """The first place that surely starts a match: a space between two characters that are not white space."""
        for p in places:
            if text[p] == " " and not text[p - 1].isspace() and not text[p + 1].isspace():
                return p
        return None

    def encode(self, text: str) -> list[int]:
        if len(text) <= LEAF_CHARS:
            return self._leaf(text)
        half = len(text) // 2
        left, right = text[:half], text[half:]
        p = self._seam(left, range(len(left) - 2, 0, -1))
        q = self._seam(right, range(1, len(right) - 1))
        if p is None or q is None:
            return self._matches(text)
        ids, more = self.encode(left), self.encode(right)
        tail, head = len(self._leaf(left[p:])), len(self._leaf(right[:q]))
        return ids[:len(ids) - tail] + self._leaf(left[p:] + right[:q]) + more[head:]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_READY: dict[int, ByteBPE] = {}


def _encoder(shared) -> ByteBPE:
    """One encoder per worker process and vocabulary."""
    key = hash(shared.value)
    if key not in _READY:
        _READY.clear()
        _READY[key] = ByteBPE(*shared.value)
    return _READY[key]


def _share(df: DataFrame, path: str, pattern: str):
    """The vocabulary is one file of fixed size, read by the driver and broadcast."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast((file.read(), pattern))


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the token ids of the whole text, and the text decoded from them again."""
    shared = _share(docs, path, pattern)
    chosen = docs.select(*keep, "text")

    def run(batches):
        bpe = _encoder(shared)
        for batch in batches:
            ids = [bpe.encode(text or "") for text in batch.column("text").to_pylist()]
            decoded = [bpe.decode(x).decode() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in keep], pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                names=[*keep, "ids", "decoded"])

    return small_batches(chosen).mapInArrow(run, fields(chosen, keep, "ids array<int>, decoded string"))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, number of tokens and SHA-256 of ids (little-endian, 32 bits each) and of the decoded bytes."""
    shared = _share(docs, path, pattern)

    def run(batches):
        bpe = _encoder(shared)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column("text"):
                ids = bpe.encode(text.as_py() or "")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(
        run, fields(docs, ["doc_id"], "n_tokens bigint, ids_sha256 string, decoded_sha256 string"))
