"""Alignment of two tokenizers over the same bytes, and how often token pairs are linked in the corpus.

Every text is tokenised whole by both. Token A of a byte-level vocabulary stands for the bytes of its entry, token B of a sentence-piece vocabulary
for its piece with U+2581 as space, or for one byte. Where both sequences spell the text with a space before it, byte offsets at which
tokens of both end cut them into groups; every A of a group is linked with every B of it.

Anchors: offsets at which both end and in both the next token is marked by a space. They cut a text into short windows of token ids, mostly
words, and the same windows come again and again: a window's groups and links are worked out once per worker and looked up by its ids.
Only ids and lengths matter inside a window, so a look-up gives what an alignment of the whole text would.

Most anchors can be told from the text: a space after another character than a space and before one that is not white. Where no token of either
vocabulary reaches over such a place and neither side merges or splits by what lies beyond it (``Side.cuts``, told from the files), a text's ids are
those of its words one after the other. Then only words that a worker does not remember are tokenised, those of a text together, and a window is looked up
by its spelling. Other tokenizers, and the words at the ends of a text that have white space there, are tokenised as they stand.

Corpus counts: a document carries its different pairs with their numbers of occurrences, stored once. Documents per pair are summed inside
tasks before the shuffle. Pairs that hold a large part of all entries return to the documents by a broadcast of bounded size, the others by a merge join.

Defined cases: a null or empty text, and one whose tokens of A or B spell other bytes (normalised or unknown characters), has no tokens: all numbers are
0 and ``groups_sha256`` is the empty string; repeated rows and null or equal doc_ids are documents of their own; an empty table gives an empty table;
further columns are not looked at; texts are tokenised one at a time, so a long one costs memory in proportion to its own length only.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from ledgerlens.llm.frames import fields, kept, small_batches
from ledgerlens.llm.spread import joined

MEMO = 400_000  # windows a worker remembers
MARK = 1 << 31
NO_PAIRS = np.empty(0, np.int64)
MEMO_TOKENS = 48  # longer windows hardly come again and are aligned each time
MEMO_CHARS = 64  # and longer words
GPT2_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # a match has a space at its start or is white
SPACE_AND_WHITE = re.compile(r" \s")
WORD_START = re.compile(r"(?<! ) (?=\S)")
OTHER_BYTES = (0, b"", b"")  # of a word that a side spells in other bytes
DIGESTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"


def byte_of_symbol() -> dict[str, int]:
    """The bytes that the symbols of a byte-level vocabulary stand for: printable Latin-1 for itself, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Side:
    """One tokenizer: ids of a text as an array, and bytes, lengths and space marks by id. A ``lossless`` one spells every text by its making.

    One that ``cuts`` has the same ids for a text and for its words (``spelled_words``) one after the other.
    """

    def __init__(self, entries: Sequence[bytes], ids, lossless: bool = False, cuts: bool = False):
        self.entries, self.ids, self.lossless, self.cuts = entries, ids, lossless, cuts
        self.sizes = [len(e) for e in entries]
        self.lengths = np.array(self.sizes, np.int64)
        self.marked = np.array([e.startswith(b" ") for e in entries])

    def spells(self, ids: np.ndarray, data: bytes) -> bool:
        return self.lossless or b"".join(map(self.entries.__getitem__, ids.tolist())) == data


def _numbers(ids: list[int]) -> np.ndarray:
    return np.frombuffer(array("I", ids), np.uint32)


def _ranks(config: dict, symbols: dict[str, int]) -> dict[bytes, int] | None:
    """The vocabulary as ranks of byte strings, where merging by rank says the same as the file: no normaliser, merges in the order of their ids."""
    model, split = config["model"], config["pre_tokenizer"] or {}
    merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    vocabulary = model["vocab"]
    plain = (config["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
             and not model.get("ignore_merges") and not model.get("unk_token") and not model.get("dropout"))
    first = len(vocabulary) - len(merges)
    if not plain or any(vocabulary.get(a + b) != first + i for i, (a, b) in enumerate(merges)):
        return None
    ranks = {bytes(map(symbols.__getitem__, token)): i for token, i in vocabulary.items()}
    return ranks if all(bytes([i]) in ranks for i in range(256)) else None


def byte_level_side(config: bytes, pattern: str) -> Side:
    """Tokenizer A from the text of its JSON file; the text is given with a space before it.

    Where the file is a plain list of merges, its ranks and ``pattern``, the split that byte-level vocabularies use, give the same ids in
    a third of the time; tests compare both for every code point. Other files go through the library that reads them.
    """
    symbols, content = byte_of_symbol(), json.loads(config)
    tokenizer = Tokenizer.from_str(config.decode())
    tokenizer.encode_special_tokens = True
    entries = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        # Added tokens may hold characters that stand for no byte; they never come out of plain text.
        entries[i] = bytes(map(symbols.__getitem__, token)) if all(c in symbols for c in token) else token.encode()
    ranks = _ranks(content, symbols)
    if ranks:
        encoding = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # Merges by rank start from the bytes of the text, all of which are in the vocabulary.
        return Side(entries, lambda text: encoding.encode_to_numpy(" " + text, disallowed_special=()), lossless=True,
                    cuts=pattern == GPT2_SPLIT)
    return Side(entries, lambda text: _numbers(tokenizer.encode(" " + text, add_special_tokens=False).ids))


def _merges_inside_words(model: bytes, spelled: Sequence[str]) -> bool:
    """Whether B takes every character as it stands and merges pairs, none of them over the end of a word."""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:  # needs protobuf; whole texts then
        return False
    content = sentencepiece_model_pb2.ModelProto.FromString(model)
    normal, trained = content.normalizer_spec, content.trainer_spec
    plain = (trained.model_type == trained.BPE and not normal.precompiled_charsmap and not normal.normalization_rule_tsv and normal.add_dummy_prefix
             and normal.escape_whitespaces and not normal.remove_extra_whitespaces and not trained.treat_whitespace_as_suffix)
    return plain and not any("\u2581" in piece.lstrip("\u2581") for piece in spelled)


def piece_side(model: bytes) -> Side:
    """Tokenizer B from the bytes of its model file; it adds the space itself."""
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    entries = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    spelled = [pieces.id_to_piece(i) for i in range(len(entries))]
    return Side(entries, lambda text: _numbers(pieces.EncodeAsIds(text)), cuts=_merges_inside_words(model, spelled))


def spelled_words(text: str) -> list[str]:
    """The text cut at every space that follows another character than a space and precedes one that is not white; those spaces left out.

    Joined by one space they give the text again. Only the first can start with white space and only the last can end with a space.
    """
    if not SPACE_AND_WHITE.search(f" {text} "):
        return text.split(" ")
    first, *others = WORD_START.split(" " + text)
    return [first[1:], *others] if first else others


class Alignment:
    """Windows, groups and links of texts, with a memory of windows."""

    def __init__(self, a: Side, b: Side, memo: int = MEMO):
        self.a, self.b, self.memo, self.known = a, b, memo, {}

    def windows(self, at: np.ndarray, bt: np.ndarray) -> Iterator[bytes]:
        """The id sequences cut at anchors: each window as its tuple of A ids and, marked by the highest bit, B ids, 32 bits each.

        Packed, a tuple is hashed and compared as one stretch of memory.
        """
        ends_a, ends_b = self.a.lengths[at].cumsum(), self.b.lengths[bt].cumsum()
        before_a = np.flatnonzero(self.a.marked[at[1:]])  # tokens before a space-marked one
        before_b = np.flatnonzero(self.b.marked[bt[1:]])
        if len(before_a) and len(before_b):
            sought, held = ends_a[before_a], ends_b[before_b]
            place = np.minimum(np.searchsorted(held, sought), len(held) - 1)
            shared = held[place] == sought
            before_a, before_b = before_a[shared], before_b[place[shared]]
        else:
            before_a = before_b = before_a[:0]
        packed_a, packed_b = at.astype("<u4", copy=False).tobytes(), (bt | np.uint32(MARK)).astype("<u4", copy=False).tobytes()
        i = j = 0
        for k, m in zip([*(4 * before_a + 4).tolist(), len(packed_a)], [*(4 * before_b + 4).tolist(), len(packed_b)]):
            yield packed_a[i:k] + packed_b[j:m]
            i, j = k, m

    def groups(self, a: list[int], b: list[int]) -> tuple[bytes, bytes]:
        """Text of the groups and linked pairs (64 bits each) of a window. Both sides are walked to their next common end."""
        size_a, size_b, b_ids = self.a.sizes, self.b.sizes, len(self.b.entries)
        said, pairs, i, j = [], [], 0, 0
        while i < len(a):
            at_i, at_j = i, j
            end_a, end_b = size_a[a[i]], size_b[b[j]]
            i, j = i + 1, j + 1
            while end_a != end_b:
                if end_a < end_b:
                    end_a += size_a[a[i]]
                    i += 1
                else:
                    end_b += size_b[b[j]]
                    j += 1
            if i - at_i == j - at_j == 1:
                x, y = a[at_i], b[at_j]
                said.append(f"{x}|{y}")
                pairs.append(x * b_ids + y)
            else:
                said.append(f"{','.join(map(str, a[at_i:i]))}|{','.join(map(str, b[at_j:j]))}")
                pairs += [x * b_ids + y for x in a[at_i:i] for y in b[at_j:j]]
        return ";".join(said).encode(), array("q", pairs).tobytes()

    def remember(self, key: bytes | str, found: tuple) -> tuple:
        if len(self.known) >= self.memo:
            self.known.clear()
        self.known[key] = found
        return found

    def window(self, key: bytes) -> tuple[bytes, bytes]:
        """Groups and pairs of a window of ids."""
        ids = array("I", key).tolist()
        found = self.groups([x for x in ids if x < MARK], [x - MARK for x in ids if x >= MARK])
        return self.remember(key, found) if len(ids) <= MEMO_TOKENS else found

    def stretch(self, text: str) -> tuple[int, bytes, bytes]:
        """Numbers of tokens (A's in the upper 32 bits), groups and pairs of a text tokenised as it stands, window by window."""
        a, b, data = self.a.ids(text), self.b.ids(text), b" " + text.encode()
        if not len(a) or not len(b) or not self.a.spells(a, data) or not self.b.spells(b, data):
            return OTHER_BYTES
        known, work = self.known.get, self.window
        said, pairs = zip(*[known(key) or work(key) for key in self.windows(a, b)])
        return len(a) << 32 | len(b), b";".join(said), b"".join(pairs)

    def learn(self, words: list[str]) -> dict[str, tuple[int, bytes, bytes]]:
        """What ``stretch`` says of each word, for words that neither start with white space nor end with a space: tokenised as one text and cut again."""
        text = " ".join(words)
        data = b" " + text.encode()
        a, b = self.a.ids(text), self.b.ids(text)
        if not self.a.spells(a, data) or not self.b.spells(b, data):
            return {word: self.stretch(word) for word in words}
        ends = np.fromiter(map(len, words) if text.isascii() else (len(word.encode()) for word in words), np.int64, len(words))
        ends = (ends + 1).cumsum()
        cuts_a, cuts_b = ((side.lengths[ids].cumsum().searchsorted(ends) + 1).tolist() for side, ids in ((self.a, a), (self.b, b)))
        a, b, i, j, found = a.tolist(), b.tolist(), 0, 0, {}
        for word, k, m in zip(words, cuts_a, cuts_b):
            found[word] = (k - i) << 32 | (m - j), *self.groups(a[i:k], b[j:m])
            if len(word) <= MEMO_CHARS:
                self.remember(word, found[word])
            i, j = k, m
        return found

    def stretches(self, text: str) -> list[tuple[int, bytes, bytes]]:
        """Numbers of tokens, groups and pairs of the words of a text; of the whole text where a side cannot be cut."""
        if not self.a.cuts or not self.b.cuts:
            return [self.stretch(text)]
        words = spelled_words(text)
        found = list(map(self.known.get, words))
        if None in found:
            missing = dict.fromkeys([word for word, said in zip(words, found) if said is None])
            ends = {word for word in (words[0], words[-1]) if word in missing and (word[0].isspace() or word[-1] == " ")}
            new = self.learn([word for word in missing if word not in ends]) if len(missing) > len(ends) else {}
            new.update((word, self.stretch(word)) for word in ends)
            found = [said or new[word] for word, said in zip(words, found)]
        return found

    def align(self, text: str | None):
        """The values of DIGESTS for one text; pairs and times as arrays."""
        found = self.stretches(text) if text else [OTHER_BYTES]
        if OTHER_BYTES in found:
            return 0, 0, 0, 0, "", NO_PAIRS, NO_PAIRS
        sizes, said, linked = zip(*found)
        n, groups, linked = sum(sizes), b";".join(said), np.frombuffer(b"".join(linked), np.int64)
        pairs, times = np.unique(linked, return_counts=True)
        return n >> 32, n & 0xFFFFFFFF, groups.count(b"|"), len(linked), hashlib.sha256(groups).hexdigest(), pairs, times


_READY: dict[int, Alignment] = {}


def _alignment(shared) -> Alignment:
    """One pair of tokenizers per worker process."""
    key = hash(shared.value)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Alignment(byte_level_side(shared.value[0], shared.value[2]), piece_side(shared.value[1]))
    return _READY[key]


def aligned(docs: DataFrame, path_a: str, path_b: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and per document the numbers of tokens, groups and links, the groups' digest and its different pairs.

    Both vocabularies are files of fixed size, read by the driver and broadcast.
    """
    with open(path_a, "rb") as a, open(path_b, "rb") as b:
        shared = docs.sparkSession.sparkContext.broadcast((a.read(), b.read(), pattern))
    chosen = docs.select(*keep, "text")
    schema = fields(chosen, keep, DIGESTS)
    names = schema.names[len(keep):]
    kinds = [pa.int64()] * 4 + [pa.string()]

    def lists(arrays: list[np.ndarray]) -> pa.ListArray:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([NO_PAIRS, *arrays])))

    def run(batches):
        both = _alignment(shared)
        for batch in batches:
            # Nothing here refers to itself; the collector would walk the remembered windows again and again.
            gc.disable()
            try:
                rows = [both.align(text.as_py()) for text in batch.column("text")]
            finally:
                gc.enable()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)),
                 *(lists([r[i] for r in rows]) for i in (5, 6))], names=[*keep, *names])

    return small_batches(chosen).mapInArrow(run, schema)


def pair_counts(links: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``n`` documents that hold it, and whether no pair of the same A id is held by more (``best``)."""
    counts = kept(links.groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    a = F.floor(F.col("pair") / size_b)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))  # one row per id of A
    return counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def cross_alignment(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and over the document's links n_best and count_sum."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    # Numbers and pairs are written once, as a second scan could number the rows anew.
    stored = kept(aligned(rows, path_a, path_b, pattern, ("doc_id", "_row")), "aligned")
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    links = stored.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("_l")).select(
        "_row", F.col("_l.pairs").alias("pair"), F.col("_l.times").alias("times"))
    rated = kept(pair_counts(links, size_b).withColumn("docs", F.col("n")), "pairs")
    sums = joined(links, rated, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("docs") * F.col("times")).alias("count_sum"))
    return stored.drop("pairs", "times").join(sums.hint("merge"), "_row", "left").na.fill(0, ["n_best", "count_sum"]).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
