"""Candidate windows for exact repeats: which windows can occur twice, brought together piece by piece.

Both repeat operators look for windows (``window`` consecutive bytes or words) that occur more than once. Every window has an
anchor: its leftmost run of ``k`` units with the smallest hash. Equal windows have equal anchors at equal places, so a window
whose anchor occurs once in the corpus occurs once, and all windows that can be equal meet under one anchor. Windows in a row that share an
anchor travel as one piece of text.

1. ``anchors``: one narrow row per piece; 2. one exchange by anchor counts them, and those that occur again are written down;
3. ``pieces``: their texts, equal ones of a task combined before the shuffle; 4. ``settle``: pieces of one anchor meet, at most ``limit`` of them in a group, and the operator's
own structure (suffix array or suffix tree) decides; anchors beyond the limit (a passage in very many documents) are split: their
distinct pieces are cut into single windows, which are counted by their 128-bit hash with partial aggregation; 5. the
marked windows return to their documents as intervals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.llm import text as T
from ledgerlens.llm.frames import kept, small_batches, unpacked

COMBINE_BYTES = 16 << 20  # pieces combined by one task before they are handed on
SAMPLE = 64  # one text in so many tells which anchors are hot
HOT_ROWS = 64  # rows of the sample that make an anchor hot, if they are a large part, too
SETTLE_BYTES = 1 << 20  # pieces whose groups are settled together


@dataclass(frozen=True)
class Kind:
    """What a window consists of."""

    by_words: bool
    window: int
    k: int

    def units(self, data: np.ndarray, bounds: np.ndarray):
        """Hashes of the units, their bounds per document, and each unit's start and end byte."""
        if not self.by_words:
            places = np.arange(len(data) + 1)
            return T.BYTE_KEYS[data], bounds, places[:-1], places[1:]
        starts, ends, word_bounds = T.word_spans(data, bounds)
        return T.word_hashes(data, starts, ends), word_bounds, starts, ends


@dataclass
class Piece:
    """A distinct piece of one anchor: its text, its number of window starts, where the anchor begins, and all its occurrences."""

    body: bytes
    starts: int
    offset: int
    rows: list[int]
    docs: list[int | None]
    places: list[int]

    def first(self) -> int:
        """The earliest occurrence: smallest doc_id (nulls last), then row, then place."""
        return min(range(len(self.rows)), key=self.order)

    def order(self, i: int) -> tuple:
        return self.docs[i] is None, self.docs[i] or 0, self.rows[i], self.places[i]


Marks = tuple[list[tuple[int, int]], list[tuple[int, int]]]
Settle = Callable[[list[list[Piece]]], Iterator[tuple[Piece, Marks]]]


def anchors(compact: DataFrame, kind: Kind) -> DataFrame:
    """_row, start, starts, offset and anchor of every run of windows with one anchor, in packed texts."""
    def run(batches):
        for batch in batches:
            rows = batch.column("_row").to_numpy()
            texts = unpacked(batch.column("packed"))
            for a, b in T.chunks(texts):
                data, bounds = T.raw(texts.slice(a, b - a))
                values, unit_bounds, _, _ = kind.units(data, bounds)
                doc, start, count, anchor, at = T.anchored_runs(values, unit_bounds, kind.k, kind.window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[a:b][doc]), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array(at.astype(np.int32)), pa.array(anchor.view(np.int64))],
                    names=["_row", "start", "starts", "offset", "anchor"])

    return small_batches(compact.select("_row", "packed")).mapInArrow(
        run, "_row bigint, start int, starts int, offset int, anchor bigint")


def hot_anchors(compact: DataFrame, kind: Kind) -> DataFrame:
    """``anchor`` of those with more than a thousandth of all rows, by a sample of the texts: fewer than a thousand, so they are broadcast.

    The sample only chooses how an anchor's rows are dealt for counting.
    """
    part = compact.where(F.pmod(F.xxhash64("_row"), F.lit(SAMPLE)) == 0)
    sampled = kept(anchors(part, kind).groupBy("anchor").agg(F.count("*").alias("n")), "sampled-anchors")
    total = sampled.agg(F.sum("n")).first()[0] or 0
    return sampled.where((F.col("n") >= HOT_ROWS) & (F.col("n") > total / 1000)).select("anchor", F.lit(True).alias("_hot"))


def pieces(texts: DataFrame, kind: Kind) -> DataFrame:
    """Pieces with their occurrences; ``texts`` has _row, doc_id, the packed text and the runs that are wanted."""
    schema = ("anchor bigint, body binary, starts int, offset int, rows array<bigint>, docs array<bigint>, "
              "places array<int>")
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def packed(found: dict) -> Iterator[pa.RecordBatch]:
        items = list(found.items())
        for i in range(0, len(items), 2000):
            part = items[i:i + 2000]
            columns = [*([key[j] for key, _ in part] for j in range(2)), *([entry[j] for _, entry in part] for j in range(5))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches):
        found: dict = {}
        held = 0
        for batch in batches:
            rows, docs = batch.column("_row").to_pylist(), batch.column("doc_id").to_pylist()
            texts, runs = unpacked(batch.column("packed")), batch.column("runs")
            for i in range(batch.num_rows):
                data, bounds = T.raw(texts.slice(i, 1))
                _, _, begins, ends = kind.units(data, bounds)
                raw, wanted = data.tobytes(), runs[i].values
                start, count = (wanted.field(n).to_numpy() for n in ("start", "starts"))
                lo, hi = begins[start].tolist(), ends[start + count + kind.window - 2].tolist()
                for a, b, s, c, o, anchor in zip(lo, hi, start.tolist(), count.tolist(), wanted.field("offset").to_pylist(),
                                                 wanted.field("anchor").to_pylist()):
                    key = (anchor, raw[a:b])
                    entry = found.get(key)
                    if entry is None:
                        entry = found[key] = (c, o, [], [], [])
                        held += b - a + 100
                    entry[2].append(rows[i])
                    entry[3].append(docs[i])
                    entry[4].append(s)
                    held += 24
                if held > COMBINE_BYTES:
                    yield from packed(found)
                    found, held = {}, 0
        yield from packed(found)

    return small_batches(texts).mapInArrow(run, schema)


def _intervals(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values as (first, length)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()))


def settled(found: DataFrame, settle: Settle) -> DataFrame:
    """Marked windows (_row, first, length) of the pieces of each anchor; ``settle`` gets whole groups."""
    def run(batches):
        groups: list[list[Piece]] = []
        group: dict[bytes, Piece] = {}
        current, held = None, 0

        def flush():
            rows, firsts, lengths = [], [], []
            for piece, (for_first, for_others) in settle(groups):
                head = piece.first() if for_first != for_others else -1
                for i, (row, place) in enumerate(zip(piece.rows, piece.places)):
                    for first, length in for_first if i == head else for_others:
                        rows.append(row)
                        firsts.append(place + first)
                        lengths.append(length)
            return pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(firsts, pa.int32()), pa.array(lengths, pa.int32())],
                names=["_row", "first", "length"])

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("anchor", "body", "starts", "offset", "rows", "docs", "places")]
            for anchor, body, starts, offset, rows, docs, places in zip(*columns):
                if anchor != current:
                    if group:
                        groups.append(list(group.values()))
                    group, current = {}, anchor
                    if held > SETTLE_BYTES:
                        yield flush()
                        groups, held = [], 0
                piece = group.get(body)
                if piece is None:
                    group[body] = Piece(body, starts, offset, rows, docs, places)
                    held += len(body)
                else:
                    piece.rows += rows
                    piece.docs += docs
                    piece.places += places
        if group:
            groups.append(list(group.values()))
        yield flush()

    grouped = found.repartition("anchor").sortWithinPartitions("anchor")
    return small_batches(grouped).mapInArrow(run, "_row bigint, first int, length int")


def spread(found: DataFrame, kind: Kind, keep_first: bool) -> DataFrame:
    """The same marks for anchors with too many occurrences for one group, window by window."""
    first = F.array_min(F.transform(F.arrays_zip("docs", "rows", "places"), lambda o: F.struct(
        o["docs"].isNull().alias("n"), F.coalesce(o["docs"], F.lit(0)).alias("d"), o["rows"].alias("r"), o["places"].alias("p"))))
    hot = found.withColumn("cls", F.unhex(F.md5(F.concat("body", F.lit("|").cast("binary"), F.col("anchor").cast("string").cast("binary")))))
    classes = hot.groupBy("cls", "body", "starts").agg(
        F.sum(F.size("rows")).alias("total"), F.min(first).alias("first"))

    def cut(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data, bounds = T.raw(batch.column("body").slice(i, 1))
                values, _, _, _ = kind.units(data, bounds)
                n = batch.column("starts")[i].as_py()
                one, two = (T.windows_hash(v, kind.window)[:n].view(np.int64) for v in (values, T.mix(values)))
                rest = batch.slice(i, 1).select(["cls", "total", "first"])
                yield pa.RecordBatch.from_arrays(
                    [*[pa.chunked_array([rest.column(c)]).take(pa.array(np.zeros(n, np.int64))).combine_chunks()
                       for c in ("cls", "total", "first")],
                     pa.array(np.arange(n, dtype=np.int32)), pa.array(one), pa.array(two)],
                    names=["cls", "total", "first", "j", "one", "two"])

    order = "struct<n:boolean,d:bigint,r:bigint,p:int>"
    windows = small_batches(classes).mapInArrow(cut, f"cls binary, total bigint, first {order}, j int, one bigint, two bigint")
    at = F.struct(F.col("first.n"), F.col("first.d"), F.col("first.r"), (F.col("first.p") + F.col("j")).alias("p"))
    windows = windows.withColumn("at", at)
    seen = windows.groupBy("one", "two").agg(F.sum("total").alias("all"), F.min("at").alias("best"))
    judged = windows.join(seen, ["one", "two"]).select(
        "cls", "first", "j", ((F.col("best") < F.col("at")) if keep_first else (F.col("all") > 1)).alias("head"),
        (F.col("all") > 1).alias("others"))
    marks = judged.groupBy("cls", "first").agg(*[
        F.sort_array(F.collect_list(F.when(F.col(name), F.col("j")))).alias(name) for name in ("head", "others")])

    def runs(js):
        """Consecutive numbers as (first, length)."""
        begins = F.filter(js, lambda j, i: (i == 0) | (F.get(js, i - 1) != j - 1))
        ends = F.filter(js, lambda j, i: (i == F.size(js) - 1) | (F.get(js, i + 1) != j + 1))
        return F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("j"), (b - a + 1).alias("length")))

    marks = marks.select("cls", "first", runs(F.col("head")).alias("head"), runs(F.col("others")).alias("others"))
    members = hot.select("cls", F.explode(F.arrays_zip("rows", "places")).alias("o"))
    is_first = (F.col("o.rows") == F.col("first.r")) & (F.col("o.places") == F.col("first.p"))
    return members.join(marks, "cls").select("o", F.explode(F.when(is_first, F.col("head")).otherwise(F.col("others"))).alias("m")).select(
        F.col("o.rows").alias("_row"), (F.col("o.places") + F.col("m.j")).alias("first"), F.col("m.length").alias("length"))


def marked(compact: DataFrame, kind: Kind, settle: Settle, keep_first: bool, limit: int) -> DataFrame:
    """The columns of ``compact`` and ``marks``: intervals (first, length) of the window starts that are to be removed.

    ``compact`` is a stored table with _row, doc_id and the packed text, and may have more. ``keep_first`` leaves the earliest occurrence of every
    repeated window unmarked. All columns are kept to the end, so that both joins use one exchange of the texts.
    """
    # An anchor that the sample shows to be hot is dealt by row number and counted apart; there are fewer than a thousand.
    runs = anchors(compact, kind).join(F.broadcast(hot_anchors(compact, kind)), "anchor", "left")
    hot = F.col("_hot").isNotNull()
    dealt = Window.partitionBy("anchor", F.when(hot, F.pmod(F.xxhash64("_row"), F.lit(1024))).otherwise(0))
    stored = kept(runs.withColumn("n", F.count("*").over(dealt)).where(hot | (F.col("n") > 1)), "repeated-anchors")
    heavy = stored.where(hot).groupBy("anchor").agg(F.count("*").alias("_n"))
    again = stored.join(F.broadcast(heavy), "anchor", "left").withColumn("n", F.coalesce("_n", "n")).drop("_hot", "_n").where("n > 1")

    def found(runs: DataFrame) -> DataFrame:
        wanted = runs.groupBy("_row").agg(F.collect_list(F.struct("start", "starts", "offset", "anchor")).alias("runs"))
        return pieces(compact.join(wanted.hint("merge"), "_row"), kind)

    marks = settled(found(again.where(F.col("n") <= limit)), settle)
    crowded = again.where(F.col("n") > limit)
    if not crowded.isEmpty():
        marks = marks.unionByName(spread(found(crowded), kind, keep_first))
    per_row = marks.groupBy("_row").agg(F.collect_list(F.struct("first", "length")).alias("marks"))
    return compact.join(per_row.hint("merge"), "_row", "left")


def covered(marks, n: int, window: int) -> np.ndarray:
    """Which of n units lie in a marked window; ``marks`` is an Arrow list value of (first, length)."""
    change = np.zeros(n + 1, np.int32)
    if marks is not None and marks.values is not None and len(marks.values):
        first = marks.values.field("first").to_numpy()
        np.add.at(change, first, 1)
        np.add.at(change, first + marks.values.field("length").to_numpy() + window - 1, -1)
    return np.cumsum(change[:-1]) > 0
