"""Near duplicates by SimHash and multi-index hashing.

Fingerprints: a text's terms are its runs of ``TERM`` words with repeats, lower-cased in A-Z and joined by one space (the whole sequence if it has
fewer words). Every term is hashed to 64 bits by XXH64; a bit of the fingerprint is 1 if more than half of the hashes have it.

Search: a fingerprint is cut into two segments. Two fingerprints that differ in at most ``radius`` bits differ in at most half as many in one
of the segments, so each looks up its own segment and the small Hamming ball around it in a table keyed by segment, and whole
distances decide. A key that holds more than ``CROWD`` different fingerprints is not compared through: the bits outside the key are cut into
two segments in turn, and those who look it up go on with the flips they have left. Keys of 56 bits hold at most ``CROWD``
fingerprints, so the descent ends, and no fingerprint is ever compared with more than ``CROWD`` others for one key. Only different fingerprints are
searched; copies count once.

Defined cases: a null or blank text has fingerprint zero and is linked like any other; a null doc_id takes part, a component's id is its
smallest doc_id that is not null, and null if there is none; repeated rows are kept as rows; an empty table gives an empty table; further
columns are not looked at. A text is read in blocks, so its length does not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.components import components
from ledgerlens.llm.frames import fields, kept, small_batches
from ledgerlens.llm.spread import joined

TERM = 3
SEED = 42
BITS = 64
RADIUS = 3
LAST = 8  # bits that stay free at the last level
CROWD = 1 << LAST  # fingerprints under one key: as many as fit at the last level
BLOCK = 1 << 20  # bytes of a text that are split into words at a time
SPACE = re.compile(rb"[ \t-\r]")


def _blocks(data: bytes) -> Iterator[bytes]:
    """The bytes in blocks that end at white space."""
    at = 0
    while len(data) - at > BLOCK:
        cut = SPACE.search(data, at + BLOCK)
        if not cut:
            break
        yield data[at:cut.start()]
        at = cut.end()
    yield data[at:]


def fingerprint(text: str | None, term: int = TERM, seed: int = SEED) -> int:
    """The SimHash of a text as an unsigned number."""
    votes, n, carried = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def vote(hashes: list[int]) -> None:
        nonlocal votes, n
        votes += np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        n += len(hashes)

    for block in _blocks((text or "").encode().lower()):  # bytes.lower changes A-Z only
        words = carried + block.split()
        if len(words) >= term:
            line = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            vote([digest(line[a:b], seed) for a, b in zip((ends - lengths).tolist(), ends[term - 1:].tolist())])
        carried = words[max(0, len(words) - term + 1):]
    if not n and carried:
        vote([digest(b" ".join(carried), seed)])
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), term: int = TERM, seed: int = SEED) -> DataFrame:
    """``keep`` and the ``fingerprint`` of every text, as a signed bigint with the same bits."""
    chosen = docs.select(*keep, "text")

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t, term, seed) for t in batch.column("text").to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in keep), pa.array(found.view(np.int64))],
                                             names=[*keep, "fingerprint"])

    return small_batches(chosen).mapInArrow(run, fields(chosen, keep, "fingerprint bigint"))


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _moved(value: Column | int, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("bigint"), by)


def _segments(half: int) -> Column:
    """Both ways to look at the ``2 * half`` free bits from bit ``free`` on: one segment is looked up (``seg``), the other one stays free."""
    return F.explode(F.array(*[F.struct((F.col("free") + a).alias("seg"), (F.col("free") + b).alias("rest")) for a, b in ((0, half), (half, 0))]))


def _keyed(rows: DataFrame, half: int) -> DataFrame:
    """Table entries: the bits known so far and those of the segment, for either segment."""
    return rows.withColumn("_s", _segments(half)).select(
        F.col("_s.rest").cast("int").alias("rest"), "fingerprint",
        F.col("known").bitwiseOR(F.col("fingerprint").bitwiseAND(_moved((1 << half) - 1, F.col("_s.seg")))).alias("key"))


def _ball(rows: DataFrame, half: int, most: int, once: bool) -> DataFrame:
    """Keys to look up: the segment with no more flips than half of those left, at most ``most``.

    ``once`` is for inputs that all look one another up: of two that differ in the segment, only the one with a zero at the lowest differing bit flips.
    """
    flips = [sum(1 << b for b in chosen) for size in range(most + 1) for chosen in combinations(range(half), size)]
    masks = F.explode(F.array(*[F.lit(_signed(m)).cast("bigint") for m in flips]))
    spread = rows.withColumn("_s", _segments(half)).withColumn("_m", masks).where(F.bit_count("_m") <= F.floor(F.col("left") / 2))
    flip = _moved(F.col("_m"), F.col("_s.seg"))
    if once:
        lowest = _moved(F.col("_m").bitwiseAND(-F.col("_m")), F.col("_s.seg"))
        spread = spread.where(F.col("fingerprint").bitwiseAND(lowest) == 0)
    segment = F.col("fingerprint").bitwiseAND(_moved((1 << half) - 1, F.col("_s.seg")))
    return spread.select(F.col("_s.rest").cast("int").alias("rest"), F.col("fingerprint").alias("query"),
                         F.col("known").bitwiseOR(segment.bitwiseXOR(flip)).alias("key"),
                         (F.col("left") - F.bit_count("_m")).cast("int").alias("left"), (F.col("_m") != 0).alias("flipped"))


def near_pairs(prints: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Links ``a``, ``b`` between different fingerprints that differ in at most ``radius`` bits, each at least once.

    ``prints`` has one row per fingerprint. The tables and look-ups of a level meet in one join; crowded keys stand in the table as one marker
    row, and whoever meets a marker is stored for the next level.
    """
    start = prints.select(F.lit(0).alias("free"), F.lit(0).cast("bigint").alias("known"), "fingerprint")
    held, sought, half, found = start, start.withColumn("left", F.lit(radius)), BITS // 2, []
    while True:
        table = _keyed(held, half)
        crowded = kept(table.groupBy("rest", "key").agg(F.count("*").alias("n")).where(
            F.col("n") > (crowd if half > LAST else CROWD)).select("rest", "key"), "crowded")
        entries = table.join(crowded.hint("merge"), ["rest", "key"], "left_anti").select("rest", "key", "fingerprint").unionByName(
            crowded.withColumn("fingerprint", F.lit(None).cast("bigint")))
        once = half == BITS // 2
        looked = _ball(sought, half, radius // 2, once)
        # At the first level all look one another up; equal segments would meet twice. Below, a look-up may be the only one of its pair.
        forward = (F.col("flipped") | (F.col("query") < F.col("fingerprint"))) if once else F.col("query") != F.col("fingerprint")
        close = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint"))) <= radius
        met = kept(looked.join(entries.hint("merge"), ["rest", "key"]).where(F.col("fingerprint").isNull() | (forward & close)), "met")
        found.append(met.where("fingerprint is not null").select(F.col("query").alias("a"), F.col("fingerprint").alias("b")))
        if crowded.isEmpty():
            break
        held = kept(table.join(crowded.hint("merge"), ["rest", "key"], "left_semi"), "held").select(
            F.col("rest").alias("free"), F.col("key").alias("known"), "fingerprint")
        sought = met.where("fingerprint is null").select(
            F.col("rest").alias("free"), F.col("key").alias("known"), F.col("query").alias("fingerprint"), "left")
        half //= 2
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def near_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, ``fingerprint`` (signed bigint) and ``component_id`` of every row."""
    rows = kept(fingerprints(docs), "prints")
    # Copies meet here once; what follows grows with the number of different fingerprints.
    nodes = kept(rows.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "nodes")
    roots = components(near_pairs(nodes.select("fingerprint"), radius))
    rooted = kept(nodes.join(roots.withColumnRenamed("node", "fingerprint").hint("merge"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")), "rooted")
    lows = kept(rooted.groupBy("root").agg(F.count("*").alias("n"), F.min("least").alias("component_id")), "lows")
    named = kept(joined(rooted.select("fingerprint", "n", "root"), lows, "root").select("fingerprint", "n", "component_id"), "named")
    return joined(rows, named, "fingerprint").select("doc_id", "fingerprint", "component_id")
