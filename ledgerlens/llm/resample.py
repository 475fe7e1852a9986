"""Target-distribution importance resampling over hashed n-grams.

Texts are lower-cased in A-Z and their separators collapsed to single spaces. For each n a regular expression is scanned with overlapping
matches; lookarounds at word boundaries let every match begin and end with a word, so that the matches are the runs of n words, and the
CRC-32 of each span picks its bucket. A document keeps its occupied buckets and their counts, stored once.

The raw corpus and the target give the buckets' counts; the logarithm of the ratio of their smoothed shares is the bucket's gain. A document's
weight is the mean gain of its features. Weight plus Gumbel noise of the document's own id is its score, and the highest scores are a
weighted sample without replacement.

Ranks need no sort of all documents: scores are whole numbers from a range that gains and noise bound (some 10^5 values at any size), so
the number of documents at each score gives the cut and each score's first rank; only drawn documents of equal score are ordered.

Defined cases: a null, empty or wordless text has no features and weight 0; a null doc_id draws the noise of ``<seed>:null`` and comes last among
equal scores; rows that repeat an id are ranked one by one in the order of their features and weight; empty tables (either) count nothing; further columns
are not looked at; a text of any length is read whole, match by match.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.llm.frames import fields, kept, small_batches

BUCKETS = 10_000
MOST = 1  # words in the longest feature
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # ASCII without digits and, after lower-casing, letters


@cache
def _run(n: int) -> regex.Pattern:
    """Runs of ``n`` words between single spaces."""
    return regex.compile(rb"(?<![^ ])[^ ]++" + rb" [^ ]++" * (n - 1) + rb"(?![^ ])")


def spans(text: str | None, most: int = MOST) -> Iterator[bytes]:
    """All runs of 1 to ``most`` consecutive words, as UTF-8 with single spaces."""
    line = SEPARATORS.sub(b" ", (text or "").encode().lower())  # bytes.lower changes A-Z only
    for n in range(1, most + 1):
        for match in _run(n).finditer(line, overlapped=True):
            yield match[0]


def profiles(docs: DataFrame, keep: tuple[str, ...] = (), most: int = MOST, buckets: int = BUCKETS) -> DataFrame:
    """``keep``, the numbers of words and features, and the occupied buckets with their counts."""
    chosen = docs.select(*keep, "text")

    def run(batches):
        for batch in batches:
            n_words, n_features, places, counts = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = np.fromiter((zlib.crc32(span) % buckets for span in spans(text, most)), np.int32)
                place, count = np.unique(found, return_counts=True)
                n_features.append(len(found))
                n_words.append(len(found) if most == 1 else sum(1 for _ in spans(text, 1)))
                places.append(place)
                counts.append(count)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(part or [np.empty(0, kind)]).astype(kind)))
                     for part, kind in ((places, np.int32), (counts, np.int64))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), *lists],
                names=[*keep, "n_words", "n_features", "buckets", "counts"])

    return small_batches(chosen).mapInArrow(
        run, fields(chosen, keep, "n_words bigint, n_features bigint, buckets array<int>, counts array<bigint>"))


def _totals(profiled: DataFrame, name: str) -> DataFrame:
    """Features of all documents per bucket: summed inside tasks first, never more than ``buckets`` rows."""
    return profiled.select(F.explode(F.arrays_zip("buckets", "counts")).alias("_f")).groupBy(F.col("_f.buckets").alias("bucket")).agg(
        F.sum("_f.counts").alias(name))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``gain`` in thousandths for every bucket, from the profiles of both corpora."""
    every = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(_totals(raw, "s"), "bucket", "left").join(_totals(target, "t"), "bucket", "left").na.fill(0, ["s", "t"])
    whole = Window.partitionBy()  # one row per bucket
    seen, wanted = F.col("s").cast("double"), F.col("t").cast("double")
    share = (wanted + 1) * (F.sum(seen).over(whole) + buckets) / ((seen + 1) * (F.sum(wanted).over(whole) + buckets))
    return both.select("bucket", F.floor(1000 * F.log(share)).alias("gain"))


def weighed(profiled: DataFrame, gained: DataFrame, seed: int = SEED) -> DataFrame:
    """Profiles with ``weight`` and ``score`` in place of buckets and counts.

    The gains, one number per bucket, enter the projection as one constant array, so no document is shuffled.
    """
    listed = [r.gain for r in gained.orderBy("bucket").collect()]  # exactly ``buckets`` numbers
    table = F.from_json(F.lit(str(listed)), "array<bigint>")
    total = F.aggregate(F.zip_with("buckets", "counts", lambda b, c: F.get(table, b) * c), F.lit(0).cast("bigint"), lambda a, b: a + b)
    n = F.greatest("n_features", F.lit(1))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    return profiled.withColumn("_t", total).withColumn("weight", ((F.col("_t") - F.pmod("_t", n)) / n).cast("bigint")).select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"))


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored``, a stored table, with ``rank`` 1, 2, 3, ... for the drawn documents."""
    able = F.col("n_words") >= least_words
    at = scored.where(able).groupBy("score").agg(F.count("*").alias("n"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)  # one row per whole score
    steps = at.select("score", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_before"),
                      F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100).alias("_draws"))
    reached = kept(steps.where(F.col("_before") < F.col("_draws")), "drawn-scores")
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    place = F.col("_before") + F.row_number().over(order)
    # Scores are whole numbers of a bounded range, see above.
    upper = scored.where(able).join(F.broadcast(reached), "score").withColumn("_place", place).select(
        *scored.columns, F.when(F.col("_place") <= F.col("_draws"), F.col("_place")).cast("bigint").alias("rank"))
    lower = scored.where(able).join(F.broadcast(reached), "score", "left_anti").unionByName(scored.where(~able))
    return upper.unionByName(lower.select(*scored.columns, F.lit(None).cast("bigint").alias("rank")))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, most: int = MOST,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and ``rank`` of every document; the drawn ones have a rank."""
    raw = kept(profiles(docs, ("doc_id",), most, buckets), "profiles")
    gained = gains(raw, profiles(target, (), most, buckets), buckets)
    return ranked(kept(weighed(raw, gained, seed), "scored"), percent, least_words)


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with their own columns. ``doc_id`` must tell documents apart."""
    chosen = resample(docs, target, **options).where("rank is not null").select("doc_id")
    return docs.join(chosen.hint("merge"), "doc_id", "left_semi")
