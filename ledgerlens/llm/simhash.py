"""Document fingerprints: SimHash over weighted word terms, and search within a Hamming radius.

Main path: DataFrame functions only. A text's terms are its runs of ``TERM`` words (the whole text if it has fewer). Each term is hashed to
64 bits; every bit votes +weight or -weight, the weight being the number of times the term occurs; the signs of the 64 sums are the
fingerprint. Votes are summed in 32 long counters with two lanes of 32 bits each, in one partial aggregation that ends
before the shuffle, so a text's terms never leave their task.

Search: fingerprints are cut into blocks; every choice of blocks that must agree gives one permuted table keyed by their bits. Two fingerprints within
the radius agree in at least ``blocks - radius`` blocks, so they meet in a table; the exact distance decides.

Defined cases: a null text is empty; an empty text and a text of white space have no terms and fingerprint 0; equal texts
have equal fingerprints; nulls in the id order last; rows with equal ids are ordered by text; an empty table gives an empty table; with one
row the next document is the row itself; further columns are not looked at.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm.frames import kept, let, words

TERM = 2
BITS = 64
COUNTERS = 32
LANES = 0x0000000100000001
RADIUS = 3
BLOCKS = 6


def _terms(w: Column) -> Column:
    """Hashes of all runs of TERM words; one hash of all words if there are fewer; none without words."""
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - TERM),
                       lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(TERM)]))
    return (F.when(F.size(w) >= TERM, runs).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
            .otherwise(F.array().cast("array<bigint>")))


def _terms_of(text: Column) -> Column:
    return let(words(text), _terms)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def simhash(df: DataFrame, texts: Column, keys: list[str]) -> DataFrame:
    """``keys``, ``which`` and ``fingerprint`` of every text in the array ``texts``; ``keys`` must tell the rows apart.

    Terms become rows only between two steps of one task: the votes of a text are summed before anything is shuffled.
    """
    terms = df.select(*keys, F.posexplode(texts).alias("which", "_text")).select(
        *keys, "which", F.explode_outer(_terms_of(F.col("_text"))).alias("_h"))
    votes = terms.groupBy(*keys, "which").agg(F.count("_h").alias("_n"), *[
        F.sum(F.shiftrightunsigned("_h", j).bitwiseAND(F.lit(LANES))).alias(f"_c{j}") for j in range(COUNTERS)])
    bits = [F.when(F.shiftrightunsigned(F.coalesce(f"_c{b % COUNTERS}", F.lit(0)), b // COUNTERS * 32)
                   .bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("_n"), F.lit(_signed(1 << b))).otherwise(F.lit(0).cast("bigint"))
            for b in range(BITS)]
    return votes.select(*keys, "which", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints."""
    return (F.lit(float(BITS)) - F.bit_count(a.bitwiseXOR(b))) / float(BITS)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _id_ranges(docs: DataFrame, n: int) -> Column:
    """Number of the row's id range, larger ids first, null ids last. At most ``n`` ranges, cut at quantiles of all ids."""
    at = F.col("doc_id")
    cuts = sorted({int(b) for b in docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n))}) if n > 1 else []
    above = F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c >= at)
    return F.when(at.isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(above))


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """_row, doc_id, text and the place and text of the next row in descending ``doc_id`` order (the first after the last).

    ``_row`` is the place in that order, a function of the rows alone: whoever reads the table again, split as it may be, gives equal rows
    equal places. Each range of ids is one window partition; the first text of a range is passed to the range before it through a
    table of one row per range.
    """
    n = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("_range", _id_ranges(docs, n))
    at = F.col("doc_id")
    first = rows.groupBy("_range").agg(
        F.count("*").alias("_n"), F.min_by("text", F.struct(at.isNull(), -F.coalesce(at, F.lit(0)), "text")).alias("_first"))
    # One row per range reaches this window. The last range finds no later one and takes the head of the first.
    around = Window.partitionBy().orderBy("_range")
    before, whole = around.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    heads = first.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"), F.sum("_n").over(whole).alias("_all"), F.coalesce(
            F.lead("_first").over(around), F.first("_first").over(around.rowsBetween(Window.unboundedPreceding, 0))).alias("_head"))
    inside = Window.partitionBy("_range").orderBy(at.desc_nulls_last(), "text")
    stepped = rows.select("*", F.lead("text").over(inside).alias("_next"), F.row_number().over(inside).alias("_at"))
    # The heads are few but hold whole texts: joined without a broadcast hint.
    row = F.col("_offset") + F.col("_at")
    return stepped.join(heads, "_range").select(
        row.alias("_row"), "doc_id", "text", (row % F.col("_all") + 1).alias("_next_row"), F.coalesce("_next", "_head").alias("_next_text"))


def edited(text: Column, other: Column) -> Column:
    """The text with its last third replaced by as many code points from the start of ``other``."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(other, F.lit(1), third))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprints of each text (``fp``), its edited form and the next document's text."""
    keys = ["_row", "_next_row", "doc_id", "n_chars", "edited_sha256"]
    altered = with_next(docs).select(
        "_row", "_next_row", "doc_id", "text", F.char_length("text").cast("bigint").alias("n_chars"),
        edited(F.col("text"), F.col("_next_text")).alias("_edited")).select(
        "*", F.unhex(F.sha2(F.col("_edited").cast("binary"), 256)).alias("edited_sha256"))
    prints = kept(simhash(altered, F.array("text", "_edited"), keys), "simhash")
    own, other = prints.where("which = 0"), prints.where("which = 1").select("_row", F.col("fingerprint").alias("edited_fp"))
    after = own.select(F.col("_row").alias("_next_row"), F.col("fingerprint").alias("next_fp"))
    return own.join(other, "_row").join(after, "_next_row").select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), F.col("fingerprint").alias("fp"),
        "next_fp", "edited_fp")


def near_pairs(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs of a query fingerprint and a stored one that differ in at most ``radius`` bits: query, fingerprint, distance.

    Both inputs have a bigint column ``fingerprint``; equal values are taken once, so copies do not multiply. Each table keys
    ``blocks - radius`` of the blocks; a pair is reported by the first table in which it meets.
    """
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
             for chosen in combinations(range(blocks), blocks - radius)]
    signed = [_signed(m) for m in masks]

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in signed])
        return df.where("fingerprint is not null").select("fingerprint").distinct().select(
            F.col("fingerprint").alias(name), F.posexplode(keys).alias("_table", "_key"))

    met = tables(queries, "query").join(tables(prints, "found"), ["_table", "_key"])
    differ = F.col("query").bitwiseXOR(F.col("found"))
    first = F.array_position(F.array(*[differ.bitwiseAND(F.lit(m)) for m in signed]), F.lit(0).cast("bigint")) - 1
    return met.where((F.bit_count(differ) <= radius) & (first == F.col("_table"))).select(
        "query", F.col("found").alias("fingerprint"), F.bit_count(differ).alias("distance"))
