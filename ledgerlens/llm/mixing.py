"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words. A document's expected number of copies is ``target / source_size`` times its own weight (1 unless
given), never above ``max_copies``. Every document gets the whole part as certain copies; the rest, a probability, decides a sample of
fixed size in words: documents are ranked by their random odds ``u / (1 - u)`` divided by their inclusion odds ``p / (1 - p)``, and the smallest are taken until the
source's remaining words are used up. ``u`` is a hash of seed, id and text size, so reruns agree.

No source is ever ordered in one task: its documents fall into slices of the rank variable, slice totals tell in which slice the words
run out, and only that slice is ordered. The table of sources has one row per source and is the only thing that is ordered as a whole.

Defined cases: a null or empty text has size 0, is taken 0 words and counts as present; a null source is a source of its own, last in
order; a source of size 0 has target 0; ties of the rank variable are ordered by id, then size; repeated rows are separate documents with equal
draws; an empty table gives an empty table; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm.frames import WORD, kept, numbered, packed, with_numbers, with_text

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
SLICES = 4096
SEED = "mix-1"


def sizes(rows: DataFrame) -> DataFrame:
    """doc_id, source, row number and size in words of numbered rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select("_row", "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"))


def targets(source_sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            max_copies: int = MAX_COPIES) -> DataFrame:
    """Target words per source: ``share`` of all words by weight, no source above ``max_copies`` times its size.

    Handing the excess on until none is above ends at ``least(cap, level * weight)`` for one common level. With sources ordered by
    cap / weight the capped ones are a prefix, so the level follows from running sums.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = source_sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * max_copies)
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = ((F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
             / (F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0))))
    leveled = weighed.withColumns({"_level": level, "_place": F.row_number().over(by_level)}).withColumn(
        # The first source whose cap is not reached sets the level for itself and all after it.
        "_open", F.min(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct("_place", "_level"))).over(whole)["_level"])
    return leveled.select(
        "source", "source_size",
        F.least(F.col("_cap").cast("double"), F.coalesce("_open", F.lit(float("inf"))) * F.col("_w")).alias("target"))


def uniform(*parts: Column) -> Column:
    """A number strictly between 0 and 1 from a digest of the parts, the same in every run and engine."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def pareto_mix(sized: DataFrame, source_targets: DataFrame, seed: str = SEED, weight: str | None = None,
               slices: int = SLICES, max_copies: int = MAX_COPIES) -> DataFrame:
    """Add ``copies`` and ``taken`` to ``sized`` (_row, doc_id, source, size and an optional weight with a size-weighted mean of 1)."""
    same = sized["source"].eqNullSafe(source_targets["source"])
    joined = sized.join(F.broadcast(source_targets) if weight is None else source_targets, same).drop(source_targets["source"])
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    if weight:
        expected = F.least(expected * F.col(weight), F.lit(float(max_copies)))
    u = uniform(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"))
    p = F.col("_expected") - F.col("_whole")
    # Odds ratio q in (0, inf), mapped to (0, 1) without changing the order; p = 0 is never sampled.
    odds = (F.col("_u") / (1 - F.col("_u"))) / (p / (1 - p))
    ranked = (joined.withColumns({"_expected": expected, "_u": u})
              .withColumn("_whole", F.floor("_expected").cast("bigint"))
              .withColumn("_rank", F.when(p > 0, odds / (1 + odds)))
              .withColumn("_slice", F.floor(F.col("_rank") * slices)))
    source_key = [F.coalesce(F.col("source"), F.lit("")).alias("_key"), F.col("source").isNull().alias("_none")]
    ranked = ranked.select("*", *source_key)
    group = ["_key", "_none"]

    totals = ranked.groupBy(*group, "_slice").agg(
        F.sum(F.when(F.col("_rank").isNotNull(), F.col("size")).otherwise(0)).alias("_own"),
        F.sum(F.col("_whole") * F.col("size")).alias("_certain"), F.first("target").alias("_target"))
    everything = Window.partitionBy(*group)
    earlier = everything.orderBy(F.col("_slice").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    cut = totals.select(*group, "_slice", "_own",
                        (F.col("_target") - F.sum("_certain").over(everything)).alias("_need"),
                        F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_before"))
    # Slices below the cut are taken whole; in the slice of the cut documents are ordered; the rest is left.
    cut = cut.where("_slice is not null").select(*group, "_slice", "_need", "_before", (
        F.when(F.col("_before") + F.col("_own") <= F.col("_need"), "all").when(F.col("_before") > F.col("_need"), "none")
        .otherwise("some")).alias("_take"))
    border = ranked.join(F.broadcast(cut.where("_take = 'some'")), [*group, "_slice"])
    inside = Window.partitionBy(*group, "_slice").orderBy("_rank", F.col("doc_id").asc_nulls_last(), "size", "_row")
    upto = F.col("_before") + F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The document at the cut is taken if that brings the total nearer to the target.
    border = border.select("_row", (upto + F.col("size") / 2 <= F.col("_need")).alias("_border"))
    whole = cut.where("_take = 'all'").groupBy(*group).agg(F.max("_slice").alias("_last"))
    out = (ranked.join(F.broadcast(whole), group, "left").join(border, "_row", "left")
           .withColumn("copies", F.col("_whole") + F.coalesce(
               "_border", F.col("_slice") <= F.col("_last"), F.lit(False)).cast("bigint")))
    return out.select(*sized.columns, "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES,
        seed: str = SEED) -> DataFrame:
    """_row, doc_id, source, size, source_size, target, copies and taken of every document."""
    return _mix_rows(with_numbers(docs, "doc_id", "source", "text"), weights, share, max_copies, seed)


def _mix_rows(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES,
              seed: str = SEED) -> DataFrame:
    sized = kept(sizes(rows), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return pareto_mix(sized, kept(targets(totals, weights, share, max_copies), "mix-targets"), seed, max_copies=max_copies)


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix with their own columns, each repeated as often as the mix takes it."""
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"])
    rows = numbered(docs.select(others.alias("_doc"), "doc_id", "source", "text"), "_doc", "doc_id", "source", "text")
    chosen = _mix_rows(rows, **settings).where("copies > 0").select("_row", "copies")
    taken = with_text(packed(rows, "_row", "_doc").join(chosen, "_row"), "_doc", "copies")
    return taken.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[F.col("text") if name == "text" else F.col(f"_doc.`{name}`") for name in docs.columns])
