"""Fold-safe risk share of a code, and walk-forward folds.

The encoding looks at labels of the training rows only. It works on the (account, code) count table, which is built
once from the ledger and reused by every fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.columns import count_if
from ledgerlens.functions.ranks import global_rank, with_single_row
from ledgerlens.schema import ENCODED_FEATURE, FOLDS


def code_counts(ledger: DataFrame, code: str = "mnemonic_code") -> DataFrame:
    """(account, code) counts over ledger rows; a NULL code keeps its row, as it counts in the denominator."""
    return ledger.groupBy("account_id", F.col(code).alias("code")).agg(F.count("*").alias("n"))


def walk_forward_folds(
    features: DataFrame, date_col: str = "account_opening_date", folds: Sequence[tuple[str, str, str]] = FOLDS,
) -> DataFrame:
    """(row, fold, part) with part 'train' or 'val'; a row may train in several folds.

    Folds whose validation part has no positive are left out. ``features`` carries ``is_mule`` and the date.
    """
    when = F.col(date_col).cast("date")
    parts = []
    for i, (cutoff, start, end) in enumerate(folds):
        train, val = when <= F.lit(cutoff).cast("date"), when.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        parts.append(F.struct(F.lit(i).alias("fold"), F.when(train, "train").when(val, "val").alias("part")))
    placed = features.withColumn("_f", F.explode(F.array(*parts))).where("_f.part IS NOT NULL").select(
        *features.columns, "_f.fold", "_f.part")
    usable = placed.where("part = 'val'").groupBy("fold").agg(F.sum("is_mule").alias("_pos")).where("_pos > 0")
    return placed.join(F.broadcast(usable.select("fold")), "fold", "left_semi")  # one row per fold at most


def class_weight(labels: DataFrame) -> DataFrame:
    """Negatives per positive, one row."""
    positives = count_if(F.col("is_mule") == 1)
    negatives = count_if(F.col("is_mule") == 0)
    return labels.agg(
        positives.alias("n_pos"), negatives.alias("n_neg"),
        F.when(positives > 0, negatives.cast("double") / positives).alias("weight"))


def _class_sample(train: DataFrame, ratio: int | None, cap: int | None) -> DataFrame:
    """All labelled accounts; with limits, the first ``cap`` positives and the first ``ratio`` x positives negatives by id."""
    if ratio is None and cap is None:
        return train.select("account_id", "is_mule").where(F.col("is_mule").isin(0, 1))
    totals = train.agg(count_if(F.col("is_mule") == 1).alias("_pos"), count_if(F.col("is_mule") == 0).alias("_neg"))
    ordered = with_single_row(
        global_rank(train.select("account_id", "is_mule"), [F.desc("is_mule"), F.asc("account_id")]), totals)
    place = F.when(F.col("is_mule") == 1, F.col("rank")).otherwise(F.col("rank") - F.col("_pos"))
    all_rows = F.lit((1 << 63) - 1)
    limit = F.when(F.col("is_mule") == 1, all_rows if cap is None else F.lit(cap)).otherwise(
        all_rows if ratio is None else F.col("_pos") * ratio)
    return ordered.where((place <= limit) & (F.col("_pos") > 0) & (F.col("_neg") > 0)).select("account_id", "is_mule")


def risky_codes(
    counts: DataFrame, train: DataFrame, k: int = 10, ratio: int | None = None, cap: int | None = None,
    legacy_denominator: bool = False,
) -> DataFrame:
    """Y2: the ``k`` codes with the highest lift of transactions per positive over transactions per negative.

    ``train`` holds account_id and is_mule; every row counts unless ``ratio`` or ``cap`` ask for the published sample (10 and
    5000). Rates are per account used; ``legacy_denominator`` divides the
    positive rate by all positives even when the cap cut some off. No positives or negatives: no codes.
    """
    sample = _class_sample(train, ratio, cap)
    used = (train if legacy_denominator else sample).agg(count_if(F.col("is_mule") == 1).alias("_n1"))
    sizes = with_single_row(used, sample.agg(count_if(F.col("is_mule") == 0).alias("_n0")))
    per_code = counts.where(F.col("code").isNotNull()).join(sample, "account_id").groupBy("code").agg(
        F.sum(F.when(F.col("is_mule") == 1, F.col("n"))).alias("_k1"),
        F.sum(F.when(F.col("is_mule") == 0, F.col("n"))).alias("_k0"))
    rated = with_single_row(per_code.where(F.col("_k1") > 0), sizes).where((F.col("_n1") > 0) & (F.col("_n0") > 0))
    lift = (F.col("_k1").cast("double") / F.col("_n1")) / (
        F.coalesce(F.col("_k0").cast("double") / F.col("_n0"), F.lit(0.0)) + F.lit(0.001))
    return rated.select("code", lift.alias("lift")).orderBy(F.desc("lift"), "code").limit(k)


def risky_code_share(counts: DataFrame, codes: DataFrame, ids: DataFrame, output: str = ENCODED_FEATURE) -> DataFrame:
    """Share of an account's ledger rows with a risky code; 0 for accounts without rows or without codes."""
    marked = counts.join(F.broadcast(codes.select("code").withColumn("_risky", F.lit(1))), "code", "left")
    share = F.sum(F.when(F.col("_risky") == 1, F.col("n")).otherwise(0)).cast("double") / F.sum("n")
    shares = marked.groupBy("account_id").agg(share.alias(output))
    return ids.select("account_id").join(shares, "account_id", "left").na.fill(0.0, [output])


def fold_codes(
    counts: DataFrame, labelled: DataFrame, folds: Sequence[tuple[str, str, str]] = FOLDS, date_col: str = "account_opening_date", k: int = 10,
) -> DataFrame:
    """Y2 for all folds at once: ``fold``, ``code`` and ``lift`` of each fold's ``k`` codes, from its training rows.

    The training parts are nested: an account enters at the first cutoff that is not before its date and stays. Counts per code, class
    and entry come from one aggregate over the count table; sums over the entries so far give every fold.
    """
    order = sorted(range(len(folds)), key=lambda i: folds[i][0])
    when, entry = F.col(date_col).cast("date"), F.lit(None).cast("int")
    for place, fold in reversed(list(enumerate(order))):
        entry = F.when(when <= F.lit(folds[fold][0]).cast("date"), F.lit(place)).otherwise(entry)
    entered = labelled.select("account_id", "is_mule", entry.alias("_entry")).where("_entry IS NOT NULL AND is_mule IN (0, 1)")
    later = F.explode(F.sequence(F.col("_entry"), F.lit(len(folds) - 1))).alias("_place")

    def so_far(df: DataFrame, keys: Sequence[str], mule: Column, legit: Column, names: tuple[str, str]) -> DataFrame:
        per_entry = df.groupBy(*keys, "_entry").agg(mule.alias(names[0]), legit.alias(names[1]))
        return per_entry.select(*keys, later, *names).groupBy(*keys, "_place").agg(*[F.sum(n).alias(n) for n in names])

    is_mule, is_legit = F.col("is_mule") == 1, F.col("is_mule") == 0
    sizes = so_far(entered, [], count_if(is_mule), count_if(is_legit), ("_n1", "_n0"))  # one row per fold
    per_code = so_far(counts.where(F.col("code").isNotNull()).join(entered, "account_id"), ["code"],
                      F.sum(F.when(is_mule, F.col("n")).otherwise(0)), F.sum(F.when(is_legit, F.col("n")).otherwise(0)), ("_k1", "_k0"))
    rated = per_code.join(F.broadcast(sizes), "_place").where("_k1 > 0 AND _n1 > 0 AND _n0 > 0")
    lift = (F.col("_k1").cast("double") / F.col("_n1")) / (F.col("_k0").cast("double") / F.col("_n0") + F.lit(0.001))
    # The best of each part of the codes, then the best of those: no window holds all codes of a fold.
    part = Window.partitionBy("_place", F.pmod(F.xxhash64("code"), F.lit(256))).orderBy(F.desc("lift"), "code")
    whole = Window.partitionBy("_place").orderBy(F.desc("lift"), "code")
    near = rated.select("_place", "code", lift.alias("lift")).withColumn("_at", F.row_number().over(part)).where(F.col("_at") <= k)
    fold = F.element_at(F.array(*[F.lit(i) for i in order]), F.col("_place") + 1)
    return near.withColumn("_at", F.row_number().over(whole)).where(F.col("_at") <= k).select(fold.alias("fold"), "code", "lift")


def fold_code_shares(counts: DataFrame, codes: DataFrame, n_folds: int = len(FOLDS)) -> DataFrame:
    """Y3 for all folds at once: per account the array ``shares``, at place i the share of its rows with a risky code of fold i."""
    marks = codes.groupBy("code").agg(F.collect_set("fold").alias("_folds"))  # at most k codes a fold
    marked = counts.join(F.broadcast(marks), "code", "left")
    total = F.sum("n").cast("double")
    return marked.groupBy("account_id").agg(F.array(*[
        F.sum(F.when(F.array_contains("_folds", i), F.col("n")).otherwise(0)).cast("double") / total for i in range(n_folds)]).alias("shares"))


def with_fold_encoding(placed: DataFrame, counts: DataFrame, codes: DataFrame, n_folds: int = len(FOLDS), output: str = ENCODED_FEATURE) -> DataFrame:
    """Rows that name their fold with the share of that fold's codes; 0 for accounts without rows."""
    shares = fold_code_shares(counts, codes, n_folds)
    return placed.join(shares, "account_id", "left").withColumn(
        output, F.coalesce(F.get("shares", F.col("fold")), F.lit(0.0))).drop("shares")
