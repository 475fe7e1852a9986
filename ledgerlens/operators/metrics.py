"""Exact ranking and threshold metrics (E). ``group`` evaluates many models side by side.

A row whose score is NULL or NaN has no score: it takes part in no metric.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.columns import count_if, flag, ratio
from ledgerlens.functions.ranks import global_rank, running_totals, with_single_row

SWEEP_START, SWEEP_STEP, SWEEP_COUNT = 0.05, 0.005, 180
TOP_FRACTIONS = (0.01, 0.02, 0.05, 0.10)


def _positive() -> Column:
    return F.col("is_mule") == 1


def _with_score(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")))


def score_counts(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: tied rows are merged before anything is ordered."""
    return _with_score(scores).groupBy(*group, "score").agg(
        F.sum(flag(_positive())).alias("pos"), F.sum(flag(~_positive())).alias("neg"))


def ranking_metrics(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """E-1 and E-2: tie-aware ROC AUC and step-wise average precision from one set of running totals."""
    rows = running_totals(score_counts(scores, group), group, "score", {"below_pos": "pos", "below_neg": "neg"})
    all_pos, all_neg = F.col("below_pos_total"), F.col("below_neg_total")
    wins = F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") / 2))
    caught = all_pos - F.col("below_pos")
    flagged = caught + all_neg - F.col("below_neg")
    positives, negatives = F.max(all_pos), F.max(all_neg)
    return rows.groupBy(*group).agg(
        F.when((positives > 0) & (negatives > 0), wins / (positives.cast("double") * negatives)).alias("auc"),
        F.when(positives > 0, F.sum(F.col("pos") * caught.cast("double") / flagged) / positives).alias("pr_auc"),
    )


def roc_auc(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """E-1."""
    return ranking_metrics(scores, group).select(*group, "auc")


def average_precision(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """E-2."""
    return ranking_metrics(scores, group).select(*group, "pr_auc")


def _threshold(index: Column) -> Column:
    return F.lit(SWEEP_START) + index * F.lit(SWEEP_STEP)


def thresholds_passed(score: Column) -> Column:
    """How many sweep thresholds a score reaches, by arithmetic; the guess is corrected by comparison."""
    guess = F.floor((score - SWEEP_START) / SWEEP_STEP)
    passed = F.when(_threshold(guess + 1) <= score, guess + 2).when(_threshold(guess) <= score, guess + 1).otherwise(guess)
    return F.greatest(F.least(passed, F.lit(SWEEP_COUNT)), F.lit(0))


def threshold_sweep(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """E-3: F1, precision, recall, MCC, balanced accuracy and flags at every threshold.

    Scores become a histogram over the thresholds first (181 rows per model), so only that is ever sorted.
    """
    group = list(group)
    histogram = _with_score(scores).groupBy(*group, thresholds_passed(F.col("score")).alias("passed")).agg(
        F.sum(flag(_positive())).alias("pos"), F.sum(flag(~_positive())).alias("neg"))
    # Every model needs all thresholds, also those no score falls between.
    axis = histogram.groupBy(*group).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n")).withColumn(
        "passed", F.explode(F.sequence(F.lit(0), F.lit(SWEEP_COUNT))))
    full = axis.join(histogram.withColumn("passed", F.col("passed").cast("int")), [*group, "passed"], "left")
    above = Window.partitionBy(*group).orderBy(F.desc("passed")).rowsBetween(Window.unboundedPreceding, 0)
    caught = full.select(
        *group, (F.col("passed") - 1).alias("step"), F.col("_p").alias("p"), F.col("_n").alias("n"),
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("fp")).where("step >= 0")
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    fn, tn = F.col("p") - tp, F.col("n") - fp
    spread = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return caught.select(
        *group, "step", F.round(_threshold(F.col("step")), 3).alias("threshold"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        F.when(spread > 0, (tp * tn - fp * fn) / spread).otherwise(0.0).alias("mcc"),
        ((ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2).alias("balanced_acc"),
        (F.col("tp") + F.col("fp")).alias("flags"),
    )


def best_threshold(sweep: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """E-3: the sweep row with the highest F1, the lowest threshold winning a tie."""
    cols = [c for c in sweep.columns if c not in (*group, "step")]
    best = F.max_by(F.struct(*cols), F.struct(F.col("f1"), -F.col("step"))).alias("b")
    return sweep.groupBy(*group).agg(best).select(*group, *[
        F.col(f"b.{c}").alias("best_threshold_flags" if c == "flags" else f"best_{c}") for c in cols])


def precision_recall_at(scores: DataFrame, fractions: Sequence[float] = TOP_FRACTIONS) -> DataFrame:
    """E-4: precision and recall in the top k rows by score (ties by id), for each fraction and for k = positives.

    k is at least 1 and rounds half to even.
    """
    scores = _with_score(scores)
    totals = scores.agg(F.count("*").alias("_rows"), count_if(_positive()).alias("_p"))
    ranked = with_single_row(
        global_rank(scores.select("account_id", "is_mule", "score"), [F.desc("score"), F.asc("account_id")]), totals)
    cuts = [(f"{f * 100:g}pct", F.bround(F.col("_rows") * F.lit(float(f)), 0).cast("long")) for f in fractions]
    cuts.append(("Npos", F.col("_p")))
    cut = F.explode(F.array(*[
        F.struct(F.lit(name).alias("cut"), F.greatest(size, F.lit(1)).alias("k")) for name, size in cuts]))
    # Rows beyond the largest cut leave before the fixed handful of cuts multiplies the rest.
    largest = F.greatest(*[size for _, size in cuts], F.lit(1))
    tops = ranked.where(F.col("rank") <= largest).select("rank", "is_mule", "_p", cut.alias("c")).where("rank <= c.k")
    return tops.groupBy(F.col("c.cut").alias("cut"), F.col("c.k").alias("k")).agg(
        F.avg(flag(_positive()).cast("double")).alias("precision"),
        (F.sum(flag(_positive())).cast("double") / F.greatest(F.max("_p"), F.lit(1))).alias("recall"))


def model_metrics_report(scores: DataFrame, members: Sequence[str]) -> DataFrame:
    """E-5: ranking metrics and the best threshold for every score column."""
    long = scores.unpivot(["account_id", "is_mule"], list(members), "model", "score")
    top = [
        precision_recall_at(scores.select("account_id", "is_mule", F.col(m).alias("score"))).groupBy().agg(*[
            F.max(F.when(F.col("cut") == cut, F.col(kind))).alias(f"{kind}_at_{cut}")
            for cut in [*(f"{f * 100:g}pct" for f in TOP_FRACTIONS), "Npos"] for kind in ("precision", "recall")
        ]).withColumn("model", F.lit(m))
        for m in members]
    tops = reduce(lambda left, right: left.unionByName(right), top)
    return (ranking_metrics(long, ["model"])
            .join(best_threshold(threshold_sweep(long, ["model"]), ["model"]), "model").join(tops, "model"))


def pairwise_correlation(scores: DataFrame, members: Sequence[str]) -> DataFrame:
    """E-6: Pearson correlation of every pair of score columns, one pass."""
    pairs = list(combinations(members, 2))
    row = scores.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    names = F.split("pair", r"\|")
    return row.unpivot([], [F.col(f"`{c}`") for c in row.columns], "pair", "correlation").select(
        names[0].alias("model_a"), names[1].alias("model_b"), "correlation")
