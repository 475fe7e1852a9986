"""Class-separation statistics of features (T).

Means, deviations and correlations come from moments that tasks merge. Order statistics start from the long form and go
through distributed ranks: a feature's values are never sorted in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens.functions.columns import flag
from ledgerlens.functions.moments import column_statistics, moments, pair_correlations
from ledgerlens.functions.ranks import ranked_percentiles, running_totals
from ledgerlens.operators.assemble import long_form

STAR_LEVELS = ((0.001, "***"), (0.01, "**"), (0.05, "*"))
SIGNAL_TIERS = ((0.30, 1), (0.15, 2), (0.05, 3))
EFFECT_TIERS = ((0.80, "T1"), (0.50, "T2"), (0.20, "T3"))


def _by_class(function, label: int) -> Column:
    return function(F.when(F.col("is_mule") == label, F.col("value")))


def effect_size(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T-1: class means and |difference| over the pooled deviation, per feature, from merged moments."""
    stats = column_statistics(moments(features.where(F.col("is_mule").isin(0, 1)), cols, "is_mule"), cols)
    spread = F.sqrt((F.pow("mule_std", F.lit(2)) + F.pow("legit_std", F.lit(2))) / 2 + F.lit(1e-9))
    return stats.groupBy("feature").agg(*[  # two rows per feature
        F.max(F.when(F.col("cls") == label, F.col(value))).alias(f"{name}_{value}")
        for label, name in ((1, "mule"), (0, "legit")) for value in ("mean", "std")],
    ).withColumn("effect_size", F.abs(F.col("mule_mean") - F.col("legit_mean")) / spread)


def median_by_class(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T-7: class medians and the direction of their difference."""
    medians = ranked_percentiles(
        long_form(features, cols, ["is_mule"]), ["feature", "is_mule"], "value", {"median": 0.5})
    return medians.groupBy("feature").agg(
        F.max(F.when(F.col("is_mule") == 1, F.col("median"))).alias("mule_median"),
        F.max(F.when(F.col("is_mule") == 0, F.col("median"))).alias("legit_median"),
    ).withColumn("direction", F.when(F.col("mule_median") > F.col("legit_median"), "up").otherwise("down"))


def mann_whitney(features: DataFrame, cols: Sequence[str], min_class: int = 5) -> DataFrame:
    """T-2: U of the positive class, its signed effect r, z and the two-sided p; NULL for classes under ``min_class``.

    The p-value is the normal approximation with tie and continuity correction. Python touches one row per feature.
    """
    counts = long_form(features, cols, ["is_mule"]).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.sum(flag(F.col("is_mule") == 1)).alias("n1"), F.sum(flag(F.col("is_mule") == 0)).alias("n0"))
    ranked = running_totals(counts, ["feature"], "value", {"below0": "n0"})
    ties = (F.col("n0") + F.col("n1")).cast("double")
    sums = ranked.groupBy("feature").agg(
        F.sum("n1").cast("double").alias("m"), F.sum("n0").cast("double").alias("n"),
        F.sum(F.col("n1") * (F.col("below0") + F.col("n0") / 2)).alias("u"),
        F.sum(ties * ties * ties - ties).alias("tie_term"))
    m, n, total = F.col("m"), F.col("n"), F.col("m") + F.col("n")
    enough = (m >= min_class) & (n >= min_class)
    shift = F.col("u") - m * n / 2
    sigma = F.sqrt(m * n / 12 * (total + 1 - F.col("tie_term") / (total * (total - 1))))
    z = F.signum(shift) * F.greatest(F.abs(shift) - 0.5, F.lit(0.0)) / sigma
    out = sums.select(
        "feature", m.cast("long").alias("n_mule"), n.cast("long").alias("n_legit"),
        F.when(enough, F.col("u")).alias("u"),
        F.when(enough, shift / F.sqrt(m * n * (total + 1) / 12)).alias("r"),
        F.when(enough & (sigma > 0), z).alias("z"),
    )
    return out.withColumn("p_value", _two_sided(F.col("z")))


@F.pandas_udf(T.DoubleType())
def _two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda v: math.nan if v is None or math.isnan(v) else math.erfc(abs(v) / math.sqrt(2)))


def _pick(value: Column, steps: Sequence[tuple[float, object]], below: bool = False) -> Column:
    chosen = F.lit(None)
    for limit, result in reversed(steps):
        chosen = F.when(value < limit if below else value >= limit, F.lit(result)).otherwise(chosen)
    return chosen


def signal_table(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T-3: medians, direction, r, p, significance stars and signal tier, strongest first."""
    joined = median_by_class(features, cols).join(mann_whitney(features, cols), "feature")
    size, p = F.abs("r"), F.col("p_value")
    tier = _pick(size, SIGNAL_TIERS)
    weak = (tier == 3) & ~(p < 0.05)
    return joined.withColumns({
        "stars": F.coalesce(_pick(p, STAR_LEVELS, below=True), F.lit("ns")),
        "tier": F.when(weak, None).otherwise(tier),
    }).orderBy(F.desc(size), "feature")


def feature_audit(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T-4: means, medians, effect size, p and tier, by effect size and then p."""
    joined = effect_size(features, cols).join(median_by_class(features, cols), "feature").join(
        mann_whitney(features, cols, min_class=1).select("feature", "z", "p_value"), "feature")
    tier = F.coalesce(_pick(F.col("effect_size"), EFFECT_TIERS), F.lit("T4"))
    return joined.withColumn("tier", tier).orderBy(F.desc("effect_size"), F.asc("p_value"), "feature")


def tier_counts(audit: DataFrame) -> DataFrame:
    """T-4: number of features per tier."""
    return audit.groupBy("tier").agg(F.count("*").alias("features"))


def correlation_matrix(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T-5: Pearson correlation of every column pair from merged co-moments; undefined values are 0."""
    pairs = pair_correlations(moments(features, cols), cols)
    return pairs.select("feature_a", "feature_b", F.coalesce(F.nanvl("correlation", F.lit(0.0)), F.lit(0.0)).alias("correlation"))


def clipped_histogram(
    features: DataFrame, cols: Sequence[str], bins: int = 40, clip_at: float = 0.99, log: bool = False,
) -> DataFrame:
    """T-6: per feature and class the density histogram after clipping at the joint quantile ``clip_at``.

    Bins are equal parts of the class's own range, the last one closed; a single-valued class spans half a unit
    to both sides.
    """
    long = long_form(features, cols, ["is_mule"]).where(F.col("value").isNotNull())
    if log:
        long = long.withColumn("value", F.log1p("value"))
    caps = ranked_percentiles(long, ["feature"], "value", {"cap": clip_at})
    clipped = long.join(F.broadcast(caps), "feature").withColumn("value", F.least("value", "cap")).drop("cap")
    # One row per feature and class: bounded by the width of the matrix, so it is broadcast.
    ranges = clipped.groupBy("feature", "is_mule").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("total"))
    single = F.col("lo") == F.col("hi")
    ranges = ranges.select(
        "feature", "is_mule", "total",
        F.when(single, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(single, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    return (
        clipped.join(F.broadcast(ranges), ["feature", "is_mule"])
        .groupBy("feature", "is_mule", place.alias("bin"), "lo", "hi", "total").agg(F.count("*").alias("n"))
        .select("feature", "is_mule", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"), "n",
                (F.col("n") / (F.col("total") * width)).alias("density"))
    )
