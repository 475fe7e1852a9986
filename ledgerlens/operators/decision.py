"""Score sheet and suspicious date windows (D-1, D-3, D-4, D-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions.columns import flag, format_ts
from ledgerlens.functions.ranks import ranked_percentiles

MIN_SCORE = 0.30
# Target length in days by score, highest limit first.
TARGET_DAYS = ((0.995, 21), (0.98, 28), (0.95, 35), (0.80, 45), (0.50, 60))


def score_sheet(ids: DataFrame, scores: DataFrame, score: str = "score") -> DataFrame:
    """D-1: every id with its score bounded to 0..1 and empty window columns."""
    bounded = F.when(F.col(score).isNotNull(), F.least(F.greatest(F.col(score), F.lit(0.0)), F.lit(1.0)))
    return ids.select("account_id").join(scores.select("account_id", score), "account_id", "left").select(
        "account_id", bounded.alias("is_mule"), F.lit("").alias("suspicious_start"), F.lit("").alias("suspicious_end"))


def score_percentiles(sheet: DataFrame, probs: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """D-1: percentiles of the scores, one row."""
    return ranked_percentiles(sheet, [], "is_mule", {f"p{p * 100:g}": p for p in probs})


def attach_windows(
    sheet: DataFrame, windows: DataFrame, start: str, end: str, min_score: float = MIN_SCORE, threshold: float = 0.495,
) -> DataFrame:
    """D-3: attach date windows and blank them below ``min_score``. Lengths count both end days."""
    extra = [c for c in ("near_zero_end", "method") if c in windows.columns]
    named = windows.select("account_id", F.col(start).cast("timestamp").alias("suspicious_start"),
                           F.col(end).cast("timestamp").alias("suspicious_end"), *extra)
    candidate = F.coalesce(F.col("is_mule") >= min_score, F.lit(False))
    first, last = F.col("suspicious_start"), F.col("suspicious_end")
    joined = sheet.select("account_id", "is_mule").join(named, "account_id", "left")
    length = F.floor((F.unix_seconds(last) - F.unix_seconds(first)) / 86400) + 1
    return joined.withColumns({
        "window_candidate": flag(candidate),
        "high_confidence": flag(F.col("is_mule") >= threshold),
        "old_window_days": length,
        "suspicious_start": F.when(candidate, first),
        "suspicious_end": F.when(candidate, last),
    })


def window_sheet(windows: DataFrame, start: str = "suspicious_start", end: str = "suspicious_end") -> DataFrame:
    """D-3: submission form with ISO text days."""
    return windows.select(
        "account_id", "is_mule", format_ts(F.col(start)).alias("suspicious_start"),
        format_ts(F.col(end), end_of_day=True).alias("suspicious_end"))


def tighten_windows(
    windows: DataFrame, near_days: int = 14, long_days: int = 21, least_days: int = 14,
) -> DataFrame:
    """D-4: shorten windows to a length that falls with the score, keeping the end.

    The near-zero date replaces the end when it lies within ``near_days`` of it. A window that was at least
    ``long_days`` long is not cut below ``least_days``.
    """
    score = F.col("is_mule")
    target = F.lit(None).cast("int")
    for limit, days in reversed(TARGET_DAYS):
        target = F.when(score >= limit, days).otherwise(target)
    first, last = F.to_date("suspicious_start"), F.to_date("suspicious_end")
    out = windows.withColumn("target_window_days", target)
    if "near_zero_end" in windows.columns:
        near = F.to_date("near_zero_end")
        out = out.withColumn(
            "safe_end", F.when(F.abs(F.datediff(last, near)) <= near_days, near).otherwise(last))
    else:
        out = out.withColumn("safe_end", last)
    adjustable = (
        (F.col("window_candidate") == 1) & first.isNotNull() & F.col("safe_end").isNotNull()
        & F.col("target_window_days").isNotNull())
    proposed = F.greatest(first, F.date_sub("safe_end", F.col("target_window_days") - 1))
    start = F.when(adjustable, proposed).otherwise(first)
    length = F.datediff(F.col("safe_end"), start) + 1
    guard = adjustable & (F.coalesce("old_window_days", F.lit(0)) >= long_days) & (
        F.coalesce(length, F.lit(0)) < least_days)
    out = out.withColumn("safe_start", F.when(guard, F.date_sub("safe_end", least_days - 1)).otherwise(start))
    return out.withColumns({
        "seed_window_days": F.datediff("safe_end", "safe_start") + 1,
        "changed": flag(F.col("safe_start") > first),
    })


def window_diagnostics(windows: DataFrame) -> DataFrame:
    """D-5: candidates with a window, how many changed, and the mean, extremes and quartiles of both lengths."""
    rows = windows.where((F.col("window_candidate") == 1) & F.col("old_window_days").isNotNull())
    long = rows.select(
        "changed", F.col("old_window_days").cast("double").alias("old"),
        F.col("seed_window_days").cast("double").alias("new")).unpivot(["changed"], ["old", "new"], "length", "days")
    summary = long.groupBy("length").agg(
        F.count("*").alias("candidates"), F.sum("changed").alias("changed"), F.avg("days").alias("mean"),
        F.stddev_samp("days").alias("std"), F.min("days").alias("min"), F.max("days").alias("max"))
    quartiles = ranked_percentiles(long, ["length"], "days", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return summary.join(quartiles, "length")
