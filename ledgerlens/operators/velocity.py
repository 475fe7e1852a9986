"""Bursts, hourly peaks and time between transactions (V)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.functions.columns import count_if, ratio, whole_seconds
from ledgerlens.functions.skew import HotKeys, aggregate_per_key, neighbours

GAP_PROBS = {"inter_txn_gap_p10": 0.1, "inter_txn_gap_p50": 0.5, "inter_txn_gap_p90": 0.9}


def burst_stats(daily: DataFrame, factor: float = 3) -> DataFrame:
    """V1: busiest day, and days with more than ``factor`` times the account's own mean active day."""
    mean = F.avg("n").over(Window.partitionBy("account_id"))
    return daily.withColumn("_mean", mean).groupBy("account_id").agg(
        F.max("n").alias("max_daily_txns"), count_if(F.col("n") > factor * F.col("_mean")).alias("burst_count"))


def hourly_peak(hourly: DataFrame) -> DataFrame:
    """V2: most transactions in one (date, hour)."""
    return hourly.groupBy("account_id").agg(F.max("n").alias("max_hourly_txns"))


def inter_txn_gaps(tx: DataFrame, hot: HotKeys) -> DataFrame:
    """V3: hours between consecutive transactions: p10, p50, p90 and variation. Zeros for a single transaction."""
    steps = neighbours(tx.select("account_id", "ts", "transaction_id"), hot, ["ts", "transaction_id"],
                       previous={"prev_ts": "ts"})
    gaps = steps.withColumn("gap_hours", whole_seconds(F.col("ts"), F.col("prev_ts")) / F.lit(3600.0))
    out = aggregate_per_key(
        gaps, hot, {"gap_cv": ratio(F.stddev_samp("gap_hours"), F.avg("gap_hours"))}, {"gap_hours": GAP_PROBS})
    return out.na.fill(0.0, list(GAP_PROBS))
