"""Inactivity gaps and reactivation (Q), all on the daily grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.columns import count_if, ratio


def with_gaps(daily: DataFrame) -> DataFrame:
    """Add ``gap_days``: idle days until the next active date; NULL on the last one."""
    window = Window.partitionBy("account_id").orderBy("txn_date")
    return daily.withColumn("gap_days", F.datediff(F.lead("txn_date").over(window), "txn_date") - 1)


def gap_aggregates(limits: Sequence[int] = (30, 60, 90)) -> dict[str, Column]:
    return {
        "max_inactivity_gap": F.coalesce(F.max("gap_days"), F.lit(0)),
        **{f"gaps_over_{d}d": count_if(F.col("gap_days") >= d) for d in limits},
    }


def inactivity_gaps(daily: DataFrame, limits: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Q1: longest gap and the number of gaps at or over each limit."""
    return with_gaps(daily).groupBy("account_id").agg(*[c.alias(n) for n, c in gap_aggregates(limits).items()])


def _longest() -> Column:
    """Longest gap; the latest start wins a tie."""
    known = F.when(F.col("gap_days").isNotNull(), F.struct("gap_days", "txn_date"))
    return F.max(known)


def longest_gap(daily: DataFrame) -> DataFrame:
    """Q2: length and start date of the longest gap; accounts with one active date have none."""
    return with_gaps(daily).groupBy("account_id").agg(_longest().alias("g")).where("g IS NOT NULL").select(
        "account_id", F.col("g.gap_days").alias("longest_gap_days"),
        F.col("g.txn_date").alias("longest_gap_start_date"))


def reactivation(daily: DataFrame, days: int = 30, limits: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Q1 and Q3: gaps, activity before the longest gap, and in the ``days`` days after its *start* date.

    The gap start is a whole-partition window value, so the daily table is sorted once and aggregated in place.
    """
    gaps = with_gaps(daily).withColumn("_start", _longest().over(Window.partitionBy("account_id"))["txn_date"])
    after = (F.col("txn_date") > F.col("_start")) & (F.col("txn_date") <= F.date_add("_start", days))
    after_days, after_txns = count_if(after), F.sum(F.when(after, F.col("n")).otherwise(0))
    intensity = F.sum("n").cast("double") / F.count("*")
    return gaps.groupBy("account_id").agg(
        *[c.alias(n) for n, c in gap_aggregates(limits).items()],
        count_if(F.col("txn_date") < F.col("_start")).alias("pre_gap_activity_days"),
        after_days.alias("post_gap_activity_days"),
        F.sum(F.when(after, F.col("credit")).otherwise(0.0)).alias("reactivation_volume"),
        ratio(F.when(after_days > 0, after_txns.cast("double") / after_days), intensity).alias("burst_ratio_after_gap"),
    ).na.fill(0.0, ["burst_ratio_after_gap"])
