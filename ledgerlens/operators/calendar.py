"""Calendar shares, activity span and rolling peak (E), burst index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.columns import clip, share
from ledgerlens.schema import MONTH_BOUNDARY_DAYS


def calendar_aggregates(first_hour: int = 6, last_hour: int = 21) -> dict[str, Column]:
    weekday = F.dayofweek("ts")  # Sunday is 1, Saturday is 7
    return {
        "weekend_share": share(weekday.isin(1, 7)),
        "sunday_share": share(weekday == 1),
        "offhours_share": share(~F.hour("ts").between(first_hour, last_hour)),
        "month_boundary_share": share(F.dayofmonth("ts").isin(*MONTH_BOUNDARY_DAYS)),
        "first_txn_ts": F.min("ts"),
        "last_txn_ts": F.max("ts"),
    }


def calendar_shares(tx: DataFrame, first_hour: int = 6, last_hour: int = 21) -> DataFrame:
    """Shares by weekday, hour and day of month, with first and last time."""
    named = [column.alias(name) for name, column in calendar_aggregates(first_hour, last_hour).items()]
    return tx.groupBy("account_id").agg(*named)


def activity_span(daily: DataFrame) -> DataFrame:
    """Active days, calendar days and their quotient."""
    return daily.groupBy("account_id").agg(
        F.count("*").alias("active_days"),
        (F.datediff(F.max("txn_date"), F.min("txn_date")) + 1).alias("calendar_days"),
    ).withColumn("activity_density", F.col("active_days").cast("double") / F.col("calendar_days"))


def rolling_peak(daily: DataFrame, days: int = 90) -> DataFrame:
    """Rolling ``days``-day transaction count: its peak, its mean over active days, and their quotient.

    The window runs over the daily grain, so a partition is bounded by the number of calendar days.
    """
    window = Window.partitionBy("account_id").orderBy("day_no").rangeBetween(-days, Window.currentRow)
    rolled = daily.withColumn("day_no", F.unix_date("txn_date")).withColumn("rolled", F.sum("n").over(window))
    peak, mean = f"peak_{days}d_count", f"avg_{days}d_count"
    return rolled.groupBy("account_id").agg(F.max("rolled").alias(peak), F.avg("rolled").alias(mean)).withColumn(
        f"peak_to_avg_{days}d", F.col(peak) / F.col(mean))


def days_to_first_txn(first_times: DataFrame, accounts: DataFrame) -> DataFrame:
    """Whole days from opening to the first transaction, not below 0; NULL without an opening date."""
    opening = accounts.select("account_id", F.col("account_opening_date").cast("timestamp").alias("_opened"))
    seconds = F.unix_seconds("first_txn_ts") - F.unix_seconds("_opened")
    return first_times.join(opening, "account_id", "left").select(
        "account_id", clip(F.floor(seconds / 86400), low=0).alias("days_to_first_txn"))


def burst_index(daily: DataFrame) -> DataFrame:
    """Variation of daily counts over active days; NULL for a single active day."""
    return daily.groupBy("account_id").agg(
        F.count("*").alias("active_days"), F.avg("n").alias("avg_daily_txns"),
        F.stddev_samp("n").alias("std_daily_txns"), (F.stddev_samp("n") / F.avg("n")).alias("burst_index"))
