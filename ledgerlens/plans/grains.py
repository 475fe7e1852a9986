"""Intermediate grains shared by many operators.

Each grain is a partial aggregate of the ledger that is far smaller than it, keyed so that a hot account is
spread over its counterparties, days or cells before anything is gathered per account.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.columns import count_if, has_valid_location, is_credit, is_debit
from ledgerlens.functions.skew import HotKeys, neighbours


def edge_table(tx: DataFrame) -> DataFrame:
    """One row per (account, counterparty): counts by side, first and last time.

    Rows without a counterparty form one row per account, so the table also carries every account.
    """
    return tx.groupBy("account_id", "counterparty_id").agg(
        F.count("*").alias("n"),
        count_if(is_credit()).alias("n_in"),
        count_if(is_debit()).alias("n_out"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def _time_measures() -> list[Column]:
    return [F.count("*").alias("n"), F.sum(F.when(is_credit(), F.col("amt")).otherwise(0.0)).alias("credit")]


def daily_table(tx: DataFrame) -> DataFrame:
    """One row per (account, active date): count and credit volume."""
    return tx.groupBy("account_id", F.to_date("ts").alias("txn_date")).agg(*_time_measures())


def hourly_table(tx: DataFrame) -> DataFrame:
    """One row per (account, date, hour) with the daily measures."""
    return tx.groupBy("account_id", F.to_date("ts").alias("txn_date"), F.hour("ts").alias("txn_hour")).agg(
        *_time_measures())


def daily_from_hourly(hourly: DataFrame) -> DataFrame:
    """The daily grain from the hourly one, without another look at the ledger."""
    measures = [c for c in hourly.columns if c not in ("account_id", "txn_date", "txn_hour")]
    return hourly.groupBy("account_id", "txn_date").agg(*[F.sum(c).alias(c) for c in measures])


def channel_table(tx: DataFrame) -> DataFrame:
    """One row per (account, channel) with its count; a NULL channel is its own row."""
    return tx.groupBy("account_id", "channel").agg(F.count("*").alias("n"))


def cell_table(ledger: DataFrame) -> DataFrame:
    """One row per (account, 0.1 degree cell, usable location): the location columns reduced once."""
    return ledger.groupBy(
        "account_id", F.round("latitude", 1).alias("lat_bin"), F.round("longitude", 1).alias("lon_bin"),
        has_valid_location().alias("located"),
    ).agg(F.count("*").alias("n"))


def step_table(ledger: DataFrame, hot: HotKeys) -> DataFrame:
    """Every row with time, side and amount of the row before it (ties broken by transaction id)."""
    return neighbours(
        ledger, hot, ["ts", "transaction_id"],
        previous={"prev_ts": "ts", "prev_type": "txn_type", "prev_amt": "amt"})
