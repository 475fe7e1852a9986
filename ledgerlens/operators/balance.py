"""Running balance, rapid drain and turnover (D, U7, U9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.columns import count_if, is_debit, ratio, share, whole_seconds

NEAR_ZERO = 500


def drain_step() -> Column:
    """A debit whose previous row is a credit."""
    return is_debit() & (F.col("prev_type") == "C")


def near_zero(limit: float = NEAR_ZERO) -> Column:
    return F.abs("bal") < limit


def balance_aggregates(limit: float = NEAR_ZERO) -> dict[str, Column]:
    level = F.abs("bal")
    return {
        "avg_running_balance": F.avg(level),
        "std_running_balance": F.stddev_samp(level),
        "near_zero_balance_share": share(near_zero(limit)),
    }


def balance_cv() -> Column:
    return ratio(F.col("std_running_balance"), F.col("avg_running_balance"), default=None)


def balance_profile(ledger: DataFrame, limit: float = NEAR_ZERO) -> DataFrame:
    """Level and spread of the balance; near-zero counts every row, not only debits."""
    named = [column.alias(name) for name, column in balance_aggregates(limit).items()]
    return ledger.groupBy("account_id").agg(*named).withColumn("balance_cv", balance_cv())


def drain_aggregates(seconds: int = 3600) -> dict[str, Column]:
    elapsed = whole_seconds(F.col("ts"), F.col("prev_ts"))
    return {
        "rapid_drain_rate": share(drain_step() & (elapsed <= seconds)),
        "avg_drain_seconds": F.avg(F.when(drain_step(), elapsed)),
    }


def rapid_drain(steps: DataFrame, seconds: int = 3600) -> DataFrame:
    """Share of rows that are a debit right after a credit within ``seconds``, and the mean such gap."""
    named = [column.alias(name) for name, column in drain_aggregates(seconds).items()]
    return steps.groupBy("account_id").agg(*named)


def turnover(tx: DataFrame, balances: DataFrame, offset: float = 100, output: str = "turnover_v3") -> DataFrame:
    """D3: volume over *all* transactions against the mean balance over ledger rows."""
    volume = tx.groupBy("account_id").agg(F.sum("amt").alias("_volume"))
    return balances.select("account_id", "avg_running_balance").join(volume, "account_id", "left").select(
        "account_id", (F.col("_volume") / (F.col("avg_running_balance") + offset)).alias(output))


def turnover_ratio(ledger: DataFrame) -> DataFrame:
    """Volume over ledger rows against mean absolute balance plus one."""
    volume = F.sum("amt") / (F.abs(F.avg(F.abs("bal"))) + 1)
    return ledger.groupBy("account_id").agg(
        F.sum("amt").alias("total_volume"), F.avg(F.abs("bal")).alias("avg_balance"), volume.alias("turnover_ratio"))


def near_zero_on_debit(ledger: DataFrame, limit: float = NEAR_ZERO) -> DataFrame:
    """Near-zero balances on debits only, and the largest amount against the mean."""
    return ledger.groupBy("account_id").agg(
        share(near_zero(limit) & is_debit()).alias("near_zero_balance_share"),
        (F.max("amt") / (F.avg("amt") + 1)).alias("peak_to_avg"))


def near_zero_debits(limit: float = NEAR_ZERO) -> Column:
    return count_if(near_zero(limit) & is_debit())
