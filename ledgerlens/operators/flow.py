"""Fund residence: how soon money leaves after it arrives (L).

A credit-to-debit pair is two adjacent rows of one account. It is recognised on the debit row, whose previous row
is a credit, so the step grain's look-back columns are all that is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.columns import count_if, exact_hours, is_credit, ratio
from ledgerlens.functions.skew import HotKeys, aggregate_per_key, neighbours
from ledgerlens.operators.balance import drain_step, near_zero

LAG_PROBS = {"median_residence_hours": 0.5, "p25_residence_hours": 0.25}
DRAIN_HOURS = (1, 6, 24)


def next_step(ledger: DataFrame, hot: HotKeys) -> DataFrame:
    """L1: every row with time, side, amount and balance of the row after it."""
    return neighbours(
        ledger, hot, ["ts", "transaction_id"],
        following={"next_ts": "ts", "next_type": "txn_type", "next_amt": "amt", "next_bal": "bal"})


def with_lag(steps: DataFrame) -> DataFrame:
    """Add ``lag_hours``: hours from credit to debit on pair rows, NULL elsewhere."""
    return steps.withColumn("lag_hours", F.when(drain_step(), exact_hours(F.col("ts"), F.col("prev_ts"))))


def residence_aggregates() -> dict[str, Column]:
    return {
        "n_credit_debit_pairs": F.count("lag_hours"),
        "avg_residence_hours": F.avg("lag_hours"),
        "min_residence_hours": F.min("lag_hours"),
    }


def drain_rate_aggregates(hours: Sequence[int] = DRAIN_HOURS) -> dict[str, Column]:
    credits = count_if(is_credit())
    return {f"drain_rate_{h}h": ratio(count_if(F.col("lag_hours") <= h), credits) for h in hours}


def same_day_aggregates() -> dict[str, Column]:
    same = count_if(drain_step() & (F.to_date("ts") == F.to_date("prev_ts")))
    return {"same_day_drain_count": same, "same_day_drain_rate": ratio(same, count_if(is_credit()))}


def drawdown_aggregates() -> dict[str, Column]:
    """L5. The zero rate applies to every credit; despite its published name there is no size filter."""
    drawdown = F.when(F.col("prev_amt") != 0, (F.col("prev_amt") - F.col("amt")) / F.col("prev_amt"))
    return {
        "avg_post_credit_drawdown": F.coalesce(F.avg(F.when(drain_step(), drawdown)), F.lit(0.0)),
        "large_credit_to_zero_rate": ratio(count_if(drain_step() & near_zero()), count_if(is_credit())),
    }


def residence_stats(steps: DataFrame, hot: HotKeys) -> DataFrame:
    """L2: number of pairs and the distribution of their lag in hours; -1 when an account has no pair."""
    return _no_pair(aggregate_per_key(with_lag(steps), hot, residence_aggregates(), {"lag_hours": LAG_PROBS}))


def drain_rates(steps: DataFrame, hours: Sequence[int] = DRAIN_HOURS) -> DataFrame:
    """L3: pairs no longer than each limit, per credit."""
    return _plain(with_lag(steps), drain_rate_aggregates(hours))


def same_day_drain(steps: DataFrame) -> DataFrame:
    """L4: pairs within one calendar day, as count and per credit."""
    return _plain(steps, same_day_aggregates())


def post_credit_drawdown(steps: DataFrame) -> DataFrame:
    """Mean relative drop from credit to debit amount, and debits that leave a near-zero balance."""
    return _plain(steps, drawdown_aggregates())


def fund_residence(
    steps: DataFrame, hot: HotKeys, hours: Sequence[int] = DRAIN_HOURS, extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """L2-L5 fused in one aggregation over the steps; ``extra`` aggregates (D2) may ride along."""
    aggregates = {
        **residence_aggregates(), **drain_rate_aggregates(hours), **same_day_aggregates(), **drawdown_aggregates(),
        **(extra or {}),
    }
    return _no_pair(aggregate_per_key(with_lag(steps), hot, aggregates, {"lag_hours": LAG_PROBS}))


def _plain(rows: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    return rows.groupBy("account_id").agg(*[column.alias(name) for name, column in aggregates.items()])


def _no_pair(df: DataFrame) -> DataFrame:
    return df.na.fill(-1.0, ["avg_residence_hours", "min_residence_hours", *LAG_PROBS])
