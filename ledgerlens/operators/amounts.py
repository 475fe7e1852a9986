"""Transaction-amount profile (C-1, C-2) and ledger overview."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.columns import clip, count_if, is_credit, is_debit, share
from ledgerlens.functions.ranks import ranked_percentiles, with_single_row
from ledgerlens.functions.skew import HotKeys, aggregate_per_key


@dataclass(frozen=True)
class AmountBands:
    """Thresholds of the amount profile. ``band_closed`` includes the band's upper end."""

    band_low: float = 40000
    band_high: float = 50000
    band_closed: bool = False
    round_unit: float = 500
    round_zero: bool = False
    high: float = 50000
    high_closed: bool = False
    micro: float = 100


FULL_PRESET = AmountBands()
EXPLORE_PRESET = AmountBands(band_high=49999, band_closed=True, round_unit=1000, round_zero=True, high_closed=True)


def amount_aggregates(bands: AmountBands = FULL_PRESET) -> dict[str, Column]:
    amt = F.col("amt")
    in_band = (amt >= bands.band_low) & (amt <= bands.band_high if bands.band_closed else amt < bands.band_high)
    is_round = amt % F.lit(float(bands.round_unit)) == 0
    if not bands.round_zero:
        is_round = (amt > 0) & is_round
    return {
        "structuring_share": share(in_band),
        "round_share": share(is_round),
        "avg_txn_amount": F.avg(amt),
        "high_value_share": share(amt >= bands.high if bands.high_closed else amt > bands.high),
        "micro_txn_share": share(amt < bands.micro),
        "total_credit_amt": F.sum(F.when(is_credit(), amt).otherwise(0.0)),
        "total_debit_amt": F.sum(F.when(is_debit(), amt).otherwise(0.0)),
        "txn_count": F.count("*"),
    }


def credit_debit_ratio(credit: Column, debit: Column, low: float = 0.0, high: float = 10.0) -> Column:
    """C-2: credit over debit volume plus one, bounded."""
    return clip(credit / (debit + 1), low, high)


def amount_profile(tx: DataFrame, hot: HotKeys, bands: AmountBands = FULL_PRESET) -> DataFrame:
    """C-1 and C-2: shares of amount bands, exact median, volumes and credit/debit ratio in one pass."""
    out = aggregate_per_key(tx, hot, amount_aggregates(bands), {"amt": {"median_txn_amount": 0.5}})
    return out.withColumn(
        "credit_debit_ratio", credit_debit_ratio(F.col("total_credit_amt"), F.col("total_debit_amt")))


def ledger_overview(tx: DataFrame) -> DataFrame:
    """One row of totals. The median over the whole ledger is located by distributed ranks."""
    totals = tx.agg(
        F.count("*").alias("total_txns"),
        count_if(is_credit()).alias("credits"),
        count_if(is_debit()).alias("debits"),
        F.avg("amt").alias("avg_amount"),
        F.min("ts").alias("first_txn"),
        F.max("ts").alias("last_txn"),
    )
    accounts = tx.select("account_id").distinct().agg(F.count("*").alias("total_accounts"))
    median = ranked_percentiles(tx, [], "amt", {"median_amount": 0.5})
    return with_single_row(with_single_row(totals, accounts), median)


def txns_per_account_by_class(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Accounts, mean and median transactions per account by class; unlabelled accounts are class -1."""
    counts = tx.groupBy("account_id").agg(F.count("*").alias("txn_count"))
    joined = counts.join(labels.select("account_id", "is_mule"), "account_id", "left").withColumn(
        "is_mule", F.coalesce("is_mule", F.lit(-1)))
    spread = joined.groupBy("is_mule", "txn_count").agg(F.count("*").alias("n"))
    return spread.groupBy("is_mule").agg(
        F.sum("n").alias("accounts"),
        (F.sum(F.col("txn_count") * F.col("n")).cast("double") / F.sum("n")).alias("mean_txns"),
        F.percentile("txn_count", F.lit(0.5), F.col("n")).alias("median_txns"),
        F.percentile("txn_count", F.lit(0.9), F.col("n")).alias("p90_txns"),
    )
