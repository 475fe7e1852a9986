"""Channel mix, category entropy and code risk (B)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.columns import count_if
from ledgerlens.functions.ranks import with_single_row
from ledgerlens.schema import BASE_RATE_PCT, TRANSFER_CHANNELS


def _entropy(part: Column) -> Column:
    return F.sum(-part * F.log(part + F.lit(1e-9)))


def entropy(counts: DataFrame, output: str, key: str = "account_id", n: str = "n") -> DataFrame:
    """B2: Shannon entropy of counts within each key, from a (key, category) count table.

    The total is a window over the count table, whose groups are as long as the list of categories.
    """
    part = F.col(n).cast("double") / F.col("_total")
    totals = F.sum(n).over(Window.partitionBy(key))
    return counts.withColumn("_total", totals).groupBy(key).agg(_entropy(part).alias(output))


def channel_mix(channels: DataFrame, transfer: Sequence[str] = TRANSFER_CHANNELS, atm: str = "ATM") -> DataFrame:
    """B1 and B2: channel counts, shares and entropy from the (account, channel) grain."""
    total = F.sum("n").over(Window.partitionBy("account_id"))
    part = F.col("n").cast("double") / F.col("total_txns")

    def summed(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("double") / F.max("total_txns")

    return channels.withColumn("total_txns", total).groupBy("account_id").agg(
        _entropy(part).alias("channel_entropy"),
        summed(F.col("channel").isin(*transfer)).alias("neft_imps_share"),
        summed(F.col("channel") == atm).alias("atm_share"),
        F.count("channel").alias("channel_count"),
        (F.max("n").cast("double") / F.max("total_txns")).alias("top_channel_share"),
        F.max("total_txns").alias("total_txns"),
    )


def channel_type_share(channels: DataFrame, transfer: Sequence[str] = TRANSFER_CHANNELS) -> DataFrame:
    """U8: channel entropy and the share of *distinct channels* (not transactions) in the transfer set."""
    kind = F.avg(F.when(F.col("channel").isin(*transfer), 1.0).otherwise(0.0))
    shares = channels.groupBy("account_id").agg(kind.alias("neft_imps_share"))
    return entropy(channels, "channel_entropy").join(shares, "account_id")


def _accounts_per_code(tx: DataFrame, code: str) -> DataFrame:
    """Distinct (account, code) pairs, so that one popular code is spread over its accounts first."""
    return tx.select("account_id", code).distinct()


def code_frequency(tx: DataFrame, code: str = "mcc_code", top: int = 20) -> DataFrame:
    """Most widely used codes by distinct accounts. NULL is a code of its own; ties go to the lower code."""
    return (
        _accounts_per_code(tx, code).groupBy(code).agg(F.count("*").alias("n_accounts"))
        .orderBy(F.desc("n_accounts"), F.asc_nulls_last(code)).limit(top)
    )


def distinct_codes(tx: DataFrame, code: str = "mcc_code") -> DataFrame:
    """Number of distinct non-NULL codes, one row."""
    return tx.select(code).distinct().agg(F.count(code).alias("n_distinct_codes"))


def _code_rates(tx: DataFrame, labels: DataFrame, code: str) -> DataFrame:
    pairs = _accounts_per_code(tx, code).join(labels.select("account_id", "is_mule"), "account_id")
    return pairs.groupBy(code).agg(
        F.count("*").alias("n_accounts"), count_if(F.col("is_mule") == 1).alias("n_mule_accs"),
    ).withColumn("mule_rate_pct", F.round(F.col("n_mule_accs") * 100.0 / F.col("n_accounts"), 2))


def code_lift(
    tx: DataFrame, labels: DataFrame, code: str = "mcc_code", min_accounts: int = 50, top: int | None = 20,
) -> DataFrame:
    """Share of positive accounts per code among labelled accounts, for codes with enough accounts.

    The ``top`` codes are a report; ``None`` gives all codes, unordered, as input of B5.
    """
    rates = _code_rates(tx, labels, code).where(F.col("n_accounts") >= min_accounts)
    return rates if top is None else rates.orderBy(F.desc("mule_rate_pct"), F.asc_nulls_last(code)).limit(top)


def risky_codes_by_rate(
    lift: DataFrame, code: str = "mcc_code", base_pct: float = BASE_RATE_PCT, factor: float = 1.5,
) -> DataFrame:
    """Codes whose positive rate is at least ``factor`` times the base rate."""
    return lift.where((F.col("mule_rate_pct") >= base_pct * factor) & F.col(code).isNotNull()).select(code)


def risky_code_share_raw(tx: DataFrame, codes: DataFrame, code: str = "mcc_code") -> DataFrame:
    """Share of an account's transactions with a code in ``codes``; 0 when none are.

    Counted per (account, code) first. The code list is joined without a hint: codes may be many.
    """
    counts = tx.groupBy("account_id", code).agg(F.count("*").alias("n"))
    marked = counts.join(codes.select(code).distinct().withColumn("_risky", F.lit(1)), code, "left")
    risky = F.sum(F.when(F.col("_risky") == 1, F.col("n")).otherwise(0))
    return marked.groupBy("account_id").agg((risky.cast("double") / F.sum("n")).alias("risky_mcc_share_raw"))


def code_rate_report(
    ledger: DataFrame, labels: DataFrame, code: str = "mnemonic_code", min_accounts: int = 50, top: int = 15,
) -> DataFrame:
    """U4: accounts, positive accounts, mean of per-account mean amounts, rate and lift over the base rate."""
    per_account = ledger.where(F.col(code).isNotNull()).groupBy("account_id", code).agg(F.avg("amt").alias("_mean"))
    rates = per_account.join(labels.select("account_id", "is_mule"), "account_id").groupBy(code).agg(
        F.count("*").alias("n_accounts"), count_if(F.col("is_mule") == 1).alias("n_mule_accs"),
        F.avg("_mean").alias("avg_amount"))
    base = labels.agg(F.avg(F.col("is_mule").cast("double")).alias("_base"))
    rate = F.col("n_mule_accs").cast("double") / F.col("n_accounts")
    return (
        with_single_row(rates.where(F.col("n_accounts") >= min_accounts), base)
        .withColumn("mule_rate", rate)
        .withColumn("lift", F.when(F.col("_base") > 0, F.col("mule_rate") / F.col("_base")))
        .drop("_base")
        .orderBy(F.desc("mule_rate"), F.asc(code)).limit(top)
    )
