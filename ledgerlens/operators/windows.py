"""Recent windows anchored at each account's own last transaction (W)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.columns import count_if, is_credit, is_debit, ratio
from ledgerlens.functions.skew import HotKeys, with_key_max
from ledgerlens.operators.balance import near_zero, near_zero_debits

LARGE_CREDIT = 50000


def anchored_windows(
    ledger: DataFrame, hot: HotKeys, days: Sequence[int] = (30, 90), large: float = LARGE_CREDIT,
) -> DataFrame:
    """Counts in the last N days, their share of lifetime, and uplift against lifetime.

    A row is in the window when ``ts >= anchor - N days``, the anchor being the account's last time. Lifetime and
    window measures come from one pass over the anchored rows. Distinct days are kept as sets of dates, which the
    calendar bounds, instead of multiplying the rows once per distinct count.
    """
    short, long = min(days), max(days)
    rows = with_key_max(ledger.select("account_id", "ts", "txn_type", "amt", "bal"), hot, "ts", "anchor")

    def inside(n: int) -> Column:
        return F.col("ts") >= F.col("anchor") - F.make_interval(days=F.lit(n))

    credit, day = F.when(is_credit(), F.col("amt")), F.to_date("ts")
    lifetime = {
        "life_txn_count": F.count("*"),
        "life_credit_vol": F.sum(credit),
        "life_near_zero": near_zero_debits(),
        "life_avg_credit": F.avg(credit),
        "life_std_credit": F.stddev_samp(credit),
        "life_active_days": F.size(F.collect_set(day)),
        "active_days": F.size(F.collect_set(F.when(inside(long), day))),
        "mean_w": F.avg(F.when(inside(long), credit)),
    }
    measures = {
        f"{name}_{n}": column for n in (short, long) for name, column in {
            "txns": count_if(inside(n)),
            "near_zero": count_if(inside(n) & near_zero() & is_debit()),
            "credit_vol": F.sum(F.when(inside(n), credit)),
            "large": count_if(inside(n) & (credit > large)),
        }.items()}
    aggregates = {**lifetime, **measures}
    return rows.groupBy("account_id").agg(*[c.alias(n) for n, c in aggregates.items()]).select(
        "account_id", *_outputs(short, long))


def _outputs(short: int, long: int) -> list[Column]:
    def c(name: str) -> Column:
        return F.col(name)

    s, w = f"w{short}", f"w{long}"
    txns_s, txns_w = c(f"txns_{short}"), c(f"txns_{long}")
    zero_s, zero_w = c(f"near_zero_{short}"), c(f"near_zero_{long}")
    mean_w = c("mean_w")
    life_rate = c("life_near_zero").cast("double") / c("life_txn_count")
    has_credit = mean_w.isNotNull()
    return [
        txns_s.alias(f"{s}_txn_count"),
        txns_w.alias(f"{w}_txn_count"),
        zero_s.alias(f"{s}_near_zero_count"),
        zero_w.alias(f"{w}_near_zero_count"),
        c(f"large_{long}").alias(f"{w}_large_credit_count"),
        ratio(txns_w, c("life_txn_count")).alias(f"{w}_txn_concentration"),
        ratio(txns_s, c("life_txn_count")).alias(f"{s}_txn_concentration"),
        ratio(F.coalesce(f"credit_vol_{long}", F.lit(0.0)), c("life_credit_vol")).alias(f"{w}_credit_concentration"),
        ratio(zero_w, txns_w).alias(f"{w}_near_zero_rate"),
        ratio(zero_s, txns_s).alias(f"{s}_near_zero_rate"),
        ratio(zero_w.cast("double") / txns_w, life_rate).alias(f"{w}_near_zero_uplift"),
        ratio(c("active_days"), c("life_active_days")).alias(f"{w}_activity_concentration"),
        F.when((c("life_avg_credit") > 0) & has_credit, mean_w / c("life_avg_credit")).otherwise(1.0)
        .alias(f"{w}_avg_credit_ratio"),
        F.when((c("life_std_credit") > 0) & has_credit, (mean_w - c("life_avg_credit")) / c("life_std_credit"))
        .otherwise(0.0).alias(f"{w}_credit_zscore"),
        ratio(txns_s, txns_w).alias(f"{s}_{w}_acceleration"),
    ]
