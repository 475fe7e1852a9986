"""Counterparty network: full-history degrees (A) and recent dynamics (X)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.columns import count_if, ratio
from ledgerlens.functions.skew import HotKeys, with_key_max


def counterparty_network(edges: DataFrame) -> DataFrame:
    """A1: distinct counterparties by direction and their ratios; a NULL counterparty is not counted."""
    known = F.col("counterparty_id").isNotNull()
    total, incoming, outgoing = F.col("all_cp"), F.col("in_cp"), F.col("out_cp")
    return edges.groupBy("account_id").agg(
        F.count("counterparty_id").alias("all_cp"),
        count_if(known & (F.col("n_in") > 0)).alias("in_cp"),
        count_if(known & (F.col("n_out") > 0)).alias("out_cp"),
    ).select(
        "account_id",
        total.alias("unique_counterparties"),
        incoming.alias("unique_incoming_cp"),
        outgoing.alias("unique_outgoing_cp"),
        (incoming.cast("double") / (outgoing + 1)).alias("fan_asymmetry"),
        (incoming.cast("double") / (total + 1)).alias("cp_incoming_ratio"),
        (outgoing.cast("double") / (total + 1)).alias("cp_outgoing_ratio"),
    )


def deviation_from_group(
    features: DataFrame, members: DataFrame, value: str, group: str, output: str, center: str = "median",
) -> DataFrame:
    """A2: value minus the median (or mean) of the account's group, over accounts present in ``features``.

    Values are first counted per (group, value), so a group with a third of all accounts arrives as its few
    distinct values.
    """
    placed = features.select("account_id", value).join(members.select("account_id", group), "account_id", "left")
    counts = placed.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).agg(
        F.count("*").alias("n"))
    if center == "median":
        middle: Column = F.percentile(value, F.lit(0.5), F.col("n"))
    else:
        middle = F.sum(F.col(value) * F.col("n")).cast("double") / F.sum("n")
    centers = counts.groupBy(group).agg(middle.alias("_center"))
    return placed.join(centers, group, "left").select(
        "account_id", (F.col(value) - F.col("_center")).alias(output))


def fan_ratio(network: DataFrame, members: DataFrame, group: str = "branch_code") -> DataFrame:
    """in/(out+1) and the deviation from the group mean."""
    dev = deviation_from_group(network, members, "unique_counterparties", group, "cp_dev", center="mean")
    return network.select("account_id", F.col("fan_asymmetry").alias("fan_ratio")).join(dev, "account_id")


def _known(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("counterparty_id").isNotNull())


def _anchored_edges(edges: DataFrame, hot: HotKeys) -> DataFrame:
    """Known edges with the account's last time over counterparty rows."""
    return with_key_max(_known(edges), hot, "last_ts", "anchor")


def _days_before(days: int) -> Column:
    return F.col("anchor") - F.make_interval(days=F.lit(days))


def novel_counterparties(edges: DataFrame, hot: HotKeys, days: int = 30) -> DataFrame:
    """Counterparties first seen within ``days`` of the account's last counterparty row.

    "Seen in the window and never before it" is "first seen in the window", so no anti join is needed.
    """
    fresh = count_if(F.col("first_ts") >= _days_before(days))
    out = _anchored_edges(edges, hot).groupBy("account_id").agg(fresh.alias("_new"), F.count("*").alias("_all"))
    return out.select(
        "account_id", F.col("_new").alias(f"new_cp_{days}d"),
        ratio(F.col("_new"), F.col("_all")).alias(f"new_cp_{days}d_rate"))


def cp_window_concentration(edges: DataFrame, hot: HotKeys, windows: Sequence[int] = (30, 90)) -> DataFrame:
    """Distinct counterparties in the last N days over distinct counterparties ever."""
    counts = [count_if(F.col("last_ts") >= _days_before(d)).alias(f"_w{d}") for d in windows]
    out = _anchored_edges(edges, hot).groupBy("account_id").agg(*counts, F.count("*").alias("_all"))
    return out.select("account_id", *[
        ratio(F.col(f"_w{d}"), F.col("_all")).alias(f"w{d}_cp_concentration") for d in windows])


def top_counterparty_share(edges: DataFrame) -> DataFrame:
    """Share of counterparty transactions that go to the busiest counterparty."""
    return _known(edges).groupBy("account_id").agg(ratio(F.max("n"), F.sum("n")).alias("top1_cp_share"))


def cp_branch_diversity(edges: DataFrame, prefix: int = 8) -> DataFrame:
    """Distinct id prefixes among counterparties and the busiest prefix's share."""
    prefixes = _known(edges).groupBy("account_id", F.substring("counterparty_id", 1, prefix).alias("prefix")).agg(
        F.sum("n").alias("n"))
    return prefixes.groupBy("account_id").agg(
        F.count("*").alias("unique_cp_branches"), ratio(F.max("n"), F.sum("n")).alias("top_branch_share"))


def bidirectional_counterparties(edges: DataFrame) -> DataFrame:
    """Counterparties that both paid and were paid."""
    both = count_if((F.col("n_in") > 0) & (F.col("n_out") > 0))
    return _known(edges).groupBy("account_id").agg(
        both.alias("bidirectional_cp_count"), ratio(both, F.count("*")).alias("bidirectional_cp_rate"))


def direction_unique_cp(edges: DataFrame) -> DataFrame:
    """Distinct counterparties by direction and their ratio."""
    outgoing, incoming = count_if(F.col("n_out") > 0), count_if(F.col("n_in") > 0)
    return _known(edges).groupBy("account_id").agg(
        outgoing.alias("outgoing_unique_cp"), incoming.alias("incoming_unique_cp"),
        ratio(outgoing, incoming).alias("outgoing_incoming_cp_ratio"))


def counterparty_dynamics(
    edges: DataFrame, hot: HotKeys, novelty_days: int = 30, windows: Sequence[int] = (30, 90), prefix: int = 8,
) -> DataFrame:
    """X1-X6 fused: prefix grain, then one aggregation per account over anchored edges."""
    everything = count_if(F.lit(True))
    fresh = count_if(F.col("first_ts") >= _days_before(novelty_days))
    both = count_if((F.col("n_in") > 0) & (F.col("n_out") > 0))
    outgoing, incoming = count_if(F.col("n_out") > 0), count_if(F.col("n_in") > 0)
    main = _anchored_edges(edges, hot).groupBy("account_id").agg(
        fresh.alias(f"new_cp_{novelty_days}d"),
        ratio(fresh, everything).alias(f"new_cp_{novelty_days}d_rate"),
        *[ratio(count_if(F.col("last_ts") >= _days_before(d)), everything).alias(f"w{d}_cp_concentration")
          for d in windows],
        ratio(F.max("n"), F.sum("n")).alias("top1_cp_share"),
        both.alias("bidirectional_cp_count"),
        ratio(both, everything).alias("bidirectional_cp_rate"),
        outgoing.alias("outgoing_unique_cp"),
        incoming.alias("incoming_unique_cp"),
        ratio(outgoing, incoming).alias("outgoing_incoming_cp_ratio"),
    )
    return main.join(cp_branch_diversity(edges, prefix), "account_id")
