"""The whole feature matrix from a ledger, its extension and the dimension tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions.skew import HotKeys, aggregate_per_key, find_hot_keys
from ledgerlens.operators import amounts, balance, calendar, channels, dormancy, flow, geo, network, profile, velocity
from ledgerlens.operators import windows as recent
from ledgerlens.operators.assemble import assemble, impute
from ledgerlens.plans import grains
from ledgerlens.schema import BEHAVIOURAL_FEATURES, FEATURES_BY_OPERATOR, REFERENCE_DATE
from ledgerlens.session import stage_table
from ledgerlens.sources.ledger import build_ledger

GROUPS_AT_ONCE = 4  # groups joined in one stage: a task holds the sorts and aggregations of these only
_BASE_GROUPS = ("counterparty_network", "channel_mix", "amount_profile", "balance_profile", "calendar", "geo_ip_profile")
LEDGER_MEDIANS = tuple(name for group in _BASE_GROUPS for name in FEATURES_BY_OPERATOR[group])
STATIC_MEDIANS = ("days_since_mobile_update", "accounts_per_employee")
# What an account without rows of a kind gets; everything not listed gets 0.
FILLS = {
    "no_mobile_update": 1, "acc_per_customer": 1, "scheme_risk": 1.0, "w90_avg_credit_ratio": 1.0,
    "median_residence_hours": -1.0, "p25_residence_hours": -1.0, "avg_residence_hours": -1.0,
    "min_residence_hours": -1.0, "unique_location_count": 1,
}


@dataclass(frozen=True)
class Dimensions:
    ids: DataFrame
    accounts: DataFrame
    link: DataFrame
    customers: DataFrame
    demographics: DataFrame
    products: DataFrame
    accounts_extra: DataFrame
    branch: DataFrame


def clustered_ledger(tx: DataFrame, extension: DataFrame) -> DataFrame:
    """Join ledger and extension once and store the result clustered by (account, time).

    The range partitioning uses the full row order, so an account with a large part of all rows is spread over many
    files. Everywhere else an account's rows sit together, and later aggregations combine nearly everything before
    they shuffle.
    """
    joined = build_ledger(tx, extension, how="left")
    order = ["account_id", "ts", "transaction_id"]
    return stage_table(joined.repartitionByRange(*order).sortWithinPartitions(*order), "ledger")


def feature_groups(full: DataFrame, dims: Dimensions, hot: HotKeys, as_of: str = REFERENCE_DATE) -> list[DataFrame]:
    """All feature groups from the clustered ledger (rows without an extension row are marked, not missing).

    Everything with one row per account and no order is taken in two fused passes, one over all rows and one over
    extended rows. Other operators read intermediate grains, each stored once.
    """
    ledger = full.where("has_extension")
    edges = stage_table(grains.edge_table(full), "edges")
    hourly = stage_table(grains.hourly_table(full), "hourly")
    daily = stage_table(grains.daily_from_hourly(hourly), "daily")
    cells = stage_table(grains.cell_table(ledger), "cells")
    ips = stage_table(geo.ip_table(ledger), "ips")

    base = aggregate_per_key(
        full, hot,
        {**amounts.amount_aggregates(), **calendar.calendar_aggregates(), "total_volume": F.sum("amt")},
        {"amt": {"median_txn_amount": 0.5}},
    ).withColumn("credit_debit_ratio", amounts.credit_debit_ratio(F.col("total_credit_amt"), F.col("total_debit_amt")))
    fused = aggregate_per_key(ledger, hot, {
        **balance.balance_aggregates(), **geo.coordinate_aggregates(), **geo.location_aggregates(),
        "extended_rows": F.count("*"),
    })
    state = stage_table(base.join(fused, "account_id", "left").withColumns({
        "balance_cv": balance.balance_cv(),
        "turnover_v3": F.col("total_volume") / (F.col("avg_running_balance") + 100),
        "geo_spread": F.when(F.col("extended_rows").isNotNull(), geo.geo_spread()),
        "max_distance_km_approx": F.when(F.col("extended_rows").isNotNull(), geo.max_distance()),
    }), "state")
    network_group = network.counterparty_network(edges)
    return [
        state, calendar.days_to_first_txn(state, dims.accounts), network_group,
        network.deviation_from_group(
            network_group, dims.accounts, "unique_counterparties", "branch_code", "cp_deviation_from_branch"),
        channels.channel_mix(grains.channel_table(full)),
        calendar.activity_span(daily), calendar.rolling_peak(daily),
        geo.ip_profile(ips, geo.ip_popularity(ips)),
        profile.account_profile(
            dims.accounts, dims.link, dims.customers, dims.products, dims.demographics, dims.accounts_extra, as_of),
        profile.branch_context(dims.accounts, dims.branch),
        recent.anchored_windows(ledger, hot),
        flow.fund_residence(grains.step_table(ledger, hot), hot, extra=balance.drain_aggregates()),
        network.counterparty_dynamics(edges, hot),
        dormancy.reactivation(daily),
        velocity.burst_stats(daily), velocity.hourly_peak(hourly), velocity.inter_txn_gaps(full, hot),
        profile.digital_products(dims.link, dims.customers, dims.demographics, dims.products, as_of),
        geo.distinct_cells(cells), geo.location_entropy(cells), geo.impossible_travel(ledger),
    ]


def raw_matrix(full: DataFrame, dims: Dimensions, hot: HotKeys, as_of: str = REFERENCE_DATE) -> DataFrame:
    """M1: every id with all 125 features in published order, NULL where a group has no row.

    Groups are joined a few at a time, and what is joined so far is stored. In one plan all groups would be sorted and aggregated in the same tasks.
    """
    groups = []
    for group in feature_groups(full, dims, hot, as_of):
        wanted = [c for c in group.columns if c in BEHAVIOURAL_FEATURES]
        groups.append(group.select("account_id", *wanted))
    joined = dims.ids
    for at in range(0, len(groups), GROUPS_AT_ONCE):
        joined = stage_table(assemble(joined, *groups[at:at + GROUPS_AT_ONCE]), "joined")
    return joined.select("account_id", *BEHAVIOURAL_FEATURES)


def build_features(
    tx: DataFrame, extension: DataFrame, dims: Dimensions, as_of: str = REFERENCE_DATE, hot: HotKeys | None = None,
) -> DataFrame:
    """Ledger to imputed feature matrix: one row per id, no NULLs, as doubles."""
    hot = find_hot_keys(tx) if hot is None else hot
    raw = raw_matrix(clustered_ledger(tx, extension), dims, hot, as_of)
    filled = impute(raw, [*LEDGER_MEDIANS, *STATIC_MEDIANS], FILLS)
    return filled.select("account_id", *[F.col(c).cast("double").alias(c) for c in BEHAVIOURAL_FEATURES])
