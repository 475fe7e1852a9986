"""Hot keys take another route and must give the same rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.skew import HotKeys, find_hot_keys, join_per_key, neighbours
from ledgerlens.operators import amounts, flow, network, velocity, windows
from ledgerlens.operators.balance import rapid_drain
from ledgerlens.plans import grains


@pytest.fixture(scope="module")
def skewed(data):
    """A ledger in which one account holds a third of all rows, and keys over 60 rows count as hot."""
    rows = data.ledger.withColumn(
        "account_id", F.when(F.crc32("transaction_id") % 3 == 0, F.lit("big")).otherwise(F.col("account_id")))
    hot = find_hot_keys(rows, rows=60)
    names = {r.account_id for r in hot.ids.collect()}
    total = rows.select("account_id").distinct().count()
    assert "big" in names and len(names) < total
    return rows, hot, HotKeys("account_id")


def _same(left, right):
    assert left.columns == right.columns

    def rounded(df):
        return sorted(tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.collect())
    a, b = rounded(left), rounded(right)
    assert a and a == b


OPERATORS = {
    "steps": lambda rows, hot: grains.step_table(rows, hot).select("transaction_id", "prev_ts", "prev_type", "prev_amt"),
    "next_step": lambda rows, hot: flow.next_step(rows, hot).select("transaction_id", "next_ts", "next_type", "next_bal"),
    "amounts": lambda rows, hot: amounts.amount_profile(rows, hot),
    "residence": lambda rows, hot: flow.residence_stats(grains.step_table(rows, hot), hot),
    "fused_residence": lambda rows, hot: flow.fund_residence(grains.step_table(rows, hot), hot),
    "drain": lambda rows, hot: rapid_drain(grains.step_table(rows, hot)),
    "gaps": lambda rows, hot: velocity.inter_txn_gaps(rows, hot),
    "windows": lambda rows, hot: windows.anchored_windows(rows, hot, (5, 15)),
    "novelty": lambda rows, hot: network.novel_counterparties(grains.edge_table(rows), hot, 7),
    "dynamics": lambda rows, hot: network.counterparty_dynamics(grains.edge_table(rows), hot, 7, (5, 15)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hot_route_equals_plain_route(skewed, name):
    rows, hot, plain = skewed
    _same(OPERATORS[name](rows, hot), OPERATORS[name](rows, plain))


def test_wide_slices_and_empty_slices(skewed):
    rows, hot, plain = skewed
    for seconds in (60, 86400 * 40):
        other = HotKeys(hot.key, hot.ids, hot.rows, seconds)
        _same(OPERATORS["steps"](rows, other), OPERATORS["steps"](rows, plain))


def test_join_per_key_keeps_every_row(skewed):
    rows, hot, _ = skewed
    last = rows.groupBy("account_id").agg(F.max("ts").alias("last"))
    assert join_per_key(rows, last, hot).count() == rows.count()


def test_short_table_has_no_hot_keys(data):
    assert not find_hot_keys(data.tx, rows=10**9)


def test_fused_dynamics_equal_single_operators(data):
    plain = HotKeys("account_id")
    fused = network.counterparty_dynamics(data.edges_long, plain)
    for single in (network.novel_counterparties(data.edges_long, plain),
                   network.cp_window_concentration(data.edges_long, plain),
                   network.top_counterparty_share(data.edges_long), network.cp_branch_diversity(data.edges_long),
                   network.bidirectional_counterparties(data.edges_long), network.direction_unique_cp(data.edges_long)):
        _same(fused.select(single.columns), single)


def test_hot_rows_without_a_time_stay(spark):
    rows = [("a", i, None if i % 5 == 0 else f"2024-01-0{1 + i % 3} 0{i % 9}:00:00") for i in range(20)]
    df = spark.createDataFrame(rows, "account_id string, id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    found = find_hot_keys(df, rows=10)
    assert found
    ask = dict(order=["ts", "id"], previous={"before": "id"}, following={"after": "id"})
    plain = {tuple(r) for r in neighbours(df, HotKeys("account_id"), **ask).collect()}
    assert len(plain) == 20
    assert {tuple(r) for r in neighbours(df, found, **ask).collect()} == plain


def test_hot_keys_are_few(spark):
    df = spark.range(100).selectExpr("concat('k', id % 3) AS account_id").union(spark.sql("SELECT CAST(NULL AS STRING) FROM range(50)"))
    assert {r[0] for r in find_hot_keys(df, rows=10).ids.collect()} == {"k0", "k1", "k2"}
