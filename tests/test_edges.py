"""Hand-written frames for boundary cases."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from frames_by_key import rows_by_key
from ledgerlens.functions import columns as C
from ledgerlens.functions.skew import HotKeys
from ledgerlens.operators import (
    amounts, balance, calendar, channels, decision, dormancy, encoding, flow, geo, metrics, network, profile, velocity,
)
from ledgerlens.operators import windows as recent
from ledgerlens.plans import grains
from ledgerlens.sources.ledger import build_ledger, standard_ledger

HOT = HotKeys("account_id")


def test_amount_limits(ledger):
    df = ledger([("a", str(i), "2024-01-01 10:00:00", "C", v, 0.0)
                 for i, v in enumerate((40000.0, 49999.99, -50000.0, 50000.01, 0.0, 99.99, 100.0, 500.0))])
    got = rows_by_key(amounts.amount_profile(df, HOT))["a"]
    assert got["structuring_share"] == 2 / 8
    assert got["high_value_share"] == 1 / 8
    assert got["micro_txn_share"] == 2 / 8
    assert got["round_share"] == 3 / 8
    other = rows_by_key(amounts.amount_profile(df, HOT, amounts.EXPLORE_PRESET))["a"]
    assert other["structuring_share"] == 1 / 8 and other["high_value_share"] == 2 / 8 and other["round_share"] == 3 / 8


def test_credit_debit_ratio_is_bounded(ledger):
    df = ledger([("a", "1", "2024-01-01 10:00:00", "C", 1000.0, 0.0), ("b", "2", "2024-01-01 10:00:00", "D", 5.0, 0.0)])
    got = rows_by_key(amounts.amount_profile(df, HOT))
    assert got["a"]["credit_debit_ratio"] == 10 and got["b"]["credit_debit_ratio"] == 0


def test_drain_limit_and_tie_order(ledger):
    df = ledger([
        ("a", "1", "2024-01-01 10:00:00", "C", 100.0, 500.0), ("a", "2", "2024-01-01 11:00:00", "D", 50.0, 499.99),
        ("b", "1", "2024-01-01 10:00:00", "C", 100.0, 0.0), ("b", "2", "2024-01-01 11:00:01", "D", 50.0, 0.0),
        ("c", "2", "2024-01-01 10:00:00", "D", 50.0, 0.0), ("c", "1", "2024-01-01 10:00:00", "C", 100.0, 0.0),
        ("d", "1", "2024-01-01 10:00:00", "C", 100.0, 0.0),
    ])
    steps = grains.step_table(df, HOT)
    drained = rows_by_key(balance.rapid_drain(steps))
    assert drained["a"]["rapid_drain_rate"] == 0.5 and drained["b"]["rapid_drain_rate"] == 0
    assert drained["c"]["rapid_drain_rate"] == 0.5 and drained["c"]["avg_drain_seconds"] == 0
    assert drained["d"]["avg_drain_seconds"] is None
    stats = rows_by_key(flow.fund_residence(steps, HOT))
    assert stats["a"]["drain_rate_1h"] == 1 and stats["b"]["drain_rate_1h"] == 0 and stats["b"]["drain_rate_6h"] == 1
    assert stats["a"]["large_credit_to_zero_rate"] == 1 and stats["a"]["avg_post_credit_drawdown"] == 0.5
    assert stats["d"]["median_residence_hours"] == -1 and stats["d"]["n_credit_debit_pairs"] == 0
    assert rows_by_key(balance.balance_profile(df))["a"]["near_zero_balance_share"] == 0.5


def test_seconds_count_boundaries_but_hours_keep_fractions(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.9' AS a, timestamp'2024-01-01 00:00:02.1' AS b")
    row = df.select(C.whole_seconds(F.col("b"), F.col("a")).alias("s"), C.exact_hours(F.col("b"), F.col("a")).alias("h")).first()
    assert row.s == 2 and row.h == pytest.approx(1.2 / 3600)


def test_hours_and_month_days(ledger):
    df = ledger([("a", "1", "2024-01-06 22:00:00", "C", 1.0, 0.0), ("a", "2", "2024-01-07 21:59:59", "C", 1.0, 0.0),
                 ("a", "3", "2024-01-25 06:00:00", "C", 1.0, 0.0), ("a", "4", "2024-01-31 05:59:59", "C", 1.0, 0.0)])
    got = rows_by_key(calendar.calendar_shares(df))["a"]
    assert got["offhours_share"] == 0.5 and got["weekend_share"] == 0.5
    assert got["sunday_share"] == 0.25 and got["month_boundary_share"] == 0.5


def test_window_start_is_inclusive(ledger):
    df = ledger([("a", "1", "2024-03-01 12:00:00", "D", 1.0, 499.0), ("a", "2", "2024-03-31 12:00:00", "C", 60000.0, 0.0),
                 ("a", "3", "2024-03-01 11:59:59", "D", 1.0, 0.0)])
    got = rows_by_key(recent.anchored_windows(df, HOT))["a"]
    assert got["w30_txn_count"] == 2 and got["w90_txn_count"] == 3
    assert got["w30_near_zero_count"] == 1 and got["w90_large_credit_count"] == 1
    assert got["w90_credit_zscore"] == 0 and got["w90_avg_credit_ratio"] == 1


def test_account_without_credits(ledger):
    got = rows_by_key(recent.anchored_windows(ledger([("a", "1", "2024-03-01 12:00:00", "D", 1.0, 900.0)]), HOT))["a"]
    assert got["w90_avg_credit_ratio"] == 1 and got["w90_credit_concentration"] == 0 and got["w90_near_zero_uplift"] == 0


def test_null_counterparty_does_not_move_the_anchor(ledger):
    df = ledger([("a", "1", "2024-01-01 00:00:00", "C", 1.0, 0.0), ("a", "2", "2024-03-01 00:00:00", "D", 1.0, 0.0),
                 ("b", "3", "2024-03-01 00:00:00", "D", 1.0, 0.0)],
                counterparty_id=F.when(F.col("transaction_id") == "1", F.lit("12345678-9")))
    edges = grains.edge_table(df)
    got = rows_by_key(network.counterparty_dynamics(edges, HOT))
    assert set(got) == {"a"} and got["a"]["new_cp_30d"] == 1 and got["a"]["outgoing_incoming_cp_ratio"] == 0
    assert rows_by_key(network.counterparty_network(edges))["b"]["unique_counterparties"] == 0


def test_equal_longest_gaps_take_the_later_start(ledger):
    days = ["2024-01-01", "2024-02-10", "2024-02-11", "2024-03-22"]
    df = ledger([("a", str(i), f"{d} 08:00:00", "C", 10.0, 0.0) for i, d in enumerate(days)]
                + [("b", "x", "2024-01-01 00:00:00", "C", 1.0, 0.0)])
    daily = grains.daily_table(df)
    got = rows_by_key(dormancy.longest_gap(daily))
    assert str(got["a"]["longest_gap_start_date"]) == "2024-02-11" and got["a"]["longest_gap_days"] == 39
    assert "b" not in got
    back = rows_by_key(dormancy.reactivation(daily, days=40))
    assert back["a"]["pre_gap_activity_days"] == 2 and back["a"]["post_gap_activity_days"] == 1
    assert back["b"]["max_inactivity_gap"] == 0 and back["b"]["burst_ratio_after_gap"] == 0


def test_single_transaction_has_no_gaps(ledger):
    df = ledger([("a", "1", "2024-01-01 00:00:00", "C", 1.0, 0.0)])
    got = rows_by_key(velocity.inter_txn_gaps(df, HOT))["a"]
    assert got["gap_cv"] == 0 and got["inter_txn_gap_p50"] == 0


def _travel(ledger, second, lat):
    df = ledger([("a", "1", "2024-01-01 00:30:00", "C", 1.0, 0.0), ("a", "2", second, "C", 1.0, 0.0)],
                latitude=F.when(F.col("transaction_id") == "1", F.lit(10.0)).otherwise(F.lit(lat)), longitude=F.lit(70.0))
    return rows_by_key(geo.impossible_travel(df))["a"]["impossible_travel_flag"]


@pytest.mark.parametrize("second, lat, flag", [
    ("2024-01-01 02:30:00", 15.1, 1), ("2024-01-01 02:30:00", 15.0, 0), ("2024-01-01 02:30:00.000001", 15.1, 0),
    ("2024-01-01 00:30:00", 15.1, 0), ("2024-01-01 00:30:00.000001", 4.9, 1), ("2024-01-01 01:00:00", 0.0, 0)])
def test_impossible_travel_limits(ledger, second, lat, flag):
    assert _travel(ledger, second, lat) == flag


def test_blank_and_null_ip(ledger):
    known = {"1": "", "3": "10.0.0.1", "4": "10.0.0.1", "5": "10.0.0.1"}
    lookup = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    df = ledger([(a, i, "2024-01-01 00:00:00", "C", 1.0, 0.0) for a, i in zip("aaaab", "12345")],
                ip_address=F.try_element_at(lookup, F.col("transaction_id")))
    ips = geo.ip_table(df)
    got = rows_by_key(geo.geo_ip_profile(df, ips, geo.ip_popularity(ips)))
    assert got["a"]["unique_ips"] == 2 and got["a"]["ip_null_rate"] == 0.5 and got["a"]["avg_ip_sharing"] == 2
    assert got["a"]["lat_std"] is None and got["a"]["geo_spread"] == 0


def test_null_cell_is_a_location_value(ledger):
    df = ledger([("a", "1", "2024-01-01 00:00:00", "C", 1.0, 0.0), ("a", "2", "2024-01-01 00:00:00", "C", 1.0, 0.0),
                 ("a", "3", "2024-01-01 00:00:00", "C", 1.0, 0.0)],
                latitude=F.when(F.col("transaction_id") == "1", F.lit(0.0)).when(F.col("transaction_id") == "2", F.lit(9.0)),
                longitude=F.when(F.col("transaction_id") == "1", F.lit(0.0)).when(F.col("transaction_id") == "2", F.lit(9.0)))
    got = rows_by_key(geo.location_stats(df, grains.cell_table(df)))["a"]
    assert got["unique_location_count"] == 3 and got["txns_with_location"] == pytest.approx(1 / 3)


def test_ledger_drops_rows_without_extension(spark):
    tx = standard_ledger(spark.sql(
        "SELECT * FROM VALUES (1, 'a', '2024-01-01', 'C', 5.0D), (2, 'a', 'bad', 'D', -3.0D) "
        "AS t(transaction_id, account_id, transaction_timestamp, txn_type, amount)"))
    ext = spark.sql("SELECT '1' AS transaction_id, 9.0D AS balance_after_transaction")
    assert build_ledger(tx, ext).count() == 1
    both = {r.transaction_id: r for r in build_ledger(tx, ext, how="left").collect()}
    assert both["1"].has_extension and not both["2"].has_extension and both["2"].ts is None and both["2"].amt == 3.0


def test_flags_and_schemes(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', ' y ', 'SCSS'), ('b', NULL, 'NEW'), ('c', 'N', NULL) AS t(account_id, f, s)")
    got = rows_by_key(C.yn_to_int(df, ["f", "missing"]).withColumn("r", C.map_category(F.col("s"), {"SCSS": 1.14}, 1.0)))
    assert [got[k]["f"] for k in "abc"] == [1, 0, 0] and [got[k]["r"] for k in "abc"] == [1.14, 1.0, 1.0]


def test_multi_customer_account_stays_one_row(spark):
    accounts = spark.sql("SELECT 'a' AS account_id, 1 AS branch_code, 560001 AS branch_pin, date'2020-01-01' AS account_opening_date,"
                         " CAST(NULL AS date) AS last_mobile_update_date, 'Y' AS kyc_compliant, 'N' AS rural_branch")
    link = spark.sql("SELECT * FROM VALUES ('a', '2'), ('a', '1'), ('b', '1') AS t(account_id, customer_id)")
    customers = spark.sql("SELECT '1' AS customer_id, '560' AS customer_pin")
    products = spark.sql("SELECT '9' AS customer_id, 1 AS sa_count, 1 AS loan_count, 1 AS cc_count")
    people = spark.sql("SELECT '1' AS customer_id, 'Y' AS nri_flag")
    extra = spark.sql("SELECT 'a' AS account_id, 'APY' AS scheme_code")
    got = rows_by_key(profile.account_profile(accounts, link, customers, products, people, extra))["a"]
    assert got["acc_per_customer"] == 2 and got["pin_mismatch"] == 0 and got["sa_count"] == 0
    assert got["nri_flag"] == 1 and got["no_mobile_update"] == 1 and got["scheme_risk"] == 0.81


def test_branch_without_staff_or_record(spark):
    accounts = spark.sql("SELECT * FROM VALUES ('a', 1), ('b', 1), ('c', 2), ('d', NULL) AS t(account_id, branch_code)")
    branch = spark.sql("SELECT 1 AS branch_code, 0 AS branch_employee_count, 'rural' AS branch_type, -5.0D AS branch_turnover, 0.0D AS branch_asset_size")
    got = rows_by_key(profile.branch_context(accounts, branch))
    assert got["a"]["accounts_per_employee"] == 2 and got["a"]["log_branch_turnover"] == 0 and got["a"]["branch_type_rural"] == 1
    assert got["c"]["accounts_per_employee"] is None and got["c"]["branch_type_rural"] == 0 and got["d"]["branch_type_urban"] == 0


def test_risky_share_uses_given_codes_only(spark):
    tx = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 2), ('b', NULL), ('b', 1) AS t(account_id, mcc_code)")
    none = tx.where("false").select("mcc_code")
    assert {r.risky_mcc_share_raw for r in channels.risky_code_share_raw(tx, none).collect()} == {0.0}
    one = spark.sql("SELECT 1 AS mcc_code")
    assert {r.account_id: r.risky_mcc_share_raw for r in channels.risky_code_share_raw(tx, one).collect()} == {"a": 0.5, "b": 0.5}


def test_tied_scores_at_k_go_by_id(spark):
    df = spark.createDataFrame([(f"{i:03d}", 1 if i == 5 else 0, 0.5) for i in range(250)], "account_id string, is_mule int, score double")
    got = {r.cut: r for r in metrics.precision_recall_at(df).collect()}
    # 2.5 and 12.5 round to the even neighbour.
    assert got["1pct"].k == 2 and got["5pct"].k == 12 and got["Npos"].k == 1
    assert got["1pct"].recall == 0 and got["5pct"].recall == 1


def test_sweep_without_flags_has_zero_scores(spark):
    df = spark.createDataFrame([("a", 1, 0.01), ("b", 0, 0.02)], "account_id string, is_mule int, score double")
    rows = metrics.threshold_sweep(df).collect()
    assert len(rows) == 180 and {(r.f1, r.precision, r.mcc, r.flags) for r in rows} == {(0.0, 0.0, 0.0, 0)}
    assert rows[0].balanced_acc == 0.5


@pytest.mark.parametrize("step", [0, 1, 17, 89, 90, 178, 179])
def test_score_on_a_threshold_reaches_it(spark, step):
    t = 0.05 + step * 0.005
    df = spark.createDataFrame([(t,), (math.nextafter(t, 0),)], "score double")
    got = [r.n for r in df.select(metrics.thresholds_passed(F.col("score")).alias("n")).collect()]
    assert got == [step + 1, step]


def test_fold_without_positives_is_left_out(spark):
    df = spark.createDataFrame([("a", 1, "2022-01-01"), ("b", 0, "2022-08-01"), ("c", 1, "2023-08-01")],
                               "account_id string, is_mule int, account_opening_date string")
    got = {(r.account_id, r.fold, r.part) for r in encoding.walk_forward_folds(df).collect()}
    assert got == {("a", 1, "train"), ("b", 1, "train"), ("c", 1, "val")}


def test_no_positives_means_no_codes(spark):
    counts = spark.createDataFrame([("a", "M1", 3)], "account_id string, code string, n long")
    train = spark.createDataFrame([("a", 0)], "account_id string, is_mule int")
    codes = encoding.risky_codes(counts, train)
    assert codes.count() == 0
    assert encoding.risky_code_share(counts, codes, train).first().risky_mcc_share == 0.0


def test_positive_cap_and_legacy_denominator(spark):
    counts = spark.createDataFrame([("a", "M1", 4), ("b", "M1", 100), ("z", "M2", 1)], "account_id string, code string, n long")
    train = spark.createDataFrame([("a", 1), ("b", 1), ("z", 0)], "account_id string, is_mule int")
    assert encoding.risky_codes(counts, train, cap=1).first().lift == pytest.approx(4 / 0.001)
    legacy = encoding.risky_codes(counts, train, cap=1, legacy_denominator=True)
    assert legacy.first().lift == pytest.approx(2 / 0.001)


def test_window_guard_keeps_two_weeks(spark):
    sheet = spark.createDataFrame([("a", 0.999), ("b", 0.2), ("c", 0.4)], "account_id string, is_mule double")
    wins = spark.sql("SELECT * FROM VALUES ('a', date'2024-01-01', date'2024-01-25', date'2024-01-11'),"
                     " ('b', date'2024-01-01', date'2024-01-25', NULL), ('c', date'2024-01-01', date'2024-01-25', NULL)"
                     " AS t(account_id, s, e, near_zero_end)")
    got = rows_by_key(decision.tighten_windows(decision.attach_windows(sheet, wins, "s", "e")))
    assert str(got["a"]["safe_end"]) == "2024-01-11" and str(got["a"]["safe_start"]) == "2023-12-29"
    assert got["a"]["seed_window_days"] == 14 and got["a"]["changed"] == 0
    assert got["b"]["safe_start"] is None and got["b"]["old_window_days"] == 25
    assert got["c"]["target_window_days"] is None and str(got["c"]["safe_start"]) == "2024-01-01"


@pytest.mark.parametrize("slices, chunk", [(64, 4096), (8, 16), (1, 4), (7, 3)])
def test_impossible_travel_equals_pairs_of_rows(ledger, slices, chunk):
    """Accounts with bursts inside one span, at its very end, across chunks and at equal times."""
    import random
    rnd, times = random.Random(slices), {}
    for a in range(60):
        base = rnd.randrange(0, 10_000_000)
        for i in range(rnd.randrange(1, 14)):
            second = base + rnd.choice([0, 0, 1, 7199, 7200, 7201, 3600, rnd.randrange(0, 20_000)])
            times.setdefault(f"a{a}", []).append((second, rnd.choice([10.0, 12.0, 14.9, 15.0, 15.1]), rnd.choice([70.0, 72.0, 75.0, 75.1])))
    flat = [(a, *t) for a, found in times.items() for t in found]
    rows = [(a, str(i), "2024-01-01 00:00:00", "C", 1.0, 1.0) for i, (a, *_) in enumerate(flat)]
    df = ledger(rows).drop("latitude", "longitude", "ts")
    spark = df.sparkSession
    more = spark.createDataFrame([(str(i), s, lat, lon) for i, (_, s, lat, lon) in enumerate(flat)],
                                 "transaction_id string, s long, latitude double, longitude double")
    df = df.join(more.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000)), "transaction_id")
    got = rows_by_key(geo.impossible_travel(df, slices=slices, chunk=chunk))
    for a, found in times.items():
        want = any(0 < t - s <= 7200 and (round(abs(x - u), 6) > 5 or round(abs(y - v), 6) > 5) for s, x, y in found for t, u, v in found)
        assert got[a]["impossible_travel_flag"] == int(want), a
