"""Ledger features: groups A-F, W, L, X, Q, V, Z and their grains."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog.registry import query
from ledgerlens.operators import amounts, balance, calendar, channels, dormancy, flow, geo, network, velocity, windows
from ledgerlens.plans import grains

# ---------------------------------------------------------------- A: counterparty network
A1_COLUMNS = ("account_id unique_counterparties:i unique_incoming_cp:i unique_outgoing_cp:i fan_asymmetry:f "
              "cp_incoming_ratio:f cp_outgoing_ratio:f")
A1_SQL = """
SELECT account_id, n AS unique_counterparties, n_in AS unique_incoming_cp, n_out AS unique_outgoing_cp,
 CAST(n_in AS DOUBLE) / (n_out + 1) AS fan_asymmetry, CAST(n_in AS DOUBLE) / (n + 1) AS cp_incoming_ratio,
 CAST(n_out AS DOUBLE) / (n + 1) AS cp_outgoing_ratio
FROM (SELECT account_id, count(DISTINCT counterparty_id) AS n,
 count(DISTINCT counterparty_id) FILTER (WHERE txn_type = 'C') AS n_in,
 count(DISTINCT counterparty_id) FILTER (WHERE txn_type = 'D') AS n_out FROM tx GROUP BY account_id) AS d"""


@query("a1_counterparty_network", A1_COLUMNS, A1_SQL)
def _(d):
    return network.counterparty_network(d.edges)


@query("a2_deviation_from_branch_median", "account_id cp_deviation_from_branch:f", """
SELECT a.account_id, a.n - m.mid AS cp_deviation_from_branch
FROM (SELECT t.account_id, t.n, c.branch_code FROM
 (SELECT account_id, count(DISTINCT counterparty_id) AS n FROM tx GROUP BY account_id) t
 LEFT JOIN accounts c ON t.account_id = c.account_id) a
LEFT JOIN (SELECT c.branch_code, median(t.n) AS mid FROM
 (SELECT account_id, count(DISTINCT counterparty_id) AS n FROM tx GROUP BY account_id) t
 JOIN accounts c ON t.account_id = c.account_id WHERE c.branch_code IS NOT NULL GROUP BY c.branch_code) m
 ON a.branch_code = m.branch_code""")
def _(d):
    return network.deviation_from_group(
        network.counterparty_network(d.edges), d.accounts, "unique_counterparties", "branch_code",
        "cp_deviation_from_branch")


# ---------------------------------------------------------------- B: channels and codes
CHANNEL_COUNTS = {"per_channel": """SELECT account_id, channel, count(*) AS n,
 CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY account_id) AS p FROM tx GROUP BY account_id, channel"""}


@query("b1_channel_mix", "account_id channel_count:i top_channel_share:f neft_imps_share:f atm_share:f total_txns:i", """
SELECT account_id, count(channel) AS channel_count, max(p) AS top_channel_share,
 coalesce(sum(p) FILTER (WHERE channel IN ('NEFT', 'IMPS', 'NTD', 'IPM')), 0) AS neft_imps_share,
 coalesce(sum(p) FILTER (WHERE channel = 'ATM'), 0) AS atm_share, sum(n) AS total_txns
FROM per_channel GROUP BY account_id""", CHANNEL_COUNTS)
def _(d):
    return channels.channel_mix(d.channels)


@query("b2_entropy", "account_id channel_entropy:f",
       "SELECT account_id, -sum(p * ln(p + 1e-9)) AS channel_entropy FROM per_channel GROUP BY account_id",
       CHANNEL_COUNTS)
def _(d):
    return channels.entropy(d.channels, "channel_entropy")


CODE_RATES_SQL = """
SELECT mcc_code, n_accounts, n_mule_accs, round(n_mule_accs * 100e0 / n_accounts, 2) AS mule_rate_pct FROM (
 SELECT mcc_code, count(*) AS n_accounts, sum(is_mule) AS n_mule_accs
 FROM (SELECT DISTINCT account_id, mcc_code FROM tx) AS used JOIN acct_labels USING (account_id) GROUP BY mcc_code) AS per_code
WHERE n_accounts >= 50"""
CODE_LIFT_SQL = CODE_RATES_SQL + " ORDER BY mule_rate_pct DESC, mcc_code NULLS LAST LIMIT 20"


@query("b3_code_lift", "mcc_code:i n_accounts:i n_mule_accs:i mule_rate_pct:f", CODE_LIFT_SQL)
def _(d):
    return channels.code_lift(d.tx, d.acct_labels)


@query("b4_code_frequency", "mcc_code:i n_accounts:i", """
SELECT mcc_code, count(DISTINCT account_id) AS n_accounts FROM tx GROUP BY mcc_code
ORDER BY n_accounts DESC, mcc_code ASC NULLS LAST LIMIT 20""")
def _(d):
    return channels.code_frequency(d.tx)


@query("b4_distinct_codes", "n_distinct_codes:i", "SELECT count(DISTINCT mcc_code) AS n_distinct_codes FROM tx")
def _(d):
    return channels.distinct_codes(d.tx)


@query("b5_risky_code_share_raw", "account_id risky_mcc_share_raw:f", f"""
SELECT account_id, avg(CASE WHEN mcc_code IN (SELECT mcc_code FROM ({CODE_RATES_SQL}) AS lift
 WHERE mule_rate_pct >= 2.79e0 * 1.5e0 AND mcc_code IS NOT NULL) THEN 1e0 ELSE 0e0 END) AS risky_mcc_share_raw
FROM tx GROUP BY account_id""")
def _(d):
    codes = channels.risky_codes_by_rate(channels.code_lift(d.tx, d.acct_labels, top=None))
    return channels.risky_code_share_raw(d.tx, codes)


# ---------------------------------------------------------------- C-1, C-2: amounts
C_1_COLUMNS = ("account_id structuring_share:f round_share:f median_txn_amount:f avg_txn_amount:f high_value_share:f "
               "micro_txn_share:f total_credit_amt:g total_debit_amt:g txn_count:i")
C_1_SQL = """
SELECT account_id, avg(CASE WHEN amt >= 40000 AND amt < 50000 THEN 1e0 ELSE 0e0 END) AS structuring_share,
 avg(CASE WHEN amt > 0 AND amt % 500 = 0 THEN 1e0 ELSE 0e0 END) AS round_share, median(amt) AS median_txn_amount,
 avg(amt) AS avg_txn_amount, avg(CASE WHEN amt > 50000 THEN 1e0 ELSE 0e0 END) AS high_value_share,
 avg(CASE WHEN amt < 100 THEN 1e0 ELSE 0e0 END) AS micro_txn_share,
 sum(CASE WHEN txn_type = 'C' THEN amt ELSE 0 END) AS total_credit_amt,
 sum(CASE WHEN txn_type = 'D' THEN amt ELSE 0 END) AS total_debit_amt, count(*) AS txn_count
FROM {t} GROUP BY account_id"""


@query("c_1_amount_profile", C_1_COLUMNS, C_1_SQL.format(t="tx"))
def _(d):
    return amounts.amount_profile(d.tx, d.hot)


@query("c_1_amount_profile_long", C_1_COLUMNS, C_1_SQL.format(t="tx_long"))
def _(d):
    return amounts.amount_profile(d.tx_long, d.hot_long)


@query("c_2_credit_debit_ratio", "account_id credit_debit_ratio:f", """
SELECT account_id, least(greatest(sum(CASE WHEN txn_type = 'C' THEN amt ELSE 0 END)
 / (sum(CASE WHEN txn_type = 'D' THEN amt ELSE 0 END) + 1), 0), 10) AS credit_debit_ratio FROM tx_long GROUP BY account_id""")
def _(d):
    named = {n: c for n, c in amounts.amount_aggregates().items() if n.startswith("total_")}
    return d.tx_long.groupBy("account_id").agg(*[c.alias(n) for n, c in named.items()]).select(
        "account_id", amounts.credit_debit_ratio(F.col("total_credit_amt"), F.col("total_debit_amt"))
        .alias("credit_debit_ratio"))


# ---------------------------------------------------------------- D: balance
D1_SQL = """
SELECT account_id, avg(abs(bal)) AS avg_running_balance, stddev_samp(abs(bal)) AS std_running_balance,
 avg(CASE WHEN abs(bal) < 500 THEN 1e0 ELSE 0e0 END) AS near_zero_balance_share,
 CASE WHEN avg(abs(bal)) > 0 THEN stddev_samp(abs(bal)) / avg(abs(bal)) END AS balance_cv FROM led GROUP BY account_id"""


@query("d1_balance_profile",
       "account_id avg_running_balance:f std_running_balance:f near_zero_balance_share:f balance_cv:f", D1_SQL)
def _(d):
    return balance.balance_profile(d.ledger)


STEPS = {"stepped": """SELECT *, lag(ts) OVER w AS prev_ts, lag(txn_type) OVER w AS prev_type, lead(ts) OVER w AS next_ts,
 lead(txn_type) OVER w AS next_type, lead(amt) OVER w AS next_amt, lead(bal) OVER w AS next_bal
FROM led WINDOW w AS (PARTITION BY account_id ORDER BY ts, transaction_id)"""}


@query("d2_rapid_drain", "account_id rapid_drain_rate:f avg_drain_seconds:f", """
SELECT account_id, avg(CASE WHEN txn_type = 'D' AND prev_type = 'C' AND secs <= 3600 THEN 1e0 ELSE 0e0 END) AS rapid_drain_rate,
 avg(CASE WHEN txn_type = 'D' AND prev_type = 'C' THEN secs END) AS avg_drain_seconds
FROM (SELECT *, datediff('second', prev_ts, ts) AS secs FROM stepped) AS s GROUP BY account_id""", STEPS)
def _(d):
    return balance.rapid_drain(d.steps)


@query("d3_turnover", "account_id turnover_v3:f", """
SELECT b.account_id, v.volume / (b.mean_bal + 100) AS turnover_v3
FROM (SELECT account_id, avg(abs(bal)) AS mean_bal FROM led GROUP BY account_id) b
LEFT JOIN (SELECT account_id, sum(amt) AS volume FROM tx GROUP BY account_id) v ON b.account_id = v.account_id""")
def _(d):
    return balance.turnover(d.tx, balance.balance_profile(d.ledger))


# ---------------------------------------------------------------- E: calendar
@query("e1_calendar_shares", "account_id weekend_share:f sunday_share:f offhours_share:f month_boundary_share:f", """
SELECT account_id, avg(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1e0 ELSE 0e0 END) AS weekend_share,
 avg(CASE WHEN dayofweek(ts) = 0 THEN 1e0 ELSE 0e0 END) AS sunday_share,
 avg(CASE WHEN hour(ts) NOT BETWEEN 6 AND 21 THEN 1e0 ELSE 0e0 END) AS offhours_share,
 avg(CASE WHEN day(ts) <= 5 OR day(ts) >= 25 THEN 1e0 ELSE 0e0 END) AS month_boundary_share FROM tx GROUP BY account_id""")
def _(d):
    return calendar.calendar_shares(d.tx)


DAILY = {"daily": "SELECT account_id, CAST(ts AS DATE) AS day, count(*) AS n, "
                  "sum(CASE WHEN txn_type = 'C' THEN amt ELSE 0 END) AS credit FROM tx GROUP BY account_id, CAST(ts AS DATE)"}
DAILY_LONG = {"daily": DAILY["daily"].replace("FROM tx", "FROM tx_long")}


@query("e2_activity_span", "account_id active_days:i calendar_days:i activity_density:f", """
SELECT account_id, count(*) AS active_days, max(day) - min(day) + 1 AS calendar_days,
 count(*) * 1e0 / (max(day) - min(day) + 1) AS activity_density FROM daily GROUP BY account_id""", DAILY_LONG)
def _(d):
    return calendar.activity_span(d.daily_long)


@query("e3_rolling_peak", "account_id peak_90d_count:i avg_90d_count:f peak_to_avg_90d:f", """
SELECT account_id, max(r) AS peak_90d_count, avg(r) AS avg_90d_count, max(r) * 1e0 / avg(r) AS peak_to_avg_90d
FROM (SELECT account_id, sum(n) OVER (PARTITION BY account_id ORDER BY day
 RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW) AS r FROM daily) AS s GROUP BY account_id""", DAILY_LONG)
def _(d):
    return calendar.rolling_peak(d.daily_long)


@query("e4_days_to_first_txn", "account_id days_to_first_txn:i", """
SELECT f.account_id, greatest(floor(epoch(f.first_ts - CAST(a.account_opening_date AS TIMESTAMP)) / 86400), 0) AS days_to_first_txn
FROM (SELECT account_id, min(ts) AS first_ts FROM tx GROUP BY account_id) f
JOIN accounts a ON f.account_id = a.account_id""")
def _(d):
    return calendar.days_to_first_txn(calendar.calendar_shares(d.tx), d.accounts)


# ---------------------------------------------------------------- F: ip and coordinates
@query("f1_ip_popularity", "ip_address ip_account_count:i", """
SELECT ip_address, count(DISTINCT account_id) AS ip_account_count FROM led
WHERE ip_address IS NOT NULL AND ip_address <> '' GROUP BY ip_address""")
def _(d):
    return geo.ip_popularity(geo.ip_table(d.ledger))


@query("f2_geo_ip_profile",
       "account_id unique_ips:i lat_std:f lon_std:f ip_null_rate:f avg_ip_sharing:f geo_spread:f", """
SELECT l.account_id, count(DISTINCT l.ip_address) AS unique_ips, stddev_samp(latitude) AS lat_std,
 stddev_samp(longitude) AS lon_std, avg(CASE WHEN l.ip_address IS NULL OR l.ip_address = '' THEN 1e0 ELSE 0e0 END) AS ip_null_rate,
 avg(p.k) AS avg_ip_sharing,
 sqrt(coalesce(stddev_samp(latitude), 0) ** 2 + coalesce(stddev_samp(longitude), 0) ** 2) AS geo_spread
FROM led l LEFT JOIN (SELECT ip_address, count(DISTINCT account_id) AS k FROM led WHERE ip_address <> '' GROUP BY ip_address) p
 ON l.ip_address = p.ip_address GROUP BY l.account_id""")
def _(d):
    ips = geo.ip_table(d.ledger)
    return geo.geo_ip_profile(d.ledger, ips, geo.ip_popularity(ips))


# ---------------------------------------------------------------- W: recent windows
W_COLUMNS = """account_id {s}_txn_count:i {w}_txn_count:i {s}_near_zero_count:i {w}_near_zero_count:i
 {w}_large_credit_count:i {w}_txn_concentration:f {s}_txn_concentration:f {w}_credit_concentration:f
 {w}_near_zero_rate:f {s}_near_zero_rate:f {w}_near_zero_uplift:f {w}_activity_concentration:f
 {w}_avg_credit_ratio:f {w}_credit_zscore:f {s}_{w}_acceleration:f"""
W_SQL = """
SELECT account_id, n_s AS {s}_txn_count, n_w AS {w}_txn_count, z_s AS {s}_near_zero_count, z_w AS {w}_near_zero_count,
 big AS {w}_large_credit_count, n_w * 1e0 / n AS {w}_txn_concentration, n_s * 1e0 / n AS {s}_txn_concentration,
 CASE WHEN vol > 0 THEN coalesce(vol_w, 0) / vol ELSE 0 END AS {w}_credit_concentration,
 z_w * 1e0 / n_w AS {w}_near_zero_rate, CASE WHEN n_s > 0 THEN z_s * 1e0 / n_s ELSE 0 END AS {s}_near_zero_rate,
 CASE WHEN z > 0 THEN (z_w * 1e0 / n_w) / (z * 1e0 / n) ELSE 0 END AS {w}_near_zero_uplift,
 days_w * 1e0 / days AS {w}_activity_concentration,
 CASE WHEN mean > 0 AND mean_w IS NOT NULL THEN mean_w / mean ELSE 1 END AS {w}_avg_credit_ratio,
 CASE WHEN sd > 0 AND mean_w IS NOT NULL THEN (mean_w - mean) / sd ELSE 0 END AS {w}_credit_zscore,
 n_s * 1e0 / n_w AS {s}_{w}_acceleration
FROM (SELECT l.account_id, count(*) AS n, count(*) FILTER (WHERE in_s) AS n_s, count(*) FILTER (WHERE in_w) AS n_w,
 count(*) FILTER (WHERE nz) AS z, count(*) FILTER (WHERE nz AND in_s) AS z_s, count(*) FILTER (WHERE nz AND in_w) AS z_w,
 count(*) FILTER (WHERE txn_type = 'C' AND amt > 50000 AND in_w) AS big,
 sum(amt) FILTER (WHERE txn_type = 'C') AS vol, sum(amt) FILTER (WHERE txn_type = 'C' AND in_w) AS vol_w,
 avg(amt) FILTER (WHERE txn_type = 'C') AS mean, avg(amt) FILTER (WHERE txn_type = 'C' AND in_w) AS mean_w,
 stddev_samp(amt) FILTER (WHERE txn_type = 'C') AS sd,
 count(DISTINCT CAST(ts AS DATE)) AS days, count(DISTINCT CAST(ts AS DATE)) FILTER (WHERE in_w) AS days_w
FROM (SELECT *, ts >= max(ts) OVER (PARTITION BY account_id) - INTERVAL {ns} DAY AS in_s,
 ts >= max(ts) OVER (PARTITION BY account_id) - INTERVAL {nw} DAY AS in_w,
 txn_type = 'D' AND abs(bal) < 500 AS nz FROM led) AS l GROUP BY l.account_id) AS a"""


def _w(template: str, short: int, long: int) -> str:
    return template.format(s=f"w{short}", w=f"w{long}", ns=short, nw=long)


@query("w1_anchored_windows", _w(W_COLUMNS, 5, 15), _w(W_SQL, 5, 15))
def _(d):
    return windows.anchored_windows(d.ledger, d.hot, (5, 15))


LONG_WITH_BALANCE = {"led": "SELECT *, amt / 100 AS bal FROM tx_long"}


def _long_ledger(d):
    """The long-horizon ledger has no extension; a balance is derived from its amounts."""
    return d.tx_long.withColumn("bal", F.col("amt") / 100)


W2_COLUMNS = """account_id w90_txn_concentration:f w30_txn_concentration:f w90_credit_concentration:f w90_near_zero_rate:f
 w30_near_zero_rate:f w90_activity_concentration:f w30_w90_acceleration:f"""


@query("w2_window_concentration", W2_COLUMNS, _w(W_SQL, 30, 90), LONG_WITH_BALANCE)
def _(d):
    return windows.anchored_windows(_long_ledger(d), d.hot_long)


@query("w3_window_uplift", "account_id w90_near_zero_uplift:f w90_avg_credit_ratio:f w90_credit_zscore:f",
       _w(W_SQL, 30, 90), LONG_WITH_BALANCE)
def _(d):
    return windows.anchored_windows(_long_ledger(d), d.hot_long)


# ---------------------------------------------------------------- L: fund residence
@query("l1_next_step", "account_id transaction_id next_us:i next_type next_amt:f next_bal:f", """
SELECT account_id, transaction_id, epoch_us(next_ts) AS next_us, next_type, next_amt, next_bal FROM stepped""", STEPS)
def _(d):
    return flow.next_step(d.ledger, d.hot).withColumn("next_us", F.unix_micros("next_ts"))


PAIRS = {**STEPS, "pairs": """SELECT *, epoch_us(next_ts) - epoch_us(ts) AS lag_us,
 (epoch_us(next_ts) - epoch_us(ts)) / 3.6e9 AS lag_hours FROM stepped WHERE txn_type = 'C' AND next_type = 'D'""",
         "credits": "SELECT account_id, count(*) FILTER (WHERE txn_type = 'C') AS k FROM led GROUP BY account_id"}


@query("l2_residence_stats", """account_id n_credit_debit_pairs:i median_residence_hours:f p25_residence_hours:f
 avg_residence_hours:f min_residence_hours:f""", """
SELECT c.account_id, count(p.lag_hours) AS n_credit_debit_pairs, coalesce(quantile_cont(p.lag_hours, 0.5), -1) AS median_residence_hours,
 coalesce(quantile_cont(p.lag_hours, 0.25), -1) AS p25_residence_hours, coalesce(avg(p.lag_hours), -1) AS avg_residence_hours,
 coalesce(min(p.lag_hours), -1) AS min_residence_hours
FROM credits c LEFT JOIN pairs p ON c.account_id = p.account_id GROUP BY c.account_id""", PAIRS)
def _(d):
    return flow.residence_stats(d.steps, d.hot)


@query("l3_drain_rates", "account_id drain_rate_1h:f drain_rate_6h:f drain_rate_24h:f", """
SELECT c.account_id, CASE WHEN max(c.k) > 0 THEN count(*) FILTER (WHERE p.lag_hours <= 1) * 1e0 / max(c.k) ELSE 0 END AS drain_rate_1h,
 CASE WHEN max(c.k) > 0 THEN count(*) FILTER (WHERE p.lag_hours <= 6) * 1e0 / max(c.k) ELSE 0 END AS drain_rate_6h,
 CASE WHEN max(c.k) > 0 THEN count(*) FILTER (WHERE p.lag_hours <= 24) * 1e0 / max(c.k) ELSE 0 END AS drain_rate_24h
FROM credits c LEFT JOIN pairs p ON c.account_id = p.account_id GROUP BY c.account_id""", PAIRS)
def _(d):
    return flow.drain_rates(d.steps)


@query("l4_same_day_drain", "account_id same_day_drain_count:i same_day_drain_rate:f", """
SELECT c.account_id, count(*) FILTER (WHERE CAST(p.ts AS DATE) = CAST(p.next_ts AS DATE)) AS same_day_drain_count,
 CASE WHEN max(c.k) > 0 THEN count(*) FILTER (WHERE CAST(p.ts AS DATE) = CAST(p.next_ts AS DATE)) * 1e0 / max(c.k) ELSE 0 END AS same_day_drain_rate
FROM credits c LEFT JOIN pairs p ON c.account_id = p.account_id GROUP BY c.account_id""", PAIRS)
def _(d):
    return flow.same_day_drain(d.steps)


@query("l5_post_credit_drawdown", "account_id avg_post_credit_drawdown:f large_credit_to_zero_rate:f", """
SELECT c.account_id, coalesce(avg(CASE WHEN p.amt <> 0 THEN (p.amt - p.next_amt) / p.amt END), 0) AS avg_post_credit_drawdown,
 CASE WHEN max(c.k) > 0 THEN count(*) FILTER (WHERE abs(p.next_bal) < 500) * 1e0 / max(c.k) ELSE 0 END AS large_credit_to_zero_rate
FROM credits c LEFT JOIN pairs p ON c.account_id = p.account_id GROUP BY c.account_id""", PAIRS)
def _(d):
    return flow.post_credit_drawdown(d.steps)


# ---------------------------------------------------------------- X: counterparty dynamics
def _cp(ledger: str) -> dict[str, str]:
    return {
        "cp": f"SELECT account_id, counterparty_id, txn_type, ts FROM {ledger} WHERE counterparty_id IS NOT NULL",
        "anchored": "SELECT *, max(ts) OVER (PARTITION BY account_id) AS anchor FROM cp",
        "life": "SELECT account_id, count(DISTINCT counterparty_id) AS k, count(*) AS n FROM cp GROUP BY account_id",
    }


X1_SQL = """
SELECT l.account_id, coalesce(f.k, 0) AS new_cp_30d, coalesce(f.k, 0) * 1e0 / l.k AS new_cp_30d_rate
FROM life l LEFT JOIN (SELECT a.account_id, count(DISTINCT a.counterparty_id) AS k FROM anchored a
 WHERE a.ts >= a.anchor - INTERVAL 30 DAY AND NOT EXISTS (SELECT 1 FROM anchored o WHERE o.account_id = a.account_id
 AND o.counterparty_id = a.counterparty_id AND o.ts < o.anchor - INTERVAL 30 DAY) GROUP BY a.account_id) f
 ON l.account_id = f.account_id"""


@query("x1_novel_counterparties", "account_id new_cp_30d:i new_cp_30d_rate:f", X1_SQL, _cp("tx_long"))
def _(d):
    return network.novel_counterparties(d.edges_long, d.hot_long)


@query("x1_novel_counterparties_7d", "account_id new_cp_7d:i new_cp_7d_rate:f",
       X1_SQL.replace("30", "7"), _cp("tx"))
def _(d):
    return network.novel_counterparties(d.edges, d.hot, 7)


@query("x2_cp_window_concentration", "account_id w30_cp_concentration:f w90_cp_concentration:f", """
SELECT account_id, count(DISTINCT counterparty_id) FILTER (WHERE ts >= anchor - INTERVAL 30 DAY) * 1e0 / count(DISTINCT counterparty_id) AS w30_cp_concentration,
 count(DISTINCT counterparty_id) FILTER (WHERE ts >= anchor - INTERVAL 90 DAY) * 1e0 / count(DISTINCT counterparty_id) AS w90_cp_concentration
FROM anchored GROUP BY account_id""", _cp("tx_long"))
def _(d):
    return network.cp_window_concentration(d.edges_long, d.hot_long)


@query("x3_top_counterparty_share", "account_id top1_cp_share:f", """
SELECT account_id, max(k) * 1e0 / sum(k) AS top1_cp_share
FROM (SELECT account_id, counterparty_id, count(*) AS k FROM cp GROUP BY account_id, counterparty_id) AS e GROUP BY account_id""",
       _cp("tx"))
def _(d):
    return network.top_counterparty_share(d.edges)


@query("x4_cp_branch_diversity", "account_id unique_cp_branches:i top_branch_share:f", """
SELECT account_id, count(*) AS unique_cp_branches, max(k) * 1e0 / sum(k) AS top_branch_share
FROM (SELECT account_id, substring(counterparty_id, 1, 8) AS pre, count(*) AS k FROM cp GROUP BY 1, 2) AS e GROUP BY account_id""",
       _cp("tx"))
def _(d):
    return network.cp_branch_diversity(d.edges)


X5_SQL = """
SELECT l.account_id, coalesce(b.both_ways, 0) AS bidirectional_cp_count, coalesce(b.both_ways, 0) * 1e0 / l.k AS bidirectional_cp_rate
FROM life l LEFT JOIN (SELECT o.account_id, count(*) AS both_ways
 FROM (SELECT DISTINCT account_id, counterparty_id FROM cp WHERE txn_type = 'D') o
 JOIN (SELECT DISTINCT account_id, counterparty_id FROM cp WHERE txn_type = 'C') i
 ON o.account_id = i.account_id AND o.counterparty_id = i.counterparty_id GROUP BY o.account_id) b ON l.account_id = b.account_id"""


@query("x5_bidirectional_counterparties", "account_id bidirectional_cp_count:i bidirectional_cp_rate:f", X5_SQL, _cp("tx"))
def _(d):
    return network.bidirectional_counterparties(d.edges)


@query("x6_direction_unique_cp", "account_id outgoing_unique_cp:i incoming_unique_cp:i outgoing_incoming_cp_ratio:f", """
SELECT account_id, o AS outgoing_unique_cp, i AS incoming_unique_cp, CASE WHEN i > 0 THEN o * 1e0 / i ELSE 0 END AS outgoing_incoming_cp_ratio
FROM (SELECT account_id, count(DISTINCT counterparty_id) FILTER (WHERE txn_type = 'D') AS o,
 count(DISTINCT counterparty_id) FILTER (WHERE txn_type = 'C') AS i FROM cp GROUP BY account_id) AS s""", _cp("tx"))
def _(d):
    return network.direction_unique_cp(d.edges)


# ---------------------------------------------------------------- Q: dormancy
GAPS = {**DAILY_LONG, "gaps": "SELECT *, lead(day) OVER (PARTITION BY account_id ORDER BY day) - day - 1 AS gap FROM daily"}


@query("q1_inactivity_gaps", "account_id max_inactivity_gap:i gaps_over_30d:i gaps_over_60d:i gaps_over_90d:i", """
SELECT account_id, coalesce(max(gap), 0) AS max_inactivity_gap, count(*) FILTER (WHERE gap >= 30) AS gaps_over_30d,
 count(*) FILTER (WHERE gap >= 60) AS gaps_over_60d, count(*) FILTER (WHERE gap >= 90) AS gaps_over_90d
FROM gaps GROUP BY account_id""", GAPS)
def _(d):
    return dormancy.inactivity_gaps(d.daily_long)


BEST_GAP = {**GAPS, "best": """SELECT account_id, gap, day AS start FROM (SELECT *, row_number() OVER
 (PARTITION BY account_id ORDER BY gap DESC, day DESC) AS rn FROM gaps WHERE gap IS NOT NULL) AS r WHERE rn = 1"""}


@query("q2_longest_gap", "account_id longest_gap_days:i longest_gap_start:i", """
SELECT account_id, gap AS longest_gap_days, start - DATE '1970-01-01' AS longest_gap_start FROM best""", BEST_GAP)
def _(d):
    return dormancy.longest_gap(d.daily_long).withColumn("longest_gap_start", F.unix_date("longest_gap_start_date"))


Q3_SQL = """
SELECT d.account_id, count(*) FILTER (WHERE d.day < b.start) AS pre_gap_activity_days,
 count(*) FILTER (WHERE d.day > b.start AND d.day <= b.start + 30) AS post_gap_activity_days,
 coalesce(sum(d.credit) FILTER (WHERE d.day > b.start AND d.day <= b.start + 30), 0) AS reactivation_volume,
 coalesce((sum(d.n) FILTER (WHERE d.day > b.start AND d.day <= b.start + 30) * 1e0
 / count(*) FILTER (WHERE d.day > b.start AND d.day <= b.start + 30)) / avg(d.n), 0) AS burst_ratio_after_gap
FROM daily d LEFT JOIN best b ON d.account_id = b.account_id GROUP BY d.account_id"""
Q3_COLUMNS = ("account_id pre_gap_activity_days:i post_gap_activity_days:i reactivation_volume:g "
              "burst_ratio_after_gap:f")


@query("q3_reactivation", Q3_COLUMNS, Q3_SQL, BEST_GAP)
def _(d):
    return dormancy.reactivation(d.daily_long)


@query("q3_reactivation_short_horizon", Q3_COLUMNS, Q3_SQL, {**BEST_GAP, **DAILY})
def _(d):
    return dormancy.reactivation(d.daily)


# ---------------------------------------------------------------- V: velocity
@query("v1_burst_stats", "account_id max_daily_txns:i burst_count:i", """
SELECT account_id, max(n) AS max_daily_txns, count(*) FILTER (WHERE n > 3 * mean) AS burst_count
FROM (SELECT *, avg(n) OVER (PARTITION BY account_id) AS mean FROM daily) AS s GROUP BY account_id""", DAILY)
def _(d):
    return velocity.burst_stats(d.daily)


@query("v2_hourly_peak", "account_id max_hourly_txns:i", """
SELECT account_id, max(n) AS max_hourly_txns FROM (SELECT account_id, CAST(ts AS DATE), hour(ts), count(*) AS n
 FROM tx GROUP BY 1, 2, 3) AS h GROUP BY account_id""")
def _(d):
    return velocity.hourly_peak(grains.hourly_table(d.tx))


@query("v3_inter_txn_gaps", "account_id inter_txn_gap_p10:f inter_txn_gap_p50:f inter_txn_gap_p90:f gap_cv:f", """
SELECT account_id, coalesce(quantile_cont(g, 0.1), 0) AS inter_txn_gap_p10, coalesce(quantile_cont(g, 0.5), 0) AS inter_txn_gap_p50,
 coalesce(quantile_cont(g, 0.9), 0) AS inter_txn_gap_p90, CASE WHEN avg(g) > 0 THEN stddev_samp(g) / avg(g) ELSE 0 END AS gap_cv
FROM (SELECT account_id, datediff('second', lag(ts) OVER (PARTITION BY account_id ORDER BY ts, transaction_id), ts) / 3600e0 AS g
 FROM tx) AS s GROUP BY account_id""")
def _(d):
    return velocity.inter_txn_gaps(d.tx, d.hot)


# ---------------------------------------------------------------- Z: locations
@query("z1_location_stats", """account_id unique_location_count:i txns_with_location:f max_distance_km_approx:f
 atm_deposit_channel_flag:f""", """
SELECT account_id, count(DISTINCT (round(latitude, 1), round(longitude, 1))) AS unique_location_count,
 avg(CASE WHEN latitude <> 0 AND longitude <> 0 THEN 1e0 ELSE 0e0 END) AS txns_with_location,
 sqrt(coalesce(max(latitude) - min(latitude), 0) ** 2 + coalesce(max(longitude) - min(longitude), 0) ** 2) AS max_distance_km_approx,
 avg(CASE WHEN atm_deposit_channel_code <> '' THEN 1e0 ELSE 0e0 END) AS atm_deposit_channel_flag FROM led GROUP BY account_id""")
def _(d):
    return geo.location_stats(d.ledger, d.cells)


@query("z2_location_entropy", "account_id location_entropy:f", """
SELECT account_id, -sum(p * ln(p + 1e-9)) AS location_entropy FROM (SELECT account_id,
 CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY account_id) AS p FROM led
 WHERE latitude <> 0 AND longitude <> 0 GROUP BY account_id, round(latitude, 1), round(longitude, 1)) AS c GROUP BY account_id""")
def _(d):
    return geo.location_entropy(d.cells)


Z3_SQL = """
SELECT a.account_id, coalesce(max(CASE WHEN abs(g.lat_bin - h.lat_bin) > 5 OR abs(g.lon_bin - h.lon_bin) > 5 THEN 1 ELSE 0 END), 0) AS impossible_travel_flag
FROM (SELECT DISTINCT account_id FROM led) a LEFT JOIN places g ON a.account_id = g.account_id
LEFT JOIN places h ON g.account_id = h.account_id AND h.ts > g.ts AND h.ts <= g.ts + INTERVAL 2 HOUR GROUP BY a.account_id"""
PLACES = {"places": """SELECT account_id, ts, round(latitude, 1) AS lat_bin, round(longitude, 1) AS lon_bin FROM led
 WHERE latitude <> 0 AND longitude <> 0"""}


@query("z3_impossible_travel", "account_id impossible_travel_flag:i", Z3_SQL, PLACES)
def _(d):
    return geo.impossible_travel(d.ledger)
