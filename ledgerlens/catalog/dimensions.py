"""Sources, cleaning, joins and dimension features: S, C, J, G, H, K, U."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlens.catalog.features import (
    CHANNEL_COUNTS, DAILY, PLACES, X1_SQL, X5_SQL, Z3_SQL, _cp,
)
from ledgerlens.catalog.registry import query
from ledgerlens.functions import columns as C
from ledgerlens.functions.skew import join_per_key
from ledgerlens.operators import amounts, balance, calendar, channels, geo, network, profile
from ledgerlens.operators.assemble import lookup_with_default, merge_packs
from ledgerlens.session import stage_folder
from ledgerlens.sources import tables
from ledgerlens.sources.ledger import build_ledger


# ---------------------------------------------------------------- S: sources and sinks
@query("s1_read_table", "o_orderkey:i o_custkey:i o_totalprice:f",
       "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(d):
    from ledgerlens.catalog.fixtures import SCHEMAS
    return tables.read_table(d.spark, f"{d.sf_dir}/orders.parquet", SCHEMAS["orders"])


@query("s2_read_ledger", "event_id:i user_id:i value:f", "SELECT event_id, user_id, value FROM events")
def _(d):
    from ledgerlens.catalog.fixtures import SCHEMAS
    return tables.read_ledger(d.spark, f"{d.sf_dir}/event[s].parquet", ["event_id", "user_id", "value"],
                              SCHEMAS["events"])


INVENTORY = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
             "labels", "conversations")


@query("s4_table_inventory", "table_name files:i rows:i has_bytes columns:i column_list", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, 1 AS files, (SELECT count(*) FROM {t}) AS rows, true AS has_bytes, count(*) AS columns, "
    f"string_agg(column_name, ',' ORDER BY ordinal_position) AS column_list FROM information_schema.columns WHERE table_name = '{t}'" for t in INVENTORY))
def _(d):
    found = tables.table_inventory(d.spark, {t: f"{d.sf_dir}/{t}.parquet" for t in INVENTORY})
    return found.withColumn("has_bytes", F.col("bytes") > 0)


def _scratch(d, name: str) -> str:
    return f"{stage_folder(d.spark)}/ledgerlens-{name}-{uuid.uuid4().hex}"


AMOUNT_TOTALS_SQL = "SELECT account_id, count(*) AS txn_count, median(amt) AS median_txn_amount FROM tx GROUP BY account_id"


@query("s6_write_features", "account_id txn_count:i median_txn_amount:f", AMOUNT_TOTALS_SQL)
def _(d):
    path = _scratch(d, "features")
    tables.write_features(amounts.amount_profile(d.tx, d.hot), path)
    return tables.read_table(d.spark, path)


@query("s7_write_csv", "account_id txn_count:i median_txn_amount:f", AMOUNT_TOTALS_SQL)
def _(d):
    path = _scratch(d, "report")
    out = amounts.amount_profile(d.tx, d.hot).select("account_id", "txn_count", "median_txn_amount")
    tables.write_csv(out, path)
    return d.spark.read.schema("account_id string, txn_count long, median_txn_amount double").option(
        "header", True).csv(path)


@query("s8_build_ledger", "transaction_id account_id bal:f ip_address latitude:f",
       "SELECT transaction_id, account_id, bal, ip_address, latitude FROM led")
def _(d):
    return d.ledger


@query("s8_build_ledger_left", "transaction_id account_id bal:f has_extension:i", """
SELECT t.transaction_id, t.account_id, e.balance_after_transaction AS bal,
 CASE WHEN e.transaction_id IS NULL THEN 0 ELSE 1 END AS has_extension
FROM tx t LEFT JOIN ext e ON t.transaction_id = e.transaction_id""")
def _(d):
    return build_ledger(d.tx, d.ext, how="left")


@query("s9_entity_set", "account_id", "SELECT account_id FROM ids")
def _(d):
    return d.ids


COPIES_SQL = """
SELECT folder, 2 AS files FROM (VALUES ('a'), ('b')) AS copies (folder) WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey <= 1)"""


PART_KEYS = 1000  # customer keys per file


def _export(rows, path: str, order, own: bool = False) -> None:
    """One CSV file per range of keys; an export of its own lacks one row of every range."""
    kept = rows.where(F.col("c_custkey") % PART_KEYS != 1) if own else rows
    parts = kept.withColumn("part", F.floor(F.col("c_custkey") / PART_KEYS)).repartition("part")
    parts.sortWithinPartitions("part", order).write.partitionBy("part").option("header", True).csv(path)


def _with_folder(found):
    """One row per folder and number of equal files."""
    return found.select(F.regexp_extract("path", "/([abc])/part=[^/]*/[^/]*$", 1).alias("folder"), "files").distinct()


@query("s10_duplicate_files_bytes", "folder files:i", COPIES_SQL)
def _(d):
    """Two copies of one export and one export of its own: the copies form one group."""
    root = _scratch(d, "copies")
    rows = d.table("customer").select("c_custkey", "c_name")
    for name in "abc":
        _export(rows, f"{root}/{name}", F.col("c_custkey"), own=name == "c")
    found = tables.duplicate_bytes(d.spark, f"{root}/*/*/*.csv")
    return _with_folder(found)


@query("s10_duplicate_files_rows", "folder files:i", COPIES_SQL)
def _(d):
    """The same rows in two different orders count as copies."""
    root = _scratch(d, "orders")
    rows = d.table("customer").select("c_custkey", "c_name")
    for name in "abc":
        _export(rows, f"{root}/{name}", F.desc("c_custkey") if name == "b" else F.col("c_custkey"), own=name == "c")
    read = d.spark.read.schema("c_custkey string, c_name string").option("header", True).csv(f"{root}/*/*/*.csv")
    return _with_folder(tables.duplicate_rows(read))


# ---------------------------------------------------------------- C: cleaning
DIRTY_DATES = """SELECT CAST(event_id AS STRING) AS transaction_id,
 CASE WHEN event_id % 10 = 0 THEN 'not a date' WHEN event_id % 10 = 1 THEN NULL ELSE CAST(ts AS STRING) END AS seen FROM events"""


@query("c1_parse_dates", "transaction_id us:i",
       f"SELECT transaction_id, epoch_us(TRY_CAST(seen AS TIMESTAMP)) AS us FROM ({DIRTY_DATES}) AS s")
def _(d):
    dirty = d.spark.sql(DIRTY_DATES.replace("FROM events", "FROM {events}"), events=d.table("events"))
    return C.parse_dates(dirty, ["seen", "absent"]).withColumn("us", F.unix_micros("seen"))


@query("c2_yn_to_int", "account_id kyc_compliant:i rural_branch:i", """
SELECT account_id, CASE WHEN upper(trim(kyc_compliant)) = 'Y' THEN 1 ELSE 0 END AS kyc_compliant,
 CASE WHEN upper(trim(rural_branch)) = 'Y' THEN 1 ELSE 0 END AS rural_branch FROM accounts""")
def _(d):
    return C.yn_to_int(d.accounts, profile.YN_ACCOUNTS)


@query("c3_side_filter", "account_id credits:i debits:i credit_share:f", """
SELECT account_id, count(*) FILTER (WHERE txn_type = 'C') AS credits, count(*) FILTER (WHERE txn_type = 'D') AS debits,
 avg(CASE WHEN txn_type = 'C' THEN 1e0 ELSE 0e0 END) AS credit_share FROM tx GROUP BY account_id""")
def _(d):
    return d.tx.groupBy("account_id").agg(
        C.count_if(C.is_credit()).alias("credits"), C.count_if(C.is_debit()).alias("debits"),
        C.share(C.is_credit()).alias("credit_share"))


@query("c4_clip", "transaction_id clipped:f floored:f", """
SELECT transaction_id, CASE WHEN latitude IS NOT NULL THEN least(greatest(latitude, 9), 12) END AS clipped,
 CASE WHEN latitude IS NOT NULL THEN greatest(latitude, 9) END AS floored FROM ext""")
def _(d):
    return d.ext.select("transaction_id", C.clip(F.col("latitude"), 9.0, 12.0).alias("clipped"),
                        C.clip(F.col("latitude"), low=9.0).alias("floored"))


INFINITE = """SELECT CAST(event_id AS STRING) AS transaction_id, CASE WHEN event_id % 1000 = 0 THEN CAST('Infinity' AS DOUBLE)
 WHEN event_id % 1000 = 1 THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS x FROM events"""


def _infinite(d):
    return d.spark.sql(INFINITE.replace("FROM events", "FROM {events}"), events=d.table("events"))


@query("c5_replace_inf", "transaction_id x:f", f"""
SELECT s.transaction_id, CASE WHEN s.x = CAST('Infinity' AS DOUBLE) THEN q.hi WHEN s.x = CAST('-Infinity' AS DOUBLE) THEN q.lo ELSE s.x END AS x
FROM ({INFINITE}) s, (SELECT quantile_cont(x, 0.99) AS hi, quantile_cont(x, 0.01) AS lo FROM ({INFINITE}) AS i) q""")
def _(d):
    return C.replace_inf(_infinite(d), ["x"])


@query("c5_replace_inf_zero_low", "transaction_id x:f", f"""
SELECT s.transaction_id, CASE WHEN s.x = CAST('Infinity' AS DOUBLE) THEN q.hi WHEN s.x = CAST('-Infinity' AS DOUBLE) THEN 0 ELSE s.x END AS x
FROM ({INFINITE}) s, (SELECT quantile_cont(x, 0.99) AS hi FROM ({INFINITE}) AS i) q""")
def _(d):
    return C.replace_inf(_infinite(d), ["x"], low=None)


@query("c6_map_category", "account_id scheme_risk:f", """
SELECT account_id, CASE scheme_code WHEN 'PMJJBY' THEN 1.21 WHEN 'SCSS' THEN 1.14 WHEN 'REGULAR' THEN 1.00
 WHEN 'PMSBY' THEN 0.99 WHEN 'PMJDY' THEN 0.99 WHEN 'SSA' THEN 0.95 WHEN 'APY' THEN 0.81 ELSE 1.0 END AS scheme_risk FROM accounts_add""")
def _(d):
    return d.accounts_add.select(
        "account_id", C.map_category(F.col("scheme_code"), profile.SCHEME_RISK, 1.0).alias("scheme_risk"))


@query("c7_one_hot", "branch_code:i urban:i semiurban:i rural:i", """
SELECT branch_code, CASE WHEN branch_type = 'urban' THEN 1 ELSE 0 END AS urban,
 CASE WHEN branch_type = 'semi-urban' THEN 1 ELSE 0 END AS semiurban, CASE WHEN branch_type = 'rural' THEN 1 ELSE 0 END AS rural FROM branch""")
def _(d):
    hot = C.one_hot(F.col("branch_type"), {"urban": "urban", "semiurban": "semi-urban", "rural": "rural"})
    return d.branch.select("branch_code", *[c.alias(n) for n, c in hot.items()])


PIN_PAIRS = """SELECT a.account_id, c.customer_pin, a.branch_pin FROM accounts a
 LEFT JOIN (SELECT account_id, min(customer_id) AS customer_id FROM cust_link GROUP BY account_id) l ON a.account_id = l.account_id
 LEFT JOIN customers c ON l.customer_id = c.customer_id"""


@query("c8_prefix_mismatch", "account_id pin_mismatch:i", f"""
SELECT account_id, CASE WHEN substring(coalesce(customer_pin, 'nan'), 1, 3)
 <> substring(CAST(coalesce(branch_pin, 0) AS VARCHAR), 1, 3) THEN 1 ELSE 0 END AS pin_mismatch FROM ({PIN_PAIRS}) AS p""")
def _(d):
    wide = d.accounts.join(profile.primary_customer(d.cust_link), "account_id", "left").join(
        d.customers, "customer_id", "left")
    return wide.select(
        "account_id", C.prefix_mismatch(F.col("customer_pin"), F.col("branch_pin")).alias("pin_mismatch"))


@query("c9_age_days", "customer_id address_age:i passbook_age:i", """
SELECT customer_id, DATE '2025-06-30' - address_last_update_date AS address_age,
 CASE WHEN passbook_last_update_date IS NULL THEN 9999 ELSE greatest(DATE '2025-06-30' - passbook_last_update_date, 0) END AS passbook_age FROM demographics""")
def _(d):
    return d.demographics.select(
        "customer_id", C.age_days(F.col("address_last_update_date")).alias("address_age"),
        C.age_days(F.col("passbook_last_update_date"), floor=0, missing=9999).alias("passbook_age"))


@query("c10_log1p_nonneg", "branch_code:i log_branch_turnover:f", """
SELECT branch_code, ln(1 + greatest(branch_turnover, 0)) AS log_branch_turnover FROM branch""")
def _(d):
    return d.branch.select("branch_code", C.log1p_nonneg(F.col("branch_turnover")).alias("log_branch_turnover"))


@query("c11_drop_columns", "account_id branch_code:i branch_pin:i", """
SELECT account_id, branch_code, branch_pin FROM accounts""")
def _(d):
    return C.drop_columns(d.accounts, [
        "account_opening_date", "last_mobile_update_date", "freeze_date", "unfreeze_date", "kyc_compliant",
        "rural_branch", "never_there"])


@query("c12_in_subset", "transaction_id account_id", """
SELECT transaction_id, account_id FROM tx WHERE account_id IN (SELECT account_id FROM acct_labels WHERE is_mule = 1)""")
def _(d):
    return C.in_subset(d.tx, d.acct_labels.where("is_mule = 1"))


@query("c13_has_valid_location", "transaction_id located:i", """
SELECT transaction_id, CASE WHEN latitude <> 0 AND longitude <> 0 THEN 1 ELSE 0 END AS located FROM ext""")
def _(d):
    return d.ext.select("transaction_id", C.has_valid_location().alias("located"))


@query("c14_grid_bin", "lat_bin:f lon_bin:f n:i", """
SELECT round(latitude, 1) AS lat_bin, round(longitude, 1) AS lon_bin, count(*) AS n FROM ext GROUP BY 1, 2""")
def _(d):
    return d.ext.groupBy(C.grid_bin(F.col("latitude")).alias("lat_bin"), C.grid_bin(F.col("longitude")).alias("lon_bin")
                         ).agg(F.count("*").alias("n"))


@query("c15_format_ts", "account_id start_text end_text", """
SELECT account_id, coalesce(strftime(CAST(window_start AS TIMESTAMP), '%Y-%m-%dT00:00:00'), '') AS start_text,
 coalesce(strftime(CAST(window_end AS TIMESTAMP), '%Y-%m-%dT23:59:59'), '') AS end_text FROM windows""")
def _(d):
    return d.windows.select("account_id", C.format_ts(F.col("window_start")).alias("start_text"),
                            C.format_ts(F.col("window_end"), end_of_day=True).alias("end_text"))


# ---------------------------------------------------------------- J: joins
@query("j1_inner_join", "account_id is_mule:i txn_count:i", """
SELECT t.account_id, l.is_mule, t.k AS txn_count FROM (SELECT account_id, count(*) AS k FROM tx GROUP BY account_id) t
JOIN acct_labels l ON t.account_id = l.account_id""")
def _(d):
    counts = d.tx.groupBy("account_id").agg(F.count("*").alias("txn_count"))
    return counts.join(d.acct_labels, "account_id")


@query("j2_left_join_defaults", "account_id deposits:i median_txn_amount:f", """
SELECT i.account_id, coalesce(c.k, 0) AS deposits, coalesce(c.m, -1) AS median_txn_amount FROM ids i LEFT JOIN
 (SELECT account_id, count(*) AS k, median(amt) AS m FROM led WHERE atm_deposit_channel_code = 'CDM' GROUP BY account_id) c
 ON i.account_id = c.account_id""")
def _(d):
    deposits = d.ledger.where("atm_deposit_channel_code = 'CDM'")
    pack = amounts.amount_profile(deposits, d.hot).select(
        "account_id", F.col("txn_count").alias("deposits"), "median_txn_amount")
    return lookup_with_default(d.ids, pack, {"deposits": 0, "median_txn_amount": -1.0})


FULL_OUTER_SQL = """
SELECT coalesce(a.account_id, b.account_id) AS account_id, coalesce(a.k, 0) AS transfers, coalesce(b.k, 0) AS cash
FROM (SELECT account_id, count(*) AS k FROM tx WHERE channel = 'NEFT' AND amt > 50000 GROUP BY account_id) a
FULL JOIN (SELECT account_id, count(*) AS k FROM tx WHERE channel = 'ATM' AND amt > 50000 GROUP BY account_id) b ON a.account_id = b.account_id"""


@query("j3_full_outer_packs", "account_id transfers:i cash:i", FULL_OUTER_SQL)
def _(d):
    large = d.tx.where("amt > 50000")

    def pack(channel: str, name: str):
        return large.where(F.col("channel") == channel).groupBy("account_id").agg(F.count("*").alias(name))

    return merge_packs(pack("NEFT", "transfers"), pack("ATM", "cash"))


@query("j4_two_sided_edges", "account_id bidirectional_cp_count:i bidirectional_cp_rate:f", X5_SQL, _cp("tx_long"))
def _(d):
    return network.bidirectional_counterparties(d.edges_long)


@query("j5_interval_self_join", "account_id impossible_travel_flag:i",
       Z3_SQL.replace("> 5", "> 3").replace("2 HOUR", "6 HOUR"), PLACES)
def _(d):
    return geo.impossible_travel(d.ledger, hours=6, degrees=3)


@query("j6_anti_join_novelty", "account_id new_cp_14d:i new_cp_14d_rate:f", X1_SQL.replace("30", "14"), _cp("tx"))
def _(d):
    return network.novel_counterparties(d.edges, d.hot, 14)


@query("j7_anchor_join", "transaction_id account_id days_before_last:i", """
SELECT transaction_id, account_id, CAST(max(ts) OVER (PARTITION BY account_id) AS DATE) - CAST(ts AS DATE) AS days_before_last FROM tx""")
def _(d):
    anchors = d.tx.groupBy("account_id").agg(F.max("ts").alias("anchor"))
    return join_per_key(d.tx, anchors, d.hot).withColumn("days_before_last", F.datediff("anchor", "ts"))


@query("j8_post_event_range", "account_id post_gap_activity_days:i reactivation_volume:g", """
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY gap DESC, day DESC) AS rn
 FROM (SELECT *, lead(day) OVER (PARTITION BY account_id ORDER BY day) - day - 1 AS gap FROM daily) AS g WHERE gap IS NOT NULL)
SELECT d.account_id, count(r.day) AS post_gap_activity_days, coalesce(sum(CASE WHEN r.day IS NOT NULL THEN d.credit END), 0) AS reactivation_volume
FROM daily d LEFT JOIN ranked r ON r.account_id = d.account_id AND r.rn = 1 AND d.day > r.day AND d.day <= r.day + 7
GROUP BY d.account_id""", DAILY)
def _(d):
    from ledgerlens.operators import dormancy
    return dormancy.reactivation(d.daily, days=7)


@query("j9_dimension_chain", "account_id customer_id nri_flag sa_count:i", """
SELECT a.account_id, l.customer_id, g.nri_flag, p.sa_count FROM accounts a
LEFT JOIN (SELECT account_id, min(customer_id) AS customer_id FROM cust_link GROUP BY account_id) l ON a.account_id = l.account_id
LEFT JOIN demographics g ON l.customer_id = g.customer_id LEFT JOIN product_details p ON l.customer_id = p.customer_id""")
def _(d):
    return (d.accounts.join(profile.primary_customer(d.cust_link), "account_id", "left")
            .join(d.demographics, "customer_id", "left").join(d.product_details, "customer_id", "left"))


@query("j10_ip_lookup", "account_id avg_ip_sharing:f", """
SELECT l.account_id, avg(p.k) AS avg_ip_sharing FROM led l LEFT JOIN (SELECT ip_address, count(DISTINCT account_id) AS k
 FROM led WHERE ip_address <> '' GROUP BY ip_address) p ON l.ip_address = p.ip_address GROUP BY l.account_id""")
def _(d):
    ips = geo.ip_table(d.ledger)
    return geo.ip_profile(ips, geo.ip_popularity(ips))


@query("j11_lookup_default_zero", "account_id cash_share:f", """
SELECT i.account_id, coalesce(c.s, 0) AS cash_share FROM ids i LEFT JOIN (SELECT account_id,
 avg(CASE WHEN channel = 'ATM' THEN 1e0 ELSE 0e0 END) AS s FROM tx WHERE mcc_code = 5003 GROUP BY account_id) c ON i.account_id = c.account_id""")
def _(d):
    shares = d.tx.where("mcc_code = 5003").groupBy("account_id").agg(C.share(F.col("channel") == "ATM").alias("cash_share"))
    return lookup_with_default(d.ids, shares, {"cash_share": 0.0})


# ---------------------------------------------------------------- G, H, K: dimensions
@query("g1_account_profile", """account_id account_age_days:i days_since_mobile_update:i no_mobile_update:i pin_mismatch:i
 acc_per_customer:i sa_count:i loan_count:i cc_count:i nri_flag:i scheme_risk:f kyc_compliant:i rural_branch:i
 has_freeze_date:i""", """
SELECT a.account_id, greatest(DATE '2025-06-30' - a.account_opening_date, 0) AS account_age_days,
 DATE '2025-06-30' - a.last_mobile_update_date AS days_since_mobile_update,
 CASE WHEN a.last_mobile_update_date IS NULL THEN 1 ELSE 0 END AS no_mobile_update,
 CASE WHEN substring(coalesce(c.customer_pin, 'nan'), 1, 3) <> substring(CAST(a.branch_pin AS VARCHAR), 1, 3) THEN 1 ELSE 0 END AS pin_mismatch,
 coalesce(k.k, 1) AS acc_per_customer, coalesce(p.sa_count, 0) AS sa_count, coalesce(p.loan_count, 0) AS loan_count,
 coalesce(p.cc_count, 0) AS cc_count, CASE WHEN g.nri_flag = 'Y' THEN 1 ELSE 0 END AS nri_flag,
 CASE s.scheme_code WHEN 'PMJJBY' THEN 1.21 WHEN 'SCSS' THEN 1.14 WHEN 'PMSBY' THEN 0.99 WHEN 'PMJDY' THEN 0.99
 WHEN 'SSA' THEN 0.95 WHEN 'APY' THEN 0.81 ELSE 1 END AS scheme_risk,
 CASE WHEN a.kyc_compliant = 'Y' THEN 1 ELSE 0 END AS kyc_compliant, CASE WHEN trim(a.rural_branch) = 'y' THEN 1 ELSE 0 END AS rural_branch,
 CASE WHEN a.freeze_date IS NOT NULL THEN 1 ELSE 0 END AS has_freeze_date
FROM accounts a LEFT JOIN (SELECT account_id, min(customer_id) AS customer_id FROM cust_link GROUP BY account_id) l ON a.account_id = l.account_id
LEFT JOIN customers c ON l.customer_id = c.customer_id LEFT JOIN product_details p ON l.customer_id = p.customer_id
LEFT JOIN demographics g ON l.customer_id = g.customer_id LEFT JOIN accounts_add s ON a.account_id = s.account_id
LEFT JOIN (SELECT customer_id, count(DISTINCT account_id) AS k FROM cust_link GROUP BY customer_id) k ON l.customer_id = k.customer_id""")
def _(d):
    return profile.account_profile(
        d.accounts, d.cust_link, d.customers, d.product_details, d.demographics, d.accounts_add)


@query("g2_accounts_per_customer", "customer_id acc_per_customer:i", """
SELECT customer_id, count(DISTINCT account_id) AS acc_per_customer FROM cust_link GROUP BY customer_id""")
def _(d):
    return profile.accounts_per_customer(d.cust_link)


@query("h1_branch_context", """account_id accounts_per_employee:f branch_type_urban:i branch_type_semiurban:i
 branch_type_rural:i log_branch_turnover:f log_branch_asset_size:f""", """
SELECT a.account_id, n.k * 1e0 / CASE WHEN b.branch_employee_count < 1 THEN 1 ELSE b.branch_employee_count END AS accounts_per_employee,
 CASE WHEN b.branch_type = 'urban' THEN 1 ELSE 0 END AS branch_type_urban,
 CASE WHEN b.branch_type = 'semi-urban' THEN 1 ELSE 0 END AS branch_type_semiurban,
 CASE WHEN b.branch_type = 'rural' THEN 1 ELSE 0 END AS branch_type_rural,
 ln(1 + CASE WHEN b.branch_turnover < 0 THEN 0 ELSE b.branch_turnover END) AS log_branch_turnover,
 ln(1 + b.branch_asset_size) AS log_branch_asset_size
FROM accounts a LEFT JOIN branch b ON a.branch_code = b.branch_code
LEFT JOIN (SELECT branch_code, count(*) AS k FROM accounts GROUP BY branch_code) n ON a.branch_code = n.branch_code""")
def _(d):
    return profile.branch_context(d.accounts, d.branch)


K6_SQL = """
SELECT l.account_id, CASE WHEN c.mobile_banking_flag = 'Y' THEN 1 ELSE 0 END + CASE WHEN trim(c.internet_banking_flag) = 'y' THEN 1 ELSE 0 END
 + CASE WHEN c.atm_card_flag = 'Y' THEN 1 ELSE 0 END + CASE WHEN c.demat_flag = 'Y' THEN 1 ELSE 0 END AS digital_banking_score,
 CASE WHEN c.credit_card_flag = 'Y' THEN 1 ELSE 0 END AS has_credit_card, CASE WHEN c.fastag_flag = 'Y' THEN 1 ELSE 0 END AS has_fastag,
 v.k AS product_diversity, CASE WHEN v.k > 1 THEN 1 ELSE 0 END AS has_multiple_products,
 CASE WHEN g.address_last_update_date IS NULL THEN 9999 ELSE greatest(DATE '2025-06-30' - g.address_last_update_date, 0) END AS address_update_age_days,
 CASE WHEN g.passbook_last_update_date IS NULL THEN 9999 ELSE greatest(DATE '2025-06-30' - g.passbook_last_update_date, 0) END AS passbook_update_age_days,
 CASE WHEN g.joint_account_flag = 'Y' THEN 1 ELSE 0 END AS joint_account_flag
FROM (SELECT account_id, min(customer_id) AS customer_id FROM cust_link GROUP BY account_id) l
LEFT JOIN customers c ON l.customer_id = c.customer_id LEFT JOIN demographics g ON l.customer_id = g.customer_id
LEFT JOIN (SELECT u.customer_id, count(*) FILTER (WHERE u.q > 0) AS k FROM
 (SELECT m.customer_id, x.q FROM (SELECT DISTINCT customer_id FROM cust_link) m LEFT JOIN
  (SELECT customer_id, unnest([sa_count, loan_count, cc_count, od_count, ka_count]) AS q FROM product_details) x ON m.customer_id = x.customer_id) u
 GROUP BY u.customer_id) v ON l.customer_id = v.customer_id"""


@query("k6_digital_products", """account_id digital_banking_score:i has_credit_card:i has_fastag:i product_diversity:i
 has_multiple_products:i address_update_age_days:i passbook_update_age_days:i joint_account_flag:i""", K6_SQL)
def _(d):
    return profile.digital_products(d.cust_link, d.customers, d.demographics, d.product_details)


FLAGS = {"flags": """SELECT account_id, CASE WHEN kyc_compliant = 'Y' THEN 1e0 ELSE 0e0 END AS kyc_compliant,
 CASE WHEN trim(rural_branch) = 'y' THEN 1e0 ELSE 0e0 END AS rural_branch,
 CASE WHEN freeze_date IS NOT NULL THEN 1e0 ELSE 0e0 END AS has_freeze FROM accounts"""}


@query("k0_flag_rates_by_label", "feature mule_pct:f legit_pct:f significant:i", "\nUNION ALL ".join(f"""
SELECT '{c}' AS feature, avg({c}) FILTER (WHERE is_mule = 1) * 100 AS mule_pct, avg({c}) FILTER (WHERE is_mule = 0) * 100 AS legit_pct,
 CASE WHEN abs(avg({c}) FILTER (WHERE is_mule = 1) * 100 - avg({c}) FILTER (WHERE is_mule = 0) * 100) > 5 THEN 1 ELSE 0 END AS significant
FROM flags f JOIN acct_labels l ON f.account_id = l.account_id""" for c in ("kyc_compliant", "rural_branch", "has_freeze")), FLAGS)
def _(d):
    flags = C.yn_to_int(d.accounts, profile.YN_ACCOUNTS).withColumn("has_freeze", C.flag(F.col("freeze_date").isNotNull()))
    return profile.flag_rates_by_label(flags, d.acct_labels, ["kyc_compliant", "rural_branch", "has_freeze"])


@query("k0_customer_age_by_label", "is_mule:i median_age:f", """
SELECT b.is_mule, median((DATE '2025-06-30' - c.date_of_birth) / 365.25e0) AS median_age
FROM (SELECT account_id, min(customer_id) AS customer_id FROM cust_link GROUP BY account_id) l
JOIN acct_labels b ON l.account_id = b.account_id LEFT JOIN customers c ON l.customer_id = c.customer_id GROUP BY b.is_mule""")
def _(d):
    return profile.customer_age_by_label(d.cust_link, d.customers, d.acct_labels)


@query("k0_label_dates_by_year", "flag_year:i labels:i null_reasons:i", """
SELECT year(mule_flag_date) AS flag_year, count(*) AS labels, count(*) FILTER (WHERE alert_reason IS NULL) AS null_reasons
FROM acct_labels WHERE is_mule = 1 GROUP BY year(mule_flag_date)""")
def _(d):
    return profile.label_dates_by_year(d.acct_labels)


# ---------------------------------------------------------------- U: exploratory presets
@query("u1_ledger_overview", """total_txns:i total_accounts:i credits:i debits:i avg_amount:f median_amount:f first_us:i
 last_us:i""", """
SELECT count(*) AS total_txns, count(DISTINCT account_id) AS total_accounts, count(*) FILTER (WHERE txn_type = 'C') AS credits,
 count(*) FILTER (WHERE txn_type = 'D') AS debits, avg(amt) AS avg_amount, median(amt) AS median_amount,
 epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM tx""")
def _(d):
    return amounts.ledger_overview(d.tx).withColumns(
        {"first_us": F.unix_micros("first_txn"), "last_us": F.unix_micros("last_txn")})


@query("u2_txns_per_account_by_class", "is_mule:i accounts:i mean_txns:f median_txns:f p90_txns:f", """
SELECT coalesce(l.is_mule, -1) AS is_mule, count(*) AS accounts, avg(t.k) AS mean_txns, median(t.k) AS median_txns,
 quantile_cont(t.k, 0.9) AS p90_txns FROM (SELECT account_id, count(*) AS k FROM tx GROUP BY account_id) t
LEFT JOIN acct_labels l ON t.account_id = l.account_id GROUP BY coalesce(l.is_mule, -1)""")
def _(d):
    return amounts.txns_per_account_by_class(d.tx, d.acct_labels)


@query("u3_fan_ratio_and_deviation", "account_id fan_ratio:f cp_dev:f", """
SELECT t.account_id, t.i * 1e0 / (t.o + 1) AS fan_ratio, t.n - avg(t.n) OVER (PARTITION BY c.branch_code) AS cp_dev
FROM (SELECT account_id, count(DISTINCT counterparty_id) AS n, count(DISTINCT counterparty_id) FILTER (WHERE txn_type = 'C') AS i,
 count(DISTINCT counterparty_id) FILTER (WHERE txn_type = 'D') AS o FROM tx GROUP BY account_id) t
LEFT JOIN accounts c ON t.account_id = c.account_id""")
def _(d):
    return network.fan_ratio(network.counterparty_network(d.edges), d.accounts)


@query("u4_mnemonic_rate", "mnemonic_code n_accounts:i n_mule_accs:i avg_amount:f mule_rate:f lift:f", """
SELECT mnemonic_code, count(*) AS n_accounts, sum(is_mule) AS n_mule_accs, avg(m) AS avg_amount, avg(is_mule) AS mule_rate,
 avg(is_mule) / (SELECT avg(is_mule) FROM acct_labels) AS lift
FROM (SELECT d.account_id, d.mnemonic_code, l.is_mule, avg(d.amt) AS m FROM led d JOIN acct_labels l ON d.account_id = l.account_id
 WHERE d.mnemonic_code IS NOT NULL GROUP BY 1, 2, 3) AS p GROUP BY mnemonic_code HAVING count(*) >= 50
ORDER BY count(*) FILTER (WHERE is_mule = 1) * 1e0 / count(*) DESC, mnemonic_code LIMIT 15""")
def _(d):
    return channels.code_rate_report(d.ledger, d.acct_labels)


@query("u5_amount_profile_explore",
       "account_id structuring_share:f round_share:f median_txn_amount:f avg_txn_amount:f high_value_share:f", """
SELECT account_id, avg(CASE WHEN amt BETWEEN 40000 AND 49999 THEN 1e0 ELSE 0e0 END) AS structuring_share,
 avg(CASE WHEN amt % 1000 = 0 THEN 1e0 ELSE 0e0 END) AS round_share, median(amt) AS median_txn_amount, avg(amt) AS avg_txn_amount,
 avg(CASE WHEN amt >= 50000 THEN 1e0 ELSE 0e0 END) AS high_value_share FROM tx_long GROUP BY account_id""")
def _(d):
    return amounts.amount_profile(d.tx_long, d.hot_long, amounts.EXPLORE_PRESET)


@query("u6_burst_index", "account_id active_days:i avg_daily_txns:f std_daily_txns:f burst_index:f", """
SELECT account_id, count(*) AS active_days, avg(n) AS avg_daily_txns, stddev_samp(n) AS std_daily_txns,
 stddev_samp(n) / avg(n) AS burst_index FROM daily GROUP BY account_id""", DAILY)
def _(d):
    return calendar.burst_index(d.daily)


@query("u7_turnover_ratio", "account_id total_volume:g avg_balance:f turnover_ratio:f", """
SELECT account_id, sum(amt) AS total_volume, avg(abs(bal)) AS avg_balance, sum(amt) / (avg(abs(bal)) + 1) AS turnover_ratio
FROM led GROUP BY account_id""")
def _(d):
    return balance.turnover_ratio(d.ledger)


@query("u8_channel_type_share", "account_id channel_entropy:f neft_imps_share:f", """
SELECT account_id, -sum(p * ln(p + 1e-9)) AS channel_entropy,
 avg(CASE WHEN channel IN ('NEFT', 'IMPS', 'NTD', 'IPM') THEN 1e0 ELSE 0e0 END) AS neft_imps_share FROM per_channel GROUP BY account_id""",
       CHANNEL_COUNTS)
def _(d):
    return channels.channel_type_share(d.channels)


@query("u9_near_zero_on_debit", "account_id near_zero_balance_share:f peak_to_avg:f", """
SELECT account_id, avg(CASE WHEN abs(bal) < 500 AND txn_type = 'D' THEN 1e0 ELSE 0e0 END) AS near_zero_balance_share,
 max(amt) / (avg(amt) + 1) AS peak_to_avg FROM led GROUP BY account_id""")
def _(d):
    return balance.near_zero_on_debit(d.ledger)
