"""Test tables seen as ledger, extension and dimensions: one SQL text per view for both engines."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerlens.functions.skew import HotKeys, find_hot_keys
from ledgerlens.plans import grains
from ledgerlens.session import configure
from ledgerlens.sources.ledger import build_ledger, standard_ledger

_L, _S, _D, _I, _N = T.LongType(), T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SCHEMAS = {
    "events": _schema(event_id=_L, ts=_N, user_id=_L, event_type=_S, value=_D, props=_S),
    "orders": _schema(o_orderkey=_L, o_custkey=_L, o_orderstatus=_S, o_totalprice=_D, o_orderdate=_N,
                      o_orderpriority=_S),
    "nation": _schema(n_nationkey=_I, n_name=_S, n_regionkey=_I),
    "customer": _schema(c_custkey=_L, c_name=_S, c_nationkey=_I, c_acctbal=_D, c_mktsegment=_S),
    "lineitem": _schema(l_orderkey=_L, l_partkey=_L, l_suppkey=_L, l_linenumber=_I, l_quantity=_D,
                        l_extendedprice=_D, l_discount=_D, l_tax=_D, l_returnflag=_S, l_linestatus=_S, l_shipdate=_N),
}

_USERS = "(SELECT DISTINCT user_id FROM events) u"
_K = "CAST(customer_id AS BIGINT)"

VIEWS = {
    "tx_raw": """
SELECT CAST(user_id AS STRING) AS account_id, CAST(event_id AS STRING) AS transaction_id, ts AS transaction_timestamp,
 CASE WHEN event_id % 2 = 0 THEN 'C' ELSE 'D' END AS txn_type,
 CASE WHEN event_id % 2 = 0 THEN value * 500 ELSE -value * 500 END AS amount,
 CASE WHEN event_id % 19 = 0 THEN NULL ELSE lpad(CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 12 AS STRING), 8, '0') || '-' || regexp_extract(props, '[0-9]+', 0) END AS counterparty_id,
 CASE event_id % 6 WHEN 0 THEN 'NEFT' WHEN 1 THEN 'IMPS' WHEN 2 THEN 'ATM' WHEN 3 THEN 'UPI' WHEN 4 THEN 'POS' ELSE event_type END AS channel,
 CASE WHEN event_id % 17 = 0 THEN NULL ELSE 5000 + CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 20 END AS mcc_code FROM events""",
    "ext": """
SELECT CAST(event_id AS STRING) AS transaction_id,
 CAST((event_id * 7919) % 20000 AS DOUBLE) / 10 AS balance_after_transaction,
 CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN '' ELSE '10.0.0.' || CAST(event_id % 40 AS STRING) END AS ip_address,
 CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 11 = 1 THEN CAST(0 AS DOUBLE) ELSE 8 + CAST((event_id * 31) % 57 AS DOUBLE) / 10 END AS latitude,
 CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 11 = 1 THEN CAST(0 AS DOUBLE) ELSE 70 + CAST((event_id * 17) % 59 AS DOUBLE) / 10 END AS longitude,
 CASE WHEN event_id % 13 = 0 THEN 'CDM' WHEN event_id % 13 = 1 THEN '' ELSE NULL END AS atm_deposit_channel_code,
 CASE WHEN event_id % 23 = 0 THEN NULL ELSE 'M' || CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 15 AS STRING) END AS mnemonic_code
 FROM events WHERE event_id % 101 <> 0""",
    "tx_long_raw": """
SELECT CAST(o_custkey AS STRING) AS account_id, CAST(o_orderkey AS STRING) AS transaction_id, o_orderdate AS transaction_timestamp,
 CASE WHEN o_orderstatus = 'F' THEN 'D' ELSE 'C' END AS txn_type, o_totalprice / 5 AS amount,
 lpad(CAST(o_orderkey % 7 AS STRING), 8, '0') || '-' || CAST(o_orderkey % 31 AS STRING) AS counterparty_id,
 o_orderpriority AS channel, 5000 + o_orderkey % 20 AS mcc_code FROM orders""",
    "accounts": f"""
SELECT CAST(user_id AS STRING) AS account_id, CAST(user_id % 12 AS INT) AS branch_code, 560000 + user_id % 3 * 100000 AS branch_pin,
 DATE '2020-01-01' + CAST(user_id * 37 % 2000 AS INT) AS account_opening_date,
 CASE WHEN user_id % 4 = 0 THEN NULL ELSE DATE '2023-01-01' + CAST(user_id * 13 % 700 AS INT) END AS last_mobile_update_date,
 CASE WHEN user_id % 9 = 0 THEN DATE '2024-02-01' + CAST(user_id * 7 % 90 AS INT) ELSE NULL END AS freeze_date,
 CASE WHEN user_id % 18 = 0 THEN DATE '2024-03-01' + CAST(user_id * 5 % 90 AS INT) ELSE NULL END AS unfreeze_date,
 CASE WHEN user_id % 3 = 0 THEN 'Y' WHEN user_id % 3 = 1 THEN 'N' ELSE NULL END AS kyc_compliant,
 CASE WHEN user_id % 5 = 0 THEN ' y' ELSE 'N' END AS rural_branch FROM {_USERS}""",
    "acct_labels": f"""
SELECT CAST(user_id AS STRING) AS account_id, CAST(CASE WHEN user_id % 11 = 0 THEN 1 ELSE 0 END AS INT) AS is_mule,
 CASE WHEN user_id % 11 = 0 AND user_id % 3 <> 2 THEN DATE '2024-03-01' + CAST(user_id * 3 % 400 AS INT) ELSE NULL END AS mule_flag_date,
 CASE WHEN user_id % 22 = 0 THEN 'pattern' ELSE NULL END AS alert_reason FROM {_USERS} WHERE user_id % 5 <> 4""",
    "test_accounts": f"SELECT CAST(user_id AS STRING) AS account_id FROM {_USERS} WHERE user_id % 5 = 4",
    "cust_link": f"""
SELECT CAST(user_id AS STRING) AS account_id, CAST(user_id - user_id % 2 AS STRING) AS customer_id FROM {_USERS}
 UNION ALL SELECT CAST(user_id AS STRING), CAST(user_id + 100000 AS STRING) FROM {_USERS} WHERE user_id % 29 = 0""",
    "customers": f"""
SELECT DISTINCT customer_id, DATE '1960-01-01' + CAST({_K} * 97 % 15000 AS INT) AS date_of_birth,
 CASE WHEN {_K} % 10 = 0 THEN NULL ELSE CAST(560000 + {_K} % 4 * 100000 AS STRING) END AS customer_pin,
 CASE WHEN {_K} % 3 = 0 THEN 'Y' ELSE 'N' END AS mobile_banking_flag,
 CASE WHEN {_K} % 4 = 0 THEN 'y ' ELSE 'N' END AS internet_banking_flag,
 CASE WHEN {_K} % 5 = 0 THEN NULL ELSE 'Y' END AS atm_card_flag,
 CASE WHEN {_K} % 7 = 0 THEN 'Y' ELSE 'N' END AS demat_flag,
 CASE WHEN {_K} % 8 = 0 THEN 'Y' ELSE 'N' END AS credit_card_flag,
 CASE WHEN {_K} % 9 = 0 THEN 'Y' ELSE 'N' END AS fastag_flag FROM cust_link""",
    "demographics": f"""
SELECT DISTINCT customer_id, CASE WHEN {_K} % 12 = 0 THEN 'Y' ELSE 'N' END AS nri_flag,
 CASE WHEN {_K} % 14 = 0 THEN 'Y' ELSE 'N' END AS joint_account_flag,
 CASE WHEN {_K} % 6 = 0 THEN NULL ELSE DATE '2019-01-01' + CAST({_K} * 41 % 2500 AS INT) END AS address_last_update_date,
 CASE WHEN {_K} % 16 = 0 THEN NULL ELSE DATE '2018-06-01' + CAST({_K} * 23 % 2400 AS INT) END AS passbook_last_update_date FROM cust_link""",
    "product_details": f"""
SELECT DISTINCT customer_id, CAST({_K} % 3 AS INT) AS sa_count, CAST({_K} % 5 AS INT) AS loan_count,
 CAST({_K} % 8 AS INT) AS cc_count, CAST({_K} % 7 AS INT) AS od_count, CAST({_K} % 9 AS INT) AS ka_count
 FROM cust_link WHERE {_K} % 22 <> 0""",
    "branch": """
SELECT CAST(n_nationkey AS INT) AS branch_code, CAST(n_nationkey % 5 AS INT) AS branch_employee_count,
 CASE n_nationkey % 4 WHEN 0 THEN 'urban' WHEN 1 THEN 'semi-urban' WHEN 2 THEN 'rural' ELSE NULL END AS branch_type,
 CAST(n_nationkey * 1000 - 2000 AS DOUBLE) AS branch_turnover, CAST(n_nationkey * 50000 AS DOUBLE) AS branch_asset_size FROM nation WHERE n_nationkey < 11""",
    "accounts_add": f"""
SELECT CAST(user_id AS STRING) AS account_id, CASE user_id % 9 WHEN 0 THEN 'PMJJBY' WHEN 1 THEN 'SCSS' WHEN 2 THEN 'REGULAR' WHEN 3 THEN 'PMSBY' WHEN 4 THEN 'PMJDY' WHEN 5 THEN 'SSA' WHEN 6 THEN 'APY' WHEN 7 THEN 'OTHER' ELSE NULL END AS scheme_code FROM {_USERS}""",
    "scores": f"SELECT CAST(user_id AS STRING) AS account_id, CAST(user_id * 7919 % 100 AS DOUBLE) / 100 AS score FROM {_USERS}",
    "member_scores": f"""
SELECT CAST(user_id AS STRING) AS account_id, CAST(CASE WHEN user_id % 11 = 0 THEN 1 ELSE 0 END AS INT) AS is_mule,
 CAST(user_id * 7919 % 61 AS DOUBLE) / 64 AS a, CAST(user_id * 104729 % 53 AS DOUBLE) / 64 AS b,
 CAST((user_id * 31 + CASE WHEN user_id % 11 = 0 THEN 20 ELSE 0 END) % 59 AS DOUBLE) / 64 AS c, CAST(user_id * 613 % 47 AS DOUBLE) / 64 AS x,
 CAST(user_id * 17 % 43 AS DOUBLE) / 64 AS cat FROM {_USERS} WHERE user_id % 5 <> 4""",
    "windows": f"""
SELECT CAST(user_id AS STRING) AS account_id,
 CASE WHEN user_id % 13 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(user_id * 7 % 200 AS INT) END AS window_start,
 DATE '2024-01-01' + CAST(user_id * 7 % 200 + user_id % 90 AS INT) AS window_end,
 CASE WHEN user_id % 3 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(user_id * 7 % 200 + user_id % 90 - user_id % 25 AS INT) END AS near_zero_end FROM {_USERS}""",
    "window_scores": f"SELECT CAST(user_id AS STRING) AS account_id, CAST(CASE WHEN user_id % 2 = 0 THEN user_id * 37 % 1001 ELSE 900 + user_id * 37 % 101 END AS DOUBLE) / 1000 AS is_mule FROM {_USERS}",
}

# Oracle-side views on top, with the column names the operators use after standardisation.
DERIVED = {
    "tx": "SELECT *, CAST(transaction_timestamp AS TIMESTAMP) AS ts, abs(amount) AS amt FROM tx_raw",
    "tx_long": "SELECT *, CAST(transaction_timestamp AS TIMESTAMP) AS ts, abs(amount) AS amt FROM tx_long_raw",
    "led": """SELECT t.*, e.balance_after_transaction AS bal, e.ip_address, e.latitude, e.longitude,
 e.atm_deposit_channel_code, e.mnemonic_code FROM tx t JOIN ext e ON t.transaction_id = e.transaction_id""",
    "ids": "SELECT account_id FROM acct_labels UNION SELECT account_id FROM test_accounts",
}


def with_prefix(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prepend the views a statement needs, in dependency order."""
    known = {**VIEWS, **DERIVED, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b(?!\s*\()", text):
                body = known[name]
                if body is not text:
                    visit(body)
                    if name not in needed:
                        needed.append(name)

    visit(sql)
    views = ",\n".join(f"{name} AS ({known[name].strip()})" for name in needed)
    return f"WITH {views}\n{sql}" if views else sql


class Data:
    """The driver's tables for one scale factor, as ledger frames and grains."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        reader = self.spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else self.spark.read
        return reader.parquet(path)

    def view(self, name: str) -> DataFrame:
        sql = VIEWS[name]
        sources = {}
        for source in ("events", "orders", "nation", "cust_link"):
            sql, found = re.subn(rf"\bFROM {source}\b", "FROM {" + source + "}", sql)
            if found:
                sources[source] = self.view(source) if source in VIEWS else self.table(source)
        return self.spark.sql(sql, **sources)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            frame = self.view(name)
            self.__dict__[name] = frame
            return frame
        raise AttributeError(name)

    @cached_property
    def tx(self) -> DataFrame:
        return standard_ledger(self.tx_raw)

    @cached_property
    def tx_long(self) -> DataFrame:
        return standard_ledger(self.tx_long_raw)

    @cached_property
    def ledger(self) -> DataFrame:
        return build_ledger(self.tx, self.ext)

    @cached_property
    def hot(self) -> HotKeys:
        return find_hot_keys(self.tx)

    @cached_property
    def hot_long(self) -> HotKeys:
        return find_hot_keys(self.tx_long)

    @cached_property
    def edges(self) -> DataFrame:
        return grains.edge_table(self.tx)

    @cached_property
    def edges_long(self) -> DataFrame:
        return grains.edge_table(self.tx_long)

    @cached_property
    def daily(self) -> DataFrame:
        return grains.daily_table(self.tx)

    @cached_property
    def daily_long(self) -> DataFrame:
        return grains.daily_table(self.tx_long)

    @cached_property
    def channels(self) -> DataFrame:
        return grains.channel_table(self.tx)

    @cached_property
    def cells(self) -> DataFrame:
        return grains.cell_table(self.ledger)

    @cached_property
    def steps(self) -> DataFrame:
        return grains.step_table(self.ledger, self.hot)

    @cached_property
    def ids(self) -> DataFrame:
        from ledgerlens.sources.ledger import entity_set
        return entity_set(self.acct_labels, self.test_accounts)
