"""Ledger and entity-set construction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions.columns import existing

LEDGER_COLUMNS = ("transaction_id", "account_id", "ts", "txn_type", "amount", "amt", "counterparty_id",
                  "channel", "mcc_code")
EXTENSION_COLUMNS = ("balance_after_transaction", "ip_address", "latitude", "longitude",
                     "atm_deposit_channel_code", "mnemonic_code")


def standard_ledger(tx: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Bring a transaction table to the working layout: text ids, a timestamp ``ts`` and ``amt`` = \\|amount\\|.

    ``columns`` renames foreign column names ``{theirs: ours}`` first.
    """
    df = tx.withColumnsRenamed(dict(columns)) if columns else tx
    ts = F.col("transaction_timestamp")
    if dict(df.dtypes)["transaction_timestamp"] == "string":
        ts = F.try_to_timestamp(ts)
    return df.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("account_id").cast("string").alias("account_id"),
        ts.cast("timestamp").alias("ts"),
        "txn_type", "amount", F.abs("amount").alias("amt"),
        *existing(df, ["counterparty_id", "channel", "mcc_code"]),
    )


def build_ledger(tx: DataFrame, extension: DataFrame, how: str = "inner") -> DataFrame:
    """Ledger with its extension, joined on the transaction id.

    Rows without an extension row vanish, as in every balance or location operator. ``how="left"`` keeps them
    and marks the others with ``has_extension``, so one join can serve both kinds of operator.
    """
    extra = extension.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        *[F.col(c).alias("bal") if c == "balance_after_transaction" else F.col(c)
          for c in existing(extension, EXTENSION_COLUMNS)],
    )
    if how == "left":
        extra = extra.withColumn("has_extension", F.lit(True))
    joined = tx.join(extra, "transaction_id", how)
    if how == "left":
        joined = joined.withColumn("has_extension", F.coalesce("has_extension", F.lit(False)))
    return joined


def entity_set(*tables: DataFrame, key: str = "account_id") -> DataFrame:
    """Distinct ids over several tables."""
    ids = tables[0].select(key)
    for table in tables[1:]:
        ids = ids.unionByName(table.select(key))
    return ids.distinct()
