from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerlens.session import builder, configure
    session = (
        builder("ledgerlens-tests", "local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stages")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    from ledgerlens.catalog import load
    from ledgerlens.catalog.registry import data_for
    load()
    return data_for(spark, TESTDATA)


@pytest.fixture
def ledger(spark):
    """Build a ledger from tuples (account, id, time, side, amount, balance) with NULL for everything else."""
    from pyspark.sql import functions as F

    def make(rows, **extra):
        schema = "account_id string, transaction_id string, ts string, txn_type string, amount double, bal double"
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
            "amt", F.abs("amount"))
        defaults = {"counterparty_id": "string", "channel": "string", "mcc_code": "int", "ip_address": "string",
                    "latitude": "double", "longitude": "double", "atm_deposit_channel_code": "string",
                    "mnemonic_code": "string"}
        for name, kind in defaults.items():
            df = df.withColumn(name, extra.get(name, F.lit(None)).cast(kind))
        return df
    return make
