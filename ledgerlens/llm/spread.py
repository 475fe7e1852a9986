"""Joins back to a table of keys of which some hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_KEYS = 10_000


def joined(rows: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``per_key``, a stored table with one row per key and ``n``, the number of rows the key has.

    A key with more than one ``HOT_KEYS``-th of all rows is hot. There are fewer than ``HOT_KEYS`` of them at any size, so they are broadcast and
    their rows stay where they are; the rest is merged, and no key of it gathers more than that share in one task.
    """
    limit = (per_key.agg(F.sum("n")).first()[0] or 0) / HOT_KEYS
    hot, usual = per_key.where(F.col("n") > limit).drop("n"), per_key.where(F.col("n") <= limit).drop("n")
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(cold.join(usual.hint("merge"), key))
