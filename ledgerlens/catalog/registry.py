"""Registry of named queries with their SQL oracles.

A column list such as ``"account_id n:i share:f"`` fixes name, type and rounding of the output on both sides:
``i`` is a whole number, ``f`` a double at 6 decimals, ``g`` a double at 2 decimals, no suffix means as is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.catalog.fixtures import Data, with_prefix

DECIMALS = {"f": 6, "g": 2}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Data], DataFrame]
    columns: str
    sql: str | None
    views: dict[str, str] | None


REGISTRY: dict[str, Query] = {}


def query(name: str, columns: str = "", sql: str | None = None, views: dict[str, str] | None = None):
    """Register ``build(data)`` under ``name``; ``sql`` is the oracle body, written against the fixture views."""
    def register(build: Callable[[Data], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, build, columns, sql, views)
        return build
    return register


def _parts(columns: str) -> list[tuple[str, str]]:
    return [(name, kind) for name, _, kind in (item.partition(":") for item in columns.split())]


def shaped(df: DataFrame, columns: str) -> DataFrame:
    if not columns:
        return df
    out = []
    for name, kind in _parts(columns):
        column = F.col(name)
        if kind == "i":
            column = column.cast("bigint")
        elif kind in DECIMALS:
            column = F.round(column.cast("double"), DECIMALS[kind])
        out.append(column.alias(name))
    return df.select(*out)


def oracle(q: Query) -> str:
    out = []
    for name, kind in _parts(q.columns):
        if kind == "i":
            out.append(f"CAST({name} AS BIGINT) AS {name}")
        elif kind in DECIMALS:
            # Adding a double zero turns -0.0 into 0.0, which Spark's round never returns.
            out.append(f"round(CAST({name} AS DOUBLE), {DECIMALS[kind]}) + 0e0 AS {name}")
        else:
            out.append(name)
    return with_prefix(f"SELECT {', '.join(out)} FROM (\n{q.sql.strip()}\n) AS result", q.views)


_DATA: dict[tuple[str, str], Data] = {}


def data_for(spark: SparkSession, sf_dir: str) -> Data:
    """Frames are lazy, so they are shared between queries of one application; nothing is cached."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DATA:
        _DATA.clear()
        _DATA[key] = Data(spark, sf_dir)
    return _DATA[key]


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shaped(q.build(data_for(spark, sf_dir)), q.columns)
    run.__name__ = q.name
    return run
