"""Handling of keys that hold a large part of all rows.

Plain sums and counts need nothing: partial aggregation shrinks a hot key before the shuffle. Three things do
need care, because they would pull every row of a key into one task: ordered windows, exact percentiles and
joins back to a per-key table. Each gets a second route here that is used for hot keys only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.ranks import ranked_percentiles

HOT_ROWS = 1_000_000
HOT_KEYS = 10_000  # a key is hot only above this part of all rows, too, which bounds the number of hot keys
NO_TIME = -(1 << 62)


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than ``rows`` rows, at most ``HOT_KEYS`` of them, so ``ids`` broadcasts."""

    key: str
    ids: DataFrame | None = None
    rows: int = HOT_ROWS
    slice_seconds: int = 3600

    def __bool__(self) -> bool:
        return self.ids is not None

    def cold_part(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.ids), self.key, "left_anti")

    def hot_part(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.ids), self.key, "left_semi")


def find_hot_keys(
    df: DataFrame, key: str = "account_id", rows: int = HOT_ROWS, slice_seconds: int = 3600,
) -> HotKeys:
    """Find hot keys with one map-side combined count over the key column.

    A table no longer than the limit cannot hold a hot key, so its row count alone settles the question. The limit rises with
    the table: fewer than ``HOT_KEYS`` keys can hold more than one ``HOT_KEYS``-th of all rows each.
    """
    everything = df.count()
    if everything <= rows:
        return HotKeys(key, None, rows, slice_seconds)
    rows = max(rows, everything // HOT_KEYS)
    counted = df.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > rows) & F.col(key).isNotNull()).select(key)
    found = counted.collect()
    ids = df.sparkSession.createDataFrame(found, counted.schema) if found else None
    return HotKeys(key, ids, rows, slice_seconds)


def join_per_key(rows: DataFrame, per_key: DataFrame, hot: HotKeys, how: str = "inner") -> DataFrame:
    """Join a one-row-per-key table back to the rows without gathering a hot key's rows in one task."""
    if not hot:
        return rows.join(per_key, hot.key, how)
    cold = hot.cold_part(rows).join(per_key, hot.key, how)
    # Only the hot keys' own rows of the table are broadcast, and their number is bounded.
    spread = hot.hot_part(rows).join(F.broadcast(hot.hot_part(per_key)), hot.key, how)
    return cold.unionByName(spread)


def with_key_max(rows: DataFrame, hot: HotKeys, value: str, output: str) -> DataFrame:
    """Add the largest ``value`` of the row's key to every row, reading the rows once.

    Usual keys take a window, which leaves the rows partitioned by key for the aggregation that follows. A hot key
    is never gathered: its maximum is aggregated apart and broadcast.
    """
    largest = F.max(value).over(Window.partitionBy(hot.key))
    if not hot:
        return rows.withColumn(output, largest)
    heavy = hot.hot_part(rows)
    spread = heavy.join(F.broadcast(heavy.groupBy(hot.key).agg(F.max(value).alias(output))), hot.key)
    return hot.cold_part(rows).withColumn(output, largest).unionByName(spread)


def aggregate_per_key(
    rows: DataFrame, hot: HotKeys, aggregates: Mapping[str, Column],
    percentiles: Mapping[str, Mapping[str, float]] | None = None,
) -> DataFrame:
    """Aggregate rows to one row per key, with exact percentiles ``{value column: {output: p}}``.

    Usual keys take one fused aggregation. Hot keys take the same sums, and distributed percentiles.
    """
    percentiles = percentiles or {}
    plain = [column.alias(name) for name, column in aggregates.items()]

    def fused(df: DataFrame) -> DataFrame:
        arrays = [
            F.percentile(value, F.array(*[F.lit(float(p)) for p in probs.values()])).alias(f"_p_{value}")
            for value, probs in percentiles.items()
        ]
        wide = df.groupBy(hot.key).agg(*plain, *arrays) if plain or arrays else df.select(hot.key).distinct()
        out = wide.select(
            hot.key, *aggregates,
            *[F.col(f"_p_{value}")[i].alias(name) for value, probs in percentiles.items()
              for i, name in enumerate(probs)],
        )
        return out

    if not hot or not percentiles:
        return fused(rows)
    heavy = hot.hot_part(rows)
    parts = [heavy.groupBy(hot.key).agg(*plain) if plain else heavy.select(hot.key).distinct()]
    parts += [ranked_percentiles(heavy, [hot.key], value, probs) for value, probs in percentiles.items()]
    spread = reduce(lambda left, right: left.join(right, hot.key, "left"), parts)
    return fused(hot.cold_part(rows)).unionByName(spread)


def neighbours(
    df: DataFrame, hot: HotKeys, order: Sequence[str],
    previous: Mapping[str, str] | None = None, following: Mapping[str, str] | None = None,
    time: str = "ts",
) -> DataFrame:
    """Add columns of the row before and after within each key: ``{new column: source column}``.

    ``order`` must be a total order that starts with ``time``. A usual key is one window partition. A hot key is
    cut into time slices; the first and last row of every slice travel through a small table to their neighbours.
    """
    previous, following = dict(previous or {}), dict(following or {})

    def plain(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(hot.key).orderBy(*order)
        return rows.withColumns({
            **{new: F.lag(source).over(window) for new, source in previous.items()},
            **{new: F.lead(source).over(window) for new, source in following.items()},
        })

    if not hot:
        return plain(df)

    def packed(names: Mapping[str, str]) -> Column:
        return F.struct(*[F.col(source).alias(new) for new, source in names.items()])

    # Rows without a time come first, as in the plain window, in a slice of their own.
    rows = hot.hot_part(df).withColumn("_slice", F.coalesce(
        F.floor(F.unix_seconds(time) / hot.slice_seconds), F.lit(NO_TIME)))
    edges = rows.groupBy(hot.key, "_slice").agg(
        *([F.max_by(packed(previous), F.struct(*order)).alias("_last")] if previous else []),
        *([F.min_by(packed(following), F.struct(*order)).alias("_first")] if following else []),
    )
    across = Window.partitionBy(hot.key).orderBy("_slice")
    inside = Window.partitionBy(hot.key, "_slice").orderBy(*order)
    edge_cols, row_cols = {}, {}
    if previous:
        edge_cols["_before"] = F.lag("_last").over(across)
        row_cols["_prev"] = F.lag(packed(previous)).over(inside)
    if following:
        edge_cols["_after"] = F.lead("_first").over(across)
        row_cols["_next"] = F.lead(packed(following)).over(inside)
    joined = rows.withColumns(row_cols).join(
        edges.select(hot.key, "_slice", *[c.alias(n) for n, c in edge_cols.items()]), [hot.key, "_slice"])
    spread = joined.withColumns({
        **{new: F.coalesce("_prev", "_before")[new] for new in previous},
        **{new: F.coalesce("_next", "_after")[new] for new in following},
    }).select(*df.columns, *previous, *following)
    return plain(hot.cold_part(df)).unionByName(spread)
