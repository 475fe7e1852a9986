"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to a grid, rows are ordered by the index of their cell on the Hilbert curve and the order is cut
into runs, one per shard. Neighbouring cells of the curve are neighbours in every dimension, so each shard spans a small box of the
metadata and files can be pruned by any of the dimensions (``write_shards``, ``read_shards``). Law: ``rows`` - the shards' row counts differ by one at most.

Ordering is one range-partitioned sort of narrow rows (no texts); a hot cell is split by id, digest and row number.

Defined cases: a null text has no bytes and checksum 0; nulls in a dimension take the first cell; equal rows are ordered by their
place in the scan; an empty table gives an empty table; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.functions.ranks import global_rank
from ledgerlens.llm.frames import kept, numbered, with_numbers

SHARDS = 24
BITS = 10


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Index on the curve of every column of ``axes`` (dimensions x points, whole numbers below 2**bits).

    The axes are rotated and reflected level by level, then Gray-decoded, and their bits are interleaved.
    """
    x = [axis.astype(np.int64).copy() for axis in axes]
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(len(x)):
            turned = (x[i] & level) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        level >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flips = np.where((x[-1] & level) != 0, flips ^ (level - 1), flips)
        level >>= 1
    out = np.zeros_like(x[0])
    for bit in reversed(range(bits)):
        for axis in x:
            out = (out << 1) | (((axis ^ flips) >> bit) & 1)
    return out


def curve(dims: Sequence[Column], bits: int = BITS) -> Column:
    """Curve index of the grid cell given by the columns ``dims``."""
    if len(dims) * bits > 62:
        raise ValueError("dimensions times bits must not exceed 62")

    @F.pandas_udf("bigint")
    def index(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(dtype=np.int64).T, bits))

    return index(F.struct(*[d.cast("int").alias(f"d{i}") for i, d in enumerate(dims)]))


def by_magnitude(value: Column, bits: int = BITS) -> Column:
    """Cell of a count on a logarithmic scale, 32 cells per doubling; null is cell 0."""
    return F.coalesce(F.least(F.floor(F.log2(value.cast("double") + 1) * 32), F.lit((1 << bits) - 1)), F.lit(0))


def by_order(df: DataFrame, name: str, output: str, bits: int = BITS) -> DataFrame:
    """Add the cell of a name among all distinct names in order, spread over the whole axis; null is cell 0."""
    ranked = global_rank(df.select(name).where(F.col(name).isNotNull()).distinct(), [F.col(name)], "_place")
    count = ranked.agg(F.count("*").alias("_names"))
    cells = ranked.join(F.broadcast(count), how="inner").select(
        F.col(name).alias("_name"), F.floor((F.col("_place") - 1) * (1 << bits) / F.col("_names")).alias("_cell"))
    return (df.join(cells, df[name] == cells["_name"], "left")
            .withColumn(output, F.coalesce("_cell", F.lit(0))).drop("_name", "_cell"))


def hilbert_shards(df: DataFrame, dims: Sequence[Column], order: Sequence[Column], shards: int = SHARDS,
                   bits: int = BITS) -> DataFrame:
    """Add ``curve_index``, ``shard`` and ``slot``; ``order`` settles the order inside a cell."""
    placed = global_rank(df.withColumn("curve_index", curve(dims, bits)), [F.col("curve_index"), *order], "_rank")
    rows = placed.agg(F.count("*").alias("_rows"))
    at = F.col("_rank") - 1
    # Shard s holds the places from ceil(s * rows / shards) on: sizes differ by one at most.
    numbered_rows = placed.join(F.broadcast(rows)).withColumn("shard", F.expr(f"cast((_rank - 1) * {shards} div _rows as int)"))
    first = F.expr(f"(shard * _rows + {shards - 1}) div {shards}")
    return numbered_rows.withColumn("slot", (at - first).cast("bigint")).drop("_rank", "_rows")


def _placed(rows: DataFrame, shards: int, bits: int) -> DataFrame:
    """Shards of stored rows (_row, doc_id, lang, source, size, text_crc32) by source, language and size."""
    cells = by_order(by_order(rows, "source", "_source_cell", bits), "lang", "_lang_cell", bits)
    dims = [F.col("_source_cell"), F.col("_lang_cell"), by_magnitude(F.col("size"), bits)]
    return hilbert_shards(cells, dims, [F.col("doc_id"), F.col("text_crc32"), F.col("_row")], shards, bits).drop(
        "_source_cell", "_lang_cell")


def _narrow(rows: DataFrame) -> DataFrame:
    text = F.col("text")
    return rows.select(
        "_row", "doc_id", "lang", "source", (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("bigint").alias("text_crc32"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Shard documents by source, language and size."""
    return _placed(kept(_narrow(with_numbers(docs, "doc_id", "text", "lang", "source")), "shard-narrow"), shards, bits)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Write the documents' own columns to ``path``, one folder ``shard=s`` per shard, in slot order; returns the bounds per shard.

    The texts are shuffled once, to ranges of (shard, slot), so a shard may be many files and no task holds a whole one. Bounds are the
    smallest and largest source, language and size and the rows of every shard, written to ``<path>-bounds``.
    """
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"])
    rows = numbered(docs.select(others.alias("_doc"), "doc_id", "lang", "source", "text"), "_doc", "doc_id", "lang", "source", "text")
    placed = kept(_placed(_narrow(rows), shards, bits), "shard-placed")
    whole = rows.select("_row", "_doc", "text").join(placed.select("_row", "shard", "slot", "size").hint("merge"), "_row")
    own = [F.col("text") if name == "text" else F.col(f"_doc.`{name}`").alias(name) for name in docs.columns if name not in ("shard", "slot")]
    whole.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot").select(
        *own, "slot", "shard").write.partitionBy("shard").parquet(path)
    bounds = placed.groupBy("shard").agg(F.count("*").alias("rows"), *[
        f(name).alias(f"{f.__name__}_{name}") for name in ("source", "lang", "size") for f in (F.min, F.max)])
    bounds.write.parquet(f"{path}-bounds")
    return docs.sparkSession.read.schema(bounds.schema).parquet(f"{path}-bounds")


def read_shards(spark: SparkSession, path: str, **ranges: tuple) -> DataFrame:
    """The written documents of shards that can hold rows within all ``ranges``, such as ``size=(100, 200)``; both ends belong to a range.

    Only whole shards are left out: the rows themselves are for the caller to filter. There is one row of bounds per shard.
    """
    bounds = spark.read.parquet(f"{path}-bounds")
    for name, (low, high) in ranges.items():
        bounds = bounds.where((F.col(f"min_{name}") <= F.lit(high)) & (F.col(f"max_{name}") >= F.lit(low)))
    wanted = [r.shard for r in bounds.select("shard").collect()]
    return spark.read.parquet(path).where(F.col("shard").isin(wanted) if wanted else F.lit(False))
