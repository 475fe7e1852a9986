"""Small helpers that the corpus operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from pathlib import Path

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerlens.session import stage_table

SPACES = "[ \\t-\\r]+"  # space and the five ASCII control characters from tab to carriage return
WORD = "[^ \\t-\\r]+"
HOME = str(Path(__file__).resolve().parents[2])
BATCH_ROWS = 256  # rows per Arrow batch, so that a batch of long texts stays small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Prepare for a Python stage: small Arrow batches, as texts differ in length by orders of magnitude, and workers that find this package.

    On a cluster the package is installed on every machine or sent with ``--py-files``.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if HOME not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (HOME, known)))
    return df


def with_numbers(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and ``_row``, a number of the row's own, for a plan that writes it down.

    The number is the place in this scan. A later scan can split the same files differently (by the number of cores, for one) and
    would number the rows anew, so whatever is joined on ``_row`` has to come from one stored table.
    """
    return docs.select(*columns, F.monotonically_increasing_id().alias("_row"))


def numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and ``_row``, written once: every use of the result reads the same numbers."""
    return kept(with_numbers(docs, *columns), "numbered")


def fields(df: DataFrame, keep: Iterable[str], more: str) -> StructType:
    """Schema of the columns ``keep`` of a frame and of further ones in SQL notation."""
    return StructType([df.schema[name] for name in keep] + StructType.fromDDL(more).fields)


def packed(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the text compressed to ``packed``, for texts that travel through a shuffle."""
    chosen = df.select(*keep, "text")

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = [None if text is None else pack(text.encode()) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in keep), pa.array(texts, pa.binary())],
                                             names=[*keep, "packed"])

    return small_batches(chosen).mapInArrow(run, fields(chosen, keep, "packed binary"))


def numbered_packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``_row``, the named columns and the text (empty for null) compressed to ``packed``, written once.

    The filter is true for every row; joins of any kind then read the table by the same scan, and so share one exchange.
    """
    rows = with_numbers(docs, *columns, "text").withColumn("text", F.coalesce("text", F.lit("")))
    return kept(packed(rows, "_row", *columns), "numbered-packed").where("_row is not null")


def unpacked(column: pa.Array) -> pa.Array:
    """The texts of an Arrow column made by ``packed``."""
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(x) if x is not None else None for x in column.to_pylist()], pa.large_binary())


def with_text(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the text of a frame whose texts are packed."""
    chosen = df.select(*keep, "packed")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), unpacked(batch.column("packed")).cast(pa.large_string()).cast(pa.string())],
                names=[*keep, "text"])

    return small_batches(chosen).mapInArrow(run, fields(chosen, keep, "text string"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside array functions."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; a null text has none."""
    inner = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder once and read it back."""
    return stage_table(df, name, compression="zstd")
