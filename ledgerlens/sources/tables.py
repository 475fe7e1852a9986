"""Readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlens.session import stage


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One parquet table; a given schema fixes names and types at the boundary."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_ledger(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType | None = None,
) -> DataFrame:
    """All part files under a glob (``.../batch-*/part_*.parquet``) as one relation."""
    df = read_table(spark, path, schema)
    return df.select(*columns) if columns else df


def table_inventory(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Files, exact rows, bytes, column count and column list per table.

    Rows are counted per input file from the parquet footers; no data column is read.
    """
    parts = []
    for name, path in paths.items():
        df = spark.read.parquet(path)
        per_file = df.groupBy(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        ).agg(F.count("*").alias("n"))
        parts.append(per_file.agg(
            F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        ).select(
            F.lit(name).alias("table_name"), "files", "rows", "bytes",
            F.lit(len(df.columns)).alias("columns"), F.lit(",".join(df.columns)).alias("column_list"),
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_features(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet checkpoint of a stage."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report or result table as CSV parts with a header."""
    df.write.mode(mode).option("header", True).csv(path)


def duplicate_bytes(spark: SparkSession, path: str) -> DataFrame:
    """S10, byte level: groups of files with equal content.

    Files are read in the scan's own blocks and line by line: files of one size are cut alike, and only blocks of files whose size
    another one has go on. Each line is hashed twice; sums of the hashes and of hash times line number stand for the lines and their order in a block. No line may exceed 2 GB.
    Compressed text files are read unpacked; empty files are not listed by Spark's scans.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"), "length")
    shared = files.groupBy("length").agg(F.count("*").alias("_files")).where("_files > 1").select(F.col("length").alias("size"))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).cast("decimal(12,0)").alias("at"), *[
            F.xxhash64(F.lit(seed), "value").bitwiseAND((1 << 40) - 1).cast("decimal(13,0)").alias(f"h{seed}") for seed in (1, 2)])
    first = F.min("at")
    sums = [F.sum(f"h{seed}") for seed in (1, 2)]
    blocks = lines.groupBy("path", "size", "start").agg(
        *[s.cast("string").alias(f"s{i}") for i, s in enumerate(sums)],
        *[(F.sum(F.col(f"h{i + 1}") * F.col("at")).cast("decimal(38,0)") - (first * s).cast("decimal(38,0)")).cast("string").alias(f"o{i}")
          for i, s in enumerate(sums)])
    whole = blocks.join(shared, "size", "left_semi").groupBy("path").agg(
        F.md5(F.to_json(F.sort_array(F.collect_list(F.struct("start", "s0", "s1", "o0", "o1"))))).alias("_content"))
    return _groups(files.join(whole, "path").select("path", F.concat_ws(":", "_content", F.col("length").cast("string")).alias("digest")))


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """S10, row level: groups of files that hold the same multiset of rows, in any order.

    ``rows`` is read from many files. Each row is hashed twice with different seeds and the hashes are summed per
    file, so a file of any size is reduced by partial aggregation.
    """
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in rows.columns]

    def summed(seed: int):
        return F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)"))

    per_file = rows.select(F.col("_metadata.file_path").alias("path"), *rows.columns).groupBy("path").agg(
        F.concat_ws(":", summed(1).cast("string"), summed(2).cast("string"), F.count("*").cast("string"))
        .alias("digest"))
    return _groups(per_file)


def _groups(digests: DataFrame) -> DataFrame:
    """digest, files and path: one row per file that shares its digest with ``files`` - 1 others.

    Digests are written once, so no file is read twice, and no list of paths is gathered in one row.
    """
    found = stage(digests)
    again = found.groupBy("digest").agg(F.count("*").alias("files")).where("files > 1")
    return found.join(again, "digest").select("digest", "files", "path")
