"""Distributed prefix sums and exact percentiles for groups of any size.

A running total ordered inside one group normally means one window partition, hence one task, per group. Here
a group is first cut into value slices, so its work spreads over many tasks: totals per slice give each slice its
starting offset, and only the rows inside a slice are sorted together. Slices are a pure function of exact minima
and maxima, so a recomputed task always places a row as before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.session import stage

SLICES_PER_E = 64  # first cut, by magnitude: slices per factor e
SUBSLICES = 64  # second cut, inside each slice's own range


def with_single_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table (an ungrouped aggregate) to every row."""
    one = F.lit(1)
    return df.withColumn("_one", one).join(F.broadcast(row.withColumn("_one", one)), "_one", "left").drop("_one")


def _log_scale(value: Column) -> Column:
    """Monotone scale on which values from 1e-6 to the largest are spread by magnitude."""
    return F.signum(value) * F.log1p(F.abs(value) * F.lit(1e6))


def _sliced(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Add ``_slice``, a number that never falls as ``order`` rises; equal values share a slice. NaN comes last.

    The first cut is by magnitude, about 1.6 % wide, and needs no look at the data. Values that crowd together
    there are cut again, evenly between the smallest and largest value of their slice.
    """
    value = F.col(order).cast("double")
    beyond = F.lit(1_000_000)
    first = df.withColumn(
        "_first",
        F.when(value == float("-inf"), -beyond).when(F.isnan(value), beyond + 1).when(value == float("inf"), beyond)
        .otherwise(F.floor(_log_scale(value) * SLICES_PER_E).cast("int")))
    inner = first.groupBy(*group, "_first").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    position = (value - F.col("_lo")) * SUBSLICES / (F.col("_hi") - F.col("_lo"))
    second = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(position), F.lit(SUBSLICES - 1)).cast("int"))
    return first.join(inner, [*group, "_first"]).select(
        *df.columns, (F.col("_first") * SUBSLICES + F.coalesce(second, F.lit(0))).alias("_slice"))


def _slice_offsets(sliced: DataFrame, group: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Totals of all earlier slices (``_offset_*``), of the slice (``_own_*``) and of the group (``_all_*``).

    A group reaches the window as its occupied slices, a bounded number whatever the size of the group.
    """
    own = sliced.groupBy(*group, "_slice").agg(*[F.sum(source).alias(f"_own_{new}") for new, source in sums.items()])
    everything = Window.partitionBy(*group)
    earlier = everything.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return own.withColumns({
        **{f"_offset_{new}": F.coalesce(F.sum(f"_own_{new}").over(earlier), F.lit(0)) for new in sums},
        **{f"_all_{new}": F.sum(f"_own_{new}").over(everything) for new in sums},
    })


def running_totals(
    df: DataFrame, group: Sequence[str], order: str, sums: Mapping[str, str],
) -> DataFrame:
    """Add, per entry ``{new: source}``, the total of ``source`` over rows of the group with a smaller ``order``,
    and as ``{new}_total`` its total over the group.

    ``df`` must hold one row per (group, order) value. NULL order values are not allowed.
    """
    group = list(group)
    sliced = _sliced(df, group, order)
    offsets = _slice_offsets(sliced, group, sums)
    inside = Window.partitionBy(*group, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.withColumns(
        {new: F.coalesce(F.sum(source).over(inside), F.lit(0)) for new, source in sums.items()})
    return totals.join(offsets, [*group, "_slice"]).select(*df.columns, *[
        c for new in sums
        for c in ((F.col(new) + F.col(f"_offset_{new}")).alias(new), F.col(f"_all_{new}").alias(f"{new}_total"))])


def value_counts(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """One row per distinct non-NULL value of a group with its row count ``n``."""
    return df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))


def ranked_percentiles(
    df: DataFrame, group: Sequence[str], value: str, probs: Mapping[str, float],
) -> DataFrame:
    """Exact interpolated percentiles per group, one output column per entry of ``probs``.

    Equals ``percentile(value, p)`` but never gathers a group: repeated values are counted first, slice totals tell
    in which slices the wanted ranks lie, and only the values of those slices are ordered.
    """
    group = list(group)
    sliced = _sliced(value_counts(df, group, value), group, value)
    offsets = _slice_offsets(sliced, group, {"n": "n"})
    positions = {name: (F.col("_all_n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    ends = [end(position) for position in positions.values() for end in (F.floor, F.ceil)]
    wanted = F.lit(False)
    for index in ends:
        wanted = wanted | ((index >= F.col("_offset_n")) & (index < F.col("_offset_n") + F.col("_own_n")))
    near = sliced.join(offsets.where(wanted), [*group, "_slice"])
    inside = Window.partitionBy(*group, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    located = near.withColumn("_below", F.col("_offset_n") + F.coalesce(F.sum("n").over(inside), F.lit(0)))

    def at(index: Column) -> Column:
        hit = (F.col("_below") <= index) & (index < F.col("_below") + F.col("n"))
        return F.max(F.when(hit, F.col(value).cast("double")))

    picked = located.groupBy(*group).agg(*[
        column for name, position in positions.items() for column in (
            at(F.floor(position)).alias(f"_{name}_lo"),
            at(F.ceil(position)).alias(f"_{name}_hi"),
            F.max(position - F.floor(position)).alias(f"_{name}_part"))])
    return picked.select(*group, *[
        F.when(F.col(f"_{n}_part") == 0, F.col(f"_{n}_lo")).otherwise(
            F.col(f"_{n}_lo") * (1 - F.col(f"_{n}_part")) + F.col(f"_{n}_hi") * F.col(f"_{n}_part")
        ).alias(n)
        for n in probs
    ])


def global_rank(df: DataFrame, order: Sequence[Column], output: str = "rank") -> DataFrame:
    """Number all rows 1, 2, 3, ... by a total order, without a single-task window.

    A range-partitioned sort gives each row its place inside its partition; the partition sizes give the offset.
    The sorted rows are staged, so both steps see the same partitioning even if executors are lost in between.
    """
    placed = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per partition reaches this window.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .withColumn(output, F.col("_offset") + inside + 1)
        .drop("_at", "_part", "_offset")
    )
