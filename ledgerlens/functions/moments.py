"""Mergeable moments and co-moments of many columns in one pass.

Every task adds its Arrow batches up to one state of fixed size per class: counts of rows, NULLs, NaNs and infinities per column, and for every
pair of columns the number of rows that have both, their means, squared deviations and co-moment. States are merged pairwise by
the update of means and deviations, which loses no digits where a plain sum of squares would. A row is never multiplied by
the number of columns, and what is shuffled grows with tasks, not with rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.session import importable

MERGERS = 64  # tasks of the first round of merging


class Moments:
    """State of one class; NULLs take part in nothing, NaNs and infinities in all, as in SQL aggregates."""

    def __init__(self, k: int):
        self.rows, self.nulls, self.nans, self.infinities = 0, *(np.zeros(k, np.int64) for _ in range(3))
        self.n, self.mean, self.square, self.cross = (np.zeros((k, k)) for _ in range(4))

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        """Add rows: doubles and which of them are not NULL."""
        part = Moments(values.shape[1])
        part.rows, part.nulls = len(values), (~known).sum(axis=0)
        part.nans, part.infinities = (np.isnan(values) & known).sum(axis=0), (np.isinf(values) & known).sum(axis=0)
        with np.errstate(invalid="ignore", divide="ignore"):
            here = known.astype(float)
            present = known.sum(axis=0)
            center = np.where(present > 0, np.where(known, values, 0).sum(axis=0) / np.maximum(present, 1), 0)
            moved = np.where(known, values - np.where(np.isfinite(center), center, 0), 0)
            part.n = here.T @ here
            total = np.maximum(part.n, 1)
            sums = moved.T @ here  # of a over the rows that have a and b
            part.mean = np.where(part.n > 0, sums / total, 0)
            part.square = (moved * moved).T @ here - part.mean * sums
            part.cross = moved.T @ moved - part.mean * sums.T
            part.mean = np.where(part.n > 0, part.mean + np.where(np.isfinite(center), center, 0)[:, None], 0)
        self.merge(part)

    def merge(self, other: Moments) -> Moments:
        for name in ("rows", "nulls", "nans", "infinities"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        with np.errstate(invalid="ignore"):
            n = self.n + other.n
            share = other.n / np.maximum(n, 1)
            apart = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0)
            self.square = self.square + other.square + apart * apart * self.n * share
            self.cross = self.cross + other.cross + apart * apart.T * self.n * share
            self.mean = np.where(self.n > 0, self.mean + apart * share, other.mean)
            self.n = n
        return self

    def correlations(self) -> np.ndarray:
        """Pearson correlations; NaN where one of the columns does not vary."""
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.cross / np.sqrt(self.square * self.square.T)

    def spread(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, mean and sum of squared deviations of every column."""
        return np.diag(self.n), np.diag(self.mean), np.diag(self.square)


def moments(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """``cls`` (the value of ``by``, an integer) and ``state``, one row per class: a Moments as bytes."""
    importable(df.sparkSession)
    names = [f"_x{i}" for i in range(len(cols))]
    chosen = df.select((F.col(by) if by else F.lit(0)).cast("int").alias("cls"),
                       *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(cols, names)])
    k = len(names)

    def rows_of(states: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(states), pa.int32()), pa.array([pickle.dumps(s) for s in states.values()], pa.binary())], names=["cls", "state"])

    def gather(batches) -> Iterator[pa.RecordBatch]:
        states: dict = {}
        for batch in batches:
            columns = [batch.column(n) for n in names]
            values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns])
            known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
            classes = batch.column("cls").to_pylist()
            for cls in dict.fromkeys(classes):
                own = np.fromiter((c == cls for c in classes), bool, len(classes))
                states.setdefault(cls, Moments(k)).add(values[own], known[own])
        yield rows_of(states)

    def merge(batches) -> Iterator[pa.RecordBatch]:
        states: dict = {}
        for batch in batches:
            for cls, state in zip(batch.column("cls").to_pylist(), batch.column("state").to_pylist()):
                other = pickle.loads(state)
                states[cls] = states[cls].merge(other) if cls in states else other
        yield rows_of(states)

    shape = "cls int, state binary"
    partial = chosen.mapInArrow(gather, shape).repartition(MERGERS).mapInArrow(merge, shape)
    return partial.repartition(1).mapInArrow(merge, shape)  # MERGERS states of fixed size per class


def column_statistics(states: DataFrame, cols: Sequence[str]) -> DataFrame:
    """cls, feature, rows, nulls, nans, infinities, n, mean and sample deviation of every column."""
    cols = list(cols)

    def run(batches):
        for batch in batches:
            for cls, state in zip(batch.column("cls").to_pylist(), batch.column("state").to_pylist()):
                s = pickle.loads(state)
                n, mean, square = s.spread()
                with np.errstate(invalid="ignore", divide="ignore"):
                    std = np.sqrt(np.maximum(square, 0) / (n - 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cls] * len(cols), pa.int32()), pa.array(cols), pa.array([s.rows] * len(cols), pa.int64()),
                     *(pa.array(x, pa.int64()) for x in (s.nulls, s.nans, s.infinities)), pa.array(n.astype(np.int64)),
                     pa.array(mean, mask=n < 1), pa.array(std, mask=n < 2)],
                    names=["cls", "feature", "rows", "nulls", "nans", "infinities", "n", "mean", "std"])

    return states.mapInArrow(run, "cls int, feature string, rows bigint, nulls bigint, nans bigint, infinities bigint, n bigint, "
                                  "mean double, std double")


def pair_correlations(states: DataFrame, cols: Sequence[str]) -> DataFrame:
    """cls, feature_a, feature_b, correlation of every pair of columns in their order; NaN where undefined."""
    pairs = list(combinations(range(len(cols)), 2))
    left, right = [cols[i] for i, _ in pairs], [cols[j] for _, j in pairs]

    def run(batches):
        for batch in batches:
            for cls, state in zip(batch.column("cls").to_pylist(), batch.column("state").to_pylist()):
                found = pickle.loads(state).correlations()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cls] * len(pairs), pa.int32()), pa.array(left), pa.array(right), pa.array([found[p] for p in pairs], pa.float64())],
                    names=["cls", "feature_a", "feature_b", "correlation"])

    return states.mapInArrow(run, "cls int, feature_a string, feature_b string, correlation double")
