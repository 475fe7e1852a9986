"""Blending of member scores (Y8, Y9), explanation samples and importances (B)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions.moments import MERGERS
from ledgerlens.operators.metrics import SWEEP_COUNT, SWEEP_START, SWEEP_STEP
from ledgerlens.session import importable, stage_table

MEMBERS = ("a", "b", "c", "x", "cat")
# Published best weights of the reference run, member order as in MEMBERS.
BEST_F1_WEIGHTS = (0.6, 0.0, 0.0, 0.2, 0.2)
BEST_AUC_WEIGHTS = (0.7, 0.2, 0.1, 0.0, 0.0)

POSITIVES = 500_000  # positives that a task compares its rows with at a time
ROWS_AT_ONCE = 100_000
WEIGHTINGS = 8  # weightings worked on at a time
_STATE = "won binary, reached binary"


def blend(scores: DataFrame, weights: Mapping[str, float], output: str = "blend") -> DataFrame:
    """Weighted sum of member scores, bounded to 0..1."""
    total = F.lit(0.0)
    for member, weight in weights.items():
        total = total + F.col(member) * F.lit(float(weight))
    return scores.withColumn(output, F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def weight_grid(members: int, parts: int) -> list[tuple[int, ...]]:
    """All ways to split ``parts`` whole parts over the members, first member slowest."""
    if members == 1:
        return [(parts,)]
    return [(first, *rest) for first in range(parts + 1) for rest in weight_grid(members - 1, parts - first)]


def _blended(values: np.ndarray, grid: np.ndarray, parts: int) -> np.ndarray:
    """Scores of all rows (rows x members) under some weightings (weightings x members): rows x weightings."""
    total = np.zeros((len(values), len(grid)))
    for m in range(values.shape[1]):  # in the order of the members, as Y8 adds them
        total += grid[:, m].astype(float)[None, :] * values[:, m:m + 1]
    return total / parts


class GridCounts:
    """What one task knows of every weighting: pairs won by positives, twice so that ties count one, and rows per threshold reached."""

    def __init__(self, grid: np.ndarray, parts: int):
        self.grid, self.parts = grid, parts
        self.won = np.zeros(len(grid), np.int64)
        self.reached = np.zeros((2, len(grid), SWEEP_COUNT + 1), np.int64)

    def add(self, negatives: np.ndarray, positives: np.ndarray, block: np.ndarray, first: bool) -> None:
        """Compare negatives with a block of positives; ``first`` also counts the thresholds of both parts of the task's own rows."""
        thresholds = SWEEP_START + np.arange(SWEEP_COUNT) * SWEEP_STEP
        for at in range(0, len(self.grid), WEIGHTINGS):
            part = self.grid[at:at + WEIGHTINGS]
            known = np.sort(_blended(block, part, self.parts), axis=0)
            seen, own = _blended(negatives, part, self.parts), _blended(positives, part, self.parts)
            for k in range(len(part)):
                score = np.sort(seen[:, k])
                at_most, below = (np.searchsorted(known[:, k], score, side) for side in ("right", "left"))
                self.won[at + k] += 2 * len(known) * len(score) - int(at_most.sum()) - int(below.sum())
                if first:
                    for kind, scores in ((0, seen[:, k]), (1, own[:, k])):
                        self.reached[kind, at + k] += np.bincount(np.searchsorted(thresholds, scores, "right"), minlength=SWEEP_COUNT + 1)


def blend_grid(scores: DataFrame, members: Sequence[str] = MEMBERS, parts: int = 10) -> DataFrame:
    """AUC and best F1 of every weighting in steps of 1/``parts``, in grid order ``w``.

    A batch of scores times the matrix of weightings gives all blends of its rows at once, inside a task. The positives, few of all
    rows, are sorted per weighting in blocks of ``POSITIVES`` that every task holds; a negative is counted by binary search, and ties count half.
    Tasks hand on sums of fixed size, which are merged; no row is multiplied by the number of weightings. A row without a score of
    every member takes part in nothing.
    """
    spark, grid = scores.sparkSession, np.array(weight_grid(len(members), parts))
    importable(spark)
    known = reduce(lambda a, b: a & b, [F.col(m).isNotNull() & ~F.isnan(F.col(m).cast("double")) for m in members])
    rows = stage_table(scores.where(known & F.col("is_mule").isNotNull()).select(
        (F.col("is_mule") == 1).alias("y"), *[F.col(m).cast("double").alias(f"_s{i}") for i, m in enumerate(members)]), "blend-rows")
    names = [f"_s{i}" for i in range(len(members))]
    blocks = max(1, -(-rows.where("y").count() // POSITIVES))
    place = F.pmod(F.xxhash64(*names), F.lit(blocks))

    def counting(shared, first: bool):
        def run(batches):
            counts, waiting, held = GridCounts(grid, parts), [], 0

            def flush():
                table = pa.Table.from_batches(waiting)
                values = np.column_stack([table.column(n).to_numpy() for n in names])
                y = table.column("y").to_numpy()
                counts.add(values[~y], values[y], shared.value, first)

            for batch in batches:
                waiting.append(batch)
                held += batch.num_rows
                if held >= ROWS_AT_ONCE:
                    flush()
                    waiting, held = [], 0
            if held:
                flush()
            yield _state(counts.won, counts.reached)
        return run

    states = []
    for number in range(blocks):
        block = rows.where("y").where(place == number).select(*names).toArrow()  # about POSITIVES rows
        shared = spark.sparkContext.broadcast(np.column_stack([block.column(n).to_numpy() for n in names]))
        states.append(rows.mapInArrow(counting(shared, number == 0), _STATE))
    merged = reduce(lambda a, b: a.unionByName(b), states).repartition(MERGERS).mapInArrow(_merged, _STATE).repartition(1).mapInArrow(_merged, _STATE)

    def finished(batches):
        for batch in batches:
            for won, reached in zip(batch.column("won").to_pylist(), batch.column("reached").to_pylist()):
                won, reached = np.frombuffer(won, np.int64), np.frombuffer(reached, np.int64).reshape(2, len(grid), -1)
                neg, pos = (int(x[0].sum()) for x in reached)
                fp, tp = (x[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:].astype(float) for x in reached)
                if pos + neg == 0:
                    continue
                f1 = (2 * tp / np.maximum(tp + fp + pos, 1)).max(axis=1)
                auc = won / 2 / (float(pos) * neg) if pos and neg else np.full(len(grid), np.nan)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(grid)), pa.int32()), *(pa.array(grid[:, m] / parts) for m in range(len(members))),
                     pa.array(auc, mask=np.isnan(auc)), pa.array(f1)],
                    names=["w", *(f"weight_{m}" for m in members), "auc", "f1"])

    return merged.mapInArrow(finished, "w int, " + ", ".join(f"`weight_{m}` double" for m in members) + ", auc double, f1 double")


def _state(won: np.ndarray, reached: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([won.tobytes()], pa.binary()), pa.array([reached.tobytes()], pa.binary())], names=["won", "reached"])


def _merged(batches):
    won = reached = None
    for batch in batches:
        for a, b in zip(batch.column("won").to_pylist(), batch.column("reached").to_pylist()):
            a, b = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
            won, reached = (a, b) if won is None else (won + a, reached + b)
    if won is not None:
        yield _state(won, reached)


def best_weights(grid: DataFrame) -> DataFrame:
    """The first grid row with the highest AUC and the first with the highest F1."""
    cols = [c for c in grid.columns if c.startswith("weight_")]
    picks = [F.max_by(F.struct("w", *cols, F.col(m).alias("value")), F.struct(F.col(m), -F.col("w"))).alias(m)
             for m in ("auc", "f1")]
    row = grid.agg(*picks)
    return row.unpivot([], ["auc", "f1"], "metric", "best").select("metric", "best.*")


def balanced_sample(
    rows: DataFrame, n_pos: int = 1200, n_neg: int = 1800, seed: int = 42, key: str = "account_id",
) -> DataFrame:
    """B-1: up to ``n_pos`` positives and ``n_neg`` negatives in a seeded pseudo-random order of the key."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))

    def take(label: int, n: int) -> DataFrame:
        return rows.where(F.col("is_mule") == label).orderBy(order, key).limit(n)

    return take(1, n_pos).unionByName(take(0, n_neg))


def importance_table(importances: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """B-2: per-member importances summed with the blend weights; a feature a member lacks counts 0 there.

    ``importances`` has one row per (model, feature), so the ranking window sees the feature list only.
    """
    factor = F.coalesce(F.try_element_at(
        F.create_map(*[F.lit(x) for entry in weights.items() for x in entry]), F.col("model")), F.lit(0.0))
    total = importances.groupBy("feature").agg(F.sum(F.col("importance") * factor).alias("importance"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("importance")).alias("neg"), "feature")))
    return total.groupBy().agg(ordered.alias("all")).select(F.posexplode("all").alias("pos", "f")).select(
        "f.feature", (-F.col("f.neg")).alias("importance"), (F.col("pos") + 1).alias("rank"))
