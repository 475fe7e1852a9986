"""Boosted-tree members on two feature views: training, out-of-fold scores, refit, scoring and contributions (Y5-Y7, B-2).

All fits are one Spark job over every labelled row. The rows of a fold are numbered in the order of their accounts and binned a few features a task into
byte codes, which are stored feature by feature; every (fold, member) is one partition that lays them into a mapped file and grows its trees from
them. What comes out is a stored table of nodes; scoring and explaining read that table and no label.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerlens.functions.ranks import global_rank
from ledgerlens.operators import boosting
from ledgerlens.operators.blend import balanced_sample
from ledgerlens.operators.encoding import fold_codes, risky_code_share, risky_codes, walk_forward_folds, with_fold_encoding
from ledgerlens.operators.trees import NODES, Forest
from ledgerlens.schema import ENCODED_FEATURE, FOLDS
from ledgerlens.session import importable, stage, stage_table

COLUMNS_AT_ONCE = 4  # columns that one task bins: it holds 8 bytes a labelled row for each
CODES_AT_ONCE = 1 << 16  # bytes of codes in a stored row
NODES_PER_BATCH = 2_000
EXPLAINERS = 96  # tasks that explain rows: a sample of thousands of rows is small to a planner, but each row visits every leaf of every tree


@dataclass(frozen=True)
class MemberSpec:
    """One ensemble member. ``encoded`` members also see the fold-safe code share.

    ``row_every`` is the number of rounds between draws of ``row_share`` of the rows; 0 means never, the library default the reference run leaves
    in place for a, b and c. ``stops`` ends the fit at the first round without a split.
    """

    name: str
    rounds: int
    seed: int
    encoded: bool
    leaves: int = 0
    depth: int = 0
    min_rows: int = 1
    min_hessian: float = 1e-3
    l1: float = 0.1
    l2: float = 1.0
    rate: float = 0.05
    feature_share: float = 0.7
    row_share: float = 0.8
    row_every: int = 0
    stops: bool = False
    symmetric: bool = False
    noise: float = 0.0
    temperature: float = 0.0
    bins: int = boosting.BINS


# Rounds, leaves, depths, regularisation, learning rate, sampling shares and seeds are the published settings of the reference run.
MEMBER_SPECS = (
    MemberSpec("a", 500, 42, False, leaves=63, min_rows=100, stops=True),
    MemberSpec("b", 500, 123, False, leaves=63, min_rows=100, stops=True),
    MemberSpec("c", 400, 77, True, leaves=31, min_rows=150, stops=True),
    MemberSpec("x", 600, 42, True, depth=6, min_hessian=10.0, row_every=1),
    MemberSpec("cat", 500, 42, True, depth=6, l1=0.0, l2=5.0, feature_share=1.0, row_share=1.0, symmetric=True, noise=1.0,
               temperature=0.5, bins=128),
)


def small_specs(rounds: int = 3, depth: int = 3) -> tuple[MemberSpec, ...]:
    """The same members with few rounds and small trees, for small data."""
    return tuple(replace(s, rounds=rounds, depth=depth, min_rows=min(s.min_rows, 2), min_hessian=min(s.min_hessian, 0.1)) for s in MEMBER_SPECS)


def _view(spec: MemberSpec, features: Sequence[str]) -> list[str]:
    return [*features, ENCODED_FEATURE] if spec.encoded else list(features)


def _columns(specs: Sequence[MemberSpec], features: Sequence[str]) -> list[str]:
    """Features of all views; the encoded one is last, so that a view is a prefix."""
    return [*features, ENCODED_FEATURE] if any(s.encoded for s in specs) else list(features)


def labelled_sample(rows: DataFrame, limit: int, group: str = "fold", key: str = "account_id") -> DataFrame:
    """All rows of groups up to ``limit``; of larger ones the share ``limit`` / rows, by hash of the key. For trials: no fit draws it by itself."""
    sizes = rows.groupBy(group).agg((F.lit(float(limit)) / F.count("*")).alias("_share"))  # one row per fold
    place = F.pmod(F.xxhash64(F.col(key), F.lit("labelled")), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(F.broadcast(sizes), group).where(place < F.col("_share")).drop("_share")


@dataclass(frozen=True)
class FoldRows:
    """The labelled rows of a fold: their number, the rank of the first one among the rows of all folds and the weight of a positive."""

    fold: int
    n: int
    first: int
    weight: float


def placed(train: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[FoldRows]]:
    """All labelled rows with ``_rank``, their place by fold and account, and what is known of each fold. Accounts that repeat are ordered by their values."""
    chosen = train.where("fold IS NOT NULL").select(
        F.col("fold").cast("int").alias("fold"), "account_id", F.col("is_mule").cast("double").alias("is_mule"), *[F.col(c).cast("double").alias(c) for c in columns])
    ranked = global_rank(chosen, [F.col("fold"), F.col("account_id").asc_nulls_last(), F.col("is_mule"), F.xxhash64(*columns)], "_rank")
    sizes = ranked.groupBy("fold").agg(  # one row per fold
        F.count("*").alias("n"), F.min("_rank").alias("first"),
        F.coalesce(F.count_if(F.col("is_mule") == 0) / F.nullif(F.count_if(F.col("is_mule") == 1), F.lit(0)), F.lit(1.0)).alias("weight"))
    return ranked, [FoldRows(r.fold, r.n, r["first"], r.weight) for r in sizes.orderBy("fold").collect()]


def binned(ranked: DataFrame, folds: Sequence[FoldRows], columns: Sequence[str], all_bins: Sequence[int]) -> DataFrame:
    """Codes by fold, number of bins and feature, ``CODES_AT_ONCE`` bytes a row, from place ``at`` on; the first row has the bin edges too.

    Feature -1 are the labels as doubles. A few columns of a fold are one partition, so no task holds whole rows of a fold.
    """
    every = ["is_mule", *columns]
    blocks = [range(at, min(at + COLUMNS_AT_ONCE, len(every))) for at in range(0, len(every), COLUMNS_AT_ONCE)]

    def deal(batches):
        for batch in batches:
            own_fold, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "_rank"))
            values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in every]).astype(float)
            slots, places, parts = [], [], []
            for i, f in enumerate(folds):
                own = np.flatnonzero(own_fold == f.fold)
                if len(own):
                    for j, block in enumerate(blocks):
                        slots.append(i * len(blocks) + j)
                        places.append((rank[own] - f.first).astype(np.int64).tobytes())
                        parts.append(values[block.start:block.stop, own].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(places, pa.binary()), pa.array(parts, pa.binary())],
                                             names=["slot", "place", "part"])

    def stored(fold: int, bins: int, feature: int, data: bytes, edges: np.ndarray | None):
        at = range(0, len(data), CODES_AT_ONCE)
        n = len(at)
        return pa.RecordBatch.from_arrays(
            [pa.array([fold] * n, pa.int32()), pa.array([bins] * n, pa.int32()), pa.array([feature] * n, pa.int32()), pa.array(at, pa.int64()),
             pa.array([data[i:i + CODES_AT_ONCE] for i in at], pa.binary()), pa.array([None if i or edges is None else edges for i in at], pa.list_(pa.float64()))],
            names=["fold", "bins", "feature", "at", "codes", "edges"])

    def run(batches):
        values = None
        for batch in batches:
            for slot, place, part in zip(*(batch.column(c).to_pylist() for c in ("slot", "place", "part"))):
                if values is None:
                    fold, block = folds[slot // len(blocks)], blocks[slot % len(blocks)]
                    values = np.empty((len(block), fold.n))
                values[:, np.frombuffer(place, np.int64)] = np.frombuffer(part).reshape(len(block), -1)
        if values is None:
            return
        for column, own in zip(block, values):
            for bins in all_bins:
                if column == 0:
                    yield stored(fold.fold, bins, -1, own.tobytes(), None)
                else:
                    edges = boosting.edges_of(own, bins)
                    yield stored(fold.fold, bins, column - 1, boosting.codes_of(own, edges).tobytes(), edges)

    dealt = ranked.select("fold", "_rank", *every).mapInArrow(deal, "slot int, place binary, part binary")
    return dealt.repartitionById(len(folds) * len(blocks), F.col("slot")).mapInArrow(
        run, "fold int, bins int, feature int, at bigint, codes binary, edges array<double>")


def node_rows(tree: boosting.Tree, number: int, names: Sequence[str], edges: Sequence[Sequence[float]]) -> list[tuple]:
    """The nodes of a tree in the order of NODES without the model; cuts are the upper edges of their codes."""
    return [
        (number, node, names[f], float(edges[f][cut - 1]), bool(missing_left), left, right, gain, value, cover)
        if left >= 0 else (number, node, None, None, None, None, None, gain, value, cover)
        for node, (f, cut, missing_left, left, right, gain, value, cover) in enumerate(zip(
            tree.feature, tree.cut, tree.missing_left, tree.left, tree.right, tree.gain, tree.value, tree.cover))]


def fit_members(train: DataFrame, features: Sequence[str], specs: Sequence[MemberSpec] = MEMBER_SPECS) -> DataFrame:
    """The stored nodes (``fold`` and NODES) of every member of every fold of ``train``, which has account_id, fold, is_mule and the features.

    Every row of a fold takes part. Positives are weighted by negatives per positive of their fold. A fold without rows has no nodes.
    """
    importable(train.sparkSession)
    schema = f"fold int, {NODES}"
    shape = to_arrow_schema(StructType.fromDDL(schema))
    columns = _columns(specs, features)
    ranked, folds = placed(train, columns)
    if not folds or not specs:
        return train.sparkSession.createDataFrame([], StructType.fromDDL(schema))
    coded = stage_table(binned(ranked, folds, columns, sorted({s.bins for s in specs})), "binned")
    # Tasks start in the order of the slots: the longest fits first, so that none of them is left to run alone at the end.
    slots = [(fold, spec) for fold in sorted(folds, key=lambda f: (-f.n, f.fold)) for spec in sorted(specs, key=lambda s: -s.rounds * (s.leaves or 2 ** s.depth))]
    choices = F.array(*[F.struct(F.lit(f.fold).alias("fold"), F.lit(spec.bins).alias("bins"), F.lit(len(_view(spec, features))).alias("width"), F.lit(i).alias("slot"))
                        for i, (f, spec) in enumerate(slots)])
    mine = F.filter(choices, lambda s: (s.fold == F.col("fold")) & (s.bins == F.col("bins")) & (F.col("feature") < s.width))
    parts = ["feature", "at", "codes", "edges"]
    dealt = coded.select(F.explode(mine).alias("_s"), *parts).select(F.col("_s.slot").alias("slot"), *parts).repartitionById(len(slots), F.col("slot"))
    plain = [(fold, asdict(spec)) for fold, spec in slots]

    def run(batches):
        codes = None
        for batch in batches:
            for slot, feature, at, part, own_edges in zip(*(batch.column(c).to_pylist() for c in ("slot", *parts))):
                if codes is None:
                    rows_of, spec = plain[slot]
                    fold, spec = rows_of.fold, MemberSpec(**spec)
                    names = _view(spec, features)
                    codes, label, edges = boosting.byte_matrix(len(names), rows_of.n), np.empty(rows_of.n), [()] * len(names)
                if feature < 0:
                    label.view(np.uint8)[at:at + len(part)] = np.frombuffer(part, np.uint8)
                    continue
                codes[feature, at:at + len(part)] = np.frombuffer(part, np.uint8)
                if own_edges is not None:
                    edges[feature] = own_edges
        if codes is None:
            return
        grow = boosting.symmetric if spec.symmetric else boosting.leaf_wise
        grown = grow(codes.T, np.array([len(e) for e in edges]), label, np.where(label == 1, rows_of.weight, 1.0), spec,
                     np.random.default_rng([spec.seed, fold]))
        start = boosting.Tree()
        start.add(next(grown), float(len(label)))
        rows = node_rows(start, -1, names, edges)
        for number, tree in enumerate(grown):
            rows += node_rows(tree, number, names, edges)
            if len(rows) >= NODES_PER_BATCH:
                yield batch_of(fold, spec.name, rows)
                rows = []
        if rows:
            yield batch_of(fold, spec.name, rows)

    def batch_of(fold: int, model: str, rows: list[tuple]) -> pa.RecordBatch:
        columns = [[fold] * len(rows), [model] * len(rows), *zip(*rows)]
        return pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(columns, shape)], schema=shape)

    return stage_table(dealt.mapInArrow(run, schema), "nodes")


def train_members(train: DataFrame, features: Sequence[str], specs: Sequence[MemberSpec] = MEMBER_SPECS) -> DataFrame:
    """The nodes of every member, fitted to all rows of ``train``."""
    return fit_members(train.withColumn("fold", F.lit(0)), features, specs).drop("fold")


def _forests(nodes: DataFrame, specs: Sequence[MemberSpec], features: Sequence[str]):
    """{fold: {member: Forest}} of a table of nodes, whose size the members' settings bound."""
    whole = nodes.toPandas()
    return {int(fold): {s.name: Forest(part[part.model == s.name], _view(s, features)) for s in specs if (part.model == s.name).any()}
            for fold, part in whole.groupby("fold")}


def score_members(
    nodes: DataFrame, rows: DataFrame, features: Sequence[str], specs: Sequence[MemberSpec] = MEMBER_SPECS, keep: Sequence[str] = (),
) -> DataFrame:
    """Positive-class probability of every member, one column each, from stored nodes alone.

    Where ``nodes`` has a ``fold``, so have the rows, and each row is scored by the members of its fold. NULL where there is no such member.
    """
    columns, by_fold = _columns(specs, features), "fold" in nodes.columns
    spark = rows.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(_forests(nodes if by_fold else nodes.withColumn("fold", F.lit(0)), specs, features))
    kept = list(dict.fromkeys(["account_id", *keep, *(["fold"] if by_fold else [])]))
    chosen = rows.select(*kept, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])

    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(f"_x{i}").to_numpy(zero_copy_only=False) for i in range(len(columns))]).astype(float)
            folds = batch.column("fold").to_numpy(zero_copy_only=False) if by_fold else np.zeros(len(x), int)
            scores = np.full((len(specs), len(x)), np.nan)
            for fold, forests in shared.value.items():
                own = np.flatnonzero(folds == fold)
                for i, s in enumerate(specs):
                    if len(own) and s.name in forests:
                        scores[i, own] = boosting.sigmoid(forests[s.name].margin(x[own, :forests[s.name].n_features]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(v, mask=np.isnan(v)) for v in scores)], names=[*kept, *(s.name for s in specs)])

    schema = StructType([chosen.schema[c] for c in kept] + StructType.fromDDL(", ".join(f"`{s.name}` double" for s in specs)).fields)
    return chosen.mapInArrow(run, schema).select("account_id", *keep, *(s.name for s in specs))


def with_encoding(rows: DataFrame, counts: DataFrame, codes: DataFrame) -> DataFrame:
    return rows.join(risky_code_share(counts, codes, rows), "account_id", "left").na.fill(0.0, [ENCODED_FEATURE])


def oof_predictions(
    labelled: DataFrame, counts: DataFrame, features: Sequence[str], specs: Sequence[MemberSpec] = MEMBER_SPECS,
    folds: Sequence[tuple[str, str, str]] = FOLDS, date_col: str = "account_opening_date",
) -> DataFrame:
    """Scores of each validation row from models that saw only earlier accounts, encoding included.

    ``labelled`` holds the features, ``is_mule`` and the date; rows outside every validation part are left out. All folds are encoded in one
    pass over the counts, and the members of all folds are fitted in one job.
    """
    placed = walk_forward_folds(labelled, date_col, folds)
    codes = stage(fold_codes(counts, labelled, folds, date_col))
    encoded = stage_table(with_fold_encoding(placed, counts, codes, len(folds)), "encoded-folds")
    nodes = fit_members(encoded.where("part = 'train'"), features, specs)
    return score_members(nodes, encoded.where("part = 'val'"), features, specs, keep=["is_mule", "fold"])


def refit_and_score(
    labelled: DataFrame, test: DataFrame, counts: DataFrame, features: Sequence[str],
    specs: Sequence[MemberSpec] = MEMBER_SPECS,
) -> tuple[DataFrame, DataFrame]:
    """Encoding and stored nodes from all training rows, then test scores."""
    codes = stage(risky_codes(counts, labelled))
    nodes = train_members(with_encoding(labelled, counts, codes), features, specs)
    return nodes, score_members(nodes, with_encoding(test, counts, codes), features, specs)


def explained(labelled: DataFrame, counts: DataFrame, **sizes: int) -> DataFrame:
    """The balanced sample (B-1) with the encoding of the refit, for explanations."""
    return with_encoding(balanced_sample(labelled, **sizes), counts, stage(risky_codes(counts, labelled)))


def contributions(
    nodes: DataFrame, rows: DataFrame, features: Sequence[str], specs: Sequence[MemberSpec] = MEMBER_SPECS,
) -> DataFrame:
    """Shapley values of every member's margin: account_id, model, feature, contribution, from stored nodes alone.

    Rows are dealt over ``EXPLAINERS`` tasks, however few bytes they have.
    """
    columns = _columns(specs, features)
    spark = rows.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(_forests(nodes.withColumn("fold", F.lit(0)), specs, features).get(0, {}))
    chosen = rows.select("account_id", *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]).repartition(EXPLAINERS, "account_id")
    kind = chosen.schema["account_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(f"_x{i}").to_numpy(zero_copy_only=False) for i in range(len(columns))]).astype(float)
            ids = batch.column("account_id")
            for name, forest in shared.value.items():
                shares = forest.contributions(x[:, :forest.n_features])
                n = forest.n_features
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(np.arange(len(x)), n))), pa.array([name] * (n * len(x))), pa.array(columns[:n] * len(x)),
                     pa.array(shares.ravel())], names=["account_id", "model", "feature", "contribution"])

    return chosen.mapInArrow(run, f"account_id {kind}, model string, feature string, contribution double")


def member_importances(
    nodes: DataFrame, rows: DataFrame, features: Sequence[str], specs: Sequence[MemberSpec] = MEMBER_SPECS,
) -> DataFrame:
    """B-2 input: (model, feature, importance), the mean absolute contribution over ``rows``, a sample as B-1 draws it."""
    return contributions(nodes, rows, features, specs).groupBy("model", "feature").agg(F.avg(F.abs("contribution")).alias("importance"))
