"""From a feature matrix to a score sheet: out-of-fold scores, blend choice, refit and test scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerlens.operators import blend, decision, members, metrics
from ledgerlens.operators.members import MEMBER_SPECS, MemberSpec
from ledgerlens.schema import BEHAVIOURAL_FEATURES, FOLDS
from ledgerlens.session import stage


@dataclass(frozen=True)
class Scored:
    """Results of :func:`train_and_score`. ``weights`` and ``threshold`` are the best-F1 choice."""

    oof: DataFrame
    grid: DataFrame
    report: DataFrame
    weights: dict[str, float]
    threshold: float
    importances: DataFrame
    nodes: DataFrame
    test_scores: DataFrame
    sheet: DataFrame


def train_and_score(
    features: DataFrame, labels: DataFrame, accounts: DataFrame, test: DataFrame, counts: DataFrame,
    names: Sequence[str] = BEHAVIOURAL_FEATURES, specs: Sequence[MemberSpec] = MEMBER_SPECS,
    folds: Sequence[tuple[str, str, str]] = FOLDS, parts: int = 10,
) -> Scored:
    """Walk-forward validation, weight grid, refit on all training rows and the test score sheet.

    ``counts`` is the (account, code) table of the fold-safe encoding. The driver sees two summary rows: the best
    weights and the best threshold.
    """
    labelled = features.select("account_id", *names).join(labels.select("account_id", "is_mule"), "account_id").join(
        accounts.select("account_id", "account_opening_date"), "account_id", "left")
    unseen = features.select("account_id", *names).join(test.select("account_id"), "account_id", "left_semi")
    order = [s.name for s in specs]
    oof = stage(members.oof_predictions(labelled, counts, names, specs, folds))
    grid = stage(blend.blend_grid(oof, order, parts))
    chosen = blend.best_weights(grid).where("metric = 'f1'").first()
    weights = {name: float(chosen[f"weight_{name}"]) for name in order}
    blended = blend.blend(oof, weights).select("account_id", "is_mule", *order, "blend")
    report = metrics.model_metrics_report(blended, [*order, "blend"])
    sweep = metrics.threshold_sweep(blended.select("account_id", "is_mule", F.col("blend").alias("score")))
    threshold = float(metrics.best_threshold(sweep).first().best_threshold)
    nodes, scores = members.refit_and_score(labelled, unseen, counts, names, specs)
    scores = stage(blend.blend(scores, weights))
    importances = blend.importance_table(members.member_importances(
        nodes, members.explained(labelled, counts), names, specs), weights)
    return Scored(oof, grid, report, weights, threshold, importances, nodes, scores,
                  decision.score_sheet(test, scores, "blend"))
