"""Encoding, folds, metrics, blending, models and decisions: Y, E, B, D."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog.matrix import _dimensions
from ledgerlens.catalog.registry import query
from ledgerlens.operators import blend, decision, encoding, members, metrics
from ledgerlens.plans.features import build_features
from ledgerlens.schema import BEHAVIOURAL_FEATURES, ENCODED_FEATURE, FOLDS
from ledgerlens.session import stage_table

# ---------------------------------------------------------------- Y1-Y4
FOLD_ROWS = "\nUNION ALL ".join(
    f"""SELECT l.account_id, {i} AS fold, CASE WHEN a.account_opening_date <= DATE '{cut}' THEN 'train' ELSE 'val' END AS part, l.is_mule
FROM acct_labels l JOIN accounts a ON l.account_id = a.account_id WHERE a.account_opening_date <= DATE '{cut}'
 OR a.account_opening_date BETWEEN DATE '{start}' AND DATE '{end}'""" for i, (cut, start, end) in enumerate(FOLDS))


def _dated(d):
    return d.acct_labels.select("account_id", "is_mule").join(
        d.accounts.select("account_id", "account_opening_date"), "account_id")


@query("y1_walk_forward_folds", "account_id fold:i part is_mule:i", """
SELECT account_id, fold, part, is_mule FROM fold_rows
WHERE fold IN (SELECT fold FROM fold_rows WHERE part = 'val' GROUP BY fold HAVING sum(is_mule) > 0)""",
       {"fold_rows": FOLD_ROWS})
def _(d):
    return encoding.walk_forward_folds(_dated(d))


CODE_VIEWS = {
    "picked": """SELECT account_id, is_mule FROM (SELECT account_id, is_mule, row_number() OVER (PARTITION BY is_mule ORDER BY account_id) AS rn,
 (SELECT sum(is_mule) FROM acct_labels) AS n1 FROM acct_labels) AS s WHERE is_mule = 1 OR {ratio} IS NULL OR rn <= n1 * {ratio}""",
    "code_rates": """SELECT d.mnemonic_code AS code, count(*) FILTER (WHERE p.is_mule = 1) * 1e0 / (SELECT count(*) FROM picked WHERE is_mule = 1) AS rate1,
 count(*) FILTER (WHERE p.is_mule = 0) * 1e0 / (SELECT count(*) FROM picked WHERE is_mule = 0) AS rate0
 FROM led d JOIN picked p ON d.account_id = p.account_id WHERE d.mnemonic_code IS NOT NULL GROUP BY d.mnemonic_code""",
    "risky": "SELECT code, rate1 / (rate0 + 0.001e0) AS lift FROM code_rates WHERE rate1 > 0 ORDER BY lift DESC, code LIMIT {k}",
}


def _code_views(ratio: int | str, k: int) -> dict[str, str]:
    return {name: sql.format(ratio=ratio, k=k) for name, sql in CODE_VIEWS.items()}


@query("y2_risky_codes", "code lift:f", "SELECT code, lift FROM risky", _code_views("NULL", 10))
def _(d):
    return encoding.risky_codes(encoding.code_counts(d.ledger), d.acct_labels)


@query("y2_risky_codes_small_sample", "code lift:f", "SELECT code, lift FROM risky", _code_views(3, 4))
def _(d):
    return encoding.risky_codes(encoding.code_counts(d.ledger), d.acct_labels, k=4, ratio=3)


@query("y3_risky_code_share", "account_id risky_mcc_share:f", """
SELECT i.account_id, coalesce(s.share, 0) AS risky_mcc_share FROM ids i LEFT JOIN (SELECT account_id,
 avg(CASE WHEN mnemonic_code IN (SELECT code FROM risky) THEN 1e0 ELSE 0e0 END) AS share FROM led GROUP BY account_id) s
 ON i.account_id = s.account_id""", _code_views("NULL", 10))
def _(d):
    counts = encoding.code_counts(d.ledger)
    return encoding.risky_code_share(counts, encoding.risky_codes(counts, d.acct_labels), d.ids)


FOLD_VIEWS = {
    "fold_rows": FOLD_ROWS,
    "fold_sizes": "SELECT fold, sum(is_mule) AS n1, count(*) - sum(is_mule) AS n0 FROM fold_rows WHERE part = 'train' GROUP BY fold",
    "fold_lifts": """SELECT k.fold, code, (k1 * 1e0 / n1) / (k0 * 1e0 / n0 + .001e0) AS lift FROM (SELECT t.fold, l.mnemonic_code AS code,
 count(*) FILTER (WHERE t.is_mule = 1) AS k1, count(*) FILTER (WHERE t.is_mule = 0) AS k0 FROM led l JOIN fold_rows t ON l.account_id = t.account_id
 WHERE t.part = 'train' AND l.mnemonic_code IS NOT NULL GROUP BY 1, 2) k JOIN fold_sizes s ON k.fold = s.fold WHERE k1 > 0 AND n1 > 0 AND n0 > 0""",
    "fold_risky": "SELECT fold, code, lift FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY lift DESC, code) AS r FROM fold_lifts) AS o WHERE r <= 10",
}


@query("y2_fold_codes", "fold:i code lift:f", "SELECT fold, code, lift FROM fold_risky", FOLD_VIEWS)
def _(d):
    return encoding.fold_codes(encoding.code_counts(d.ledger), _dated(d))


@query("y3_fold_code_share", "account_id fold:i part risky_mcc_share:f", """
SELECT p.account_id, p.fold, p.part, coalesce(s.share, 0) AS risky_mcc_share FROM fold_rows p LEFT JOIN (
 SELECT l.account_id, f.fold, avg(CASE WHEN r.code IS NOT NULL THEN 1e0 ELSE 0e0 END) AS share FROM led l CROSS JOIN (SELECT DISTINCT fold FROM fold_rows) f
 LEFT JOIN fold_risky r ON r.fold = f.fold AND r.code = l.mnemonic_code GROUP BY 1, 2) s ON s.account_id = p.account_id AND s.fold = p.fold
WHERE p.fold IN (SELECT fold FROM fold_rows WHERE part = 'val' GROUP BY fold HAVING sum(is_mule) > 0)""", FOLD_VIEWS)
def _(d):
    counts = encoding.code_counts(d.ledger)
    return encoding.with_fold_encoding(encoding.walk_forward_folds(_dated(d)), counts, encoding.fold_codes(counts, _dated(d)))


@query("y4_class_weight", "n_pos:i n_neg:i weight:f", """
SELECT sum(is_mule) AS n_pos, count(*) - sum(is_mule) AS n_neg, (count(*) - sum(is_mule)) * 1e0 / sum(is_mule) AS weight FROM acct_labels""")
def _(d):
    return encoding.class_weight(d.acct_labels)


# ---------------------------------------------------------------- Y8, Y9
@query("y8_blend", "account_id blend:f", """
SELECT account_id, least(greatest(a * 0.6e0 + b * 0 + c * 0 + x * 0.2e0 + cat * 0.2e0, 0), 1) AS blend FROM member_scores""")
def _(d):
    return blend.blend(d.member_scores, dict(zip(blend.MEMBERS, blend.BEST_F1_WEIGHTS)))


@query("y8_blend_best_auc", "account_id blend:f", """
SELECT account_id, least(greatest(a * 0.7e0 + b * 0.2e0 + c * 0.1e0, 0), 1) AS blend FROM member_scores""")
def _(d):
    return blend.blend(d.member_scores, dict(zip(blend.MEMBERS, blend.BEST_AUC_WEIGHTS)))


def _grid_views(parts: int) -> dict[str, str]:
    r = f"(SELECT unnest(range({parts} + 1)) AS v)"
    return {
        "grid": f"""SELECT CAST(row_number() OVER (ORDER BY a.v, b.v, c.v, x.v) - 1 AS BIGINT) AS w, a.v AS ga, b.v AS gb, c.v AS gc, x.v AS gx,
 {parts} - a.v - b.v - c.v - x.v AS gcat FROM {r} a, {r} b, {r} c, {r} x WHERE a.v + b.v + c.v + x.v <= {parts}""",
        "blended": f"""SELECT g.w, m.account_id, m.is_mule, (g.ga * m.a + g.gb * m.b + g.gc * m.c + g.gx * m.x + g.gcat * m.cat) / {parts}e0 AS score
 FROM member_scores m, grid g""",
        "auc_rows": """SELECT w, is_mule, rank() OVER (PARTITION BY w ORDER BY score) + (count(*) OVER (PARTITION BY w, score) - 1) / 2e0 AS rk FROM blended""",
        "aucs": """SELECT w, (sum(rk) FILTER (WHERE is_mule = 1) - sum(is_mule) * (sum(is_mule) + 1) / 2e0) / (sum(is_mule) * (count(*) - sum(is_mule))) AS auc
 FROM auc_rows GROUP BY w""",
        "f1s": """SELECT w, max(f1) AS f1 FROM (SELECT b.w, t.i, 2e0 * count(*) FILTER (WHERE is_mule = 1 AND score >= 0.05e0 + t.i * 0.005e0)
 / (sum(is_mule) + count(*) FILTER (WHERE score >= 0.05e0 + t.i * 0.005e0)) AS f1 FROM blended b, (SELECT unnest(range(180)) AS i) t GROUP BY b.w, t.i) AS s GROUP BY w""",
    }


@query("y9_blend_grid", "w:i weight_a:f weight_b:f weight_c:f weight_x:f weight_cat:f auc:f f1:f", """
SELECT g.w, ga / 10e0 AS weight_a, gb / 10e0 AS weight_b, gc / 10e0 AS weight_c, gx / 10e0 AS weight_x, gcat / 10e0 AS weight_cat, u.auc, f.f1
FROM grid g JOIN aucs u ON g.w = u.w JOIN f1s f ON g.w = f.w""", _grid_views(10))
def _(d):
    return blend.blend_grid(d.member_scores)


@query("y9_best_weights", "metric w:i weight_a:f weight_b:f weight_c:f weight_x:f weight_cat:f value:f", """
WITH whole AS (SELECT g.*, u.auc, f.f1 FROM grid g JOIN aucs u ON g.w = u.w JOIN f1s f ON g.w = f.w)
SELECT metric, w, ga / 10e0 AS weight_a, gb / 10e0 AS weight_b, gc / 10e0 AS weight_c, gx / 10e0 AS weight_x, gcat / 10e0 AS weight_cat, value
FROM ((SELECT 'auc' AS metric, *, auc AS value FROM whole ORDER BY auc DESC, w LIMIT 1)
 UNION ALL (SELECT 'f1', *, f1 FROM whole ORDER BY f1 DESC, w LIMIT 1)) AS best""", _grid_views(10))
def _(d):
    return blend.best_weights(blend.blend_grid(d.member_scores))


# ---------------------------------------------------------------- E: metrics
SCORE_VIEWS = {
    "scored": "SELECT s.account_id, l.is_mule, s.score FROM scores s JOIN acct_labels l ON s.account_id = l.account_id",
    "sweep": """SELECT t.i, count(*) FILTER (WHERE hit AND is_mule = 1) * 1e0 AS tp, count(*) FILTER (WHERE hit AND is_mule = 0) * 1e0 AS fp,
 count(*) FILTER (WHERE NOT hit AND is_mule = 1) * 1e0 AS fn, count(*) FILTER (WHERE NOT hit AND is_mule = 0) * 1e0 AS tn
 FROM (SELECT s.is_mule, t.i, s.score >= 0.05e0 + t.i * 0.005e0 AS hit FROM scored s, (SELECT unnest(range(180)) AS i) t) AS t GROUP BY t.i""",
    "curve": """SELECT i AS step, round(0.05e0 + i * 0.005e0, 3) AS threshold, 2 * tp / (2 * tp + fp + fn) AS f1,
 CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, tp / (tp + fn) AS recall,
 CASE WHEN (tp + fp) * (tn + fn) > 0 THEN (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0 END AS mcc,
 (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_acc, tp + fp AS flags FROM sweep""",
}


def _scored(d):
    return d.scores.join(d.acct_labels.select("account_id", "is_mule"), "account_id")


@query("e_1_roc_auc", "auc:f", """
SELECT sum(CASE WHEN p.score > q.score THEN 1e0 WHEN p.score = q.score THEN 0.5e0 ELSE 0e0 END) / count(*) AS auc
FROM (SELECT score FROM scored WHERE is_mule = 1) p, (SELECT score FROM scored WHERE is_mule = 0) q""", SCORE_VIEWS)
def _(d):
    return metrics.roc_auc(_scored(d))


@query("e_2_average_precision", "pr_auc:f", """
SELECT sum(pos * cum_pos / cum_all) / max(total) AS pr_auc FROM (SELECT pos, sum(pos) OVER (ORDER BY score DESC) AS cum_pos,
 sum(k) OVER (ORDER BY score DESC) AS cum_all, sum(pos) OVER () AS total FROM (SELECT score, CAST(sum(is_mule) AS DOUBLE) AS pos,
 CAST(count(*) AS DOUBLE) AS k FROM scored GROUP BY score) AS c) AS r""", SCORE_VIEWS)
def _(d):
    return metrics.average_precision(_scored(d))


SWEEP_COLUMNS = "step:i threshold:f f1:f precision:f recall:f mcc:f balanced_acc:f flags:i"


@query("e_3_threshold_sweep", SWEEP_COLUMNS, "SELECT * FROM curve", SCORE_VIEWS)
def _(d):
    return metrics.threshold_sweep(_scored(d))


@query("e_3_best_threshold", "best_threshold:f best_f1:f best_precision:f best_recall:f best_mcc:f best_balanced_acc:f best_threshold_flags:i", """
SELECT threshold AS best_threshold, f1 AS best_f1, precision AS best_precision, recall AS best_recall, mcc AS best_mcc,
 balanced_acc AS best_balanced_acc, flags AS best_threshold_flags FROM curve ORDER BY f1 DESC, step LIMIT 1""", SCORE_VIEWS)
def _(d):
    return metrics.best_threshold(metrics.threshold_sweep(_scored(d)))


@query("e_4_precision_recall_at", "cut k:i precision:f recall:f", """
WITH ranked AS (SELECT is_mule, row_number() OVER (ORDER BY score DESC, account_id) AS rn FROM scored),
sizes AS (SELECT count(*) AS n, sum(is_mule) AS p FROM scored),
cuts AS (SELECT '1pct' AS cut, greatest(round_even(n * 0.01e0, 0), 1) AS k, p FROM sizes UNION ALL SELECT '2pct', greatest(round_even(n * 0.02e0, 0), 1), p FROM sizes
 UNION ALL SELECT '5pct', greatest(round_even(n * 0.05e0, 0), 1), p FROM sizes UNION ALL SELECT '10pct', greatest(round_even(n * 0.1e0, 0), 1), p FROM sizes
 UNION ALL SELECT 'Npos', greatest(p, 1), p FROM sizes)
SELECT c.cut, c.k, avg(r.is_mule) AS precision, sum(r.is_mule) * 1e0 / max(c.p) AS recall FROM cuts c JOIN ranked r ON r.rn <= c.k GROUP BY c.cut, c.k""",
       SCORE_VIEWS)
def _(d):
    return metrics.precision_recall_at(_scored(d))


LONG_SCORES = {
    "members": "\nUNION ALL ".join(
        f"SELECT account_id, is_mule, '{m}' AS model, {m} AS score FROM member_scores" for m in blend.MEMBERS),
    "ordered": """SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, account_id) AS rn,
 sum(is_mule) OVER (PARTITION BY model) AS p, count(*) OVER (PARTITION BY model) AS k,
 rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2e0 AS rk FROM members""",
    "steps": """SELECT model, score, CAST(sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS DOUBLE) AS cum_pos, pos,
 sum(k) OVER (PARTITION BY model ORDER BY score DESC) AS cum_all, sum(pos) OVER (PARTITION BY model) AS total
 FROM (SELECT model, score, sum(is_mule) AS pos, count(*) AS k FROM members GROUP BY model, score) AS c""",
    "areas": "SELECT model, sum(pos * cum_pos / cum_all) / max(total) AS pr_auc FROM steps GROUP BY model",
    "cutoffs": """SELECT model, i, 2e0 * count(*) FILTER (WHERE is_mule = 1 AND score >= 0.05e0 + i * 0.005e0)
 / (sum(is_mule) + count(*) FILTER (WHERE score >= 0.05e0 + i * 0.005e0)) AS f1
 FROM members, (SELECT unnest(range(180)) AS i) t GROUP BY model, i""",
    "chosen": "SELECT model, f1, i FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, i) AS r FROM cutoffs) AS q WHERE r = 1",
}


@query("e_5_model_metrics_report", "model auc:f pr_auc:f best_threshold:f best_f1:f precision_at_5pct:f recall_at_Npos:f", """
SELECT o.model, (sum(o.rk) FILTER (WHERE o.is_mule = 1) - max(o.p) * (max(o.p) + 1) / 2e0) / (max(o.p) * (max(o.k) - max(o.p))) AS auc,
 max(a.pr_auc) AS pr_auc, round(0.05e0 + max(c.i) * 0.005e0, 3) AS best_threshold, max(c.f1) AS best_f1,
 avg(o.is_mule) FILTER (WHERE o.rn <= greatest(round_even(o.k * 0.05e0, 0), 1)) AS precision_at_5pct,
 sum(o.is_mule) FILTER (WHERE o.rn <= o.p) * 1e0 / max(o.p) AS recall_at_Npos
FROM ordered o JOIN areas a ON o.model = a.model JOIN chosen c ON o.model = c.model GROUP BY o.model""", LONG_SCORES)
def _(d):
    return metrics.model_metrics_report(d.member_scores, blend.MEMBERS)


@query("e_6_pairwise_correlation", "model_a model_b correlation:f", "\nUNION ALL ".join(
    f"SELECT '{a}' AS model_a, '{b}' AS model_b, corr({a}, {b}) AS correlation FROM member_scores"
    for i, a in enumerate(blend.MEMBERS) for b in blend.MEMBERS[i + 1:]))
def _(d):
    return metrics.pairwise_correlation(d.member_scores, blend.MEMBERS)


# ---------------------------------------------------------------- B-1
@query("b_1_balanced_sample", "account_id is_mule:i", """
SELECT account_id, is_mule FROM (SELECT account_id, is_mule, row_number() OVER (PARTITION BY is_mule ORDER BY md5('42:' || account_id), account_id) AS rn
 FROM acct_labels) AS s WHERE rn <= CASE WHEN is_mule = 1 THEN 8 ELSE 20 END""")
def _(d):
    return blend.balanced_sample(d.acct_labels, 8, 20)


# ---------------------------------------------------------------- models: rows only
def _features(d):
    """The whole feature matrix, stored once per application."""
    if "model_matrix" not in d.__dict__:
        d.__dict__["model_matrix"] = stage_table(build_features(d.tx, d.ext, _dimensions(d), hot=d.hot), "model-matrix")
    return d.__dict__["model_matrix"]


def _model_inputs(d):
    features = _features(d)
    labelled = features.join(_dated(d), "account_id")
    test = features.join(d.test_accounts, "account_id", "left_semi")
    return labelled, test, encoding.code_counts(d.ledger)


def _oof(d):
    """Out-of-fold scores of the published members, once per application."""
    if "oof" not in d.__dict__:
        labelled, _, counts = _model_inputs(d)
        d.__dict__["oof"] = stage_table(members.oof_predictions(labelled, counts, BEHAVIOURAL_FEATURES, members.MEMBER_SPECS), "oof")
    return d.__dict__["oof"]


def _refit(d):
    """Stored nodes and test scores of the published members on the whole matrix, once per application."""
    if "refit" not in d.__dict__:
        labelled, test, counts = _model_inputs(d)
        nodes, scores = members.refit_and_score(labelled, test, counts, BEHAVIOURAL_FEATURES, members.MEMBER_SPECS)
        d.__dict__["refit"] = nodes, stage_table(scores, "test-scores")
    return d.__dict__["refit"]


@query("y5_train_members", "model tree:i node:i feature cut:f left_node:i right_node:i gain:f value:f")
def _(d):
    return _refit(d)[0]


@query("y6_oof_predictions", "account_id is_mule:i fold:i a:f b:f c:f x:f cat:f")
def _(d):
    return _oof(d)


@query("y7_refit_and_score", "account_id a:f b:f c:f x:f cat:f")
def _(d):
    return _refit(d)[1]


def _importances(d):
    nodes, _ = _refit(d)
    labelled, _, counts = _model_inputs(d)
    long = members.member_importances(nodes, members.explained(labelled, counts), BEHAVIOURAL_FEATURES, members.MEMBER_SPECS)
    return blend.importance_table(long, dict(zip(blend.MEMBERS, blend.BEST_F1_WEIGHTS)))


@query("b_2_importance_table", "feature importance:f rank:i")
def _(d):
    return _importances(d)


# What holds for any fit, row by row: who is scored, in which fold, within which range, and which trees may come out.
def _in_range(names):
    within = F.lit(True)
    for name in names:
        within = within & F.col(name).between(0, 1)
    return F.coalesce(within, F.lit(False))


@query("y6_oof_rows", "account_id fold:i is_mule:i in_range", """
SELECT account_id, fold, is_mule, true AS in_range FROM fold_rows
WHERE part = 'val' AND fold IN (SELECT fold FROM fold_rows WHERE part = 'val' GROUP BY fold HAVING sum(is_mule) > 0)""", {"fold_rows": FOLD_ROWS})
def _(d):
    return _oof(d).withColumn("in_range", _in_range(blend.MEMBERS))


@query("y7_scored_accounts", "account_id in_range", "SELECT account_id, true AS in_range FROM test_accounts")
def _(d):
    return _refit(d)[1].withColumn("in_range", _in_range(blend.MEMBERS))


@query("y5_tree_limits", "model within_rounds within_leaves whole_trees is_symmetric", "\nUNION ALL ".join(
    f"SELECT '{s.name}' AS model, true AS within_rounds, true AS within_leaves, true AS whole_trees, {str(s.symmetric).lower()} AS is_symmetric"
    for s in members.MEMBER_SPECS))
def _(d):
    nodes = _refit(d)[0].where("tree >= 0")
    leaf = F.col("feature").isNull()
    per_tree = nodes.groupBy("model", "tree").agg(F.count_if(leaf).alias("leaves"), F.count("*").alias("nodes"), F.max("node").alias("last"))
    levels = nodes.where(~leaf).groupBy("model", "tree", F.floor(F.log2(F.col("node") + 1)).alias("level")).agg(
        F.countDistinct("feature", "cut").alias("splits")).groupBy("model").agg((F.max("splits") == 1).alias("symmetric"))
    limits = F.create_map(*[F.lit(x) for s in members.MEMBER_SPECS for x in (s.name, s.leaves or 2 ** s.depth)])
    rounds = F.create_map(*[F.lit(x) for s in members.MEMBER_SPECS for x in (s.name, s.rounds)])
    models = d.spark.createDataFrame([(s.name, s.symmetric) for s in members.MEMBER_SPECS], "model string, published boolean")
    return models.join(per_tree.groupBy("model").agg(
        F.max("tree").alias("trees"), F.max("leaves").alias("leaves"),
        F.min((F.col("nodes") == 2 * F.col("leaves") - 1) & (F.col("last") == F.col("nodes") - 1)).alias("whole")), "model", "left").join(
        levels, "model", "left").select(
        "model", (F.coalesce("trees", F.lit(0)) < rounds[F.col("model")]).alias("within_rounds"),
        (F.coalesce("leaves", F.lit(1)) <= limits[F.col("model")]).alias("within_leaves"), F.coalesce("whole", F.lit(True)).alias("whole_trees"),
        (F.col("published") & F.coalesce("symmetric", F.lit(False))).alias("is_symmetric"))


@query("b_2_ranked_features", "feature in_range", "\nUNION ALL ".join(
    f"SELECT '{name}' AS feature, true AS in_range" for name in (*BEHAVIOURAL_FEATURES, ENCODED_FEATURE)))
def _(d):
    table = _importances(d)
    n = len(BEHAVIOURAL_FEATURES) + 1
    return table.select("feature", ((F.col("importance") >= 0) & F.col("rank").between(1, n)).alias("in_range"))


# From out-of-fold scores to the report and the weights, on the members' own scores.
@query("e_5_oof_report", "model auc:f pr_auc:f best_threshold:f best_f1:f precision_at_5pct:f recall_at_Npos:f")
def _(d):
    return metrics.model_metrics_report(_oof(d), blend.MEMBERS)


@query("y9_oof_best_weights")
def _(d):
    return blend.best_weights(blend.blend_grid(_oof(d)))


# ---------------------------------------------------------------- D: decisions
@query("d_1_score_sheet", "account_id is_mule:f suspicious_start suspicious_end", """
SELECT t.account_id, least(greatest(s.score * 1.2e0 - 0.1e0, 0), 1) AS is_mule, '' AS suspicious_start, '' AS suspicious_end
FROM test_accounts t LEFT JOIN scores s ON t.account_id = s.account_id""")
def _(d):
    raw = d.scores.withColumn("score", F.col("score") * 1.2 - 0.1)
    return decision.score_sheet(d.test_accounts, raw)


@query("d_1_score_percentiles", "p50:f p90:f p95:f p99:f", """
SELECT quantile_cont(score, 0.5) AS p50, quantile_cont(score, 0.9) AS p90, quantile_cont(score, 0.95) AS p95, quantile_cont(score, 0.99) AS p99 FROM scores""")
def _(d):
    return decision.score_percentiles(d.scores.withColumnRenamed("score", "is_mule"))


WINDOW_VIEWS = {
    "attached": """SELECT s.account_id, s.is_mule, s.is_mule >= 0.3 AS ok, s.is_mule >= 0.495 AS sure, w.window_end - w.window_start + 1 AS old_days,
 CASE WHEN s.is_mule >= 0.3 THEN w.window_start END AS d1, CASE WHEN s.is_mule >= 0.3 THEN w.window_end END AS d2, w.near_zero_end AS nz
 FROM window_scores s LEFT JOIN windows w ON s.account_id = w.account_id""",
    "targets": """SELECT *, CASE WHEN is_mule >= 0.995 THEN 21 WHEN is_mule >= 0.98 THEN 28 WHEN is_mule >= 0.95 THEN 35 WHEN is_mule >= 0.8 THEN 45
 WHEN is_mule >= 0.5 THEN 60 END AS target, CASE WHEN abs(d2 - nz) <= 14 THEN nz ELSE d2 END AS safe_end FROM attached""",
    "moved": """SELECT *, CASE WHEN ok AND d1 IS NOT NULL AND safe_end IS NOT NULL AND target IS NOT NULL
 THEN greatest(d1, safe_end - (target - 1)) ELSE d1 END AS start1 FROM targets""",
    "tight": """SELECT *, CASE WHEN ok AND d1 IS NOT NULL AND safe_end IS NOT NULL AND target IS NOT NULL AND coalesce(old_days, 0) >= 21
 AND safe_end - start1 + 1 < 14 THEN safe_end - 13 ELSE start1 END AS safe_start FROM moved""",
    "finished": """SELECT *, safe_end - safe_start + 1 AS new_days, CASE WHEN safe_start > d1 THEN 1 ELSE 0 END AS changed FROM tight""",
}


def _attached(d):
    return decision.attach_windows(d.window_scores, d.windows, "window_start", "window_end")


@query("d_3_attach_windows", "account_id is_mule:f window_candidate:i high_confidence:i old_window_days:i start_text end_text", """
SELECT account_id, is_mule, ok::INT AS window_candidate, sure::INT AS high_confidence, old_days AS old_window_days,
 coalesce(strftime(CAST(d1 AS TIMESTAMP), '%Y-%m-%dT00:00:00'), '') AS start_text,
 coalesce(strftime(CAST(d2 AS TIMESTAMP), '%Y-%m-%dT23:59:59'), '') AS end_text FROM attached""", WINDOW_VIEWS)
def _(d):
    full = _attached(d)
    text = decision.window_sheet(full).select(
        "account_id", F.col("suspicious_start").alias("start_text"), F.col("suspicious_end").alias("end_text"))
    return full.join(text, "account_id")


@query("d_4_tighten_windows", "account_id target_window_days:i start_day:i end_day:i seed_window_days:i changed:i", """
SELECT account_id, target AS target_window_days, safe_start - DATE '1970-01-01' AS start_day, safe_end - DATE '1970-01-01' AS end_day,
 new_days AS seed_window_days, changed FROM finished""", WINDOW_VIEWS)
def _(d):
    return decision.tighten_windows(_attached(d)).withColumns(
        {"start_day": F.unix_date("safe_start"), "end_day": F.unix_date("safe_end")})


@query("d_5_window_diagnostics", "length candidates:i changed:i mean:f std:f min:f max:f p25:f p50:f p75:f", "\nUNION ALL ".join(f"""
SELECT '{n}' AS length, count(*) AS candidates, sum(changed) AS changed, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max,
 quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75 FROM finished WHERE ok AND old_days IS NOT NULL"""
    for n, c in (("old", "old_days"), ("new", "new_days"))), WINDOW_VIEWS)
def _(d):
    return decision.window_diagnostics(decision.tighten_windows(_attached(d)))
