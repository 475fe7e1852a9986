"""Encoding, folds, models, blending: leakage and planted-signal checks, brute-force comparisons."""

from __future__ import annotations

import math
import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import assemble, audit, blend, encoding, members, metrics
from ledgerlens.schema import BEHAVIOURAL_FEATURES
from ledgerlens.sources import tables


def _auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p, n in product(pos, neg)) / (len(pos) * len(neg))


def _ap(pairs):
    total, area, caught, seen = sum(y for _, y in pairs), 0.0, 0, 0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        tied = [y for s, y in pairs if s == t]
        caught, seen = caught + sum(tied), seen + len(tied)
        area += sum(tied) / total * caught / seen
    return area


@pytest.mark.parametrize("levels", [3, 50, 10**6])
def test_ranking_metrics_against_brute_force(spark, levels):
    rnd = random.Random(levels)
    pairs = [(rnd.randint(0, levels) / levels, int(rnd.random() < 0.2)) for _ in range(300)]
    df = spark.createDataFrame([(str(i), y, s) for i, (s, y) in enumerate(pairs)], "account_id string, is_mule int, score double")
    row = metrics.ranking_metrics(df).first()
    assert row.auc == pytest.approx(_auc(pairs)) and row.pr_auc == pytest.approx(_ap(pairs))


def test_sweep_against_brute_force(spark):
    rnd = random.Random(1)
    pairs = [(round(rnd.random(), 3), int(rnd.random() < 0.3)) for _ in range(200)]
    df = spark.createDataFrame([("m", y, s) for s, y in pairs], "model string, is_mule int, score double")
    for r in metrics.threshold_sweep(df, ["model"]).collect():
        t = 0.05 + r.step * 0.005
        tp = sum(y for s, y in pairs if s >= t)
        flagged = sum(s >= t for s, _ in pairs)
        positives = sum(y for _, y in pairs)
        assert r.flags == flagged and r.recall == pytest.approx(tp / positives)
        assert r.f1 == pytest.approx(2 * tp / (flagged + positives))


def test_p_values_against_known_normal_tail(spark):
    rnd = random.Random(3)
    rows = [(str(i), int(i % 3 == 0), round(rnd.gauss(0.4 * (i % 3 == 0), 1), 1)) for i in range(240)]
    df = spark.createDataFrame(rows, "account_id string, is_mule int, x double")
    got = audit.mann_whitney(df, ["x"]).first()
    pos, neg = [v for _, y, v in rows if y], [v for _, y, v in rows if not y]
    u = sum((p > n) + 0.5 * (p == n) for p, n in product(pos, neg))
    m, n = len(pos), len(neg)
    values = [v for _, _, v in rows]
    ties = sum(k**3 - k for k in (values.count(v) for v in set(values)))
    sigma = math.sqrt(m * n / 12 * (m + n + 1 - ties / ((m + n) * (m + n - 1))))
    z = (abs(u - m * n / 2) - 0.5) / sigma
    assert got.u == pytest.approx(u) and got.p_value == pytest.approx(math.erfc(z / math.sqrt(2)))
    assert got.r == pytest.approx((u - m * n / 2) / math.sqrt(m * n * (m + n + 1) / 12))


def test_small_class_has_no_rank_test(spark):
    df = spark.createDataFrame([(str(i), int(i < 4), float(i)) for i in range(30)], "account_id string, is_mule int, x double")
    row = audit.mann_whitney(df, ["x"]).first()
    assert row.u is None and row.r is None and (row.p_value is None or math.isnan(row.p_value))


def test_validation_labels_do_not_reach_the_encoding(data):
    dated = data.acct_labels.select("account_id", "is_mule").join(
        data.accounts.select("account_id", "account_opening_date"), "account_id")
    counts = encoding.code_counts(data.ledger)
    late = F.col("account_opening_date") > F.lit("2023-06-30").cast("date")
    shuffled = dated.withColumn("is_mule", F.when(late, 1 - F.col("is_mule")).otherwise(F.col("is_mule")))

    def codes(df):
        train = df.where(F.col("account_opening_date") <= F.lit("2023-06-30").cast("date"))
        found = encoding.risky_codes(counts, train)
        return [(r.code, r.lift) for r in found.collect()]
    assert codes(dated) == codes(shuffled) and codes(dated)


def test_grid_size_and_order():
    grid = blend.weight_grid(5, 10)
    assert len(grid) == 1001 and grid[0] == (0, 0, 0, 0, 10) and grid[-1] == (10, 0, 0, 0, 0) and grid == sorted(grid)


@pytest.mark.parametrize("block", [500_000, 7])
def test_blend_grid_equals_metrics_of_each_blend(spark, monkeypatch, block):
    """Ties, scores on thresholds, rows without a score, and positives in several blocks."""
    monkeypatch.setattr(blend, "POSITIVES", block)
    rnd = random.Random(block)
    rows = [(int(rnd.random() < 0.3), rnd.randrange(21) / 20, rnd.randrange(5) / 4 if i % 17 else None, rnd.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "is_mule int, a double, b double, c double").repartition(3)
    got = {r.w: r for r in blend.blend_grid(df, ["a", "b", "c"], parts=4).collect()}
    assert len(got) == 15
    whole = df.where("b IS NOT NULL")
    for w, weights in list(enumerate(blend.weight_grid(3, 4)))[::4]:
        total = sum((F.col(m) * k for m, k in zip("abc", weights)), F.lit(0.0)) / 4
        one = whole.select("is_mule", total.alias("score"))
        assert got[w].auc == pytest.approx(metrics.roc_auc(one).first().auc, abs=1e-12)
        assert got[w].f1 == pytest.approx(metrics.threshold_sweep(one).agg(F.max("f1")).first()[0], abs=1e-12)
    plan = blend.blend_grid(df, ["a", "b", "c"], parts=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    assert blend.blend_grid(df.limit(0), ["a", "b", "c"], parts=4).count() == 0
    none = blend.blend_grid(df.where("is_mule = 0"), ["a", "b", "c"], parts=4).first()
    assert none.auc is None and none.f1 == 0


def test_blend_grid_finds_the_informative_member(spark):
    rnd = random.Random(9)
    rows = [(str(i), int(i % 4 == 0), *[rnd.randint(0, 64) / 64 for _ in range(2)], (0.75 if i % 4 == 0 else 0.25))
            for i in range(80)]
    df = spark.createDataFrame(rows, "account_id string, is_mule int, a double, b double, c double")
    grid = blend.blend_grid(df, ["a", "b", "c"], parts=4)
    assert grid.count() == 15
    best = {r.metric: r for r in blend.best_weights(grid).collect()}
    assert best["auc"].value == 1 and best["f1"].value == 1
    for r in grid.collect():
        pairs = [(r.weight_a * a + r.weight_b * b + r.weight_c * c, y) for _, y, a, b, c in rows]
        assert r.auc == pytest.approx(_auc(pairs))


def test_members_find_a_planted_signal(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        y = int(rnd.random() < 0.2)
        rows.append((f"{i:04d}", y, y + rnd.gauss(0, 0.35), rnd.random(), f"20{20 + i % 5}-{1 + i % 12:02d}-10"))
    df = spark.createDataFrame(rows, "account_id string, is_mule int, s double, noise double, account_opening_date string")
    codes = [(a, "M1" if y and rnd.random() < 0.8 else "M2", 3) for a, y, *_ in rows]
    counts = spark.createDataFrame(codes, "account_id string, code string, n long")
    specs = members.small_specs(2, 2)
    oof = members.oof_predictions(df, counts, ["s", "noise"], specs).toPandas()
    assert oof.account_id.is_unique and set(oof.fold) <= {0, 1, 2}
    assert _auc(list(zip(oof.a, oof.is_mule))) > 0.9 and _auc(list(zip(oof.x, oof.is_mule))) > 0.9


def test_balanced_sample_is_stable_and_capped(data):
    one = {tuple(r) for r in blend.balanced_sample(data.acct_labels.select("account_id", "is_mule"), 2, 3).collect()}
    two = {tuple(r) for r in blend.balanced_sample(data.acct_labels.select("account_id", "is_mule").repartition(5), 2, 3).collect()}
    assert one == two and sum(y for _, y in one) <= 2 and sum(1 - y for _, y in one) == 3


def test_importances_weighted_and_ranked(spark):
    df = spark.createDataFrame([("a", "f1", 1.0), ("a", "f2", 3.0), ("c", "f1", 10.0)], "model string, feature string, importance double")
    got = [(r.feature, r.importance, r["rank"]) for r in blend.importance_table(df, {"a": 0.5, "c": 0.1}).collect()]
    assert got == [("f1", pytest.approx(1.5), 1), ("f2", pytest.approx(1.5), 2)]


def test_duplicate_files(spark, tmp_path):
    contents = {"a": "id,v\n1,x\n2,y\n", "b": "id,v\n2,y\n1,x\n", "c": "id,v\n1,x\n2,y\n", "d": "id,v\n1,x\n2,z\n", "e": "id,v\n1,x\n1,x\n2,y\n"}
    for name, text in contents.items():
        (tmp_path / f"{name}.csv").write_text(text)
    same = tables.duplicate_bytes(spark, f"{tmp_path}/*.csv").collect()
    assert sorted((r.path[-5], r.files) for r in same) == [("a", 2), ("c", 2)]
    rows = spark.read.schema("id string, v string").option("header", True).csv(f"{tmp_path}/*.csv")
    alike = tables.duplicate_rows(rows).collect()
    assert sorted((r.path[-5], r.files) for r in alike) == [("a", 3), ("b", 3), ("c", 3)] and len({r.digest for r in alike}) == 1


def test_equal_bytes_in_blocks(spark, tmp_path):
    lines = [f"line {i} é\n" for i in range(2000)]
    swapped = [lines[1], lines[0], *lines[2:]]
    late = [*lines[:-2], lines[-1], lines[-2]]
    contents = {"a": lines, "b": lines, "c": swapped, "d": late, "e": late, "f": lines[:-1]}
    for name, text in contents.items():
        (tmp_path / f"{name}.csv").write_text("".join(text))
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.sources.binaryFile.maxLength")}
    try:
        for size in ("5k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")  # no file is read as one row
            same = tables.duplicate_bytes(spark, f"{tmp_path}/*.csv").collect()
            assert sorted((r.path[-5], r.files) for r in same) == [(x, 2) for x in "abde"] and len({r.digest for r in same}) == 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_inventory_counts_files_and_rows(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/batch-1")
    spark.range(5).repartition(1).write.parquet(f"{tmp_path}/batch-2")
    row = tables.table_inventory(spark, {"t": f"{tmp_path}/batch-*"}).first()
    assert (row.files, row.rows, row.columns, row.column_list) == (4, 15, 1, "id") and row.bytes > 0
    assert tables.read_ledger(spark, f"{tmp_path}/batch-*/part-*.parquet", ["id"]).count() == 15


def test_imputation_on_train_rows_only(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 3.0, 2), ("c", None, 4), ("d", 100.0, 4)], "account_id string, x double, y int")
    train = df.where("account_id IN ('a', 'b')")
    got = {r.account_id: r for r in assemble.impute(df, ["x"], {"y": 9}, fit_rows=train).collect()}
    assert got["c"].x == 2 and got["a"].y == 9 and got["d"].x == 100


def test_whole_scoring_plan(spark):
    from ledgerlens.plans.scoring import train_and_score
    rnd = random.Random(8)
    people = [(f"{i:04d}", int(rnd.random() < 0.25)) for i in range(300)]
    features = spark.createDataFrame([(a, y + rnd.gauss(0, 0.3), rnd.random()) for a, y in people],
                                     "account_id string, s double, noise double")
    labels = spark.createDataFrame(people[:240], "account_id string, is_mule int")
    test = spark.createDataFrame([(a,) for a, _ in people[240:]], "account_id string")
    accounts = spark.createDataFrame([(a, f"20{21 + i % 5}-03-{1 + i % 28:02d}") for i, (a, _) in enumerate(people)],
                                     "account_id string, account_opening_date string")
    counts = spark.createDataFrame([(a, f"M{i % 4}", 2) for i, (a, _) in enumerate(people)],
                                   "account_id string, code string, n long")
    specs = [s for s in members.small_specs(2, 2) if s.name in ("a", "c")]
    got = train_and_score(features, labels, accounts, test, counts, ["s", "noise"], specs, parts=2)
    assert got.grid.count() == 3 and sum(got.weights.values()) == pytest.approx(1) and 0.05 <= got.threshold < 0.95
    sheet = got.sheet.toPandas().set_index("account_id")
    truth = dict(people[240:])
    assert len(sheet) == 60 and _auc([(sheet.is_mule[a], y) for a, y in truth.items()]) > 0.9
    assert got.importances.first().feature == "s"
    assert {r.model for r in got.report.collect()} == {"a", "c", "blend"}


@pytest.mark.parametrize("name", ["y5_train_members", "y6_oof_predictions", "y7_refit_and_score", "b_2_importance_table"])
def test_model_queries_take_the_published_members(monkeypatch, data, name):
    """All features of the whole matrix, rounds and depths; the training itself is replaced."""
    from ledgerlens.catalog import scoring
    from ledgerlens.catalog.registry import REGISTRY

    class Stop(Exception):
        pass

    def caught(*args):
        raise Stop(args)

    monkeypatch.setattr(scoring, "stage_table", lambda df, name: df)
    monkeypatch.setattr(scoring, "build_features", lambda *_, **__: data.ids.select(
        "account_id", *[F.lit(0.0).alias(c) for c in BEHAVIOURAL_FEATURES]))
    for function in ("train_members", "oof_predictions", "refit_and_score"):
        monkeypatch.setattr(members, function, caught)
    data.__dict__.pop("model_matrix", None)
    try:
        with pytest.raises(Stop) as stopped:
            REGISTRY[name].build(data)
    finally:
        data.__dict__.pop("model_matrix", None)
    args = stopped.value.args[0]
    assert args[-1] == members.MEMBER_SPECS and tuple(args[-2]) == tuple(BEHAVIOURAL_FEATURES)
    assert set(BEHAVIOURAL_FEATURES) < set(args[0].columns)
