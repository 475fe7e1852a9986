from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.columns import replace_inf
from ledgerlens.functions.ranks import global_rank, ranked_percentiles, running_totals

PROBS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def _values(kind: str, n: int) -> list[float]:
    rnd = random.Random(f"{kind}{n}")
    return {
        "uniform": lambda: [rnd.random() for _ in range(n)],
        "heavy": lambda: [math.exp(rnd.gauss(0, 6)) * rnd.choice((-1, 1)) for _ in range(n)],
        "crowded": lambda: [100 + rnd.random() * 1e-9 for _ in range(n)],
        "tied": lambda: [float(rnd.randint(-2, 2)) for _ in range(n)],
        "constant": lambda: [7.0] * n,
    }[kind]()


@pytest.mark.parametrize("kind", ["uniform", "heavy", "crowded", "tied", "constant"])
@pytest.mark.parametrize("n", [1, 2, 101])
def test_percentiles_match_numpy(spark, kind, n):
    values = _values(kind, n)
    df = spark.createDataFrame([("g", v) for v in values] + [("h", -v) for v in values] + [("g", None)],
                               "k string, v double")
    out = {r.k: r for r in ranked_percentiles(df, ["k"], "v", PROBS).collect()}
    for key, sign in (("g", 1), ("h", -1)):
        for name, p in PROBS.items():
            assert out[key][name] == pytest.approx(np.percentile(np.array(values) * sign, p * 100), rel=1e-12, abs=1e-12)


def test_percentiles_equal_builtin_without_group(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id") % 613).cast("double").alias("v"))
    ours = ranked_percentiles(df, [], "v", {"m": 0.37}).first().m
    assert ours == pytest.approx(df.agg(F.percentile("v", F.lit(0.37))).first()[0])


def test_running_totals_match_brute_force(spark):
    rnd = random.Random(5)
    rows = {(g, round(rnd.gauss(0, 100), 1)): rnd.randint(1, 9) for g in "abc" for _ in range(200)}
    rows[("a", math.inf)] = 3
    rows[("a", -math.inf)] = 4
    df = spark.createDataFrame([(g, v, n) for (g, v), n in rows.items()], "g string, v double, n int")
    for r in running_totals(df, ["g"], "v", {"below": "n"}).collect():
        mine = [(v, n) for (g, v), n in rows.items() if g == r.g]
        assert r.below == sum(n for v, n in mine if v < r.v)
        assert r.below_total == sum(n for _, n in mine)


def test_global_rank_is_a_permutation_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("a"), F.col("id").cast("string").alias("b"))
    got = [(r["rank"], r.a, r.b) for r in global_rank(df.repartition(7), [F.desc("a"), F.asc("b")]).collect()]
    want = sorted(((a, b) for _, a, b in got), key=lambda x: (-x[0], x[1]))
    assert [(a, b) for _, a, b in sorted(got)] == want
    assert sorted(r for r, _, _ in got) == list(range(1, 5001))


def test_replace_inf_uses_quantiles_of_the_whole_column(spark):
    values = [float(i) for i in range(1, 999)] + [math.inf, -math.inf]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "account_id string, x double")
    got = {r.account_id: r.x for r in replace_inf(df, ["x"]).collect()}
    assert got["998"] == pytest.approx(np.quantile(values, 0.99))
    assert got["999"] == pytest.approx(np.quantile(values, 0.01))
    zeroed = {r.account_id: r.x for r in replace_inf(df, ["x"], high=None, low=None).collect()}
    assert zeroed["998"] == zeroed["999"] == 0.0


def test_nan_is_the_largest_value(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "x double")
    got = ranked_percentiles(df, [], "x", {"p50": 0.5, "p100": 1.0}).first()
    assert got.p50 == 2.5 and got.p100 != got.p100


def test_rows_without_a_score_count_nowhere(spark):
    from ledgerlens.operators import metrics
    rows = [("a", 1, 0.9), ("b", 0, 0.1), ("c", 1, None), ("d", 0, float("nan"))]
    scores = spark.createDataFrame(rows, "account_id string, is_mule int, score double")
    assert metrics.roc_auc(scores).first().auc == 1.0
    sweep = {r.step: r for r in metrics.threshold_sweep(scores).collect()}
    assert sweep[0].flags == 2 and sweep[179].flags == 0 and sweep[100].flags == 1
    assert {r.k for r in metrics.precision_recall_at(scores).where("cut = 'Npos'").collect()} == {1}


def test_nan_is_missing(spark):
    from ledgerlens.operators import assemble
    rows = [("a", 1.0, 5.0), ("b", float("nan"), None), ("c", None, float("nan")), ("d", 3.0, 1.0)]
    features = spark.createDataFrame(rows, "account_id string, x double, y double")
    filled = {r.account_id: (r.x, r.y) for r in assemble.impute(features, ["x"], {"y": 7.0}).collect()}
    assert filled == {"a": (1.0, 5.0), "b": (2.0, 7.0), "c": (2.0, 7.0), "d": (3.0, 1.0)}
    report = {r.feature: (r.nulls, r.nans, r.null_pct) for r in assemble.null_inf_report(features, ["x", "y"]).collect()}
    assert report == {"x": (1, 1, 50.0), "y": (1, 1, 50.0)}
    gate = {r.check_name: r.found for r in assemble.quality_gate(features, features.select("account_id")).collect()}
    assert gate["null_values"] == 4
