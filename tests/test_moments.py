"""Merged moments against plain statistics."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerlens.functions.moments import Moments, column_statistics, moments, pair_correlations


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_merged_states_equal_the_whole(parts):
    rng = np.random.default_rng(parts)
    values = rng.normal(size=(90, 4)) * [1, 1e-3, 50, 1] + [0, 1e6, -5, 3]
    values[:, 3] = 3
    known = rng.random((90, 4)) < 0.8
    known[:30, 2] = False  # a part without any value of a column
    state = Moments(4)
    for v, k in zip(np.array_split(values, parts), np.array_split(known, parts)):
        state.merge((lambda m: m.add(v, k) or m)(Moments(4)))
    n, mean, square = state.spread()
    for i in range(4):
        own = values[known[:, i], i]
        assert (n[i], mean[i]) == (len(own), pytest.approx(own.mean())) and square[i] == pytest.approx(((own - own.mean()) ** 2).sum(), rel=1e-6, abs=1e-9)
    found = state.correlations()
    for i in range(3):
        for j in range(3):
            both = known[:, i] & known[:, j]
            assert found[i, j] == pytest.approx(np.corrcoef(values[both, i], values[both, j])[0, 1], abs=1e-6)
    assert not np.isfinite(found[0, 3]) and state.rows == 90 and (state.nulls == (~known).sum(axis=0)).all()


def test_nulls_nans_and_infinities(spark):
    rows = [(1, 1.0, None, 2.0), (1, math.nan, 3.0, 4.0), (0, 2.0, math.inf, 6.0), (0, None, 5.0, 9.0), (None, 4.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "y int, a double, b double, c double").repartition(3)
    got = {r.feature: r for r in column_statistics(moments(df, "abc"), "abc").collect()}
    assert [(got[f].rows, got[f].nulls, got[f].nans, got[f].infinities, got[f].n) for f in "abc"] == [(5, 1, 1, 0, 4), (5, 1, 0, 1, 4), (5, 0, 0, 0, 5)]
    assert math.isnan(got["a"].mean) and got["c"].mean == pytest.approx(4.4)
    by = {(r.cls, r.feature): r for r in column_statistics(moments(df, "abc", "y"), "abc").collect()}
    assert by[1, "c"].mean == 3 and by[0, "c"].mean == 7.5 and by[None, "c"].n == 1 and by[None, "c"].std is None
    pairs = {(r.feature_a, r.feature_b): r.correlation for r in pair_correlations(moments(df, "abc"), "abc").collect()}
    assert set(pairs) == {("a", "b"), ("a", "c"), ("b", "c")} and math.isnan(pairs["a", "c"])


def test_empty_frame_and_odd_names(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0)], ["x.y", "_x0"])
    row = pair_correlations(moments(df, ["x.y", "_x0"]), ["x.y", "_x0"]).first()
    assert (row.feature_a, row.feature_b) == ("x.y", "_x0") and row.correlation == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])
    assert column_statistics(moments(df.limit(0), ["_x0"]), ["_x0"]).count() == 0
