"""Boosted trees against plain versions: growing, ordered residuals, stored nodes, contributions."""

from __future__ import annotations

import math
from dataclasses import replace
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import boosting, members
from ledgerlens.operators.trees import NODES, Forest

LEAF, DEPTH, LEVEL = (next(s for s in members.MEMBER_SPECS if s.name == name) for name in ("a", "x", "cat"))


def matrix(n=150, f=4, missing=0.1, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, f)) / 4
    x[rng.random((n, f)) < missing] = np.nan
    score = np.nan_to_num(x[:, 0], nan=2.0) + np.nan_to_num(x[:, 1]) * (np.nan_to_num(x[:, 2]) > 1)
    label = (rng.random(n) < boosting.sigmoid(2 * score - 6)).astype(float)
    return x, label, np.where(label == 1, 3.0, 1.0)


def prepared(x, bins=boosting.BINS):
    edges = [boosting.edges_of(x[:, i], bins) for i in range(x.shape[1])]
    return edges, np.column_stack([boosting.codes_of(x[:, i], e) for i, e in enumerate(edges)])


def forest(x, label, weight, spec, seed=1):
    edges, codes = prepared(x, spec.bins)
    grow = boosting.symmetric if spec.symmetric else boosting.leaf_wise
    grown = grow(codes, np.array([len(e) for e in edges]), label, weight, spec, np.random.default_rng(seed))
    names = [f"f{i}" for i in range(x.shape[1])]
    start = boosting.Tree()
    start.add(next(grown), len(x))
    rows = members.node_rows(start, -1, names, edges)
    trees = list(grown)
    for number, tree in enumerate(trees):
        rows += members.node_rows(tree, number, names, edges)
    nodes = pd.DataFrame(rows, columns=[c.split()[0] for c in NODES.split(", ")][1:])
    return Forest(nodes, names), trees, names


def plain_margins(x, label, weight, spec):
    """All rows and features, every cut between neighbouring values and both ways for missing ones, summed row by row."""
    share = (weight * label).sum() / weight.sum()
    margin = np.full(len(x), math.log(share / (1 - share)))

    def score(g, h):
        return max(abs(g) - spec.l1, 0) ** 2 / (h + spec.l2)

    def best(rows, g, h):
        found = None
        for f in range(x.shape[1]):
            v = x[rows, f]
            known = sorted(set(v[~np.isnan(v)]))
            everywhere = sorted(set(x[~np.isnan(x[:, f]), f]))
            for missing_left in (False, True):
                for low, high in zip(everywhere, everywhere[1:]):
                    left = (v <= (low + high) / 2) | (np.isnan(v) & missing_left)
                    parts = rows[left], rows[~left]
                    if not known or any(len(p) < spec.min_rows or h[p].sum() < spec.min_hessian for p in parts):
                        continue
                    gain = sum(score(g[p].sum(), h[p].sum()) for p in parts) - score(g[rows].sum(), h[rows].sum())
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = gain, parts
        return found

    for _ in range(spec.rounds):
        p = boosting.sigmoid(margin)
        g, h = weight * (p - label), weight * p * (1 - p)
        leaves = [(np.arange(len(x)), 0)]
        while not spec.leaves or len(leaves) < spec.leaves:
            options = [(best(rows, g, h), i) for i, (rows, depth) in enumerate(leaves) if not spec.depth or depth < spec.depth]
            options = [(o[0], i, o[1]) for o, i in options if o]
            if not options:
                break
            _, i, parts = max(options, key=lambda o: o[0])
            depth = leaves.pop(i)[1]
            leaves += [(part, depth + 1) for part in parts]
        for rows, _ in leaves:
            total = g[rows].sum()
            margin[rows] -= spec.rate * math.copysign(max(abs(total) - spec.l1, 0), total) / (h[rows].sum() + spec.l2)
    return margin


@pytest.mark.parametrize("spec", [
    replace(LEAF, rounds=4, leaves=6, min_rows=8, feature_share=1.0), replace(DEPTH, rounds=4, depth=3, min_hessian=2.0, feature_share=1.0, row_every=0),
    replace(LEAF, rounds=3, leaves=4, min_rows=1, feature_share=1.0, l1=0.0)], ids=["leaves", "depth", "no-l1"])
@pytest.mark.parametrize("missing", [0.0, 0.2])
def test_leaf_wise_equals_a_plain_version(spec, missing):
    x, label, weight = matrix(missing=missing)
    got, trees, _ = forest(x, label, weight, spec)
    assert len(trees) == spec.rounds
    np.testing.assert_allclose(got.margin(x), plain_margins(x, label, weight, spec), atol=1e-9)


def test_leaf_limit_and_least_rows():
    x, label, weight = matrix(600)
    _, trees, _ = forest(x, label, weight, replace(LEAF, rounds=10, leaves=7, min_rows=40))
    for tree in trees:
        leaves = [i for i, left in enumerate(tree.left) if left < 0]
        assert len(leaves) <= 7 and min(tree.cover[i] for i in leaves) >= 40
    _, trees, _ = forest(x[:60], label[:60], weight[:60], replace(LEAF, rounds=10))
    assert trees == []  # 60 rows cannot make two leaves of 100: the fit stops


def test_depth_and_sampled_rows():
    x, label, weight = matrix(400)
    got, trees, _ = forest(x, label, weight, replace(DEPTH, rounds=12, depth=2, min_hessian=1.0))
    assert got.depth <= 2 and len(trees) == 12
    assert all(tree.cover[0] < 400 for tree in trees) and len({tree.cover[0] for tree in trees}) > 3


def test_missing_values_go_the_better_way():
    x = np.array([[1.0]] * 20 + [[2.0]] * 20 + [[np.nan]] * 20)
    weight = np.ones(60)
    for label, way in ((np.repeat([0.0, 1.0, 0.0], 20), True), (np.repeat([0.0, 1.0, 1.0], 20), False)):
        _, trees, _ = forest(x, label, weight, replace(DEPTH, rounds=1, min_hessian=0.1, row_every=0))
        assert trees[0].missing_left[0] is way


def test_edges_and_codes():
    assert boosting.edges_of(np.array([np.nan, np.nan])).size == 0
    assert list(boosting.edges_of(np.array([3.0, 1.0, np.nan, 1.0, 2.0]))) == [1.5, 2.5]
    assert list(boosting.codes_of(np.array([np.nan, 1.0, 1.5, 1.6, 9.0]), np.array([1.5, 2.5]))) == [0, 1, 1, 2, 3]
    rng = np.random.default_rng(0)
    many = rng.normal(size=5000)
    edges = boosting.edges_of(many, 16)
    sizes = np.bincount(boosting.codes_of(many, edges))[1:]
    assert len(edges) == 15 and sizes.max() - sizes.min() <= 2
    close = np.array([1.0, np.nextafter(1.0, 2.0)])
    assert list(boosting.codes_of(close, boosting.edges_of(close))) == [1, 2]


def test_no_residual_has_seen_its_own_label():
    """With the trees' leaves given, a row's label moves no residual margin of its own, at any place of the order and in any round."""
    rng = np.random.default_rng(3)
    n, leaves = 37, [rng.integers(0, 4, 37) for _ in range(6)]
    label, weight = (rng.random(n) < 0.4).astype(float), rng.random(n) + 0.5

    def run(y):
        ordered, seen = boosting.Ordered(y, weight, 5.0, 0.05), []
        for leaf in leaves:
            seen.append(ordered.unseen())
            ordered.update(leaf, 4)
        return np.array(seen)

    base = run(label)
    for row in range(n):
        other = label.copy()
        other[row] = 1 - other[row]
        changed = run(other)
        assert (changed[:, row] == base[:, row]).all()
        assert (changed[:, :row] == base[:, :row]).all()  # nor does it reach rows before it
    other = label.copy()
    other[0] = 1 - other[0]
    assert not np.allclose(run(other)[1:, 1:], base[1:, 1:])


def test_kept_tree_is_a_newton_step_of_all_rows():
    x, label, weight = matrix(200)
    spec = replace(LEVEL, rounds=5, depth=3)
    got, trees, _ = forest(x, label, weight, spec)
    margin = np.zeros(200)
    for number, tree in enumerate(trees):
        inner = 7
        assert len(tree.left) == 15 and all(len({(tree.feature[i], tree.cut[i]) for i in level}) == 1 for level in ([0], [1, 2], [3, 4, 5, 6]))
        edges, codes = prepared(x, spec.bins)
        leaf = np.zeros(200, int)
        for node in (0, 1, 3):
            leaf = 2 * leaf + (codes[:, tree.feature[node]] > tree.cut[node])
        p = boosting.sigmoid(margin)
        for k in range(8):
            own = leaf == k
            want = -spec.rate * (weight * (p - label))[own].sum() / ((weight * p * (1 - p))[own].sum() + spec.l2)
            assert tree.value[inner + k] == pytest.approx(want, abs=1e-12)
        margin += np.array(tree.value[inner:])[leaf]
    np.testing.assert_allclose(got.margin(x), margin, atol=1e-9)


@pytest.mark.parametrize("spec", [replace(LEAF, rounds=3, leaves=6, min_rows=5), replace(DEPTH, rounds=3, depth=3, min_hessian=1.0),
                                  replace(LEVEL, rounds=2, depth=3)], ids=["leaves", "depth", "levels"])
def test_contributions_equal_the_enumeration_of_coalitions(spec):
    x, label, weight = matrix(120, 4, 0.15)
    got, _, _ = forest(x, label, weight, spec)

    def value(row, known, node):
        if not got.inner[node]:
            return got.value[node]
        f, v = got.feature[node], row[got.feature[node]]
        if f in known:
            left = v <= got.cut[node] or (math.isnan(v) and got.missing[node])
            return value(row, known, got.left[node] if left else got.right[node])
        return sum(got.cover[c] / got.cover[node] * value(row, known, c) for c in (got.left[node], got.right[node]))

    n = x.shape[1]
    for i in range(0, 120, 17):
        def game(known):
            return got.base + sum(value(x[i], known, root) for root in got.roots)
        want = [sum(math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (game({*s, f}) - game(set(s)))
                    for k in range(n) for s in combinations([j for j in range(n) if j != f], k)) for f in range(n)]
        np.testing.assert_allclose(got.contributions(x[i:i + 1])[0], want, atol=1e-9)
    np.testing.assert_allclose(got.contributions(x).sum(axis=1) + got.expected(), got.margin(x), atol=1e-9)


def test_trees_without_a_split():
    x, label, weight = matrix(30)
    got, trees, _ = forest(x, label, weight, replace(DEPTH, rounds=2, min_hessian=1e9))
    assert len(trees) == 2 and got.depth == 0 and len(set(got.margin(x))) == 1
    assert not got.contributions(x).any() and got.expected() == pytest.approx(got.margin(x)[0])


@pytest.fixture(scope="module")
def people(spark):
    x, label, _ = matrix(300, 3)
    rows = [(f"{i:04d}", i % 2, int(y), *[None if math.isnan(v) else float(v) for v in r], 0.25 * (i % 3)) for i, (r, y) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "account_id string, fold int, is_mule int, f0 double, f1 double, f2 double, risky_mcc_share double")


SMALL = members.small_specs(4, 3)
FEATURES = ["f0", "f1", "f2"]


def test_every_fold_and_member_is_fitted(spark, people):
    nodes = members.fit_members(people, FEATURES, SMALL)
    seen = nodes.groupBy("fold", "model").agg(F.countDistinct("tree").alias("n")).collect()
    assert {(r.fold, r.model) for r in seen} == {(f, s.name) for f in (0, 1) for s in SMALL} and {r.n for r in seen} == {5}
    again = members.fit_members(people.repartition(7), FEATURES, SMALL)
    assert sorted(map(repr, nodes.collect())) == sorted(map(repr, again.collect()))  # whatever the partitions
    names = {r.feature for r in nodes.where("model IN ('a', 'b') AND feature IS NOT NULL").select("feature").distinct().collect()}
    assert names <= set(FEATURES)


def test_scores_come_from_the_stored_nodes(spark, people):
    train = people.where("fold = 0")
    nodes = members.train_members(train.drop("fold"), FEATURES, SMALL)
    got = {r.account_id: r for r in members.score_members(nodes, train, FEATURES, SMALL).collect()}
    frame = train.toPandas().sort_values("account_id")
    label = frame.is_mule.to_numpy(float)
    weight = np.where(label == 1, (label == 0).sum() / label.sum(), 1.0)
    for spec in SMALL:
        x = frame[[*FEATURES, "risky_mcc_share"][:4 if spec.encoded else 3]].to_numpy(float)
        names = [*FEATURES, "risky_mcc_share"][:x.shape[1]]
        edges, codes = prepared(x, spec.bins)
        grow = boosting.symmetric if spec.symmetric else boosting.leaf_wise
        grown = grow(codes, np.array([len(e) for e in edges]), label, weight, spec, np.random.default_rng([spec.seed, 0]))
        start = boosting.Tree()
        start.add(next(grown), len(x))
        rows = members.node_rows(start, -1, names, edges)
        for number, tree in enumerate(grown):
            rows += members.node_rows(tree, number, names, edges)
        own = Forest(pd.DataFrame(rows, columns=[c.split()[0] for c in NODES.split(", ")][1:]), names)
        np.testing.assert_allclose([got[a][spec.name] for a in frame.account_id], boosting.sigmoid(own.margin(x)), atol=1e-9)


def test_rows_of_a_fold_without_members_have_no_score(spark, people):
    nodes = members.fit_members(people.where("fold = 0"), FEATURES, SMALL)
    got = members.score_members(nodes, people, FEATURES, SMALL, keep=["fold"]).collect()
    assert len(got) == 300 and all((r.a is None) == (r.fold == 1) for r in got)
    none = members.fit_members(people.limit(0), FEATURES, SMALL)
    assert none.count() == 0 and members.score_members(none, people, FEATURES, SMALL, keep=["fold"]).where("x IS NOT NULL").count() == 0


def test_labelled_rows_are_bounded(spark, people):
    sample = members.labelled_sample(people, 60)
    sizes = {r.fold: r["count"] for r in sample.groupBy("fold").count().collect()}
    assert set(sizes) == {0, 1} and all(35 <= n <= 90 for n in sizes.values())
    assert members.labelled_sample(people, 150).count() == 300
    one = people.where("is_mule = 0").withColumn("fold", F.lit(0))
    scored = members.score_members(members.train_members(one, FEATURES, SMALL), one, FEATURES, SMALL).collect()
    assert all(0 <= r[s.name] < 0.5 for r in scored for s in SMALL)  # one class alone


def test_every_labelled_row_is_fitted(spark):
    """A fold of more than 100,000 rows is fitted whole: its start and the roots of rounds without a draw cover every row."""
    n = 100_700
    rows = spark.range(n).select(F.format_string("%07d", "id").alias("account_id"), (F.col("id") % 7 == 0).cast("int").alias("is_mule"),
                                 (F.col("id") % 50).cast("double").alias("f0"), F.lit(0.0).alias("risky_mcc_share"))
    specs = [replace(s, rounds=1, depth=1, leaves=s.leaves and 2) for s in (LEAF, LEVEL)]
    nodes = members.train_members(rows, ["f0"], specs).where("node = 0").collect()
    assert {(r.model, r.tree): r.cover for r in nodes} == {(s.name, t): n for s in specs for t in (-1, 0)}


def test_rows_keep_their_place_in_every_feature(spark, monkeypatch):
    """Repeated and null accounts, missing values, more columns than a task bins and more codes than a stored row holds."""
    monkeypatch.setattr(members, "CODES_AT_ONCE", 60)
    x, label, _ = matrix(200, 9)
    accounts = [None if i % 40 == 0 else f"{(i * 37 % 200) // 2:03d}" for i in range(200)]
    names = [f"f{i}" for i in range(9)]
    rows = [(a, int(y), *[None if math.isnan(v) else float(v) for v in r]) for a, y, r in zip(accounts, label, x)]
    frame = spark.createDataFrame(rows, "account_id string, is_mule int, " + ", ".join(f"{c} double" for c in names)).withColumn(
        "fold", (F.col("f0").isNotNull() & (F.col("f0") < 1)).cast("int"))
    ranked, folds = members.placed(frame.repartition(5), names)
    assert {(f.fold, f.n) for f in folds} == {tuple(r) for r in frame.groupBy("fold").count().collect()}
    coded = members.binned(ranked, folds, names, [254]).collect()
    wanted = frame.toPandas()
    for f in folds:
        own = wanted[wanted.fold == f.fold]
        got = {}
        for r in sorted((r for r in coded if r.fold == f.fold), key=lambda r: (r.feature, r.at)):
            assert r.at == len(got.setdefault(r.feature, b"")) and len(r.codes) <= 60 and (r.edges is None) == (r.at > 0 or r.feature < 0)
            got[r.feature] += r.codes
        edges, codes = prepared(own[names].to_numpy(float))
        assert all(r.edges == edges[r.feature].tolist() for r in coded if r.fold == f.fold and r.edges is not None)
        whole = [(float(y), *c) for y, c in zip(np.frombuffer(got[-1]), zip(*(got[i] for i in range(9))))]
        assert sorted(whole) == sorted((float(y), *c) for y, c in zip(own.is_mule, codes.tolist()))
        known = own.sort_values("account_id", kind="stable", na_position="last").account_id.tolist()
        place = {r["_rank"] - f.first: r.account_id for r in ranked.where(f"fold = {f.fold}").collect()}
        assert [place[i] for i in range(f.n)] == known


def test_contributions_of_rows_add_up(spark, people):
    train = people.where("fold = 0").drop("fold")
    nodes = members.train_members(train, FEATURES, SMALL)
    total = {(r.account_id, r.model): r.s for r in members.contributions(nodes, train, FEATURES, SMALL).groupBy("account_id", "model").agg(
        F.sum("contribution").alias("s")).collect()}
    scores = members.score_members(nodes, train, FEATURES, SMALL).collect()
    for spec in SMALL:
        means = {round(math.log(r[spec.name] / (1 - r[spec.name])) - total[r.account_id, spec.name], 6) for r in scores}
        assert len(means) == 1  # the score less its contributions is the same mean for every row
    table = members.member_importances(nodes, train, FEATURES, SMALL).collect()
    assert len(table) == sum(4 if s.encoded else 3 for s in SMALL) and all(r.importance >= 0 for r in table)


def test_sums_of_a_leaf_do_not_depend_on_its_size(monkeypatch):
    """Large leaves are counted feature by feature, small ones at once; both add in the order of the rows, over the drawn features only."""
    rng = np.random.default_rng(5)
    codes, g, h = rng.integers(0, 9, (400, 6)).astype(np.uint8), rng.normal(size=400), rng.random(400)
    rows, features = np.sort(rng.choice(400, 150, replace=False)), np.array([1, 3, 4])
    grower = boosting.LeafWise(codes, np.full(6, 8), members.MEMBER_SPECS[0])
    wanted = np.zeros((3, 3, 10))
    for row in rows:
        for i, f in enumerate(features):
            wanted[:, i, codes[row, f]] += (1, g[row], h[row])
    for few in (1, 1_000):
        monkeypatch.setattr(boosting, "FEW_ROWS", few)
        assert (grower.sums(rows, features, g, h) == wanted).all()
        everything = grower.sums(np.arange(400), features, g, h)
        assert (everything[0].sum(axis=1) == 400).all()


def test_explanations_are_spread(spark):
    """A small sample is dealt over many tasks: its rows are few bytes, but each visits every leaf."""
    nodes = spark.createDataFrame([("a", -1, 0, None, None, None, None, None, 0.0, 0.25, 9.0), ("a", 0, 0, "f", 0.5, True, 1, 2, 1.0, 0.0, 9.0),
                                   ("a", 0, 1, None, None, None, None, None, 0.0, -1.0, 6.0), ("a", 0, 2, None, None, None, None, None, 0.0, 2.0, 3.0)], NODES)
    rows = spark.createDataFrame([(str(i), float(i % 2)) for i in range(300)], "account_id string, f double").coalesce(1)
    found = members.contributions(nodes, rows, ["f"], members.MEMBER_SPECS[:1])
    assert found.rdd.getNumPartitions() >= 48
    assert sorted((int(r.account_id), round(r.contribution, 9)) for r in found.collect()) == [(i, 2.0 if i % 2 else -1.0) for i in range(300)]
