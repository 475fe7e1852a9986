"""The whole matrix: shape, invariants, gates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlens.catalog.matrix import _dimensions
from ledgerlens.functions.skew import find_hot_keys
from ledgerlens.operators import assemble
from ledgerlens.plans.features import build_features, clustered_ledger
from ledgerlens.schema import ALL_FEATURES, BEHAVIOURAL_FEATURES


@pytest.fixture(scope="module")
def matrix(data):
    return build_features(data.tx, data.ext, _dimensions(data)).toPandas().set_index("account_id")


def test_published_order_and_size():
    assert len(BEHAVIOURAL_FEATURES) == 125 and len(ALL_FEATURES) == 126 and len(set(ALL_FEATURES)) == 126
    assert BEHAVIOURAL_FEATURES[0] == "unique_counterparties" and ALL_FEATURES[-1] == "risky_mcc_share"


def test_one_complete_row_per_id(data, matrix):
    assert sorted(matrix.index) == sorted(r.account_id for r in data.ids.collect())
    assert tuple(matrix.columns) == BEHAVIOURAL_FEATURES and not matrix.isna().any().any()


def test_invariants(matrix):
    shares = [c for c in matrix.columns if c.endswith(("_share", "_rate", "_density", "_concentration"))
              and c not in ("new_cp_30d_rate",)]
    assert (matrix[shares] >= 0).all().all() and (matrix[shares] <= 1 + 1e-9).all().all()
    assert (matrix.inter_txn_gap_p10 <= matrix.inter_txn_gap_p50).all()
    assert (matrix.inter_txn_gap_p50 <= matrix.inter_txn_gap_p90).all()
    assert (matrix.w30_txn_count <= matrix.w90_txn_count).all() and (matrix.w90_txn_count <= matrix.txn_count).all()
    assert (matrix.channel_entropy >= -1e-8).all() and (matrix.location_entropy >= -1e-8).all()
    assert (matrix.unique_incoming_cp <= matrix.unique_counterparties).all()
    assert (matrix.max_hourly_txns <= matrix.max_daily_txns).all()


def test_hot_accounts_do_not_change_the_matrix(data, matrix):
    hot = find_hot_keys(data.tx, rows=60)
    assert hot
    other = build_features(data.tx, data.ext, _dimensions(data), hot=hot).toPandas().set_index("account_id")
    assert abs(other.loc[matrix.index, list(matrix.columns)] - matrix).max().max() < 1e-6


def test_id_without_any_rows_gets_defaults(data, spark):
    dims = _dimensions(data)
    ids = dims.ids.unionByName(spark.sql("SELECT 'nobody' AS account_id"))
    more = type(dims)(ids, dims.accounts, dims.link, dims.customers, dims.demographics, dims.products,
                      dims.accounts_extra, dims.branch)
    row = build_features(data.tx, data.ext, more).where("account_id = 'nobody'").first()
    assert row.median_residence_hours == -1 and row.w90_avg_credit_ratio == 1 and row.unique_location_count == 1
    assert row.no_mobile_update == 1 and row.scheme_risk == 1 and row.txn_count > 0 and row.max_daily_txns == 0


def test_clustered_ledger_keeps_every_transaction(data):
    full = clustered_ledger(data.tx, data.ext)
    assert full.count() == data.tx.count()
    assert full.where("has_extension").count() == data.ledger.count()


def test_quality_gate_passes_on_the_matrix(data, spark):
    features = spark.createDataFrame([(r.account_id, 1.0) for r in data.ids.collect()], "account_id string, gap_cv double")
    gate = {r.check_name: r.passed for r in assemble.quality_gate(features, data.ids, required=["gap_cv"]).collect()}
    assert set(gate.values()) == {1}
    twice = features.unionByName(features.limit(1)).withColumn("is_mule", F.lit(1))
    gate = {r.check_name: r.passed for r in assemble.quality_gate(twice, data.ids).collect()}
    assert gate["repeated_ids"] == 0 and gate["banned_columns"] == 0 and gate["missing_ids"] == 1


def test_groups_are_joined_a_few_at_a_time(spark, monkeypatch):
    """No stage of the matrix holds the joins of all groups; missing and repeated keys come out as from one join of all."""
    from ledgerlens.operators.assemble import assemble
    from ledgerlens.plans import features as plan
    from ledgerlens.schema import BEHAVIOURAL_FEATURES
    keys, parts = ["k1", "k2", "k3", None], [BEHAVIOURAL_FEATURES[at:at + 13] for at in range(0, len(BEHAVIOURAL_FEATURES), 13)]
    groups = [spark.createDataFrame([(k, *[float(g * 100 + i)] * len(part)) for i, k in enumerate((keys * 2)[g % 4:g % 4 + 2 + (g == 6) * 3])],
                                    "account_id string, " + ", ".join(f"{c} double" for c in part)) for g, part in enumerate(parts)]
    ids = spark.createDataFrame([(k,) for k in keys], "account_id string")
    calls = []

    def counted(left, *some):
        calls.append(len(some))
        return assemble(left, *some)

    monkeypatch.setattr(plan, "assemble", counted)
    monkeypatch.setattr(plan, "feature_groups", lambda *_: groups)
    dims = plan.Dimensions(ids, *[None] * 7)
    found = plan.raw_matrix(None, dims, None)
    assert max(calls) <= 4 < sum(calls) == len(groups)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    wanted = assemble(ids, *groups).select("account_id", *BEHAVIOURAL_FEATURES)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect())) and found.count() > len(keys)
