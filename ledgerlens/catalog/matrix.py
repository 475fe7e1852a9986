"""Matrix assembly, gates and class statistics: M and T, and the whole feature build."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ledgerlens.catalog import dimensions, features  # noqa: F401  (their oracles are composed below)
from ledgerlens.catalog.registry import REGISTRY, query, shaped
from ledgerlens.operators import amounts, assemble, audit, balance, profile
from ledgerlens.plans.features import FILLS, LEDGER_MEDIANS, STATIC_MEDIANS, Dimensions, build_features
from ledgerlens.schema import BEHAVIOURAL_FEATURES
from ledgerlens.session import stage_table

# ---------------------------------------------------------------- a small matrix with NULLs
SMALL = ("txn_count", "avg_txn_amount", "micro_txn_share", "credit_debit_ratio", "near_zero_balance_share",
         "avg_drain_seconds", "days_since_mobile_update", "cc_count")
SMALL_VIEWS = {**features.STEPS, "feat": """
SELECT i.account_id, a.txn_count, a.avg_txn_amount, a.micro_txn_share, a.credit_debit_ratio, b.near_zero_balance_share,
 s.avg_drain_seconds, c.days_since_mobile_update, c.cc_count FROM ids i
LEFT JOIN (SELECT account_id, CAST(count(*) AS DOUBLE) AS txn_count, round(avg(amt), 6) + 0e0 AS avg_txn_amount,
  round(avg(CASE WHEN amt < 100 THEN 1e0 ELSE 0e0 END), 6) + 0e0 AS micro_txn_share,
  round(least(sum(CASE WHEN txn_type = 'C' THEN amt ELSE 0 END) / (sum(CASE WHEN txn_type = 'D' THEN amt ELSE 0 END) + 1), 10), 6) + 0e0 AS credit_debit_ratio
  FROM tx GROUP BY account_id) a ON i.account_id = a.account_id
LEFT JOIN (SELECT account_id, round(avg(CASE WHEN abs(bal) < 500 THEN 1e0 ELSE 0e0 END), 6) + 0e0 AS near_zero_balance_share
  FROM led GROUP BY account_id) b ON i.account_id = b.account_id
LEFT JOIN (SELECT account_id, round(avg(datediff('second', prev_ts, ts)), 6) + 0e0 AS avg_drain_seconds FROM stepped
  WHERE txn_type = 'D' AND prev_type = 'C' GROUP BY account_id) s ON i.account_id = s.account_id
LEFT JOIN (SELECT p.account_id, CAST(DATE '2025-06-30' - p.last_mobile_update_date AS DOUBLE) AS days_since_mobile_update,
  CAST(q.cc_count AS DOUBLE) AS cc_count FROM accounts p
  LEFT JOIN (SELECT account_id, min(customer_id) AS customer_id FROM cust_link GROUP BY account_id) l ON p.account_id = l.account_id
  LEFT JOIN product_details q ON l.customer_id = q.customer_id) c ON i.account_id = c.account_id"""}
LONG_VIEWS = {**SMALL_VIEWS, "long_feat": "SELECT f.account_id, l.is_mule, f.feature, f.value FROM (" + "\nUNION ALL ".join(
    f"SELECT account_id, '{c}' AS feature, {c} AS value FROM feat" for c in SMALL)
    + ") f JOIN acct_labels l ON f.account_id = l.account_id"}


def _small(d):
    """Rounded to 6 decimals, so that ties are the same in both engines; stored once per application."""
    if "small_matrix" not in d.__dict__:
        numbers = d.accounts.join(profile.primary_customer(d.cust_link), "account_id", "left").join(
            d.product_details, "customer_id", "left").select(
            "account_id", F.datediff(F.lit("2025-06-30").cast("date"), "last_mobile_update_date")
            .alias("days_since_mobile_update"), "cc_count")
        groups = [amounts.amount_profile(d.tx, d.hot), balance.balance_profile(d.ledger), balance.rapid_drain(d.steps),
                  numbers]
        wide = assemble.assemble(d.ids, *groups)
        shape = "account_id " + " ".join(f"{c}:f" for c in SMALL)
        d.__dict__["small_matrix"] = stage_table(shaped(wide, shape), "small-matrix")
    return d.__dict__["small_matrix"]


def _labelled(d):
    return _small(d).join(d.acct_labels.select("account_id", "is_mule"), "account_id")


def _all_as_float(names) -> str:
    return "account_id " + " ".join(f"{c}:f" for c in names)


# ---------------------------------------------------------------- M
@query("m1_assemble", _all_as_float(SMALL), "SELECT * FROM feat", SMALL_VIEWS)
def _(d):
    return _small(d)


MEDIANS = ("txn_count", "avg_txn_amount", "micro_txn_share", "credit_debit_ratio", "near_zero_balance_share",
           "avg_drain_seconds", "days_since_mobile_update")
IMPUTED_SQL = "SELECT f.account_id, " + ", ".join(
    f"coalesce(f.{c}, m.{c}, 0) AS {c}" for c in MEDIANS) + """, coalesce(f.cc_count, 2) AS cc_count
FROM feat f, (SELECT """ + ", ".join(f"median({c}) AS {c}" for c in MEDIANS) + " FROM feat{where}) m"


@query("m2_impute", _all_as_float(SMALL), IMPUTED_SQL.format(where=""), SMALL_VIEWS)
def _(d):
    return assemble.impute(_small(d), MEDIANS, {"cc_count": 2.0})


@query("m2_impute_train_only", _all_as_float(SMALL), IMPUTED_SQL.format(
    where=" WHERE account_id IN (SELECT account_id FROM acct_labels)"), SMALL_VIEWS)
def _(d):
    train = _small(d).join(d.acct_labels, "account_id", "left_semi")
    return assemble.impute(_small(d), MEDIANS, {"cc_count": 2.0}, fit_rows=train)


@query("m3_null_inf_report", "feature rows:i nulls:i nans:i infinities:i null_pct:f", "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"count(*) FILTER (WHERE isnan({c})) AS nans, count(*) FILTER (WHERE isinf({c})) AS infinities, avg(CASE WHEN {c} IS NULL THEN 100e0 ELSE 0e0 END) AS null_pct FROM feat"
    for c in SMALL), SMALL_VIEWS)
def _(d):
    return assemble.null_inf_report(_small(d), SMALL)


@query("m4_split_by_membership", "account_id part is_mule:i txn_count:f", """
SELECT f.account_id, 'train' AS part, l.is_mule, f.txn_count FROM feat f JOIN acct_labels l ON f.account_id = l.account_id
UNION ALL SELECT f.account_id, 'test', NULL, f.txn_count FROM feat f WHERE f.account_id IN (SELECT account_id FROM test_accounts)""",
       SMALL_VIEWS)
def _(d):
    train, test = assemble.split_by_membership(_small(d), d.acct_labels, d.test_accounts)
    cols = ["account_id", "part", "is_mule", "txn_count"]
    return train.withColumn("part", F.lit("train")).select(*cols).unionByName(
        test.withColumn("part", F.lit("test")).withColumn("is_mule", F.lit(None).cast("int")).select(*cols))


@query("m5_append_pack", "account_id txn_count:f deposits:i", """
SELECT f.account_id, f.txn_count, coalesce(p.k, 0) AS deposits FROM feat f LEFT JOIN (SELECT account_id, count(*) AS k FROM led
 WHERE atm_deposit_channel_code = 'CDM' GROUP BY account_id) p ON f.account_id = p.account_id""", SMALL_VIEWS)
def _(d):
    pack = d.ledger.where("atm_deposit_channel_code = 'CDM'").groupBy("account_id").agg(F.count("*").alias("deposits"))
    return assemble.append_pack(_small(d).select("account_id", "txn_count"), pack)


@query("m6_quality_gate", "check_name found:i passed:i", """
SELECT check_name, found, CASE WHEN found = 0 THEN 1 ELSE 0 END AS passed FROM (
SELECT 'missing_ids' AS check_name, (SELECT count(*) FROM acct_labels WHERE account_id NOT IN (SELECT account_id FROM feat)) AS found
UNION ALL SELECT 'unknown_ids', (SELECT count(*) FROM feat WHERE account_id NOT IN (SELECT account_id FROM acct_labels))
UNION ALL SELECT 'repeated_ids', (SELECT count(*) FROM (SELECT account_id FROM feat GROUP BY account_id HAVING count(*) > 1) AS r)
UNION ALL SELECT 'null_values', (SELECT """ + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in SMALL) + """ FROM feat)
UNION ALL SELECT 'banned_columns', 0 UNION ALL SELECT 'absent_columns', 1) AS g""", SMALL_VIEWS)
def _(d):
    return assemble.quality_gate(_small(d), d.acct_labels, required=["txn_count", "gap_cv"])


@query("m7_column_policy", "account_id txn_count:f", "SELECT account_id, txn_count FROM feat", SMALL_VIEWS)
def _(d):
    leaky = _small(d).select("account_id", "txn_count").join(d.accounts.select("account_id", "account_opening_date"), "account_id")
    leaky = leaky.withColumns({"avg_balance": F.lit(1.0), "is_mule": F.lit(0), "nri_flag_y": F.lit(0)})
    kept = assemble.column_policy(leaky)
    if set(kept.columns) != {"account_id", "txn_count"}:
        raise ValueError(f"columns left over: {kept.columns}")
    return kept


@query("m8_pre_label_freeze",
       "account_id part is_frozen_clean:i freeze_duration_clean:i was_unfrozen_before_flag:i", """
SELECT l.account_id, 'train' AS part, CASE WHEN a.freeze_date < l.mule_flag_date THEN 1 ELSE 0 END AS is_frozen_clean,
 CASE WHEN a.freeze_date < l.mule_flag_date THEN greatest(DATE '2025-06-30' - a.freeze_date, 0) ELSE 0 END AS freeze_duration_clean,
 CASE WHEN a.unfreeze_date < l.mule_flag_date THEN 1 ELSE 0 END AS was_unfrozen_before_flag
FROM acct_labels l LEFT JOIN accounts a ON l.account_id = a.account_id
UNION ALL SELECT t.account_id, 'test', CASE WHEN a.freeze_date IS NOT NULL THEN 1 ELSE 0 END,
 CASE WHEN a.freeze_date IS NOT NULL THEN greatest(DATE '2025-06-30' - a.freeze_date, 0) ELSE 0 END,
 CASE WHEN a.unfreeze_date IS NOT NULL THEN 1 ELSE 0 END FROM test_accounts t LEFT JOIN accounts a ON t.account_id = a.account_id""")
def _(d):
    return assemble.pre_label_freeze(d.acct_labels, d.test_accounts, d.accounts)


# ---------------------------------------------------------------- T
EFFECT_SQL = """
SELECT feature, avg(value) FILTER (WHERE is_mule = 1) AS mule_mean, avg(value) FILTER (WHERE is_mule = 0) AS legit_mean,
 abs(avg(value) FILTER (WHERE is_mule = 1) - avg(value) FILTER (WHERE is_mule = 0)) / sqrt((stddev_samp(value) FILTER (WHERE is_mule = 1) ** 2
 + stddev_samp(value) FILTER (WHERE is_mule = 0) ** 2) / 2 + 1e-9) AS effect_size FROM long_feat GROUP BY feature"""


@query("t_1_effect_size", "feature mule_mean:f legit_mean:f effect_size:f", EFFECT_SQL, LONG_VIEWS)
def _(d):
    return audit.effect_size(_labelled(d), SMALL)


RANKED_VIEWS = {
    **LONG_VIEWS,
    "ranked": """SELECT *, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2e0 AS rk
 FROM long_feat WHERE value IS NOT NULL""",
    "tied": "SELECT feature, sum(k * k * k - k) AS tie_term FROM (SELECT feature, CAST(count(*) AS DOUBLE) AS k FROM ranked GROUP BY feature, value) AS s GROUP BY feature",
    "usums": """SELECT feature, CAST(count(*) FILTER (WHERE is_mule = 1) AS DOUBLE) AS m, CAST(count(*) FILTER (WHERE is_mule = 0) AS DOUBLE) AS n,
 sum(rk) FILTER (WHERE is_mule = 1) AS rank_sum FROM ranked GROUP BY feature""",
    "mw_all": """SELECT s.feature, m, n, rank_sum - m * (m + 1) / 2 AS u, (rank_sum - m * (m + 1) / 2 - m * n / 2) / sqrt(m * n * (m + n + 1) / 12) AS r,
 sign(rank_sum - m * (m + 1) / 2 - m * n / 2) * greatest(abs(rank_sum - m * (m + 1) / 2 - m * n / 2) - 0.5e0, 0e0)
 / sqrt(m * n / 12 * (m + n + 1 - t.tie_term / ((m + n) * (m + n - 1)))) AS z FROM usums s JOIN tied t ON s.feature = t.feature""",
    "mw": """SELECT feature, m, n, CASE WHEN m >= 5 AND n >= 5 THEN u END AS u, CASE WHEN m >= 5 AND n >= 5 THEN r END AS r,
 CASE WHEN m >= 5 AND n >= 5 THEN z END AS z FROM mw_all""",
    "med": """SELECT feature, median(value) FILTER (WHERE is_mule = 1) AS mule_median, median(value) FILTER (WHERE is_mule = 0) AS legit_median
 FROM long_feat GROUP BY feature""",
}


@query("t_2_mann_whitney", "feature n_mule:i n_legit:i u:f r:f z:f",
       "SELECT feature, m AS n_mule, n AS n_legit, u, r, z FROM mw", RANKED_VIEWS)
def _(d):
    return audit.mann_whitney(_labelled(d), SMALL)


# |z| at p = .001, .01 and .05, so that the oracle needs no error function.
@query("t_3_signal_table", "feature mule_median:f legit_median:f direction r:f stars tier:i", """
SELECT w.feature, mule_median, legit_median, CASE WHEN mule_median > legit_median THEN 'up' ELSE 'down' END AS direction, r,
 CASE WHEN abs(z) > 3.290526731 THEN '***' WHEN abs(z) > 2.575829304 THEN '**' WHEN abs(z) > 1.959963985 THEN '*' ELSE 'ns' END AS stars,
 CASE WHEN abs(r) >= 0.30 THEN 1 WHEN abs(r) >= 0.15 THEN 2 WHEN abs(r) >= 0.05 AND abs(z) > 1.959963985 THEN 3 END AS tier
FROM mw w JOIN med d ON w.feature = d.feature""", RANKED_VIEWS)
def _(d):
    return audit.signal_table(_labelled(d), SMALL)


@query("t_4_feature_audit", "feature mule_mean:f legit_mean:f mule_median:f legit_median:f effect_size:f z:f direction tier", f"""
SELECT e.feature, mule_mean, legit_mean, mule_median, legit_median, effect_size, z,
 CASE WHEN mule_median > legit_median THEN 'up' ELSE 'down' END AS direction,
 CASE WHEN effect_size >= 0.8 THEN 'T1' WHEN effect_size >= 0.5 THEN 'T2' WHEN effect_size >= 0.2 THEN 'T3' ELSE 'T4' END AS tier
FROM ({EFFECT_SQL}) e JOIN med d ON e.feature = d.feature JOIN mw_all w ON e.feature = w.feature""", RANKED_VIEWS)
def _(d):
    return audit.feature_audit(_labelled(d), SMALL)


@query("t_4_tier_counts", "tier features:i", f"""
SELECT tier, count(*) AS features FROM (SELECT CASE WHEN effect_size >= 0.8 THEN 'T1' WHEN effect_size >= 0.5 THEN 'T2'
 WHEN effect_size >= 0.2 THEN 'T3' ELSE 'T4' END AS tier FROM ({EFFECT_SQL}) AS e) AS t GROUP BY tier""", LONG_VIEWS)
def _(d):
    return audit.tier_counts(audit.feature_audit(_labelled(d), SMALL))


@query("t_5_correlation_matrix", "feature_a feature_b correlation:f", "\nUNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, coalesce(CASE WHEN isnan(corr({a}, {b})) THEN 0e0 ELSE corr({a}, {b}) END, 0) AS correlation FROM lab"
    for i, a in enumerate(SMALL) for b in SMALL[i + 1:]),
    {**SMALL_VIEWS, "lab": "SELECT f.* FROM feat f JOIN acct_labels l ON f.account_id = l.account_id"})
def _(d):
    return audit.correlation_matrix(_labelled(d), SMALL)


@query("t_6_clipped_histogram", "feature is_mule:i bin:i bin_start:f n:i density:f", """
WITH caps AS (SELECT feature, quantile_cont(value, 0.99) AS cap FROM long_feat WHERE value IS NOT NULL GROUP BY feature),
clipped AS (SELECT l.feature, l.is_mule, least(l.value, c.cap) AS v FROM long_feat l JOIN caps c ON l.feature = c.feature WHERE l.value IS NOT NULL),
spans AS (SELECT feature, is_mule, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
 CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi, count(*) AS total FROM clipped GROUP BY feature, is_mule)
SELECT c.feature, c.is_mule, least(floor((c.v - s.lo) / ((s.hi - s.lo) / 40)), 39) AS bin,
 min(s.lo + least(floor((c.v - s.lo) / ((s.hi - s.lo) / 40)), 39) * ((s.hi - s.lo) / 40)) AS bin_start, count(*) AS n,
 count(*) / (max(s.total) * ((max(s.hi) - max(s.lo)) / 40)) AS density
FROM clipped c JOIN spans s ON c.feature = s.feature AND c.is_mule = s.is_mule GROUP BY 1, 2, 3""", LONG_VIEWS)
def _(d):
    return audit.clipped_histogram(_labelled(d), SMALL)


@query("t_7_median_by_class", "feature mule_median:f legit_median:f direction", """
SELECT feature, mule_median, legit_median, CASE WHEN mule_median > legit_median THEN 'up' ELSE 'down' END AS direction FROM med""",
       RANKED_VIEWS)
def _(d):
    return audit.median_by_class(_labelled(d), SMALL)


# ---------------------------------------------------------------- the whole matrix
PACKS = (
    "a1_counterparty_network", "a2_deviation_from_branch_median", "b1_channel_mix", "b2_entropy",
    "c_1_amount_profile", "d1_balance_profile", "d2_rapid_drain", "d3_turnover",
    "e1_calendar_shares", "e2_activity_span", "e3_rolling_peak", "e4_days_to_first_txn",
    "f2_geo_ip_profile", "g1_account_profile", "h1_branch_context", "l2_residence_stats",
    "l3_drain_rates", "l4_same_day_drain", "l5_post_credit_drawdown", "x2_cp_window_concentration",
    "x3_top_counterparty_share", "x4_cp_branch_diversity", "x5_bidirectional_counterparties",
    "x6_direction_unique_cp", "q1_inactivity_gaps", "q3_reactivation", "v1_burst_stats",
    "v2_hourly_peak", "v3_inter_txn_gaps", "k6_digital_products", "z1_location_stats",
    "z2_location_entropy", "z3_impossible_travel",
)
BODIES = {
    **{name: REGISTRY[name].sql for name in PACKS},
    "c_2_credit_debit_ratio": REGISTRY["c_2_credit_debit_ratio"].sql.replace("tx_long", "tx"),
    "w_recent": features._w(features.W_SQL, 30, 90),
    "x1_novel": features.X1_SQL,
}
WHOLE_VIEWS = reduce(lambda left, right: {**left, **right}, [
    features.CHANNEL_COUNTS, features.PAIRS, features._cp("tx"), features.BEST_GAP, features.DAILY, features.PLACES,
    {f"pack_{name}": body for name, body in BODIES.items()}])


def _whole_sql() -> str:
    where = {}
    for name, body in BODIES.items():
        for feature in BEHAVIOURAL_FEATURES:
            if f"AS {feature}" in body and feature not in where:
                where[feature] = name
    missing = [f for f in BEHAVIOURAL_FEATURES if f not in where]
    if missing:
        raise ValueError(f"no oracle for {missing}")
    raw = ", ".join(f"CAST(p_{where[f]}.{f} AS DOUBLE) AS {f}" for f in BEHAVIOURAL_FEATURES)
    joins = "\n".join(f"LEFT JOIN pack_{n} p_{n} ON i.account_id = p_{n}.account_id" for n in BODIES)
    medians = {*LEDGER_MEDIANS, *STATIC_MEDIANS}
    final = ", ".join(
        f"coalesce(r.{f}, m.{f}, 0) AS {f}" if f in medians else f"coalesce(r.{f}, {FILLS.get(f, 0)}) AS {f}"
        for f in BEHAVIOURAL_FEATURES)
    middle = ", ".join(f"median({f}) AS {f}" for f in BEHAVIOURAL_FEATURES if f in medians)
    return f"""
WITH raw AS MATERIALIZED (SELECT i.account_id, {raw} FROM ids i {joins})
SELECT r.account_id, {final} FROM raw r, (SELECT {middle} FROM raw) m"""


@query("m2_feature_matrix", _all_as_float(BEHAVIOURAL_FEATURES), _whole_sql(), WHOLE_VIEWS)
def _(d):
    return build_features(d.tx, d.ext, _dimensions(d), hot=d.hot)


def _dimensions(d) -> Dimensions:
    return Dimensions(d.ids, d.accounts, d.cust_link, d.customers, d.demographics, d.product_details, d.accounts_add,
                      d.branch)


# ---------------------------------------------------------------- the audit on all features of the whole matrix
WHOLE_AUDIT_VIEWS = {
    **WHOLE_VIEWS,
    "whole": "SELECT account_id, " + ", ".join(f"round({f}, 6) + 0e0 AS {f}" for f in BEHAVIOURAL_FEATURES) + f" FROM ({_whole_sql()}) AS w",
    "whole_lab": "SELECT w.*, l.is_mule FROM whole w JOIN acct_labels l ON w.account_id = l.account_id",
    "long_feat": "SELECT account_id, is_mule, feature, value FROM (UNPIVOT whole_lab ON COLUMNS(* EXCLUDE (account_id, is_mule)) INTO NAME feature VALUE value)",
    **{name: body for name, body in RANKED_VIEWS.items() if name in ("ranked", "tied", "usums", "mw", "med")},
    # Features without any spread have no z.
    "mw_all": RANKED_VIEWS["mw_all"].replace("SELECT s.feature", "SELECT s.feature, tie_term").replace(
        "sign(rank_sum", "CASE WHEN m + n + 1 > t.tie_term / ((m + n) * (m + n - 1)) THEN sign(rank_sum").replace(") AS z FROM", ") END AS z FROM"),
}


def _whole(d):
    """The labelled rows of the whole matrix, rounded so that ties are the same in both engines; stored once per application."""
    if "whole_matrix" not in d.__dict__:
        matrix = shaped(build_features(d.tx, d.ext, _dimensions(d), hot=d.hot), _all_as_float(BEHAVIOURAL_FEATURES))
        d.__dict__["whole_matrix"] = stage_table(matrix, "whole-matrix")
    return d.__dict__["whole_matrix"].join(d.acct_labels.select("account_id", "is_mule"), "account_id")


def _on_whole_matrix(name: str, sql: str, build) -> None:
    """The query ``name`` again, on all features and all accounts of the matrix. Means in the millions are compared at 2 decimals; where a bin
    starts follows from its number."""
    columns = " ".join(c.replace(":f", ":g") if c in ("mule_mean:f", "legit_mean:f") else c
                       for c in REGISTRY[name].columns.split() if c != "bin_start:f")
    query(f"{name}_whole", columns, sql, WHOLE_AUDIT_VIEWS)(build)


for _name, _build in (("t_1_effect_size", audit.effect_size), ("t_2_mann_whitney", audit.mann_whitney), ("t_3_signal_table", audit.signal_table),
                      ("t_4_feature_audit", audit.feature_audit), ("t_6_clipped_histogram", audit.clipped_histogram),
                      ("t_7_median_by_class", audit.median_by_class)):
    _on_whole_matrix(_name, REGISTRY[_name].sql, lambda d, _build=_build: _build(_whole(d), BEHAVIOURAL_FEATURES))

_on_whole_matrix("t_5_correlation_matrix", """
WITH placed AS (SELECT account_id, feature, value, list_position(""" + str(list(BEHAVIOURAL_FEATURES)) + """, feature) AS place FROM long_feat)
SELECT a.feature AS feature_a, b.feature AS feature_b, CASE WHEN min(a.value) = max(a.value) OR min(b.value) = max(b.value) THEN 0e0
 ELSE corr(a.value, b.value) END AS correlation FROM placed a JOIN placed b ON a.account_id = b.account_id AND a.place < b.place GROUP BY 1, 2""",
                 lambda d: audit.correlation_matrix(_whole(d), BEHAVIOURAL_FEATURES))
_on_whole_matrix("m3_null_inf_report", """
SELECT feature, count(*) AS rows, 0 AS nulls, count(*) FILTER (WHERE isnan(value)) AS nans, count(*) FILTER (WHERE isinf(value)) AS infinities,
 0e0 AS null_pct FROM long_feat GROUP BY feature""", lambda d: assemble.null_inf_report(_whole(d), BEHAVIOURAL_FEATURES))
_on_whole_matrix("m6_quality_gate", """
SELECT check_name, found, CASE WHEN found = 0 THEN 1 ELSE 0 END AS passed FROM (
SELECT 'missing_ids' AS check_name, (SELECT count(*) FROM acct_labels WHERE account_id NOT IN (SELECT account_id FROM whole_lab)) AS found
UNION ALL SELECT 'unknown_ids', (SELECT count(*) FROM whole_lab WHERE account_id NOT IN (SELECT account_id FROM acct_labels))
UNION ALL SELECT 'repeated_ids', (SELECT count(*) FROM (SELECT account_id FROM whole_lab GROUP BY account_id HAVING count(*) > 1) AS r)
UNION ALL SELECT 'null_values', (SELECT count(*) * """ + str(len(BEHAVIOURAL_FEATURES)) + """ FROM whole_lab) - (SELECT count(*) FROM long_feat)
UNION ALL SELECT 'banned_columns', 0 UNION ALL SELECT 'absent_columns', 0) AS g""",
                 lambda d: assemble.quality_gate(_whole(d).drop("is_mule"), d.acct_labels, required=list(BEHAVIOURAL_FEATURES)))
