"""Table contracts, default column lists and the ordered feature schema."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "account_id"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D, _I, _DATE, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.DateType(), T.TimestampType()

TRANSACTIONS = _struct(
    ("transaction_id", _S), ("account_id", _S), ("transaction_timestamp", _TS), ("txn_type", _S),
    ("amount", _D), ("counterparty_id", _S), ("channel", _S), ("mcc_code", _I),
)
TRANSACTIONS_ADDITIONAL = _struct(
    ("transaction_id", _S), ("balance_after_transaction", _D), ("ip_address", _S), ("latitude", _D),
    ("longitude", _D), ("atm_deposit_channel_code", _S), ("mnemonic_code", _S),
)
ACCOUNTS = _struct(
    ("account_id", _S), ("branch_code", _I), ("branch_pin", _I), ("account_opening_date", _DATE),
    ("freeze_date", _DATE), ("unfreeze_date", _DATE), ("last_kyc_date", _DATE),
    ("last_mobile_update_date", _DATE), ("avg_balance", _D), ("kyc_compliant", _S), ("rural_branch", _S),
    ("nomination_flag", _S), ("cheque_allowed", _S), ("cheque_availed", _S),
)
ACCOUNTS_ADDITIONAL = _struct(("account_id", _S), ("scheme_code", _S))
CUSTOMERS = _struct(
    ("customer_id", _S), ("date_of_birth", _DATE), ("relationship_start_date", _DATE), ("customer_pin", _S),
    ("permanent_pin", _S), ("pan_available", _S), ("aadhaar_available", _S), ("passport_available", _S),
    ("mobile_banking_flag", _S), ("internet_banking_flag", _S), ("atm_card_flag", _S), ("demat_flag", _S),
    ("credit_card_flag", _S), ("fastag_flag", _S),
)
CUSTOMER_LINK = _struct(("account_id", _S), ("customer_id", _S))
DEMOGRAPHICS = _struct(
    ("customer_id", _S), ("joint_account_flag", _S), ("nri_flag", _S),
    ("address_last_update_date", _DATE), ("passbook_last_update_date", _DATE),
)
PRODUCT_DETAILS = _struct(
    ("customer_id", _S), ("sa_count", _I), ("loan_count", _I), ("cc_count", _I), ("od_count", _I), ("ka_count", _I),
)
BRANCH = _struct(
    ("branch_code", _I), ("branch_employee_count", _I), ("branch_type", _S),
    ("branch_turnover", _D), ("branch_asset_size", _D),
)
TRAIN_LABELS = _struct(
    ("account_id", _S), ("is_mule", _I), ("mule_flag_date", _DATE), ("alert_reason", _S), ("flagged_by_branch", _S),
)
TEST_ACCOUNTS = _struct(("account_id", _S))

# ---- fixed values that results depend on --------------------------------------------------
REFERENCE_DATE = "2025-06-30"
TRANSFER_CHANNELS = ("NEFT", "IMPS", "NTD", "IPM")
SCHEME_RISK = {
    "PMJJBY": 1.21, "SCSS": 1.14, "REGULAR": 1.00, "PMSBY": 0.99, "PMJDY": 0.99, "SSA": 0.95, "APY": 0.81,
}
MONTH_BOUNDARY_DAYS = (1, 2, 3, 4, 5, 25, 26, 27, 28, 29, 30, 31)
BASE_RATE_PCT = 2.79
LEAKY_COLUMNS = (
    "is_frozen", "is_frozen_clean", "freeze_duration_days", "freeze_duration_clean", "was_unfrozen_before_flag",
    "avg_balance", "monthly_avg_balance", "quarterly_avg_balance", "daily_avg_balance", "risky_mcc_share",
    "has_freeze_date",
)
LABEL_COLUMNS = ("is_mule", "mule_flag_date", "alert_reason", "flagged_by_branch", "account_opening_date")
DUPLICATE_COLUMNS = ("account_age_days_y", "rural_branch_y", "kyc_compliant_y", "nri_flag_y")
FOLDS = (
    ("2022-06-30", "2022-07-01", "2023-06-30"),
    ("2023-06-30", "2023-07-01", "2024-06-30"),
    ("2024-06-30", "2024-07-01", "2025-06-30"),
)

# The 125 behavioural features in their published order, grouped by the operator that makes them.
FEATURES_BY_OPERATOR = {
    "counterparty_network": (
        "unique_counterparties", "unique_incoming_cp", "unique_outgoing_cp", "fan_asymmetry", "cp_incoming_ratio",
        "cp_outgoing_ratio", "cp_deviation_from_branch",
    ),
    "channel_mix": (
        "channel_entropy", "neft_imps_share", "atm_share", "channel_count", "top_channel_share",
    ),
    "amount_profile": (
        "structuring_share", "round_share", "median_txn_amount", "avg_txn_amount", "high_value_share",
        "micro_txn_share", "txn_count", "credit_debit_ratio",
    ),
    "balance_profile": (
        "near_zero_balance_share", "rapid_drain_rate", "avg_drain_seconds", "balance_cv", "turnover_v3",
    ),
    "calendar": (
        "weekend_share", "sunday_share", "offhours_share", "month_boundary_share", "active_days", "activity_density",
        "peak_to_avg_90d", "days_to_first_txn",
    ),
    "geo_ip_profile": (
        "unique_ips", "lat_std", "lon_std", "ip_null_rate", "avg_ip_sharing", "geo_spread",
    ),
    "account_profile": (
        "account_age_days", "days_since_mobile_update", "no_mobile_update", "pin_mismatch", "acc_per_customer",
        "sa_count", "loan_count", "cc_count", "nri_flag", "scheme_risk", "kyc_compliant", "rural_branch",
    ),
    "branch_context": (
        "accounts_per_employee", "branch_type_urban", "branch_type_semiurban", "branch_type_rural",
        "log_branch_turnover", "log_branch_asset_size",
    ),
    "anchored_windows": (
        "w30_txn_count", "w90_txn_count", "w30_near_zero_count", "w90_near_zero_count", "w90_large_credit_count",
        "w90_txn_concentration", "w30_txn_concentration", "w90_credit_concentration", "w90_near_zero_rate",
        "w30_near_zero_rate", "w90_near_zero_uplift", "w90_activity_concentration", "w90_avg_credit_ratio",
        "w90_credit_zscore", "w30_w90_acceleration",
    ),
    "fund_residence": (
        "n_credit_debit_pairs", "median_residence_hours", "p25_residence_hours", "avg_residence_hours",
        "min_residence_hours", "same_day_drain_count", "same_day_drain_rate", "drain_rate_1h", "drain_rate_6h",
        "drain_rate_24h", "avg_post_credit_drawdown", "large_credit_to_zero_rate",
    ),
    "counterparty_dynamics": (
        "new_cp_30d", "new_cp_30d_rate", "w30_cp_concentration", "w90_cp_concentration", "top1_cp_share",
        "unique_cp_branches", "top_branch_share", "bidirectional_cp_count", "bidirectional_cp_rate",
        "outgoing_unique_cp", "incoming_unique_cp", "outgoing_incoming_cp_ratio",
    ),
    "dormancy": (
        "max_inactivity_gap", "gaps_over_30d", "gaps_over_60d", "gaps_over_90d", "pre_gap_activity_days",
        "post_gap_activity_days", "reactivation_volume", "burst_ratio_after_gap",
    ),
    "velocity": (
        "max_daily_txns", "burst_count", "inter_txn_gap_p10", "inter_txn_gap_p50", "inter_txn_gap_p90", "gap_cv",
        "max_hourly_txns",
    ),
    "digital_products": (
        "digital_banking_score", "has_credit_card", "has_fastag", "product_diversity", "has_multiple_products",
        "address_update_age_days", "passbook_update_age_days", "joint_account_flag",
    ),
    "location": (
        "unique_location_count", "txns_with_location", "max_distance_km_approx", "location_entropy",
        "impossible_travel_flag", "atm_deposit_channel_flag",
    ),
}
BEHAVIOURAL_FEATURES = tuple(name for names in FEATURES_BY_OPERATOR.values() for name in names)
ENCODED_FEATURE = "risky_mcc_share"
ALL_FEATURES = BEHAVIOURAL_FEATURES + (ENCODED_FEATURE,)
