"""Customer, branch and product context (G, H, K).

Dimension tables are joined without hints: those that fit ``spark.sql.autoBroadcastJoinThreshold`` are broadcast by
size and larger ones are shuffled. Customer tables meet each other first, one row per customer, so that accounts are
joined to a customer once; a customer or branch with a large part of all accounts is then split by the adaptive join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.columns import (
    age_days, clip, count_if, existing, flag, log1p_nonneg, map_category, one_hot, prefix_mismatch, yn_to_int,
)
from ledgerlens.functions.ranks import ranked_percentiles
from ledgerlens.schema import REFERENCE_DATE, SCHEME_RISK

YN_ACCOUNTS = ("nomination_flag", "cheque_allowed", "cheque_availed", "kyc_compliant", "rural_branch")
YN_CUSTOMERS = (
    "pan_available", "aadhaar_available", "passport_available", "mobile_banking_flag", "internet_banking_flag",
    "atm_card_flag", "demat_flag", "credit_card_flag", "fastag_flag",
)
YN_DEMOGRAPHICS = ("joint_account_flag", "nri_flag")
DIGITAL_FLAGS = ("mobile_banking_flag", "internet_banking_flag", "atm_card_flag", "demat_flag")
PRODUCT_COUNTS = ("loan_count", "cc_count", "od_count", "ka_count", "sa_count")


def primary_customer(link: DataFrame) -> DataFrame:
    """One customer per account: the lowest id, so that a multi-customer account stays one row."""
    return link.groupBy("account_id").agg(F.min("customer_id").alias("customer_id"))


def accounts_per_customer(link: DataFrame) -> DataFrame:
    """Distinct accounts of each customer."""
    return link.select("customer_id", "account_id").distinct().groupBy("customer_id").agg(
        F.count("*").alias("acc_per_customer"))


def account_profile(
    accounts: DataFrame, link: DataFrame, customers: DataFrame, products: DataFrame, demographics: DataFrame,
    extra: DataFrame, as_of: str = REFERENCE_DATE,
) -> DataFrame:
    """G1: ages, flags, product counts and scheme risk, one row per account."""
    base = yn_to_int(accounts, YN_ACCOUNTS, skip_numeric=True)
    people = yn_to_int(demographics, YN_DEMOGRAPHICS, skip_numeric=True)
    per_customer = (
        accounts_per_customer(link)
        .join(customers.select("customer_id", "customer_pin"), "customer_id", "left")
        .join(products.select("customer_id", "sa_count", "loan_count", "cc_count"), "customer_id", "left")
        .join(people.select("customer_id", "nri_flag"), "customer_id", "left")
    )
    wide = (
        base.join(primary_customer(link), "account_id", "left")
        .join(per_customer, "customer_id", "left")
        .join(extra.select("account_id", "scheme_code"), "account_id", "left")
    )
    frozen = F.col("freeze_date").isNotNull() if "freeze_date" in accounts.columns else F.lit(False)

    def or_default(name: str, default: int) -> Column:
        return F.coalesce(F.col(name), F.lit(default)).alias(name)

    return wide.select(
        "account_id",
        age_days(F.col("account_opening_date"), as_of, floor=0).alias("account_age_days"),
        age_days(F.col("last_mobile_update_date"), as_of).alias("days_since_mobile_update"),
        flag(F.col("last_mobile_update_date").isNull()).alias("no_mobile_update"),
        prefix_mismatch(F.col("customer_pin"), F.col("branch_pin")).alias("pin_mismatch"),
        or_default("acc_per_customer", 1),
        *[or_default(c, 0) for c in ("sa_count", "loan_count", "cc_count", "nri_flag")],
        map_category(F.col("scheme_code"), SCHEME_RISK, 1.0).alias("scheme_risk"),
        or_default("kyc_compliant", 0),
        or_default("rural_branch", 0),
        flag(frozen).alias("has_freeze_date"),
    )


def branch_context(accounts: DataFrame, branch: DataFrame) -> DataFrame:
    """H1: accounts per employee, branch type flags, log turnover and assets."""
    sizes = accounts.where(F.col("branch_code").isNotNull()).groupBy("branch_code").agg(F.count("*").alias("_size"))
    # One row per branch, so account rows meet a single small table.
    offices = branch.join(sizes, "branch_code", "left")
    wide = accounts.select("account_id", "branch_code").join(offices, "branch_code", "left")
    types = {"branch_type_urban": "urban", "branch_type_semiurban": "semi-urban", "branch_type_rural": "rural"}
    staff = clip(F.col("branch_employee_count"), low=1)
    return wide.select(
        "account_id",
        (F.col("_size").cast("double") / staff).alias("accounts_per_employee"),
        *[c.alias(n) for n, c in one_hot(F.col("branch_type"), types).items()],
        log1p_nonneg(F.col("branch_turnover")).alias("log_branch_turnover"),
        log1p_nonneg(F.col("branch_asset_size")).alias("log_branch_asset_size"),
    )


def digital_products(
    link: DataFrame, customers: DataFrame, demographics: DataFrame, products: DataFrame, as_of: str = REFERENCE_DATE,
) -> DataFrame:
    """K6: digital and product footprint. Of several customers the one with the lowest id speaks for the account.

    Every output has a default, so "first non-null per column" and "first customer" are the same thing.
    """
    people = yn_to_int(customers, DIGITAL_FLAGS + ("credit_card_flag", "fastag_flag"), skip_numeric=True)
    homes = yn_to_int(demographics, YN_DEMOGRAPHICS, skip_numeric=True)
    dates = ("address_last_update_date", "passbook_last_update_date")
    per_customer = (
        link.select("customer_id").distinct()
        .join(people.select("customer_id", *DIGITAL_FLAGS, "credit_card_flag", "fastag_flag"), "customer_id", "left")
        .join(homes.select("customer_id", "joint_account_flag", *existing(homes, dates)), "customer_id", "left")
        .join(products.select("customer_id", *PRODUCT_COUNTS), "customer_id", "left")
    )
    wide = primary_customer(link).join(per_customer, "customer_id", "left")

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    score = zero(DIGITAL_FLAGS[0])
    for name in DIGITAL_FLAGS[1:]:
        score = score + zero(name)
    diversity = flag(F.col(PRODUCT_COUNTS[0]) > 0)
    for name in PRODUCT_COUNTS[1:]:
        diversity = diversity + flag(F.col(name) > 0)

    def age(name: str) -> Column:
        if name not in homes.columns:
            return F.lit(9999)
        return age_days(F.col(name), as_of, floor=0, missing=9999)

    return wide.select(
        "account_id",
        score.alias("digital_banking_score"),
        zero("credit_card_flag").alias("has_credit_card"),
        zero("fastag_flag").alias("has_fastag"),
        diversity.alias("product_diversity"),
        flag(diversity > 1).alias("has_multiple_products"),
        age("address_last_update_date").alias("address_update_age_days"),
        age("passbook_last_update_date").alias("passbook_update_age_days"),
        zero("joint_account_flag").alias("joint_account_flag"),
    )


def flag_rates_by_label(
    flags: DataFrame, labels: DataFrame, columns: Mapping[str, str] | list[str], gap_points: float = 5,
) -> DataFrame:
    """K0: percent of flag = 1 in each class and whether the classes differ by more than ``gap_points``."""
    joined = flags.join(labels.select("account_id", "is_mule"), "account_id")
    long = joined.unpivot("is_mule", [F.col(c).cast("double").alias(c) for c in columns], "feature", "value")
    rates = long.groupBy("feature").agg(
        (F.avg(F.when(F.col("is_mule") == 1, F.col("value"))) * 100).alias("mule_pct"),
        (F.avg(F.when(F.col("is_mule") == 0, F.col("value"))) * 100).alias("legit_pct"))
    return rates.withColumn("significant", flag(F.abs(F.col("mule_pct") - F.col("legit_pct")) > gap_points))


def customer_age_by_label(
    link: DataFrame, customers: DataFrame, labels: DataFrame, as_of: str = REFERENCE_DATE,
) -> DataFrame:
    """K0: median customer age in years per class, one customer per account."""
    ages = (
        primary_customer(link).join(labels.select("account_id", "is_mule"), "account_id")
        .join(customers.select("customer_id", "date_of_birth"), "customer_id", "left")
        .select("is_mule", (age_days(F.col("date_of_birth"), as_of) / F.lit(365.25)).alias("age"))
    )
    return ranked_percentiles(ages, ["is_mule"], "age", {"median_age": 0.5})


def label_dates_by_year(labels: DataFrame) -> DataFrame:
    """K0: positive labels per flag year, with missing dates (NULL year) and missing alert reasons."""
    missing = count_if(F.col("alert_reason").isNull()) if "alert_reason" in labels.columns else F.lit(None).cast("long")
    return labels.where(F.col("is_mule") == 1).groupBy(F.year("mule_flag_date").alias("flag_year")).agg(
        F.count("*").alias("labels"), missing.alias("null_reasons"))
