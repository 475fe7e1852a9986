"""Matrix assembly, imputation, gates and column policy (M)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.columns import age_days, count_if, flag, present
from ledgerlens.functions.moments import column_statistics, moments
from ledgerlens.functions.ranks import ranked_percentiles, with_single_row
from ledgerlens.schema import DUPLICATE_COLUMNS, LABEL_COLUMNS, LEAKY_COLUMNS, REFERENCE_DATE

KEY = "account_id"


def assemble(ids: DataFrame, *groups: DataFrame) -> DataFrame:
    """M1: left-join feature groups to the entity set. Every group is already hashed by account."""
    return reduce(lambda left, right: left.join(right, KEY, "left"), groups, ids)


def lookup_with_default(ids: DataFrame, values: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    """Look values up for every id, with a default where there is none."""
    return ids.join(values, KEY, "left").na.fill(dict(defaults))


def merge_packs(*packs: DataFrame, fill: float = 0) -> DataFrame:
    """Full outer join of feature packs; what one pack lacks is ``fill``."""
    return reduce(lambda left, right: left.join(right, KEY, "full"), packs).na.fill(fill)


def append_pack(features: DataFrame, pack: DataFrame, fill: float = 0) -> DataFrame:
    """M5: left-join a pack and fill its missing values."""
    names = [c for c in pack.columns if c != KEY]
    return features.join(pack, KEY, "left").na.fill(fill, names)


def long_form(features: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, feature) with a double ``value``; the common input of all column statistics."""
    doubles = [F.col(c).cast("double").alias(c) for c in cols]
    return features.select(*keep, *doubles).unpivot(list(keep), list(cols), "feature", "value")


def impute(
    features: DataFrame, median_cols: Sequence[str], fills: Mapping[str, float] | None = None,
    fit_rows: DataFrame | None = None,
) -> DataFrame:
    """M2: missing values in ``median_cols`` take the exact column median, others their fixed fill, the rest 0.

    NULL and NaN are missing. Medians come from ``fit_rows``; by default from all rows, train and test together.
    """
    fills = dict(fills or {})
    known = long_form(features if fit_rows is None else fit_rows, median_cols).where(~F.isnan("value"))
    medians = ranked_percentiles(known, ["feature"], "value", {"median": 0.5})
    row = medians.groupBy().agg(*[
        F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_m_{c}") for c in median_cols])
    rest = [c for c in features.columns if c != KEY and c not in median_cols]
    fractions = {name for name, kind in features.dtypes if kind in ("double", "float")}
    return with_single_row(features, row).select(
        KEY,
        *[F.coalesce(present(F.col(c).cast("double")), F.col(f"_m_{c}"), F.lit(0.0)).alias(c) for c in median_cols],
        *[F.coalesce(present(F.col(c)) if c in fractions else F.col(c), F.lit(fills.get(c, 0))).alias(c) for c in rest],
    ).select(*features.columns)


def null_inf_report(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M3: rows, NULLs, NaNs, infinities and the percentage of missing values (NULL or NaN) per column."""
    found = column_statistics(moments(features, cols), cols)
    return found.select("feature", "rows", "nulls", "nans", "infinities",
                        ((F.col("nulls") + F.col("nans")) / F.nullif("rows", F.lit(0)) * 100).alias("null_pct"))


def split_by_membership(features: DataFrame, labels: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M4: train rows with their labels attached, and test rows."""
    return features.join(labels, KEY, "inner"), features.join(test.select(KEY), KEY, "left_semi")


def column_policy(features: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """M7: drop leaky, label and duplicated columns."""
    return features.drop(*LEAKY_COLUMNS, *LABEL_COLUMNS, *DUPLICATE_COLUMNS, *extra)


def quality_gate(
    features: DataFrame, expected: DataFrame, required: Sequence[str] = (),
    banned: Sequence[str] = LEAKY_COLUMNS + LABEL_COLUMNS + DUPLICATE_COLUMNS,
) -> DataFrame:
    """M6: one row per check with ``passed`` 0/1 and the number of offences ``found``. NaN counts as a null value."""
    cols = [c for c in features.columns if c != KEY]
    fractions = {name for name, kind in features.dtypes if kind in ("double", "float")}
    nulls = sum((flag((present(F.col(c)) if c in fractions else F.col(c)).isNull()) for c in cols), F.lit(0))
    per_id = features.groupBy(KEY).agg(F.count("*").alias("copies"), F.sum(nulls).alias("nulls"))
    wanted = expected.select(KEY).distinct().withColumn("wanted", F.lit(1))
    facts = per_id.join(wanted, KEY, "full").agg(
        count_if(F.col("copies").isNull()).alias("missing_ids"),
        count_if(F.col("wanted").isNull()).alias("unknown_ids"),
        count_if(F.col("copies") > 1).alias("repeated_ids"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_values"),
    ).withColumns({
        "banned_columns": F.lit(len(set(banned) & set(features.columns))).cast("long"),
        "absent_columns": F.lit(len(set(required) - set(features.columns))).cast("long"),
    })
    long = facts.unpivot([], list(facts.columns), "check_name", "found")
    return long.withColumn("passed", flag(F.col("found") == 0))


def pre_label_freeze(
    labels: DataFrame, test: DataFrame, accounts: DataFrame, as_of: str = REFERENCE_DATE,
) -> DataFrame:
    """M8: freeze facts known before the flag date (train) or at all (test).

    Deliberately reproduces a leak: only positives carry a flag date, so the train flags are 0 for all others.
    :func:`column_policy` drops these columns from any feature matrix.
    """
    dates = accounts.select(KEY, "freeze_date", "unfreeze_date")
    frozen, thawed = F.col("freeze_date"), F.col("unfreeze_date")

    def described(rows: DataFrame, is_frozen: Column, was_thawed: Column, part: str) -> DataFrame:
        held = flag(is_frozen)
        return rows.join(dates, KEY, "left").select(
            KEY, F.lit(part).alias("part"), held.alias("is_frozen_clean"),
            F.when(held == 1, age_days(frozen, as_of, floor=0)).otherwise(0).alias("freeze_duration_clean"),
            flag(was_thawed).alias("was_unfrozen_before_flag"))

    flagged = F.col("mule_flag_date")
    train = described(labels.select(KEY, "mule_flag_date"), frozen < flagged, thawed < flagged, "train")
    return train.unionByName(described(test.select(KEY), frozen.isNotNull(), thawed.isNotNull(), "test"))
