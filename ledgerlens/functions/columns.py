"""Column-level cleaning and derivation (operators C1-C15)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens.functions.ranks import ranked_percentiles, with_single_row
from ledgerlens.schema import REFERENCE_DATE


def is_credit() -> Column:
    """C3."""
    return F.col("txn_type") == "C"


def is_debit() -> Column:
    """C3."""
    return F.col("txn_type") == "D"


def existing(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """The names among ``cols`` that ``df`` has; optional input columns are tolerated this way."""
    return [c for c in cols if c in df.columns]


def parse_dates(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Coerce to timestamp; unreadable text becomes NULL and absent columns are skipped."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")) for c in existing(df, cols)})


def yn_to_int(df: DataFrame, cols: Iterable[str], skip_numeric: bool = False) -> DataFrame:
    """C2: 'Y' in any case and padding is 1; everything else, NULL included, is 0."""
    types = {f.name: f.dataType for f in df.schema.fields}
    chosen = [c for c in existing(df, cols) if not (skip_numeric and isinstance(types[c], T.NumericType))]
    return df.withColumns({c: flag(F.upper(F.trim(F.col(c).cast("string"))) == "Y") for c in chosen})


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def share(condition: Column) -> Column:
    """Aggregate: fraction of rows for which the condition holds (NULL counts as no)."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def count_if(condition: Column) -> Column:
    """Aggregate: number of rows for which the condition holds; 0 and not NULL when none do."""
    return F.count(F.when(condition, True))


def ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Quotient where the denominator is positive, otherwise ``default``."""
    quotient = F.when(denominator > 0, numerator.cast("double") / denominator)
    return quotient if default is None else quotient.otherwise(F.lit(default))


def clip(column: Column, low: float | None = None, high: float | None = None) -> Column:
    """C4: bound a column on one or both sides; NULL stays NULL."""
    bounded = column
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(column.isNotNull(), bounded)


def present(column: Column) -> Column:
    """The value, NULL where it is NaN."""
    return F.when(~F.isnan(column), column)


def is_infinite(column: Column) -> Column:
    return F.abs(column.cast("double")) == F.lit(float("inf"))


def replace_inf(
    df: DataFrame, cols: Sequence[str], high: float | None = 0.99, low: float | None = 0.01,
) -> DataFrame:
    """Replace +inf / -inf by the column's own exact quantiles, or by 0 where a level is None."""
    levels = {name: p for name, p in (("q_hi", high), ("q_lo", low)) if p is not None}
    if not levels:
        zeroed = {c: F.when(is_infinite(F.col(c)), 0.0).otherwise(F.col(c)) for c in cols}
        return df.withColumns(zeroed)
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in cols], "feature", "value")
    stats = ranked_percentiles(long, ["feature"], "value", levels)
    # One row with one struct per column: as wide as the column list, never as long as the data.
    row = stats.groupBy().agg(*[
        F.max(F.when(F.col("feature") == c, F.struct(*levels))).alias(f"_{c}") for c in cols
    ])

    def bound(c: str, name: str) -> Column:
        return F.col(f"_{c}")[name] if name in levels else F.lit(0.0)

    fixed = {
        c: F.when(F.col(c) == float("inf"), bound(c, "q_hi"))
        .when(F.col(c) == float("-inf"), bound(c, "q_lo"))
        .otherwise(F.col(c))
        for c in cols
    }
    return with_single_row(df, row).withColumns(fixed).drop(*[f"_{c}" for c in cols])


def map_category(column: Column, mapping: Mapping[str, float], default: float) -> Column:
    """Look a category up in a small fixed mapping."""
    pairs = [F.lit(item) for entry in mapping.items() for item in entry]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), F.lit(default))


def one_hot(column: Column, values: Mapping[str, str]) -> dict[str, Column]:
    """0/1 column per value, keyed by output name; NULL is 0 everywhere."""
    return {name: flag(column == value) for name, value in values.items()}


def prefix_mismatch(left: Column, right: Column, length: int = 3) -> Column:
    """1 when the leading characters differ. A NULL left side never matches; NULL right reads as 0."""
    head = F.substring(F.coalesce(left.cast("string"), F.lit("nan")), 1, length)
    other = F.substring(F.coalesce(right.cast("int"), F.lit(0)).cast("string"), 1, length)
    return flag(head != other)


def age_days(column: Column, as_of: str = REFERENCE_DATE, floor: int | None = None,
             missing: int | None = None) -> Column:
    """Whole days from ``column`` to the reference date."""
    days = F.datediff(F.lit(as_of).cast("date"), column)
    if floor is not None:
        days = clip(days, low=floor)
    return days if missing is None else F.coalesce(days, F.lit(missing))


def log1p_nonneg(column: Column) -> Column:
    """log(1 + max(x, 0)); NULL stays NULL."""
    return F.log1p(clip(column.cast("double"), low=0.0))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """C11: drop columns, ignoring those that are absent."""
    return df.drop(*names)


def in_subset(df: DataFrame, ids: DataFrame, key: str = "account_id") -> DataFrame:
    """Keep rows whose key is in ``ids``; a semi join, so the id set may be any size."""
    return df.join(ids.select(key), key, "left_semi")


def has_valid_location(lat: str = "latitude", lon: str = "longitude") -> Column:
    """Both coordinates present and non-zero."""
    return F.coalesce((F.col(lat) != 0) & (F.col(lon) != 0), F.lit(False))


def grid_bin(column: Column, digits: int = 1) -> Column:
    """C14: grid cell of a coordinate by rounding."""
    return F.round(column, digits)


def format_ts(column: Column, end_of_day: bool = False) -> Column:
    """Day as ISO text, at midnight or at 23:59:59; NULL becomes ''."""
    pattern = "yyyy-MM-dd'T23:59:59'" if end_of_day else "yyyy-MM-dd'T00:00:00'"
    return F.coalesce(F.date_format(column, pattern), F.lit(""))


def whole_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two timestamps counted as crossed second boundaries."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def exact_hours(later: Column, earlier: Column) -> Column:
    """Hours between two timestamps, fractions kept to the microsecond."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)
