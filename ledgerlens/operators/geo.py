"""IP sharing (F) and locations (Z)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.columns import flag, has_valid_location, share
from ledgerlens.operators.channels import entropy


def ip_table(ledger: DataFrame) -> DataFrame:
    """One row per (account, ip), blank and NULL included, with the row count."""
    return ledger.groupBy("account_id", "ip_address").agg(F.count("*").alias("n"))


def ip_popularity(ips: DataFrame) -> DataFrame:
    """distinct accounts per non-blank ip, from the (account, ip) grain."""
    used = ips.where(F.col("ip_address").isNotNull() & (F.col("ip_address") != ""))
    return used.groupBy("ip_address").agg(F.count("*").alias("ip_account_count"))


def coordinate_aggregates() -> dict[str, Column]:
    return {"lat_std": F.stddev_samp("latitude"), "lon_std": F.stddev_samp("longitude")}


def _length(lat: str, lon: str) -> Column:
    return F.sqrt(F.pow(F.coalesce(lat, F.lit(0.0)), F.lit(2)) + F.pow(F.coalesce(lon, F.lit(0.0)), F.lit(2)))


def geo_spread() -> Column:
    return _length("lat_std", "lon_std")


def coordinate_spread(ledger: DataFrame) -> DataFrame:
    """F2, coordinates: sample deviations (0/0 points included) and their combined length."""
    named = [column.alias(name) for name, column in coordinate_aggregates().items()]
    return ledger.groupBy("account_id").agg(*named).withColumn("geo_spread", geo_spread())


def ip_profile(ips: DataFrame, popularity: DataFrame) -> DataFrame:
    """F2, addresses: distinct ips (a blank is a value), blank share, and transaction-weighted ip sharing.

    The join to ip popularity runs at the (account, ip) grain. A popular ip is one row per account there, and the
    popularity side holds one row per ip, so a skewed ip is split by the adaptive join. Rows without an address
    match nothing; they join on a key of their own account, or they would all meet in one partition.
    """
    no_address = F.col("ip_address").isNull() | (F.col("ip_address") == "")
    keyed = ips.withColumn("_ip", F.when(no_address, F.concat(F.lit("none:"), "account_id")).otherwise(
        F.concat(F.lit("ip:"), "ip_address")))
    weighted = keyed.join(
        popularity.select(F.concat(F.lit("ip:"), "ip_address").alias("_ip"), "ip_account_count"), "_ip", "left")
    known = F.when(F.col("ip_account_count").isNotNull(), F.col("n"))
    blank = F.col("ip_address").isNull() | (F.col("ip_address") == "")
    return weighted.groupBy("account_id").agg(
        F.count("ip_address").alias("unique_ips"),
        (F.sum(F.when(blank, F.col("n")).otherwise(0)).cast("double") / F.sum("n")).alias("ip_null_rate"),
        F.when(F.sum(known) > 0, F.sum(F.col("ip_account_count") * F.col("n")).cast("double") / F.sum(known))
        .alias("avg_ip_sharing"),
    )


def geo_ip_profile(ledger: DataFrame, ips: DataFrame, popularity: DataFrame) -> DataFrame:
    """address and coordinate statistics together."""
    return ip_profile(ips, popularity).join(coordinate_spread(ledger), "account_id")


def location_aggregates() -> dict[str, Column]:
    deposit = F.col("atm_deposit_channel_code")
    return {
        "txns_with_location": share(has_valid_location()),
        "lat_range": F.max("latitude") - F.min("latitude"),
        "lon_range": F.max("longitude") - F.min("longitude"),
        "atm_deposit_channel_flag": share(deposit.isNotNull() & (deposit != "")),
    }


def max_distance() -> Column:
    """Length of the coordinate ranges. The published output name says km, but it is in degrees."""
    return _length("lat_range", "lon_range")


def distinct_cells(cells: DataFrame) -> DataFrame:
    """Distinct grid cells; a cell with NULL coordinates is a value."""
    return cells.groupBy("account_id", "lat_bin", "lon_bin").agg(F.count("*").alias("_k")).groupBy("account_id").agg(
        F.count("*").alias("unique_location_count"))


def location_stats(ledger: DataFrame, cells: DataFrame) -> DataFrame:
    """Distinct cells, located share, coordinate range, deposit-channel share."""
    named = [column.alias(name) for name, column in location_aggregates().items()]
    spread = ledger.groupBy("account_id").agg(*named).withColumn("max_distance_km_approx", max_distance())
    return spread.drop("lat_range", "lon_range").join(distinct_cells(cells), "account_id")


def location_entropy(cells: DataFrame) -> DataFrame:
    """Entropy over grid cells of usable locations; an account has at most as many cells as the grid."""
    usable = cells.where("located").groupBy("account_id", "lat_bin", "lon_bin").agg(F.sum("n").alias("n"))
    return entropy(usable, "location_entropy")


def impossible_travel(ledger: DataFrame, hours: float = 2, degrees: float = 5, slices: int = 64, chunk: int = 4096) -> DataFrame:
    """Z3: 1 for accounts with two usable locations within (0, ``hours``] more than ``degrees`` apart on an axis.

    Instead of pairing rows, time is cut into ``slices`` per span of ``hours``. The later partner of a row lies in its own slice, in one of the
    next ``slices`` - 1, which the span always covers whole, or in the two at the span's end. Whole slices are decided by the smallest
    and largest coordinates of slices alone, a partial aggregate; sliding extremes over slices run in chunks of bounded length that carry the
    slices of the next chunk they look into. Rows are only compared inside a slice, or between a slice and the two at the span's end, where
    the extremes leave it open. However many rows an account has in ``hours``, they are spread over that many slices.
    """
    width = int(hours * 3_600_000_000)
    slices = max(1, min(slices, width))
    step, chunk = max(1, width // slices), max(chunk, slices + 1)
    axes = ("lat_bin", "lon_bin")
    points = ledger.where(has_valid_location()).select(
        "account_id", F.unix_micros("ts").alias("us"),
        F.round("latitude", 1).alias("lat_bin"), F.round("longitude", 1).alias("lon_bin"),
    ).withColumn("slice", F.floor(F.col("us") / step))
    extremes = points.groupBy("account_id", "slice").agg(*[f(axis).alias(f"{f.__name__}_{axis}") for axis in axes for f in (F.min, F.max)])

    own = F.floor(F.col("slice") / chunk)
    ahead = slices + 1  # slices of the next chunk that a chunk looks into
    carried = extremes.select("*", F.explode(F.when(
        F.pmod("slice", F.lit(chunk)) < ahead, F.array(own, own - 1)).otherwise(F.array(own))).alias("chunk"))
    order = Window.partitionBy("account_id", "chunk").orderBy("slice")

    def apart(first: int, last: int) -> Column:
        window, found = order.rangeBetween(first, last), F.lit(False)
        for axis in axes:
            low, high = F.min(f"min_{axis}").over(window), F.max(f"max_{axis}").over(window)
            found = found | (high - F.col(f"min_{axis}") > degrees) | (F.col(f"max_{axis}") - low > degrees)
        return F.coalesce(found, F.lit(False))

    judged = carried.select("account_id", "slice", "chunk", apart(1, slices - 1).alias("sure") if slices > 1 else F.lit(False).alias("sure"),
                            apart(0, 0).alias("inside"), apart(slices, slices + 1).alias("ends")).where(F.col("chunk") == own)
    open_slices = judged.where("NOT sure AND (inside OR ends)").select(
        "account_id", F.col("slice").alias("home"),
        F.explode(F.array(F.col("slice"), F.col("slice") + slices, F.col("slice") + slices + 1)).alias("slice"))
    later = Window.partitionBy("account_id", "home").orderBy("us").rangeBetween(1, width)
    gap = F.lit(False)
    for axis in axes:
        gap = gap | (F.max(axis).over(later) - F.col(axis) > degrees) | (F.col(axis) - F.min(axis).over(later) > degrees)
    compared = points.join(open_slices, ["account_id", "slice"]).withColumn("apart", F.coalesce(gap, F.lit(False)))
    hits = judged.where("sure").select("account_id").unionByName(compared.where("apart").select("account_id")).distinct()
    everyone = ledger.select("account_id").distinct()
    return everyone.join(hits.withColumn("_hit", F.lit(1)), "account_id", "left").select(
        "account_id", flag(F.col("_hit") == 1).alias("impossible_travel_flag"))
