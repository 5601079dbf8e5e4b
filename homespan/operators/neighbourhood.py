"""Neighbourhood keys, percentiles, peer statistics and valuation labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from homespan.functions import values as V
from homespan.functions.scalar import named_label, round_even, text_or_nan
from homespan.operators.skew import HOT_ROWS, group_medians, join_lookup, percent_ranks
from homespan.session import cut

PERCENTILES = {
    "price_per_sqft": "ppsf_neighborhood_percentile",
    "crime_rate_per_1k": "crime_neighborhood_percentile",
    "school_quality_score": "school_neighborhood_percentile",
    "median_household_income": "income_neighborhood_percentile",
}


def assign_neighborhood(df: DataFrame) -> DataFrame:
    """Grid key borough_lat_lng at two decimals."""
    return df.withColumn("nta_proxy", F.concat_ws(
        "_", text_or_nan(F.col("borough")),
        text_or_nan(round_even("lat", 2)), text_or_nan(round_even("lng", 2))))


def neighborhood_percentiles(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Four percentile ranks within the neighbourhood."""
    return percent_ranks(df, "nta_proxy", PERCENTILES, hot_rows)


def neighborhood_median_join(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Median price per square foot of the neighbourhood on every row."""
    medians = group_medians(df, ["nta_proxy"], ["price_per_sqft"], hot_rows=hot_rows)
    return join_lookup(df, medians.withColumnRenamed("price_per_sqft", "ppsf_neighborhood_median"), ["nta_proxy"])


def enrich(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The enrich stage: key, percentiles, median."""
    keyed = assign_neighborhood(df)
    return neighborhood_median_join(neighborhood_percentiles(keyed, hot_rows), hot_rows)


def unit_bucket(units: Column) -> Column:
    """Right-closed bins of the unit count; outside them the text 'nan'."""
    inside = (units > 0) & (units <= 1000)
    return (F.when(~inside | units.isNull(), F.lit("nan"))
             .when(units <= 1, F.lit("1u")).when(units <= 2, F.lit("2u"))
             .when(units <= 4, F.lit("3-4u")).when(units <= 8, F.lit("5-8u")).otherwise(F.lit("9+u")))


def peer_keys(df: DataFrame) -> DataFrame:
    """Add both peer-group keys."""
    keyed = df if "nta_proxy" in df.columns else assign_neighborhood(df)
    return keyed.withColumn("unit_bucket", unit_bucket(F.col("num_units")))


def peer_stats(keyed: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows, median and sample deviation of price per square foot per peer group."""
    return group_medians(
        keyed, ["nta_proxy", "unit_bucket"], ["price_per_sqft"],
        [F.count(F.lit(1)).alias("peer_rows"), F.stddev_samp("price_per_sqft").alias("peer_std")],
        hot_rows).withColumnRenamed("price_per_sqft", "peer_median_ppsf")


def std_fill(peers: DataFrame) -> DataFrame:
    """Row-weighted mean deviation over groups that have one (one row)."""
    return peers.filter(F.col("peer_std").isNotNull()).agg(
        (F.sum(F.col("peer_std") * F.col("peer_rows")) / F.sum("peer_rows")).alias("std_fill"))


def borough_stats(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Median and deviation per borough; rows without a borough form no group."""
    return group_medians(
        df.filter(F.col("borough").isNotNull()), ["borough"], ["price_per_sqft"],
        [F.stddev_samp("price_per_sqft").alias("borough_std")], hot_rows,
    ).withColumnRenamed("price_per_sqft", "borough_median")


def peer_zscore(df: DataFrame, hot_rows: int = HOT_ROWS, min_peers: int = V.MIN_PEERS) -> DataFrame:
    """Distance from the peer median in peer deviations.

    A missing deviation takes the row-weighted mean one, a zero deviation or a
    missing price gives 0, and groups below ``min_peers`` rows use their borough.
    Group statistics are aggregates joined back: no window over the whole table.
    """
    keyed = peer_keys(df)
    peers = cut(peer_stats(keyed, hot_rows))
    rows = join_lookup(keyed, peers, ["nta_proxy", "unit_bucket"], stored=True)
    rows = rows.withColumn("std_fill", std_fill(peers).scalar())
    rows = join_lookup(rows, borough_stats(keyed, hot_rows), ["borough"])
    std = F.coalesce("peer_std", "std_fill")
    near = (F.col("price_per_sqft") - F.col("peer_median_ppsf")) / F.nullif(std, F.lit(0.0))
    wide = (F.col("price_per_sqft") - F.col("borough_median")) / F.nullif(F.col("borough_std"), F.lit(0.0))
    z = F.coalesce(F.when(F.col("peer_rows") < min_peers, wide).otherwise(near), F.lit(0.0))
    return rows.withColumns({"peer_std_ppsf": std, "peer_z": z}).drop(
        "peer_std", "std_fill", "peer_rows", "borough_median", "borough_std")


def valuation_label(df: DataFrame, lo: float = V.UNDERVALUED_Z, hi: float = V.OVERVALUED_Z) -> DataFrame:
    """Class from the z-score, and its name."""
    label = F.when(F.col("peer_z") < lo, 0).when(F.col("peer_z") > hi, 2).otherwise(1)
    return df.withColumn("valuation_label", label).withColumn(
        "valuation_label_name", named_label("valuation_label", V.LABEL_NAMES))


CRITICAL = ["price", "sqft", "price_per_sqft", "valuation_label"]


def drop_null_critical(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows that miss a critical field."""
    return df.dropna(subset=columns or CRITICAL)


def dropped_null_critical(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """How many rows ``drop_null_critical`` keeps and drops (one row)."""
    bad = F.lit(False)
    for c in columns or CRITICAL:
        bad = bad | F.col(c).isNull()
    return df.agg(F.count_if(~bad).alias("kept"), F.count_if(bad).alias("dropped"))


def label(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The features stage after ``engineer_features``: z-score, label, clean-up."""
    return drop_null_critical(valuation_label(peer_zscore(df, hot_rows)))
