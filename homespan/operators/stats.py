"""Summary tables: counts, shares, medians, correlations, histograms."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from homespan.functions.scalar import ratio, round_even, settle
from homespan.operators.sampling import sample_n
from homespan.operators.skew import HOT_ROWS, group_medians, group_quantiles, join_lookup


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def label_distribution(df: DataFrame, keys: Sequence[str] = (), label: str = "valuation_label_name") -> DataFrame:
    """Rows and share per label, per key group; the shares are taken over the small counted table."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    if not keys:
        total = counts.agg(F.sum("n").alias("n")).scalar()
        return counts.withColumn("share", round_even(F.col("n") / total, 3))
    return counts.withColumn("share", round_even(F.col("n") / F.sum("n").over(Window.partitionBy(*keys)), 3))


def _label_shares(df: DataFrame) -> list[Column]:
    named = F.count("valuation_label_name")
    return [round_even(ratio(F.count_if(F.col("valuation_label_name") == name), named), 3).alias(f"share_{name}")
            for name in ("undervalued", "fairly_valued", "overvalued")]


PROFILE_PLACES = {"price": None, "price_per_sqft": 2, "walk_score": 1, "transit_score": 1,
                  "school_quality_score": 2, "crime_rate_per_1k": 2, "median_household_income": None}


def neighborhood_profile(df: DataFrame, borough: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Size, seven medians and label shares of one borough, or of each."""
    rows = df.filter(F.col("borough") == borough.upper()) if borough else df.filter(F.col("borough").isNotNull())
    out = group_medians(rows, ["borough"], list(PROFILE_PLACES),
                        [F.count(F.lit(1)).alias("n_properties"), *_label_shares(df)], hot_rows)
    medians = {f"median_{c}" if not c.startswith("median_") else c:
               F.floor(c).cast("bigint") if p is None else round_even(c, p) for c, p in PROFILE_PLACES.items()}
    return out.select("borough", "n_properties", *[e.alias(n) for n, e in medians.items()],
                      *[f"share_{n}" for n in ("undervalued", "fairly_valued", "overvalued")])


def _whole_and_parts(df: DataFrame, key: str, columns: Sequence[str], aggs: Sequence[Column],
                     hot_rows: int) -> DataFrame:
    """Medians and aggregates per ``key`` and for the table ('all')."""
    parts = group_medians(df.filter(F.col(key).isNotNull()), [key], columns, aggs, hot_rows)
    whole = group_medians(df, [], columns, aggs, hot_rows).withColumn(key, F.lit("all"))
    return whole.unionByName(parts)


def market_summary(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Size, median price and ppsf, label shares: the whole market and each borough."""
    out = _whole_and_parts(df, "borough", ["price", "price_per_sqft"],
                           [F.count(F.lit(1)).alias("total_properties"), *_label_shares(df)], hot_rows)
    return out.select("borough", "total_properties", F.floor("price").cast("bigint").alias("median_price"),
                      round_even("price_per_sqft", 2).alias("median_ppsf"),
                      *[f"share_{n}" for n in ("undervalued", "fairly_valued", "overvalued")])


def live_market_summary(df: DataFrame, as_of: str, days_back: int = 90, borough: str | None = None,
                        hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sales of the last ``days_back`` days before ``as_of``: overall and per borough."""
    start = F.date_sub(F.lit(as_of).cast("date"), days_back).cast("timestamp_ntz")
    rows = df.filter((F.col("sale_date") >= start) & (F.col("sale_date") <= F.lit(as_of).cast("timestamp_ntz")))
    if borough:
        rows = rows.filter(F.col("borough") == borough.upper())
    out = _whole_and_parts(rows, "borough", ["price", "price_per_sqft"],
                           [F.count(F.lit(1)).alias("n"), F.min("sale_date").alias("lo"),
                            F.max("sale_date").alias("hi")], hot_rows)
    return out.select(
        "borough", "n", F.floor("price").cast("bigint").alias("median_price"),
        round_even("price_per_sqft", 2).alias("median_ppsf"),
        F.date_format("lo", "yyyy-MM-dd").alias("earliest"), F.date_format("hi", "yyyy-MM-dd").alias("latest"))


BOROUGH_METRICS = ["price", "price_per_sqft", "sqft", "walk_score", "crime_rate_per_1k", "school_quality_score"]


def borough_medians(df: DataFrame, columns: Sequence[str] = tuple(BOROUGH_METRICS),
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Medians of several metrics by borough."""
    return group_medians(df.filter(F.col("borough").isNotNull()), ["borough"], list(columns), hot_rows=hot_rows)


def boroughs_by_median(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Boroughs by median price per square foot, dearest first, with their position."""
    medians = borough_medians(df, ["price_per_sqft"], hot_rows)
    place = Window.partitionBy(F.lit(1)).orderBy(F.desc("price_per_sqft"), "borough")  # one row per borough
    return medians.select("borough", F.col("price_per_sqft").alias("median_ppsf"),
                          F.row_number().over(place).alias("position")).orderBy("position")


def price_trend(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Median price per square foot by sale year and borough."""
    return group_medians(df.filter(F.col("borough").isNotNull()), ["sale_year", "borough"],
                         ["price_per_sqft"], hot_rows=hot_rows) \
        .withColumnRenamed("price_per_sqft", "median_ppsf")


def count_neighborhoods(df: DataFrame) -> DataFrame:
    """Number of distinct zones (one row)."""
    return df.agg(F.count_distinct("nta_proxy").alias("n_neighborhoods"))


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe_table(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Count, mean, deviation, quartiles of numeric and unique/top/freq of text columns.

    Distinct text values are counted before the shuffle, so a frequent value is
    one row per task; the quartiles use the hot-group route for large tables.
    """
    numbers = _numeric(df)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    nothing = F.lit(None)
    counts = (df.select(*texts).unpivot([], texts, "column", "value").filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    # the most frequent value, the smallest on a tie
    top_n = counts.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
                                         F.max("n").alias("freq"))
    top = (counts.join(F.broadcast(top_n), "column").filter(F.col("n") == F.col("freq"))  # one row per column
           .groupBy("column").agg(F.min("value").alias("top"), F.first("count").alias("count"),
                                  F.first("unique").alias("unique"), F.first("freq").alias("freq")))
    text_part = top.select("column", "count", "unique", "top", "freq", *[
        nothing.cast("double").alias(s) for s in ("mean", "std", "min", "q25", "q50", "q75", "max")])
    q = group_quantiles(df, [], numbers, (0.25, 0.5, 0.75), hot_rows=hot_rows)
    moments = df.agg(*[F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                                F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
                       for c in numbers])
    q_long = q.unpivot([], numbers, "column", "q")
    m_long = moments.unpivot([], numbers, "column", "m")
    number_part = m_long.join(q_long, "column").select(
        "column", "m.count", nothing.cast("bigint").alias("unique"), nothing.cast("string").alias("top"),
        nothing.cast("bigint").alias("freq"), "m.mean", "m.std", "m.min",
        *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))], "m.max")
    out = text_part.unionByName(number_part)
    return out.withColumns({s: round_even(settle(s), 6) for s in ("mean", "std", "min", "q25", "q50", "q75", "max")})


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair, over rows where both are present; long form.

    Every Arrow batch becomes one small matrix of sums over its present pairs
    (values taken relative to the column mean); Spark adds the matrices up.
    """
    columns = list(columns or _numeric(df))
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()  # one number per column
    centre = np.array([means[c] or 0.0 for c in columns], dtype=float)
    m = len(columns)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, m, m))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float, na_value=np.nan) - centre
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            xx = x * x
            total += np.stack([there.T @ there, x.T @ there, there.T @ x, xx.T @ there, there.T @ xx, x.T @ x])
        yield pd.DataFrame({"i": np.repeat(np.arange(m), m), "j": np.tile(np.arange(m), m),
                            **{f"s{k}": total[k].ravel() for k in range(6)}})
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInPandas(
        sums, "i int, j int, " + ", ".join(f"s{k} double" for k in range(6)))
    n, sx, sy, sxx, syy, sxy = (F.col(f"s{k}") for k in range(6))
    total = parts.groupBy("i", "j").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(6)])
    spread = F.sqrt(sxx - sx * sx / n) * F.sqrt(syy - sy * sy / n)
    names = F.array(*[F.lit(c) for c in columns])
    return total.filter(n > 0).select(
        F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"),
        round_even(settle(F.try_divide(sxy - sx * sy / n, spread)), 6).alias("r"))


def missingness(df: DataFrame) -> DataFrame:
    """Share of nulls per column that has any, largest first."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return shares.unpivot([], df.columns, "column", "null_share") \
        .filter(F.col("null_share") > 0).orderBy(F.desc("null_share"), "column")


def histogram(df: DataFrame, value: Column, bins: int = 60, limits: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; ``limits`` clips first."""
    x = value.cast("double")
    if limits:
        x = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(limits[0])), F.lit(limits[1])))
    rows = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    bounds = rows.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("b")).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    place = F.least(F.floor(F.coalesce(F.try_divide(F.col("x") - lo, width), F.lit(0.0))), F.lit(bins - 1))
    counts = rows.select(place.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", round_even(lo + width * F.col("bin"), 6).alias("from_value"),
                         round_even(lo + width * (F.col("bin") + 1), 6).alias("to_value"), "n")


def boxplot_stats(df: DataFrame, key: str = "borough", value: str = "price_per_sqft",
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Quartiles and 1.5-IQR whiskers per group, largest median first."""
    rows = df.filter(F.col(key).isNotNull())
    q = group_quantiles(rows, [key], [value], (0.25, 0.5, 0.75), hot_rows=hot_rows).select(
        key, *[F.get(value, F.lit(i)).alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    fence = 1.5 * (F.col("q3") - F.col("q1"))
    inside = join_lookup(rows.select(key, value), q, [key]).filter(
        F.col(value).between(F.col("q1") - fence, F.col("q3") + fence))
    return inside.groupBy(key, "q1", "median", "q3").agg(
        F.min(value).alias("whisker_lo"), F.max(value).alias("whisker_hi")) \
        .withColumns({c: round_even(c, 6) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")}) \
        .orderBy(F.desc("median"), key)


def rating_means(interactions: DataFrame) -> DataFrame:
    """Mean rating per buyer, per item and overall, in long form."""
    def part(kind: str, key: Column, *by: str) -> DataFrame:
        return interactions.groupBy(*by).agg(F.avg("rating").alias("mean_rating"), F.count(F.lit(1)).alias("n")) \
            .select(F.lit(kind).alias("kind"), key.cast("string").alias("key"), "mean_rating", "n")
    return part("buyer", F.col("buyer_id"), "buyer_id") \
        .unionByName(part("property", F.col("property_id"), "property_id")) \
        .unionByName(part("all", F.lit("all"))).withColumn("mean_rating", round_even("mean_rating", 6))


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / sample deviation, null -> 0, as ``z_<column>``; one pass plus one row."""
    one = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c)
                            for c in columns]).alias("fit")).scalar()
    return df.withColumns({
        f"z_{c}": F.coalesce(F.try_divide(F.col(c) - one.getField(c).getField("m"), one.getField(c).getField("s")),
                             F.lit(0.0)) for c in columns})


def union_sources(first: DataFrame, top_up: DataFrame, target: int | None = None,
                  tags: tuple[str, str] = ("live_nyc_dof", "synthetic")) -> DataFrame:
    """Rows of both sources over their shared columns, tagged.

    With ``target`` the second source only fills up to that many rows, by a repeatable sample.
    """
    shared = [c for c in top_up.columns if c in first.columns and c != "data_source"]
    if target is not None:
        top_up = sample_n(top_up, max(target - first.count(), 0))
    return first.select(*shared, F.lit(tags[0]).alias("data_source")).unionByName(
        top_up.select(*shared, F.lit(tags[1]).alias("data_source")))


def merge_candidates(best: DataFrame, browsed: DataFrame, cap: int) -> DataFrame:
    """Union of two id sets per profile without repeats, best first, at most ``cap`` each."""
    both = best.select("buyer_profile", "property_id", F.lit(0).alias("source")).unionByName(
        browsed.select("buyer_profile", "property_id", F.lit(1).alias("source")))
    merged = both.groupBy("buyer_profile", "property_id").agg(F.min("source").alias("source"))
    place = Window.partitionBy("buyer_profile").orderBy("source", "property_id")
    return merged.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= cap)


def melt_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide model metrics -> (ids, metric, value)."""
    return df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(ids), list(metrics), "metric", "value")
