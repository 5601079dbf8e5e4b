"""Predicates and row selection. Plain filters, so Spark pushes them to the scan."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from homespan.functions import values as V


def recent_sales(df: DataFrame, limit: int = 5000, borough: str | None = None,
                 min_price: float = 100_000, since: str | None = None) -> DataFrame:
    """Newest sales first, ties by id; ``limit`` is how many."""
    out = df.filter(F.col("price") > min_price)
    if borough:
        out = out.filter(F.col("borough") == borough.upper().strip())
    if since:
        out = out.filter(F.col("sale_date") >= F.lit(datetime.fromisoformat(since)).cast("timestamp_ntz"))
    return topk_recent(out, limit)


def topk_recent(df: DataFrame, n: int) -> DataFrame:
    """The n newest sales."""
    return df.orderBy(F.desc_nulls_last("sale_date"), "property_id").limit(n)


def sanity_filter(df: DataFrame, min_price: float = 100_000, min_sqft: float = 200,
                  ppsf_range: tuple[float, float] = (50.0, 5000.0)) -> DataFrame:
    """Drop sales that cannot be market sales."""
    return df.filter((F.col("price") >= min_price) & (F.col("sqft") >= min_sqft)
                     & F.col("price_per_sqft").between(*ppsf_range))


COMPARE_COLUMNS = ["property_id", "borough", "price", "sqft", "price_per_sqft", "num_units", "walk_score",
                   "transit_score", "school_quality_score", "crime_rate_per_1k", "valuation_label_name"]


def compare_properties(df: DataFrame, ids: Sequence[str] | DataFrame) -> DataFrame:
    """The named properties side by side; ids as a list or as a table."""
    picked = (df.join(ids.select("property_id").distinct(), "property_id", "left_semi")
              if isinstance(ids, DataFrame) else df.filter(F.col("property_id").isin(list(ids))))
    return picked.select(*[c for c in COMPARE_COLUMNS if c in df.columns])


#: What a preference request may hold. Null, zero, false or an empty text is no wish.
REQUEST_FIELDS = {"budget_max": "double", "borough": "string", "bedrooms_min": "int", "prefer_undervalued": "boolean",
                  "prefer_walkable": "boolean", "prefer_safe": "boolean", "prefer_school": "boolean",
                  "prefer_transit": "boolean"}


def asked_for(field: str, wish: Column) -> Column:
    """Whether a request has this wish."""
    nothing = {"string": F.lit(""), "boolean": F.lit(False)}.get(REQUEST_FIELDS[field], F.lit(0))
    return F.coalesce(wish != nothing, F.lit(False))


def within_limits(wish: Callable[[str], Column]) -> Column:
    """Whether a row meets the hard limits of a request, whose fields ``wish`` gives as columns."""
    limits = {"budget_max": F.col("price") <= wish("budget_max"),
              "borough": F.col("borough") == F.upper(wish("borough")),
              "bedrooms_min": F.col("num_units") >= wish("bedrooms_min"),
              "prefer_undervalued": F.col("valuation_label_name") == V.LABEL_NAMES[0]}
    return reduce(and_, [~asked_for(field, wish(field)) | met for field, met in limits.items()])


def preference_filter(df: DataFrame, preferences: dict) -> DataFrame:
    """Hard limits of one buyer's wishes; constants, so they reach the scan."""
    return df.filter(within_limits(lambda field: F.lit(preferences.get(field)).cast(REQUEST_FIELDS[field])))


def similarity_filter(df: DataFrame, label: str | None = None, max_price: float | None = None,
                      borough: str | None = None) -> DataFrame:
    """Limits on recommended rows; applied before scoring, which gives the same top rows."""
    out = df
    if label is not None:
        out = out.filter(F.col("valuation_label_name") == label)
    if max_price is not None:
        out = out.filter(F.col("price") <= max_price)
    if borough is not None:
        out = out.filter(F.col("borough") == borough)
    return out


def relevant_set(df: DataFrame, borough: str = V.DEFAULT_BOROUGH, max_price: float = 1_200_000) -> DataFrame:
    """Ids that count as relevant when recommendations are judged."""
    return preference_filter(df, {"budget_max": max_price, "borough": borough, "prefer_undervalued": True}) \
        .select("property_id")
