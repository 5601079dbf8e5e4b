"""Row-wise operators: one projection each, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from homespan.functions import values as V
from homespan.functions.scalar import clip, ratio, round_even


def engineer_features(df: DataFrame, reference_year: int = V.REFERENCE_YEAR) -> DataFrame:
    """Nine derived columns; a zero divisor gives null."""
    c = F.col
    floors = F.greatest(c("num_floors"), F.lit(1))
    amenity = (c("walk_score") / 100.0 + c("transit_score") / 100.0
               + c("school_quality_score") / 10.0 - c("crime_rate_per_1k") / 80.0)
    cycle = (c("sale_year") - V.MARKET_BASE_YEAR) + (c("sale_quarter") - 1) / F.lit(4.0)
    return df.withColumns({
        "building_age": (F.lit(reference_year) - c("year_built")).cast("int"),
        "sqft_per_unit": round_even(ratio("sqft", "num_units"), 2),
        "price_per_unit": round_even(ratio("price", "num_units"), 2),
        "floor_area_ratio": round_even(ratio("sqft", "lot_sqft"), 3),
        "lot_coverage": round_even(ratio(c("sqft"), c("lot_sqft") * floors), 3),
        "amenity_score": round_even(amenity, 3),
        "log_subway_dist": round_even(F.log1p(c("nearest_subway_m").cast("double")), 3),
        "log_park_dist": round_even(F.log1p(c("nearest_park_m").cast("double")), 3),
        "market_cycle_index": round_even(cycle, 3),
    })


def canonicalize_sales(raw: DataFrame) -> DataFrame:
    """Landed all-text sales records -> typed canonical columns; bad values turn null."""
    df = raw.withColumnsRenamed({k: v for k, v in V.SALES_FIELDS.items() if k in raw.columns})
    typed = {c: F.expr(f"try_cast(`{c}` as double)") for c in V.SALES_NUMERIC if c in df.columns}
    if "sale_date" in df.columns:
        typed["sale_date"] = F.expr("try_cast(sale_date as timestamp_ntz)")
    df = df.withColumns(typed)
    if "borough_code" in df.columns:
        known = F.create_map(*[F.lit(x) for pair in V.BOROUGH_CODES.items() for x in pair])
        code = F.col("borough_code").cast("string")
        df = df.withColumn("borough", F.when(code.isin(V.BOROUGHS), code).otherwise(F.try_element_at(known, code)))
    if {"price", "sqft"} <= set(df.columns):
        df = df.withColumn("price_per_sqft", ratio("price", "sqft"))
    return df


def default_live_fields(df: DataFrame, reference_year: int = V.REFERENCE_YEAR) -> DataFrame:
    """Fill what a sales feed leaves out, so that every model input exists."""
    have = set(df.columns)

    def given(name: str):
        return F.col(name) if name in have else F.lit(None).cast("double")

    out = df.withColumns({
        "num_units": F.greatest(F.coalesce(given("num_units"), F.lit(1)), F.lit(1)).cast("int"),
        "year_built": clip(F.coalesce(given("year_built"), F.lit(1970)), 1800, reference_year).cast("int"),
        "lot_sqft": F.greatest(
            F.coalesce(given("lot_sqft"), F.col("sqft") * 1.5,
                       *([] if "lot_sqft" in have else [F.lit(2000.0)])), F.lit(500.0)).cast("bigint"),
    })
    out = out.withColumns({
        "building_age": (F.lit(reference_year) - F.col("year_built")).cast("int"),
        "num_floors": F.greatest(F.lit(1), F.floor(F.col("num_units") / 2)).cast("int"),
    })
    if "building_class" not in have:
        return out.withColumn("building_class", F.lit("Unknown"))
    # "Unknown" only if no row at all names a class
    any_class = df.agg(F.count("building_class").alias("n")).scalar()
    return out.withColumn("building_class", F.when(any_class == 0, F.lit("Unknown")).otherwise(F.col("building_class")))


def derive_sale_period(df: DataFrame) -> DataFrame:
    """Sale year and quarter; 2024/1 without a date."""
    if "sale_date" not in df.columns:
        return df.withColumns({"sale_year": F.lit(2024), "sale_quarter": F.lit(1)})
    return df.withColumns({
        "sale_year": F.coalesce(F.year("sale_date"), F.lit(2024)),
        "sale_quarter": F.coalesce(F.quarter("sale_date"), F.lit(1)),
    })


def assign_live_id(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``LIVE_<md5 of the row's content>_<price>``: independent of row order, and different sales stay apart."""
    if "property_id" in df.columns:
        return df
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(columns or df.columns)]
    digest = F.md5(F.concat_ws("|", *parts))
    return df.withColumn("property_id", F.concat(
        F.lit("LIVE_"), digest, F.lit("_"), F.coalesce(F.col("price").cast("bigint"), F.lit(0)).cast("string")))


def select_features(df: DataFrame, mode: str = "declared") -> tuple[list[str], list[str]]:
    """(numeric, categorical) model inputs without leaking or identifying columns.

    ``declared`` keeps the listed features that exist; ``dtype`` takes every
    remaining column by its type.
    """
    if mode == "declared":
        return ([c for c in V.MODEL_NUMERIC if c in df.columns],
                [c for c in V.MODEL_CATEGORICAL if c in df.columns])
    if mode != "dtype":
        raise ValueError(f"unknown mode {mode!r}")
    dropped = set(V.LEAKAGE_COLUMNS) | set(V.ID_COLUMNS)
    fields = [f for f in df.schema.fields if f.name not in dropped]
    return ([f.name for f in fields if isinstance(f.dataType, T.NumericType)],
            [f.name for f in fields if isinstance(f.dataType, T.StringType)])


def project_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def label_lookup(df: DataFrame, label: str = "valuation_label") -> DataFrame:
    """Class number -> name and recommendation bonus, as plain expressions."""
    names = F.create_map(*[F.lit(x) for pair in V.LABEL_NAMES.items() for x in pair])
    bonus = F.create_map(*[F.lit(x) for pair in V.LABEL_BONUS.items() for x in pair])
    named = df.withColumn("label_name", F.try_element_at(names, F.col(label).cast("int")))
    return named.withColumn("label_bonus", F.coalesce(F.try_element_at(bonus, F.col("label_name")), F.lit(0.0)))


def what_if_rows(requests: DataFrame, typical: DataFrame, reference_year: int = V.REFERENCE_YEAR) -> DataFrame:
    """Hypothetical properties as model inputs.

    ``requests``: borough, sqft, price, num_units, year_built and the five local
    scores. Inputs the request cannot know come from ``typical``, the one-row
    table of training medians (and most frequent class).
    """
    c = F.col
    known = requests.withColumns({
        "borough": F.upper("borough"),
        "lot_sqft": F.greatest(c("sqft") * 1.5, F.lit(1000.0)),
        "num_floors": F.greatest(F.lit(1), F.floor(c("num_units") / 2)).cast("int"),
        "building_age": (F.lit(reference_year) - c("year_built")).cast("int"),
        "bike_score": c("walk_score"),
        "amenity_score": (c("walk_score") / 100.0 + c("transit_score") / 100.0
                          + c("school_quality_score") / 10.0 - c("crime_rate_per_1k") / 80.0),
        "implied_ppsf": round_even(ratio("price", "sqft"), 2),
    })
    missing = [f for f in typical.columns if f not in known.columns]
    if not missing:
        return known
    one = typical.select(F.struct(*missing).alias("s")).limit(1).scalar()
    return known.withColumns({f: one.getField(f) for f in missing})
