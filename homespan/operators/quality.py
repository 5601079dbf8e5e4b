"""Record checks. All rules are counted in one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from homespan.functions import values as V


def _violations(df: DataFrame, boroughs: Sequence[str], rules: dict) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for name, (kind, lo, hi) in rules.items():
        if name not in df.columns:
            out[f"{name}:column_present"] = F.lit(True)
            continue
        x = F.col(name)
        out[f"{name}:not_null"] = x.isNull()
        if kind == "borough":
            out[f"{name}:allowed"] = x.isNotNull() & ~x.isin(list(boroughs))
        elif kind == "flag":
            out[f"{name}:allowed"] = x.isNotNull() & ~x.isin(0, 1)
        elif kind == "gt":
            out[f"{name}:above"] = x <= lo
        elif kind == "range":
            bad = F.lit(False)
            bad = bad | (x < lo) if lo is not None else bad
            bad = bad | (x > hi) if hi is not None else bad
            out[f"{name}:range"] = bad
    return {rule: F.coalesce(bad, F.lit(False)) for rule, bad in out.items()}


def validate_properties(df: DataFrame, boroughs: Sequence[str] = tuple(V.BOROUGHS),
                        rules: dict | None = None) -> DataFrame:
    """(rule, failures) for every rule of the property record, absent columns included."""
    checks = _violations(df, boroughs, rules or V.PROPERTY_RULES)
    row = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(checks.values())])
    entries = [F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("failures")) for i, rule in enumerate(checks)]
    return row.select(F.inline(F.array(*entries)))


def failure_cases(df: DataFrame, n: int = 20, boroughs: Sequence[str] = tuple(V.BOROUGHS),
                  rules: dict | None = None) -> DataFrame:
    """The first n (property_id, rule) failures by id."""
    checks = _violations(df, boroughs, rules or V.PROPERTY_RULES)
    broken = F.filter(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in checks.items()]), lambda r: r.isNotNull())
    return df.select("property_id", F.explode(broken).alias("rule")).orderBy("property_id", "rule").limit(n)


def require_valid(df: DataFrame, **options) -> DataFrame:
    """The input itself, or ValueError naming the broken rules."""
    broken = validate_properties(df, **options).filter("failures > 0").collect()  # at most one row per rule
    if broken:
        raise ValueError("; ".join(f"{r.rule}: {r.failures}" for r in broken))
    return df


BASIC_REQUIRED = ["property_id", "borough", "lat", "lng", "sqft", "price"]


def validate_basic(df: DataFrame, boroughs: Sequence[str] = tuple(V.BOROUGHS)) -> DataFrame:
    """The short check: required columns, known boroughs, positive price and size, latitude bounds."""
    have = set(df.columns)
    checks = {f"missing:{c}": F.lit(c not in have) for c in BASIC_REQUIRED}
    if "borough" in have:
        checks["invalid_borough"] = F.col("borough").isNotNull() & ~F.col("borough").isin(list(boroughs))
    for c in ("price", "sqft"):
        if c in have:
            checks[f"non_positive:{c}"] = F.col(c) <= 0
    if "lat" in have:
        checks["latitude_bounds"] = ~F.coalesce(F.col("lat").between(40.4, 40.95), F.lit(False))
    row = df.agg(*[F.max(F.coalesce(bad, F.lit(False))).alias(f"r{i}") for i, bad in enumerate(checks.values())])
    entries = [F.struct(F.lit(name).alias("check"), F.coalesce(F.col(f"r{i}"), F.lit(False)).alias("failed"))
               for i, name in enumerate(checks)]
    return row.select(F.inline(F.array(*entries)))


def invalid_values(df: DataFrame, column: str, valid: Sequence[str] | DataFrame) -> DataFrame:
    """Distinct values outside the valid set."""
    found = df.select(column).filter(F.col(column).isNotNull()).distinct()
    if isinstance(valid, DataFrame):
        return found.join(valid.select(column), column, "left_anti")
    return found.filter(~F.col(column).isin(list(valid)))


def feature_sanity_corr(df: DataFrame) -> DataFrame:
    """Correlations whose sign a sound table has: walk and school up, crime down."""
    wanted = {"walk_score": 1, "school_quality_score": 1, "crime_rate_per_1k": -1}
    row = df.agg(*[F.corr("price_per_sqft", c).alias(c) for c in wanted])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.rint(F.col(c) * 1e6) / 1e6).alias("r"),
                 F.lit(sign).alias("expected_sign"), (F.signum(c) == sign).alias("as_expected"))
        for c, sign in wanted.items()])))


def label_consistency(df: DataFrame) -> DataFrame:
    """Rows whose label number and name disagree, and the number of classes seen (one row)."""
    name = F.lit(None).cast("string")
    for code, text in V.LABEL_NAMES.items():
        name = F.when(F.col("valuation_label") == code, F.lit(text)).otherwise(name)
    return df.agg(F.count_if(~name.eqNullSafe(F.col("valuation_label_name"))).alias("mismatches"),
                  F.count_distinct("valuation_label").alias("classes"))
