"""Column expressions shared by the operators. All stay inside Spark's codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def col_of(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_even(x: Column | str, places: int) -> Column:
    """Scale, round half to even, unscale (``round``/``bround`` go through decimals)."""
    scale = F.lit(float(10**places))
    return F.rint(col_of(x).cast("double") * scale) / scale


def settle(x: Column | str) -> Column:
    """Thirteen significant digits: drops last-bit noise that depends on the order of summation, at any scale."""
    return F.format_string("%.12e", col_of(x).cast("double")).try_cast("double")


def clip(x: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit to [lo, hi]; null stays null (``greatest``/``least`` skip nulls)."""
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(x.isNotNull(), out)


def ratio(a: Column | str, b: Column | str) -> Column:
    """Division that yields null for a zero divisor."""
    return F.try_divide(col_of(a).cast("double"), col_of(b).cast("double"))


def text_or_nan(x: Column) -> Column:
    """Text form with 'nan' for a missing part, so that a key never turns null."""
    return F.coalesce(x.cast("string"), F.lit("nan"))


def normalize_zip(x: Column | str) -> Column:
    """Trim, pad with zeros to five places; blank and 00000 become ''."""
    text = F.trim(F.coalesce(col_of(x).cast("string"), F.lit("")))
    padded = F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)
    return F.when(padded == "00000", F.lit("")).otherwise(padded)


def hash_uniform(key: Column | str, field: str) -> Column:
    """Repeatable draw from [0, 1) for a row key and a field name."""
    digest = F.md5(F.concat(col_of(key).cast("string"), F.lit(f":{field}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_order(key: Column | str) -> Column:
    """52 bits of the key's digest as a double: a repeatable shuffle order."""
    return F.conv(F.substring(F.md5(col_of(key).cast("string")), 1, 13), 16, 10).cast("bigint").cast("double")


def hash_normal(key: Column | str, field: str) -> Column:
    """Repeatable standard normal draw (Box-Muller over two uniforms)."""
    u = F.lit(1.0) - hash_uniform(key, f"{field}:r")
    v = hash_uniform(key, f"{field}:a")
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2.0 * math.pi) * v)


def hash_exponential(key: Column | str, field: str, scale: float) -> Column:
    """Repeatable exponential draw by the inverse distribution function."""
    return F.lit(-scale) * F.log(F.lit(1.0) - hash_uniform(key, field))


def named_label(x: Column | str, names: dict) -> Column:
    """Small fixed code -> name mapping as one CASE expression."""
    out = None
    for code, name in names.items():
        out = F.when(col_of(x) == code, F.lit(name)) if out is None else out.when(col_of(x) == code, F.lit(name))
    return out
