"""Repeatable samples: the order is a digest of the row key, never a random seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from homespan.functions.scalar import hash_order
from homespan.operators.skew import join_lookup, kth_smallest

IN_ONE_TASK = 100_000  # largest sample that is gathered by one top-n


def sample_n(df: DataFrame, n: int, key: str = "property_id") -> DataFrame:
    """n rows (all, if fewer): those with the smallest digest of the key, ties by key.

    Small samples are a top-n. Large ones use the digest of the n-th row as a
    cutoff, so no task gathers the sample; rows that share that very digest are
    resolved by key among themselves.
    """
    if n <= IN_ONE_TASK:
        return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
    marked = df.withColumns({"__order": hash_order(key), "__all": F.lit(1)})
    cut_at = kth_smallest(marked, ["__all"], "__order", lambda total: F.least(total, F.lit(n)))
    at = cut_at.select("cutoff").scalar()
    below = marked.filter(F.col("__order") < at)
    room = F.lit(n) - below.agg(F.count(F.lit(1))).scalar()
    tied = marked.filter(F.col("__order") == at).withColumn(
        "__place", F.row_number().over(Window.partitionBy("__order").orderBy(F.md5(F.col(key).cast("string")), key)))
    return below.unionByName(tied.filter(F.col("__place") <= room).drop("__place")).drop("__order", "__all")


def stratified_split(df: DataFrame, label: str = "valuation_label", test_share: float = 0.2,
                     key: str = "property_id") -> DataFrame:
    """Add ``is_test``: per label, the rows up to the ceil(share * n)-th smallest key digest.

    Only one cutoff per label is computed, by value counts, so a label holding
    most rows is no problem. Equal keys always fall on the same side.
    """
    marked = df.withColumn("__order", hash_order(key))
    cutoffs = kth_smallest(marked.filter(F.col(label).isNotNull()), [label], "__order",
                           lambda total: F.ceil(total * F.lit(float(test_share))))
    out = join_lookup(marked, cutoffs, [label])
    return out.withColumn("is_test", F.coalesce(F.col("__order") <= F.col("cutoff"), F.lit(False))) \
        .drop("__order", "cutoff")


def top_k(df: DataFrame, request: Sequence[str], order: Sequence[Column], k: int, place: str = "rank",
          coarse: Column | None = None) -> DataFrame:
    """First k rows per request. Spark sorts each partition and cuts it to k rows per request before the shuffle.

    Large tables pass ``coarse``, a whole number that never decreases along ``order`` (null first, as Spark sorts): its
    values are counted per request, and only rows up to the value that holds the k-th place are sorted at all.
    """
    if coarse is not None:
        df = df.withColumn("__coarse", coarse)
        counts = df.groupBy(*request, "__coarse").agg(F.count(F.lit(1)).alias("__n"))
        ahead = Window.partitionBy(*request).orderBy("__coarse").rowsBetween(Window.unboundedPreceding, -1)
        last = counts.withColumn("__before", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).filter(F.col("__before") < k)
        df = join_lookup(df, last.select(*request, "__coarse"), [*request, "__coarse"], "left_semi").drop("__coarse")
    w = Window.partitionBy(*request).orderBy(*order)
    return df.withColumn(place, F.row_number().over(w)).filter(F.col(place) <= k)


def scatter_sample(df: DataFrame, x: str, n: int = 10_000) -> DataFrame:
    """Points of the metric-against-price scatter plots."""
    return sample_n(df, n).select("property_id", "borough", x, "price_per_sqft")
