"""Grouped exact statistics, ranks and lookups that survive hot groups.

A group of up to ``HOT_ROWS`` rows is handled in one task. Larger groups (one
borough may hold a third of a table) take a second route: values are counted
before the shuffle, spread over value buckets, and only bucket totals are
ordered per group. Both routes give the same exact result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from homespan.functions.scalar import settle
from homespan.session import cut

HOT_ROWS = 1_000_000        # rows of one group that a single task may hold
BROADCAST_ROWS = 200_000    # rows of a lookup that may be broadcast
BUCKETS_PER_OCTAVE = 16384  # resolution of the value buckets of hot groups
COARSE_PER_OCTAVE = 256     # and of a first count that only looks for the buckets that matter


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where null keys match each other; keys come out once, from the left."""
    tag = f"__r{uuid.uuid4().hex[:6]}_"
    renamed = right.withColumnsRenamed({k: tag + k for k in keys})
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(tag + k))
        condition = same if condition is None else condition & same
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[tag + k for k in keys])


def join_lookup(left: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left",
                max_rows: int = BROADCAST_ROWS, stored: bool = False) -> DataFrame:
    """Join a summary table: broadcast if it counts at most ``max_rows`` rows, else shuffle.

    The summary is checkpointed (unless ``stored`` says it already is), so
    counting does not compute it twice; the shuffled route leaves skewed keys to
    adaptive skew-join splitting.
    """
    lookup = lookup if stored else cut(lookup)
    if lookup.count() <= max_rows:
        lookup = F.broadcast(lookup)
    return join_on(left, lookup, keys, how)


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys of groups above ``hot_rows``: at most (rows of df / hot_rows) rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows).select(*keys)


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows of normal groups, rows of hot groups); the hot-key list is bounded, see above."""
    hot = F.broadcast(hot_groups(df, keys, hot_rows))
    return join_on(df, hot, keys, "left_anti"), join_on(df, hot, keys, "left_semi")


def value_bucket(x: Column, per_octave: int = BUCKETS_PER_OCTAVE) -> Column:
    """Bucket number that never decreases as x grows; logarithmic in size, as fine for tiny numbers as for huge ones."""
    octave = F.log2(F.abs(x)) + F.lit(1075.0)  # no double lies below 2 to the power of -1074
    size = F.when(x == 0, F.lit(0)).otherwise(F.lit(1) + F.floor(octave * F.lit(float(per_octave))))
    return (F.signum(x) * size).cast("bigint")


def descending_bucket(x: Column) -> Column:
    """Coarse bucket number that never decreases as x falls, in the order of ``desc``: NaN first, null last."""
    finite = F.greatest(F.least(x, F.lit(1e300)), F.lit(-1e300))
    down = F.coalesce(value_bucket(-finite, COARSE_PER_OCTAVE), F.lit(2**62))
    return F.when(F.isnan(x), F.lit(-(2**62))).when(x.isNull(), F.lit(2**62)).otherwise(down)


def running_totals(cells: DataFrame, keys: Sequence[str], value: str, sums: Sequence[str],
                   descending: bool = False, keep: Callable[[], Column] | None = None) -> DataFrame:
    """Add ``<s>_before`` (total over smaller values) and ``<s>_total`` per key group.

    ``cells`` has one row per (keys, value). No task sees a whole group: rows are
    ordered inside value buckets, and only bucket totals are ordered per group.
    ``keep`` may discard buckets (a condition over ``<s>_from``, ``<s>_in``,
    ``<s>_total``) before the rows are ordered.
    """
    sign = -1.0 if descending else 1.0
    cells = cells.withColumn("__bucket", value_bucket(F.col(value) * F.lit(sign)))
    coarse = cells.groupBy(*keys, "__bucket").agg(*[F.sum(s).alias(f"{s}_in") for s in sums])
    ahead = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = coarse.withColumns(
        {f"{s}_from": F.coalesce(F.sum(f"{s}_in").over(ahead), F.lit(0)) for s in sums}
        | {f"{s}_total": F.sum(f"{s}_in").over(whole) for s in sums}
    )
    if keep is not None:
        offsets = offsets.filter(keep())
    placed = join_on(cells, offsets, [*keys, "__bucket"])
    order = F.desc(value) if descending else F.asc(value)
    inside = Window.partitionBy(*keys, "__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumns({
        f"{s}_before": F.col(f"{s}_from") + F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums
    })
    return placed.drop("__bucket", *[f"{s}_in" for s in sums], *[f"{s}_from" for s in sums])


def _value_cells(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, __metric, __value, __n): non-null values per column number, counted before the shuffle."""
    values = F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("__metric", "__value")
    return df.select(*keys, values).filter(F.col("__value").isNotNull() & ~F.isnan("__value")) \
        .groupBy(*keys, "__metric", "__value").agg(F.count(F.lit(1)).alias("__n"))


def _hot_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   probs: Sequence[float]) -> DataFrame:
    """Order statistics of hot groups by cumulative value counts."""
    def places(p: float) -> tuple[Column, Column]:
        at = F.lit(float(p)) * (F.col("__n_total") - 1)
        return F.floor(at), F.ceil(at)

    def wanted() -> Column:
        hits = [(i >= F.col("__n_from")) & (i < F.col("__n_from") + F.col("__n_in"))
                for p in probs for i in places(p)]
        out = hits[0]
        for h in hits[1:]:
            out = out | h
        return out

    cells = running_totals(_value_cells(df, keys, columns), [*keys, "__metric"], "__value", ["__n"], keep=wanted)

    def value_at(i: Column) -> Column:
        inside = (i >= F.col("__n_before")) & (i < F.col("__n_before") + F.col("__n"))
        return F.max(F.when(inside, F.col("__value")))

    ends = [e.alias(f"__{side}{n}") for n, p in enumerate(probs)
            for side, e in zip(("lo", "hi"), map(value_at, places(p)))]
    found = cells.groupBy(*keys, "__metric").agg(*ends, F.max("__n_total").alias("__n_total"))
    between = F.array(*[
        F.col(f"__lo{n}") + (F.col(f"__hi{n}") - F.col(f"__lo{n}"))
        * (F.lit(float(p)) * (F.col("__n_total") - 1) - places(p)[0])
        for n, p in enumerate(probs)])
    per = found.select(*keys, "__metric", between.alias("__q"))
    return per.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__metric") == i, F.col("__q"))).alias(c) for i, c in enumerate(columns)])


def group_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                    probs: Sequence[float] = (0.5,), aggs: Sequence[Column] = (),
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Exact interpolated quantiles per group plus further aggregates.

    Each column comes back as an array with one element per probability (null
    when the group has no value). ``keys=[]`` gives one row for the table. A task
    holds at most ``hot_rows`` values, over all columns together.
    """
    limit = max(1, hot_rows // len(columns))
    points = F.array(*[F.lit(float(p)) for p in probs])

    def in_one_task(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*by).agg(*aggs, *[F.percentile(F.col(c).cast("double"), points).alias(c) for c in columns])

    def spread_out(rows: DataFrame) -> DataFrame:
        counted = rows.groupBy(*by).agg(*aggs, F.lit(0).alias("__hot"))
        return join_on(counted, _hot_quantiles(rows, by, columns, probs), by, "left").drop("__hot")

    by = list(keys)
    if by:
        normal, hot = split_hot(df, by, limit)
        out = in_one_task(normal).unionByName(spread_out(hot))
    else:  # one group: its size decides the route
        by, df = ["__all"], df.withColumn("__all", F.lit(1))
        out = (in_one_task if df.count() <= limit else spread_out)(df)
    out = out.withColumns({
        c: F.array(*[settle(F.get(F.col(c), F.lit(i))) for i in range(len(probs))]) for c in columns
    })
    return out if keys else out.drop("__all")


def group_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  aggs: Sequence[Column] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Exact medians per group, one double column per input column."""
    out = group_quantiles(df, keys, columns, (0.5,), aggs, hot_rows)
    return out.withColumns({c: F.get(F.col(c), F.lit(0)) for c in columns})


def percent_ranks(df: DataFrame, key: str, columns: dict[str, str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Average rank / count of non-null values within ``key``; null stays null.

    ``columns`` maps a value column to the new rank column. Normal groups: one
    shuffle, one sort per column. Hot groups: ranks of distinct values come from
    running totals and are joined back on (key, value).
    """
    normal, hot = split_hot(df, [key], hot_rows)

    def ranked(c: str) -> Column:
        # one order, so one sort, per column: tied rows share the places from rank to the count up to their value
        order = Window.partitionBy(key).orderBy(F.asc_nulls_last(c))
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        average = (F.rank().over(order) + F.count(c).over(order)) / F.lit(2.0)
        return F.when(F.col(c).isNotNull(), average / F.count(c).over(whole))

    few = normal.withColumns({new: ranked(c) for c, new in columns.items()})
    many = hot
    for c, new in columns.items():
        cells = running_totals(
            hot.filter(F.col(c).isNotNull()).groupBy(key, F.col(c).alias("__v"))
               .agg(F.count(F.lit(1)).alias("__n"), F.first(F.col(c).cast("double")).alias("__x")),
            [key], "__x", ["__n"])
        share = cells.select(
            key, F.col("__v").alias(c),
            ((F.col("__n_before") + (F.col("__n") + 1) / F.lit(2.0)) / F.col("__n_total")).alias(new))
        many = join_on(many, share, [key, c], "left")
    return few.unionByName(many)


def kth_smallest(df: DataFrame, keys: Sequence[str], value: str, k: Callable[[Column], Column]) -> DataFrame:
    """(keys, cutoff): the k-th smallest value per group; ``k`` is given the group's row count.

    Groups of any size: rows are counted in coarse value buckets, and only the rows of the one bucket per group that
    holds the place are shuffled, counted by value and located by running totals.
    """
    marked = df.select(*keys, value).withColumn("__coarse", value_bucket(F.col(value), COARSE_PER_OCTAVE))
    counts = marked.groupBy(*keys, "__coarse").agg(F.count(F.lit(1)).alias("__in"))
    group = Window.partitionBy(*keys)
    ahead = group.orderBy("__coarse").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({
        "__place": k(F.sum("__in").over(group)) - 1, "__from": F.coalesce(F.sum("__in").over(ahead), F.lit(0))})
    holder = counts.filter((F.col("__place") >= F.col("__from")) & (F.col("__place") < F.col("__from") + F.col("__in"))) \
        .select(*keys, "__coarse", (F.col("__place") - F.col("__from")).alias("__at"))
    near = join_lookup(marked, holder, [*keys, "__coarse"], "inner")
    by = [*keys, "__at"]  # one place per group
    cells = near.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))

    def holds_place() -> Column:
        return (F.col("__at") >= F.col("__n_from")) & (F.col("__at") < F.col("__n_from") + F.col("__n_in"))

    placed = running_totals(cells, by, value, ["__n"], keep=holds_place)
    return placed.filter((F.col("__at") >= F.col("__n_before")) & (F.col("__at") < F.col("__n_before") + F.col("__n"))) \
        .select(*keys, F.col(value).alias("cutoff"))
