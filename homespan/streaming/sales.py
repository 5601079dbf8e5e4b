"""Continuous forms of the live feed: landed files in, canonical rows and windows out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from homespan.operators.filters import sanity_filter
from homespan.operators.projections import assign_live_id, canonicalize_sales, derive_sale_period
from homespan.session import fresh_path
from homespan.sources.landed import SALES_SCHEMA


def stream_sales(spark: SparkSession, path: str, late: str = "7 days", files_per_batch: int | None = None,
                 id_columns: list[str] | None = None, **limits) -> DataFrame:
    """Landed JSON pages -> typed, checked sales, each once.

    State is bounded: ids are forgotten once their sale date falls behind the
    watermark, and later rows are dropped. Sales without a date that can be read
    have no place in time; ``stream_undated_sales`` gives them.
    """
    dated = _landed(spark, path, files_per_batch, id_columns).filter(F.col("sale_date").isNotNull())
    once = dated.withWatermark("sale_date", late).dropDuplicatesWithinWatermark(["property_id"])
    return derive_sale_period(sanity_filter(once, **limits))


def stream_undated_sales(spark: SparkSession, path: str, files_per_batch: int | None = None,
                         id_columns: list[str] | None = None, **limits) -> DataFrame:
    """The checked sales that ``stream_sales`` leaves out for want of a date; they count as the first quarter of 2024.

    Without a date no watermark can ever forget an id, so repeats are kept: the upsert removes them by id.
    """
    undated = _landed(spark, path, files_per_batch, id_columns).filter(F.col("sale_date").isNull())
    return derive_sale_period(sanity_filter(undated, **limits))


def _landed(spark: SparkSession, path: str, files_per_batch: int | None, id_columns: list[str] | None) -> DataFrame:
    reader = spark.readStream.schema(SALES_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = assign_live_id(canonicalize_sales(reader.json(path)), id_columns)
    return rows.withColumn("sale_date", F.col("sale_date").cast("timestamp"))


def stream_market_window(sales: DataFrame, at: str = "sale_date", key: str = "borough", value: str = "price",
                         size: str = "90 days", slide: str = "30 days", late: str = "7 days") -> DataFrame:
    """Sliding-window count, mean, lowest and highest value and approximate median per key.

    Rows older than the watermark are dropped; the state holds one row (and one
    bounded quantile sketch) per open window and key.
    """
    return sales.withWatermark(at, late).groupBy(F.window(at, size, slide), key).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"), F.min(value).alias("lowest"),
        F.max(value).alias("highest"), F.approx_percentile(value, 0.5, 1000).alias("median_approx")) \
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                key, "n", "mean_value", "lowest", "highest", "median_approx")


def stream_enrich(sales: DataFrame, local: DataFrame, key: str = "zip_code") -> DataFrame:
    """Stream-static join with a per-key context table; Spark decides on the broadcast."""
    return sales.join(local, key, "left")


def run_available(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process what has landed so far into parquet, and read the result back."""
    spark = stream.sparkSession
    out, state = fresh_path(spark, name), fresh_path(spark, f"{name}-state")
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", out) \
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def upsert_available(stream: DataFrame, keys: list[str], name: str, at: str | None = None) -> DataFrame:
    """foreachBatch upsert: each batch is written under its number, the newest row per key wins.

    Of rows in one batch the latest by ``at`` wins, then the one with the larger digest, so replays agree.

    A batch that is replayed after a failure overwrites its own folder.
    """
    spark = stream.sparkSession
    out, state = fresh_path(spark, name), fresh_path(spark, f"{name}-state")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
    _drain(stream, write, state)
    rows = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.IntegerType())])).option("basePath", out).parquet(out)
    others = [c for c in stream.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct("batch", *([at] if at else []), F.xxhash64(*others))).alias("r"))
    return newest.select(*keys, "r.*")


def _drain(stream: DataFrame, write: Callable[[DataFrame, int], None], state: str) -> StreamingQuery:
    query = stream.writeStream.foreachBatch(write).outputMode("append") \
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
