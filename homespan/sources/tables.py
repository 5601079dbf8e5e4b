"""Table sources and sinks: parquet and CSV, and the ingest step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMPARISON_SCHEMA = (
    "model string, accuracy double, f1_macro double, f1_weighted double, precision_macro double, "
    "recall_macro double, roc_auc_ovr double, cohen_kappa double, train_sec double, predict_sec double"
)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Snappy parquet, replacing what is there."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line, replacing what is there."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType = COMPARISON_SCHEMA) -> DataFrame:
    """CSV with a header line and a given schema (never inferred)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is at ``path``."""
    try:
        spark.read.parquet(path).schema
        return True
    except Exception as err:  # PATH_NOT_FOUND or nothing to infer a schema from
        if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            return False
        raise


def ingest(spark: SparkSession, path: str, sources: dict[str, Callable[[], DataFrame]], mode: str,
           force: bool = False) -> DataFrame:
    """Write the raw table once; ``force`` rewrites it; an unknown mode is an error."""
    if mode not in sources:
        raise ValueError(f"unknown ingest mode {mode!r}")
    if force or not table_exists(spark, path):
        write_table(sources[mode](), path)
    return read_table(spark, path)
