"""Model inputs: imputation, scaling, encoding and the assembled preprocessor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    Imputer, SQLTransformer, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler)
from pyspark.sql import DataFrame, Window, functions as F

from homespan.operators.projections import select_features
from homespan.operators.skew import HOT_ROWS, group_medians
from homespan.session import cut

MAX_CATEGORIES = 10_000  # category names are part of the model and live on the driver


def impute_numeric(df: DataFrame, columns: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Missing numbers take the exact column median."""
    median = group_medians(df, [], list(columns), hot_rows=hot_rows).first()  # one number per column
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(median[c])) for c in columns})


def scale_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column gives 0."""
    fit = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).first()
    return df.withColumns({
        c: (F.col(c) - F.lit(fit[c].m)) / F.lit(fit[c].s) if fit[c].s else F.lit(0.0) for c in columns})


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value): the most frequent value, the smallest on a tie.

    Values are counted before the shuffle, so a frequent one is a single row per task.
    """
    counts = df.select(*columns).unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull()) \
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("column").agg(F.max("n").alias("n"))
    return counts.join(F.broadcast(top), ["column", "n"]).groupBy("column").agg(F.min("value").alias("value"))  # row per column


def impute_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing texts take the most frequent value."""
    value = {r.column: r.value for r in most_frequent(df, columns).collect()}  # one row per column
    return df.fillna(value, subset=list(value)) if value else df


def wide_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with more distinct values than a model on the driver should hold."""
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    return [c for c in columns if sizes[c] > MAX_CATEGORIES]


def code_table(df: DataFrame, column: str) -> DataFrame:
    """(value, code): alphabetic codes of a column of any number of values, numbered part by part of a range partitioning."""
    spark = df.sparkSession
    values = df.select(F.col(column).cast("string").alias("value")).filter(F.col("value").isNotNull()).distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(values.repartitionByRange(parts, "value").withColumn("part", F.spark_partition_id()))
    start, before = 0, []
    for row in sorted(placed.groupBy("part").count().collect()):  # one row per partition
        before.append((row.part, start))
        start += row["count"]
    firsts = F.broadcast(spark.createDataFrame(before, "part int, first long"))
    number = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    return placed.join(firsts, "part").select("value", (F.col("first") + number - 1).cast("int").alias("code"))


def fit_ordinal(df: DataFrame, columns: Sequence[str]) -> StringIndexerModel:
    """Alphabetic codes per column, held by the driver; ``encode_ordinal`` takes columns with very many values by a join."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"__x_{c}" for c in columns],
                         stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)


def _codes(model: StringIndexerModel) -> SQLTransformer:
    """Unknown -> -1; going through an expression also drops the nominal metadata."""
    cases = ", ".join(
        f"CAST(CASE WHEN `{x}` = {len(labels)} THEN -1 ELSE `{x}` END AS DOUBLE) AS `__code_{x[4:]}`"
        for x, labels in zip(model.getOutputCols(), model.labelsArray))
    return SQLTransformer(statement=f"SELECT *, {cases} FROM __THIS__")


def encode_ordinal(df: DataFrame, columns: Sequence[str], model: StringIndexerModel | None = None) -> DataFrame:
    """Replace each column by its code; values the model has not seen give -1."""
    if model is None:
        wide = wide_columns(df, columns)
        narrow = [c for c in columns if c not in wide]
        for c in wide:
            codes = code_table(df, c).withColumnsRenamed({"value": "__value", "code": "__code"})
            df = df.join(codes, F.col(c).cast("string") == F.col("__value"), "left").withColumn(
                c, F.coalesce("__code", F.lit(-1))).drop("__value", "__code")
        if not narrow:
            return df
        columns, model = narrow, fit_ordinal(df, narrow)
    coded = _codes(model).transform(model.transform(df))
    return coded.withColumns({c: F.col(f"__code_{c}").cast("int") for c in columns}).drop(
        *model.getOutputCols(), *[f"__code_{c}" for c in columns])


def build_preprocessor(df: DataFrame, numeric: Sequence[str] | None = None,
                       categorical: Sequence[str] | None = None) -> PipelineModel:
    """Fitted steps from raw columns to the vector ``features``: numbers first, then codes."""
    if numeric is None or categorical is None:
        numeric, categorical = select_features(df)
    stages: list = []
    if categorical:
        value = {r.column: r.value for r in most_frequent(df, categorical).collect()}  # one row per column
        fills = ", ".join("COALESCE(`{0}`, '{1}') AS `__t_{0}`".format(c, str(value.get(c, "")).replace("'", "\\'"))
                          for c in categorical)
        stages.append(SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__"))
        filled = stages[-1].transform(df)
        model = fit_ordinal(filled, [f"__t_{c}" for c in categorical])
        stages += [model, _codes(model)]
    if numeric:
        casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `__n_{c}`" for c in numeric)
        stages.append(SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__"))
        rows = PipelineModel(stages).transform(df)
        imputer = Imputer(strategy="median", relativeError=0.0001, inputCols=[f"__n_{c}" for c in numeric],
                          outputCols=[f"__i_{c}" for c in numeric]).fit(rows)
        assembler = VectorAssembler(inputCols=[f"__i_{c}" for c in numeric], outputCol="__numbers")
        rows = assembler.transform(imputer.transform(rows))
        scaler = StandardScaler(inputCol="__numbers", outputCol="__scaled", withMean=True).fit(rows)
        stages += [imputer, assembler, scaler]
    parts = (["__scaled"] if numeric else []) + [f"__code___t_{c}" for c in categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return PipelineModel(stages)


def prepared(df: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """The kept columns and the vector, without the working columns."""
    return model.transform(df).select(*keep, "features")


def typical_inputs(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row: the median of every number and the most frequent value of every category."""
    median = group_medians(df, [], list(numeric), hot_rows=hot_rows).first()
    value = {r.column: r.value for r in most_frequent(df, categorical).collect()}  # one row per column
    return df.sparkSession.range(1).select(
        *[F.lit(median[c]).cast("double").alias(c) for c in numeric],
        *[F.lit(value.get(c)).cast("string").alias(c) for c in categorical])
