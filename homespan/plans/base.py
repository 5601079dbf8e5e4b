"""The property table over the order tables, and its staged descendants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from homespan.functions import values as V
from homespan.operators import neighbourhood, projections
from homespan.session import is_staged, staged


def properties_from(tables) -> DataFrame:
    """One sale per line item: region as borough, customer as neighbourhood.

    ``nation`` and ``region`` have 25 and 5 rows by definition and are broadcast;
    the growing tables are joined by whatever their file sizes call for.
    """
    places = F.broadcast(
        tables("nation").join(F.broadcast(tables("region")), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name"))
    buyers = tables("customer").select("c_custkey", "c_nationkey").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    placed = tables("orders").select("o_orderkey", "o_custkey").join(
        buyers, F.col("o_custkey") == F.col("c_custkey"))
    sold = tables("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate")
    joined = sold.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(
        tables("part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    cust, item, supp = F.col("c_custkey"), F.col("l_partkey"), F.col("l_suppkey")

    def spread(key, times: int, span: int, start: int, kind: str):
        return (start + (key * times) % span).cast(kind)

    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("property_id"),
        F.col("r_name").alias("borough"),
        ((4040 + cust % 50).cast("double") / 100).alias("lat"),
        ((-7430 + F.floor(cust / 50) % 60).cast("double") / 100).alias("lng"),
        F.col("l_quantity").cast("bigint").alias("sqft"),
        (1 + item % 60).cast("bigint").alias("lot_sqft"),
        (1900 + item % 124).cast("int").alias("year_built"),
        F.when((F.col("l_linenumber") == 7) & (item % 3 == 0), 12)
         .otherwise(F.col("l_linenumber")).alias("num_units"),
        (1 + supp % 6).cast("int").alias("num_floors"),
        F.col("p_type").alias("building_class"),
        spread(cust, 29, 80, 20, "double").alias("walk_score"),
        spread(supp, 23, 90, 10, "double").alias("transit_score"),
        spread(cust, 31, 100, 0, "double").alias("bike_score"),
        spread(item, 97, 4950, 50, "bigint").alias("nearest_subway_m"),
        spread(supp, 89, 3950, 50, "bigint").alias("nearest_park_m"),
        spread(cust, 7, 60, 1, "double").alias("crime_rate_per_1k"),
        spread(supp, 3, 9, 1, "double").alias("school_quality_score"),
        spread(cust, 373, 300000, 20000, "bigint").alias("median_household_income"),
        spread(cust, 211, 109000, 1000, "bigint").alias("population_density"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("flood_zone_flag"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_per_sqft"),
        F.year("l_shipdate").alias("sale_year"),
        F.quarter("l_shipdate").alias("sale_quarter"),
        F.col("l_shipdate").alias("sale_date"),
        cust.alias("buyer_key"),
        item.alias("item_key"),
    )


class Workspace:
    """Tables of one data folder and the stages derived from them.

    Stages follow the ingest -> enrich -> features order; each is written once
    per session to the shared folder and read back column-pruned.
    """

    def __init__(self, spark: SparkSession, source: str):
        self.spark, self.source = spark, source.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.source}/{name}.parquet")

    def _stage(self, name: str, build) -> DataFrame:
        return staged(self.spark, self.source, name, build, self.table("lineitem").count())  # from the file footers

    def properties(self) -> DataFrame:
        return self._stage("properties", lambda: properties_from(self.table))

    def enriched(self) -> DataFrame:
        return self._stage("enriched", lambda: neighbourhood.enrich(self.properties()))

    def features(self) -> DataFrame:
        """Engineered and labelled rows (without the percentile columns)."""
        return self._stage("features", lambda: neighbourhood.label(
            projections.engineer_features(self.properties())))

    def area_features(self) -> DataFrame:
        """The columns of ``features`` that area clusters are made and described by.

        Unless the session has written the whole features, only these columns go through their steps and to disk.
        """
        columns = ["property_id", *dict.fromkeys([*V.CLUSTER_FEATURES, *V.CLUSTER_PROFILE_COLUMNS])]
        if is_staged(self.spark, self.source, "features"):
            return self.features().select(*columns)
        return self._stage("area_features", lambda: neighbourhood.label(
            projections.engineer_features(self.properties())).select(*columns))

    def _model_rows(self) -> DataFrame:
        """The rows of the model table; the enriched stage is read if this session has written it.

        Else its rows go straight into this one, since the passes for the peers read the columns they need from the
        properties.
        """
        known = is_staged(self.spark, self.source, "enriched")
        rows = self.enriched() if known else neighbourhood.enrich(self.properties())
        return neighbourhood.label(projections.engineer_features(rows))

    def model_table(self) -> DataFrame:
        """Labelled rows with the percentile columns, as the models need them."""
        return self._stage("model_table", self._model_rows)

    def model_inputs(self) -> DataFrame:
        """Key, label and model inputs of every row of the model table, for fits that read nothing else.

        Without a written model table only these columns go through the passes and to disk.
        """
        def chosen(table: DataFrame) -> DataFrame:
            numeric, categorical = projections.select_features(table)
            return table.select("property_id", "valuation_label", *numeric, *categorical)
        if is_staged(self.spark, self.source, "model_table"):
            return chosen(self.model_table())
        return self._stage("model_inputs", lambda: chosen(self._model_rows()))

    def judged(self) -> DataFrame:
        """Label and price percentile of every row of the model table, for rules that stand in for a model.

        Without a written model table only these columns go through the passes, not whole sales.
        """
        def rows() -> DataFrame:
            table = self.model_table() if is_staged(self.spark, self.source, "model_table") else self._model_rows()
            return table.select("property_id", "valuation_label", "ppsf_neighborhood_percentile")
        return self._stage("judged", rows)

    def interactions(self) -> DataFrame:
        """Buyer, item, mean rating."""
        return self._stage("interactions", lambda: self.properties().select(
            F.col("buyer_key").alias("buyer_id"), F.col("item_key").alias("property_id"),
            (1 + F.least(F.lit(4), F.floor((F.col("sqft") - 1) / 10))).cast("double").alias("rating"))
            .groupBy("buyer_id", "property_id").agg(F.avg("rating").alias("rating")))
