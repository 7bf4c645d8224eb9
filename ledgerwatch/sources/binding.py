"""The bank tables (transactions, reports, customers, countries) derived from the order tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.plans import features, layers
from ledgerwatch.sources.tables import staged

# Balances are account balances on the scale of the order totals.
_SCALE = 50


def _country_code(nation: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(nation.cast("string"), 2, "0"))


# Columns per table path, as a catalog would keep them: opening a file anew costs a job each time.
_SCHEMAS: dict[str, T.StructType] = {}


class Bank:
    """Lazy frames over one folder of Parquet tables, which are not rewritten during a session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def countries(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            _country_code(key, "N").alias("alpha3_code"),
            F.col("n_name").alias("country"),
            (key * 14 - 170).cast("double").alias("long_avg"),
            (key * 7 - 84).cast("double").alias("lat_avg"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("id"),
            F.col("c_name").alias("firstname"),
            F.col("c_mktsegment").alias("lastname"),
            _country_code(F.col("c_nationkey"), "N").alias("country"),
            (F.col("c_custkey") % 10).cast("double").alias("age_group"),
        )

    @cached_property
    def reports(self) -> DataFrame:
        returned = self.table("lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49))
        return returned.select(F.col("l_orderkey").cast("string").alias("id"), F.lit("1").alias("is_fraud")).distinct()

    @cached_property
    def transactions(self) -> DataFrame:
        receiver = self.table("lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("suppkey"))
        when, total = F.col("o_orderdate"), F.col("o_totalprice")
        held = F.col("c_acctbal") * _SCALE
        receiving = F.when(F.col("s_acctbal") > 0, F.col("s_acctbal") * _SCALE).otherwise(F.lit(0.0))
        orders = self.table("orders").join(receiver, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        return (
            orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("supplier"), F.col("suppkey") == F.col("s_suppkey"), "left")
            .select(
                F.col("o_orderkey").cast("string").alias("id"),
                F.col("o_custkey").cast("string").alias("customer_id"),
                ((F.year(when) - 1995) * 372 + (F.month(when) - 1) * 31 + F.day(when)).cast("bigint").alias("step"),
                total.alias("amount"),
                F.col("o_orderpriority").alias("type"),
                F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("nameOrig"),
                F.concat(F.lit("S"), F.col("suppkey").cast("string")).alias("nameDest"),
                held.alias("oldBalanceOrig"),
                F.greatest(held - total, F.lit(0.0)).alias("newBalanceOrig"),
                receiving.alias("oldBalanceDest"),
                (receiving + total).alias("newBalanceDest"),
                _country_code(F.col("c_nationkey"), "N--").alias("countryOrig"),
                _country_code(F.col("s_nationkey"), "N--").alias("countryDest"),
                F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("isUnauthorizedOverdraft"),
                when.alias("event_ts"),
            )
        )

    @cached_property
    def silver(self) -> DataFrame:
        return layers.silver(self.transactions, self.reports)

    @cached_property
    def gold(self) -> DataFrame:
        return layers.gold(self.silver, self.countries, self.customers)

    def stored_gold(self, *columns: str) -> DataFrame:
        """Gold, or the named columns of it, as a table: for queries that read it more than once."""
        return staged(self.gold.select(*columns) if columns else self.gold, "gold")

    @cached_property
    def features(self) -> DataFrame:
        return features.feature_table(self.gold)

    @cached_property
    def scored(self) -> DataFrame:
        """Gold scored by the rule `risk score >= 0.6`, with the label beside the prediction."""
        return features.rule_scored(self.gold)
