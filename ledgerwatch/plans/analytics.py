"""Analytics over gold transactions: volumes, routes and accounts of interest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import MONEY, money_sum, pair_key
from ledgerwatch.operators.windows import last_hours, top

# Fixed value: amount above which a transaction is looked at by route.
LARGE_AMOUNT = 350_000

ROUTE = ("countryOrig", "countryDest", "type")


def _recent_fraud(gold: DataFrame, hours: int) -> DataFrame:
    # The window ends at the newest of all transactions, fraud or not.
    return last_hours(gold, "step", hours).where("is_fraud")


def _fraud_by_step(gold: DataFrame, hours: int) -> DataFrame:
    """Fraud per step, from one pass: the window is cut out of the one row per step that the aggregate leaves."""
    amount = F.sum(F.when(F.col("is_fraud"), F.col("amount").try_cast(MONEY))).cast("double")
    steps = gold.groupBy("step").agg(F.count_if("is_fraud").alias("fraud_transactions"), amount.alias("fraud_amount"))
    newest = F.max("step").over(Window.partitionBy())
    recent = F.col("step").between(F.col("__newest") - hours, F.col("__newest"))
    return steps.withColumn("__newest", newest).where(recent & (F.col("fraud_transactions") > 0))


def fraud_by_hour(gold: DataFrame, anchor: str, hours: int = 24 * 30) -> DataFrame:
    """Count and amount of fraud per time point; step n lies n hours after `anchor`."""
    start = F.lit(anchor).cast("timestamp_ntz")
    at = F.timestamp_add("HOUR", F.col("step").cast("int"), start)
    return _fraud_by_step(gold, hours).select(at.alias("ts"), "fraud_transactions", "fraud_amount").orderBy("ts")


def flow_pairs(gold: DataFrame, n: int = 20, order: str = "pair") -> DataFrame:
    """Number of large transactions per route and type, with a key common to both directions.

    `order="pair"` lists pairs alphabetically, the largest first within a pair; `order="value"` lists
    the largest flows first.
    """
    routes = (
        gold.where(F.col("amount") > LARGE_AMOUNT)
        .groupBy(*ROUTE)
        .agg(F.count("amount").alias("value"))
        .withColumn("countries_combined", pair_key(F.col("countryOrig"), F.col("countryDest")))
    )
    first = {"pair": [F.asc("countries_combined"), F.desc("value")], "value": [F.desc("value")]}[order]
    return top(routes, n, *first, ties=ROUTE)


def flow_pairs_total(gold: DataFrame, n: int = 20) -> DataFrame:
    """Transactions per country pair and type over the rows of `flow_pairs`."""
    return flow_pairs(gold, n).groupBy("countries_combined", "type").agg(F.sum("value").alias("value"))


def _top_account(gold: DataFrame, account: str, hours: int) -> DataFrame:
    counts = _recent_fraud(gold, hours).groupBy(account).agg(F.count(F.lit(1)).alias("transactions"))
    return top(counts, 1, F.desc("transactions"), ties=[account])


def top_origin_account(gold: DataFrame, hours: int = 24 * 30) -> DataFrame:
    return _top_account(gold, "nameOrig", hours)


def top_dest_account(gold: DataFrame, hours: int = 24 * 30) -> DataFrame:
    return _top_account(gold, "nameDest", hours)


def fraud_amount_by_route(gold: DataFrame, n: int = 100) -> DataFrame:
    """Amount of large fraud per route and type, the greatest first."""
    routes = (
        gold.where(F.col("is_fraud") & (F.col("amount") > LARGE_AMOUNT))
        .groupBy(*ROUTE)
        .agg(money_sum(F.col("amount")).alias("value"))
    )
    return top(routes, n, F.desc("value"), ties=ROUTE)


def fraud_amount_by_dest(gold: DataFrame, n: int = 100) -> DataFrame:
    """Amount per destination country over the rows of `fraud_amount_by_route`."""
    return fraud_amount_by_route(gold, n).groupBy("countryDest").agg(money_sum(F.col("value")).alias("value"))


def fraud_count(gold: DataFrame, hours: int = 24 * 30) -> DataFrame:
    return _fraud_by_step(gold, hours).agg(F.coalesce(F.sum("fraud_transactions"), F.lit(0)).alias("transactions"))
