"""Cleaning and enrichment of transactions. Each function takes batch or streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import strip_dashes, truthy

RESCUE = "_rescued_data"


def silver(transactions: DataFrame, reports: DataFrame) -> DataFrame:
    """Transactions with clean country codes, balance changes and the label known so far.

    A left join on id: a transaction reported twice appears twice, one without report keeps a null label.
    """
    cleaned = transactions.drop(RESCUE).withColumns(
        {
            "countryOrig": strip_dashes(F.col("countryOrig")),
            "countryDest": strip_dashes(F.col("countryDest")),
            "diffOrig": F.col("newBalanceOrig") - F.col("oldBalanceOrig"),
            "diffDest": F.col("newBalanceDest") - F.col("oldBalanceDest"),
        }
    )
    return cleaned.join(reports.drop(RESCUE), "id", "left")


def _places(countries: DataFrame, role: str) -> DataFrame:
    """The country table under the column names of one end of a transaction."""
    return countries.select(
        F.col("alpha3_code").alias(f"country{role}"),
        F.col("country").alias(f"country{role}_name"),
        F.col("long_avg").alias(f"countryLong{role}_long"),
        F.col("lat_avg").alias(f"countryLat{role}_lat"),
    )


def gold(silver_transactions: DataFrame, countries: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions with customer and both countries; unknown countries or customers drop the row.

    No broadcast hint: the planner broadcasts the country table from its measured size, and a
    table over the limit falls back to a shuffle join whose hot keys adaptive execution splits.
    """
    people = customers.drop(RESCUE).withColumnRenamed("id", "customer_id")
    return (
        silver_transactions.join(_places(countries, "Orig"), "countryOrig")
        .join(_places(countries, "Dest"), "countryDest")
        .join(people, "customer_id")
        .withColumn("is_fraud", truthy(F.col("is_fraud")))
    )
