"""Files and tables: conversions, scans, replaced, appended, grown and merged tables, functions of SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import split_by_type
from ledgerwatch.functions.reports import customer_details, register_customer_details
from ledgerwatch.functions.risk import register_risk_score
from ledgerwatch.operators import keyed
from ledgerwatch.plans.oracles import over
from ledgerwatch.plans.registry import query
from ledgerwatch.sources import tables
from ledgerwatch.sources.binding import Bank
from ledgerwatch.sources.readers import convert, read_raw
from ledgerwatch.sources.tables import VersionedTable, scratch

CUSTOMER = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer"
_COLUMNS = ("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def _scan(bank: Bank, fmt: str) -> DataFrame:
    folder = scratch(bank.spark, fmt)
    convert(bank.spark, f"{bank.folder}/customer.parquet", fmt, folder)
    rows = read_raw(bank.spark, folder, fmt, multi_line=fmt == "csv")
    return rows.select(F.col("c_custkey").cast("long").alias("c_custkey"), *_COLUMNS[1:])


@query(CUSTOMER)
def json_scan(bank: Bank) -> DataFrame:
    """Customers through sixteen JSON files."""
    return _scan(bank, "json")


@query(CUSTOMER)
def csv_scan(bank: Bank) -> DataFrame:
    """Customers through sixteen CSV files."""
    return _scan(bank, "csv")


@query("SELECT c_custkey, c_acctbal * 2 AS balance, 'v2' AS note FROM customer")
def replaced_table(bank: Bank) -> DataFrame:
    """A table replaced from itself, with other columns."""
    table = VersionedTable(bank.spark, scratch(bank.spark, "replaced"))
    table.replace(bank.table("customer").select("c_custkey", "c_acctbal"), sort_by=["c_custkey"])
    table.replace(table.read().select("c_custkey", (F.col("c_acctbal") * 2).alias("balance"), F.lit("v2").alias("note")))
    return table.read()


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN c_name END AS c_name, 'run-' || c_custkey % 2 AS run_id FROM customer")
def appended_grown(bank: Bank) -> DataFrame:
    """Rows of two runs in one folder, the second with a column more."""
    folder, customers = scratch(bank.spark, "appended"), bank.table("customer")
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    for k, columns in enumerate((["c_custkey"], ["c_custkey", "c_name"])):
        tables.append_lineage(customers.where(F.pmod("c_custkey", F.lit(2)) == k).select(*columns), folder, f"run-{k}", at)
    return tables.read_grown(bank.spark, folder).select("c_custkey", "c_name", "run_id")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders"""
)
def upsert_stored(bank: Bank) -> DataFrame:
    """Orders merged by key into a folder with a partition per status; some have none."""
    folder = scratch(bank.spark, "upserted")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status")
    orders = bank.table("orders").select("o_orderkey", "o_totalprice", status)
    changed = orders.where("o_orderkey % 7 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for rows in (orders.where("o_orderkey % 5 <> 0"), orders.where("o_orderkey % 5 = 0"), changed):
        tables.upsert_partitions(bank.spark, folder, rows, ["o_orderkey"], "status")
    return tables.read_partitions(bank.spark, folder).select("o_orderkey", "o_totalprice", "status")


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'delete' ELSE kind END AS change_type,
       CASE WHEN c_custkey % 3 = 0 OR kind = 'update_pre' THEN NULL ELSE c_mktsegment END AS segment
       FROM customer, (SELECT unnest(['update_pre', 'update_post']) AS kind) k WHERE c_custkey % 3 <> 0 OR kind = 'update_pre'"""
)
def changes_grown(bank: Bank) -> DataFrame:
    """Changes between two stored versions, the second with a column more and a third of the rows gone."""
    table, customers = VersionedTable(bank.spark, scratch(bank.spark, "changes")), bank.table("customer")
    table.replace(customers.select("c_custkey", "c_name"))
    table.replace(customers.where("c_custkey % 3 <> 0").select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment")))
    return keyed.changes(table.read(1), table.read(2), ["c_custkey"]).select("c_custkey", "change_type", "segment")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, {kind} AS categorical, count(DISTINCT {c}) AS n_values, count({c}) AS n_rows FROM orders"
        for c, kind in (("o_orderkey", "false"), ("o_orderstatus", "true"), ("o_totalprice", "false"))
    )
)
def column_types(bank: Bank) -> DataFrame:
    """Which columns of the orders count as categories, and how many values and rows each has."""
    orders = bank.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    categorical, numeric = split_by_type(orders)
    cells = [F.struct(F.lit(c).alias("name"), F.lit(c in categorical).alias("categorical"), F.col(c).cast("string").alias("value")) for c in [*categorical, *numeric]]
    # One row per value first, so that no task holds the values of a column.
    values = orders.select(F.inline(F.array(*cells))).groupBy("name", "categorical", "value").agg(F.count("value").alias("rows"))
    return values.groupBy("name", "categorical").agg(F.count("value").alias("n_values"), F.sum("rows").alias("n_rows"))


_ONE = over("gold_transactions", ctes="newest AS (SELECT max(id) AS id FROM gold_transactions)", select="SELECT id, amount FROM gold_transactions JOIN newest USING (id)")


@query(_ONE)
def one_customer(bank: Bank) -> DataFrame:
    """Details of one transaction by its id."""
    one = bank.gold.agg(F.max("id")).first()[0]  # one value
    return customer_details(bank.gold, one).select("id", "amount")


@query(_ONE)
def one_customer_sql(bank: Bank) -> DataFrame:
    """The same by the SQL table function."""
    bank.stored_gold().createOrReplaceTempView("storage_gold")
    register_customer_details(bank.spark, "storage_gold")
    one = bank.spark.table("storage_gold").agg(F.max("id")).first()[0]  # one value
    return bank.spark.sql("SELECT id, amount FROM get_customer_details(:id)", {"id": one})


@query(over("fraud_scored", select="SELECT transaction_id, risk_score FROM fraud_scored"))
def risk_score_sql(bank: Bank) -> DataFrame:
    """The risk score by the function registered for SQL."""
    from ledgerwatch.plans.features import with_features

    register_risk_score(bank.spark)
    with_features(bank.gold).createOrReplaceTempView("storage_features")
    return bank.spark.sql(
        "SELECT transaction_id, transaction_risk_score(amount, balance_orig_ratio, is_full_transfer, is_cross_border) AS risk_score FROM storage_features"
    )
