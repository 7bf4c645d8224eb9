"""Layers, analytics and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions import reports
from ledgerwatch.functions.columns import to_number
from ledgerwatch.plans import analytics
from ledgerwatch.plans.oracles import over
from ledgerwatch.plans.registry import query
from ledgerwatch.sources.binding import Bank

# Time of step 0 in reports by hour.
ANCHOR = "2020-01-01 00:00:00"

RECENT = """recent AS (
  SELECT g.* FROM gold_transactions g, (SELECT max(step) AS newest FROM gold_transactions)
  WHERE step BETWEEN newest - 720 AND newest AND is_fraud)"""


@query(over("silver_transactions", select="SELECT * FROM silver_transactions"))
def silver_transactions(bank: Bank) -> DataFrame:
    return bank.silver


@query(over("gold_transactions", select="SELECT * FROM gold_transactions"))
def gold_transactions(bank: Bank) -> DataFrame:
    return bank.gold


@query(
    over(
        "gold_transactions",
        ctes=RECENT,
        select=f"""SELECT TIMESTAMP '{ANCHOR}' + to_hours(CAST(step AS INT)) AS ts, count(*) AS fraud_transactions,
                   CAST(sum(CAST(amount AS DECIMAL(20,4))) AS DOUBLE) AS fraud_amount FROM recent GROUP BY 1""",
    )
)
def fraud_by_hour(bank: Bank) -> DataFrame:
    return analytics.fraud_by_hour(bank.gold, ANCHOR)


_ROUTES = """routes AS (
  SELECT countryOrig, countryDest, type, count(amount) AS value,
         CASE WHEN countryOrig < countryDest THEN concat(countryOrig, '-', countryDest)
              ELSE concat(countryDest, '-', countryOrig) END AS countries_combined
  FROM gold_transactions WHERE amount > 350000 GROUP BY ALL)"""
_FLOWS = _ROUTES + """, flows AS (
  SELECT * FROM routes ORDER BY countries_combined, value DESC, countryOrig, countryDest, type LIMIT 20)"""


@query(over("gold_transactions", ctes=_FLOWS, select="SELECT * FROM flows"))
def flow_pairs(bank: Bank) -> DataFrame:
    return analytics.flow_pairs(bank.gold)


@query(
    over(
        "gold_transactions",
        ctes=_ROUTES,
        select="SELECT * FROM routes ORDER BY value DESC, countryOrig, countryDest, type LIMIT 20",
    )
)
def flow_pairs_by_value(bank: Bank) -> DataFrame:
    return analytics.flow_pairs(bank.gold, order="value")


@query(
    over(
        "gold_transactions",
        ctes=_FLOWS,
        select="SELECT countries_combined, type, CAST(sum(value) AS BIGINT) AS value FROM flows GROUP BY ALL",
    )
)
def flow_pairs_total(bank: Bank) -> DataFrame:
    return analytics.flow_pairs_total(bank.gold)


def _top_account_sql(account: str) -> str:
    return over(
        "gold_transactions",
        ctes=RECENT,
        select=f"SELECT {account}, count(*) AS transactions FROM recent GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    )


@query(_top_account_sql("nameOrig"))
def top_origin_account(bank: Bank) -> DataFrame:
    return analytics.top_origin_account(bank.stored_gold("step", "is_fraud", "nameOrig"))


@query(_top_account_sql("nameDest"))
def top_dest_account(bank: Bank) -> DataFrame:
    return analytics.top_dest_account(bank.stored_gold("step", "is_fraud", "nameDest"))


_AMOUNTS = """amounts AS (
  SELECT countryOrig, countryDest, type, CAST(sum(CAST(amount AS DECIMAL(20,4))) AS DOUBLE) AS value
  FROM gold_transactions WHERE is_fraud AND amount > 350000 GROUP BY ALL
  ORDER BY value DESC, countryOrig, countryDest, type LIMIT 100)"""


@query(over("gold_transactions", ctes=_AMOUNTS, select="SELECT * FROM amounts"))
def fraud_amount_by_route(bank: Bank) -> DataFrame:
    return analytics.fraud_amount_by_route(bank.gold)


@query(
    over(
        "gold_transactions",
        ctes=_AMOUNTS,
        select="""SELECT countryDest, CAST(sum(CAST(value AS DECIMAL(20,4))) AS DOUBLE) AS value
                  FROM amounts GROUP BY 1""",
    )
)
def fraud_amount_by_dest(bank: Bank) -> DataFrame:
    return analytics.fraud_amount_by_dest(bank.gold)


@query(over("gold_transactions", ctes=RECENT, select="SELECT count(*) AS transactions FROM recent"))
def fraud_count(bank: Bank) -> DataFrame:
    return analytics.fraud_count(bank.gold)


@query(
    over(
        "gold_transactions",
        select="""SELECT count(*) AS transactions, count(*) FILTER (WHERE is_fraud) AS frauds,
                  CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) / count(*) AS fraud_rate FROM gold_transactions""",
    )
)
def fraud_rate(bank: Bank) -> DataFrame:
    counts = bank.gold.agg(F.count(F.lit(1)).alias("transactions"), F.count_if("is_fraud").alias("frauds"))
    return counts.withColumn("fraud_rate", F.try_divide(F.col("frauds").cast("double"), F.col("transactions")))


@query(
    """SELECT o_orderkey AS id, TRY_CAST(o_orderpriority AS DOUBLE) AS words,
              TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS digit,
              TRY_CAST(CAST(o_totalprice AS STRING) AS DOUBLE) AS price FROM orders"""
)
def numeric_coerce(bank: Bank) -> DataFrame:
    return bank.table("orders").select(
        F.col("o_orderkey").alias("id"),
        to_number(F.col("o_orderpriority")).alias("words"),
        to_number(F.substring("o_orderpriority", 1, 1)).alias("digit"),
        to_number(F.col("o_totalprice").cast("string")).alias("price"),
    )


_DETAILS_SQL = """SELECT id, is_fraud, amount, customer_id, nameDest, nameOrig, type, firstname, lastname,
       CAST(NULL AS STRING) AS email, CAST(NULL AS STRING) AS address, country,
       CAST(NULL AS STRING) AS creation_date, age_group, countryOrig_name, countryDest_name
FROM gold_transactions"""


@query(
    over("gold_transactions", "fraud_reports", select=f"{_DETAILS_SQL} WHERE id IN (SELECT id FROM fraud_reports)")
)
def customer_details(bank: Bank) -> DataFrame:
    return reports.customer_details(bank.gold, bank.reports)


_JSON_SQL = ", ".join(f"'{c}', {c}" for c in reports.DETAILS)


@query(
    over(
        "gold_transactions",
        ctes=f"details AS ({_DETAILS_SQL})",
        select=f"""SELECT id, concat('{reports.INSTRUCTIONS.replace("'", "''")}', '{reports.DETAILS_HEADING}',
                   CAST(json_object({_JSON_SQL}) AS STRING)) AS prompt FROM details""",
    )
)
def fraud_report_prompt(bank: Bank) -> DataFrame:
    return reports.details(bank.gold).select("id", reports.report_prompt(keep_nulls=True).alias("prompt"))


@query(
    over(
        "gold_transactions",
        select="""SELECT id, is_fraud, concat('Fraud report: transaction ', id, ' of customer ', customer_id, ' (', type,
          ', ', nameOrig, ' to ', nameDest, '). Freeze the account and escalate to compliance.', chr(10), 'Dear ',
          firstname, ', suspicious activity was detected on your account. Please contact the fraud team.') AS report
          FROM gold_transactions WHERE is_fraud""",
    )
)
def fraud_reports_batch(bank: Bank) -> DataFrame:
    return reports.fraud_reports(bank.gold)
