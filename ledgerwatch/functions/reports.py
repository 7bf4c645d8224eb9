"""Customer lookups and the text of transaction reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the fields of a transaction's details, in order, with their types.
DETAILS = {
    "id": "string",
    "is_fraud": "boolean",
    "amount": "double",
    "customer_id": "string",
    "nameDest": "string",
    "nameOrig": "string",
    "type": "string",
    "firstname": "string",
    "lastname": "string",
    "email": "string",
    "address": "string",
    "country": "string",
    "creation_date": "string",
    "age_group": "double",
    "countryOrig_name": "string",
    "countryDest_name": "string",
}

# Fixed value: what stands between the instructions and the details.
DETAILS_HEADING = "Transaction and customer details: "

INSTRUCTIONS = (
    "Write the bank's answer for one card or account transaction. If it is marked as fraud, give an internal "
    "report (transaction, customer, amount, risk signs, findings, recommended steps) and a formal message that "
    "greets the customer by first name and says what to do next, repeated in the customer's language where that "
    "is not English. If it is not marked as fraud, confirm in one sentence that it can be processed. "
    "Give the answer only.\n"
)


def details(gold: DataFrame) -> DataFrame:
    """The detail columns; those the source lacks are null."""
    present = set(gold.columns)
    return gold.select(
        *[(F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in DETAILS.items()]
    )


def customer_details(gold: DataFrame, ids: str | DataFrame) -> DataFrame:
    """Details of one transaction, or of every transaction whose id is in a frame of ids."""
    if isinstance(ids, str):
        return details(gold.where(F.col("id") == ids))
    return details(gold.join(ids.select("id"), "id", "left_semi"))


def register_customer_details(spark: SparkSession, gold_table: str, name: str = "get_customer_details") -> None:
    """The lookup as a SQL table function over a table or view; its body is inlined into the query."""
    present = set(spark.table(gold_table).columns)
    returns = ", ".join(f"{c} {t.upper()}" for c, t in DETAILS.items())
    columns = ", ".join(
        f"CAST({'g.' + c if c in present else 'NULL'} AS {t.upper()}) AS {c}" for c, t in DETAILS.items()
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(tran_id STRING) RETURNS TABLE({returns}) "
        f"RETURN SELECT {columns} FROM {gold_table} g WHERE g.id = tran_id"
    )


def report_prompt(instructions: str = INSTRUCTIONS, keep_nulls: bool = False) -> Column:
    """Instructions and the details as JSON, fields in fixed order."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.concat(
        F.lit(instructions), F.lit(DETAILS_HEADING), F.to_json(F.struct(*DETAILS), options)
    )


# The built-in answer, as SQL over the detail fields.
TEMPLATE = """
CASE WHEN is_fraud THEN concat(
  'Fraud report: transaction ', id, ' of customer ', customer_id, ' (', type, ', ', nameOrig, ' to ', nameDest,
  '). Freeze the account and escalate to compliance.\\nDear ', firstname,
  ', suspicious activity was detected on your account. Please contact the fraud team.')
ELSE concat('Transaction ', id, ' is legitimate and can be processed.') END"""


def template_report() -> Column:
    """The built-in answer: a fixed text that depends on the fraud mark."""
    return F.expr(TEMPLATE)


def register_reports(
    spark: SparkSession, prompt: str = "fraud_report_prompt", report: str = "fraud_report", instructions: str = INSTRUCTIONS
) -> None:
    """Prompt and built-in report as SQL functions of the detail fields, in their order."""
    arguments = ", ".join(f"{c} {t.upper()}" for c, t in DETAILS.items())
    fields = ", ".join(f"'{c}', {c}" for c in DETAILS)
    head = (instructions + DETAILS_HEADING).replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    for name, body in ((prompt, f"concat('{head}', to_json(named_struct({fields})))"), (report, TEMPLATE)):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS STRING RETURN {body}")


def fraud_reports(
    gold: DataFrame,
    respond: Callable[[pd.Series], pd.Series] | None = None,
    limit: int | None = None,
    instructions: str = INSTRUCTIONS,
) -> DataFrame:
    """id, is_fraud and report of every fraud row (the first `limit` by id, if given).

    `respond` answers a batch of prompts; without it the built-in template is used, without Python.
    """
    fraud = details(gold).where("is_fraud")
    if limit is not None:
        fraud = fraud.orderBy("id").limit(limit)
    if respond is None:
        return fraud.select("id", "is_fraud", template_report().alias("report"))

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"id": batch["id"], "is_fraud": batch["is_fraud"], "report": respond(batch["prompt"])}
            )

    prompts = fraud.select("id", "is_fraud", report_prompt(instructions).alias("prompt"))
    return prompts.mapInPandas(answer, "id string, is_fraud boolean, report string")
