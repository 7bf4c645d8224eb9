"""Lookups and report texts."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions import reports
from ledgerwatch.plans import layers
from tests.bank import frames


@pytest.fixture
def gold(spark):
    transactions, labels, countries, customers = frames(spark)
    return layers.gold(layers.silver(transactions, labels.where("id = 't1'")), countries, customers)


def test_lookup_of_one_and_of_many(spark, gold):
    found = reports.customer_details(gold, "t1").collect()
    assert len(found) == 1 and found[0].firstname == "Ann" and found[0].email is None
    assert found[0].asDict().keys() == reports.DETAILS.keys()
    ids = spark.createDataFrame([("t1",), ("t1",), ("t3",), ("zz",)], "id string")
    assert sorted(r.id for r in reports.customer_details(gold, ids).collect()) == ["t1", "t3"]


def test_lookup_as_table_function(spark, gold, folder):
    gold.write.parquet(folder)
    spark.read.parquet(folder).createOrReplaceTempView("gold_view")
    reports.register_customer_details(spark, "gold_view", "details_of")
    found = spark.sql("SELECT * FROM details_of('t3')")
    assert [r.customer_id for r in found.collect()] == ["c2"] and found.dtypes == list(reports.DETAILS.items())
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,t3)]" in found._jdf.queryExecution().toString()


def test_prompt(spark, gold):
    row = reports.details(gold.where("id = 't1'"))
    text = row.select(reports.report_prompt("Do this. ")).first()[0]
    head, body = text.split(reports.DETAILS_HEADING)
    fields = json.loads(body)
    assert head == "Do this. " and fields["amount"] == 60.0 and fields["is_fraud"] is True
    assert fields["address"].startswith("1 Main St\n") and "email" not in fields
    full = json.loads(row.select(reports.report_prompt("", keep_nulls=True)).first()[0][len(reports.DETAILS_HEADING):])
    assert list(full) == list(reports.DETAILS) and full["email"] is None


def test_batch_reports(spark, gold):
    found = reports.fraud_reports(gold).collect()
    assert [r.id for r in found] == ["t1"] and "Dear Ann" in found[0].report
    everything = gold.withColumn("is_fraud", F.lit(True))
    assert [r.id for r in reports.fraud_reports(everything, limit=1).collect()] == ["t1"]
    calm = reports.details(gold.where("id = 't3'")).select(reports.template_report()).first()[0]
    assert calm == "Transaction t3 is legitimate and can be processed."


def test_own_responder(spark, gold):
    found = reports.fraud_reports(gold, respond=lambda prompts: prompts.str.len().astype(str)).first()
    prompt = reports.details(gold.where("is_fraud")).select(reports.report_prompt()).first()[0]
    assert (found.id, found.is_fraud, found.report) == ("t1", True, str(len(prompt)))


def test_reports_as_sql_functions(spark, gold):
    instructions = "It's a \"test\"\nwith a \\ in it. "
    reports.register_reports(spark, instructions=instructions)
    rows = reports.details(gold)
    arguments = ", ".join(reports.DETAILS)
    found = rows.select(
        F.expr(f"fraud_report_prompt({arguments})").alias("p"),
        F.expr(f"fraud_report({arguments})").alias("r"),
        reports.report_prompt(instructions).alias("prompt"),
        reports.template_report().alias("report"),
    ).collect()
    assert found and all(r.p == r.prompt and r.r == r.report for r in found)
