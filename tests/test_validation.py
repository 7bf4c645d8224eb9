"""Champion and challenger on the same rows, and what becomes of the aliases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import gates
from ledgerwatch.plans import validation
from ledgerwatch.sources.tables import VersionedTable

AT = dt.datetime(2024, 1, 1)
VERSIONS = "model_name string, model_version string, alias string, description string, approval string"
LONG = "A description of more than 20 characters"


def cutoff(least, name="score"):
    return lambda rows: rows.withColumn("prediction", (F.col(name) >= least).cast("double"))


@pytest.fixture
def rows(spark):
    n = F.col("id")
    return spark.range(1000).select(
        (n % 100 / 100).alias("score"), (n % 100 >= 60).cast("int").alias("label"), (n % 3).cast("string").alias("country"), F.lit("given").alias("extra")
    )


def decide(spark, rows, models, versions=None, **options):
    versions = versions or [("m", "1", gates.CHAMPION, LONG, None), ("m", "2", gates.CHALLENGER, LONG, None), ("other", "2", gates.CHALLENGER, LONG, None)]
    return validation.validate(rows, models, spark.createDataFrame(versions, VERSIONS), "m", AT, **options)


def test_the_better_version_is_promoted(spark, rows):
    found = decide(spark, rows, {"1": cutoff(0.5), "2": cutoff(0.6)}).collect()
    assert [(r.model_name, r.model_version, r.champion_version, r.promoted, r.decided_at) for r in found] == [("m", "2", "1", True, AT)]
    worse = decide(spark, rows, {"1": cutoff(0.6), "2": cutoff(0.9)}).first()
    assert (worse.promoted, worse.metric_f1_passed, worse.business_metric_passed, worse.fairness_passed) == (False, False, False, True)


def test_each_version_is_judged_by_its_own_predictions(spark, rows):
    """The challenger flags one country far more often than is right."""
    unfair = lambda df: df.withColumn("prediction", ((F.col("score") >= 0.6) | (F.col("country") == "1") & (F.col("score") >= 0.05)).cast("int"))
    found = decide(spark, rows, {"1": cutoff(0.6), "2": unfair}, threshold=1.5).first()
    assert not found.fairness_passed
    assert decide(spark, rows, {"1": unfair, "2": cutoff(0.6)}, threshold=1.5).first().fairness_passed


def test_a_model_that_cannot_score_a_row_fails(spark, rows):
    partly = lambda df: df.withColumn("prediction", F.when(F.col("score") != 0.5, (F.col("score") >= 0.6).cast("int")))
    found = decide(spark, rows, {"1": cutoff(0.6), "2": partly}).first()
    assert not found.predicts and not found.promoted


def test_no_champion_no_protected_columns_and_manual_approval(spark, rows):
    versions = [("m", "2", gates.CHALLENGER, LONG, "approved")]
    found = decide(spark, rows, {"2": cutoff(0.6)}, versions, manual_approval=True).first()
    assert found.promoted and found.champion_version is None
    assert not decide(spark, rows.drop("country"), {"2": cutoff(0.6)}, versions).first().fairness_passed


def test_models_do_not_see_each_other(spark, rows):
    seen = []

    def watching(df):
        seen.append(set(df.columns) - {c for c in df.columns if c.startswith("__")})
        return df.withColumn("prediction", F.lit(1)).withColumn("extra", F.lit("changed"))

    out = validation.predictions(rows, {"a": watching, "b": watching}, ["label", "extra"])
    assert seen == [set(rows.columns)] * 2 and out.count() == 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Exchange" not in plan


def test_aliases_follow_the_decisions(spark, rows, folder):
    table = VersionedTable(spark, f"{folder}/versions")
    more = [("m", "3", gates.CHALLENGER, "short", None), ("x", "1", gates.CHAMPION, LONG, None)]
    versions = [("m", "1", gates.CHAMPION, LONG, None), ("m", "2", gates.CHALLENGER, LONG, None), *more]
    table.replace(spark.createDataFrame(versions, VERSIONS))
    decisions = validation.validate(rows, {"1": cutoff(0.5), "2": cutoff(0.6), "3": cutoff(0.6)}, table.read(), "m", AT)
    after = {(r.model_name, r.model_version): r.alias for r in validation.promote(table, decisions, f"{folder}/log").collect()}
    assert after == {("m", "1"): validation.FORMER, ("m", "2"): gates.CHAMPION, ("m", "3"): validation.REJECTED, ("x", "1"): gates.CHAMPION}
    assert table.versions() == [1, 2] and spark.read.parquet(f"{folder}/log").count() == 2
