"""Train, judge, score, watch: one pass over the small bank."""

import datetime as dt

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerwatch.plans import features, learning, lifecycle
from ledgerwatch.sources.binding import Bank
from ledgerwatch.sources.tables import read_grown, staged
from ledgerwatch.streaming.flows import score_requests
from ledgerwatch.streaming.ingest import StreamTable, append_stream, read_table, run_to_end

AT = dt.datetime(2024, 1, 1)
LOGISTIC = learning.Trial(0, "logistic", {"C": 0.5, "tol": 1e-5})
BOOSTED = learning.Trial(1, "gbt", {"trees": 3, "depth": 3, "rate": 0.3, "bins": 16})


@pytest.fixture(scope="module")
def gold(spark, small):
    """The bank with a label that follows the amount."""
    rows = Bank(spark, small).gold.withColumn("is_fraud", F.col("amount") > 400_000)
    return staged(rows, "lifecycle")


@pytest.mark.parametrize("trial", [LOGISTIC, BOOSTED], ids=lambda t: t.family)
def test_train_judge_score_watch(spark, gold, folder, trial):
    candidate = lifecycle.train_and_judge(gold, [trial], AT)
    report = {r.split: r for r in candidate.report.collect()}
    assert report["test"].roc_auc > 0.95
    assert {r.slice_dimension for r in candidate.slices.collect()} == {"country", "age_group", "is_cross_border"}
    assert candidate.gate.count() == 1 and candidate.trials.first().state == "FINISHED"
    assert candidate.trials.first().test_f1 == pytest.approx(report["test"].f1, abs=1e-9)
    # The destination gains the amount, so its balances say the same.
    assert candidate.importance().first().feature in {"amount", "diffDest", "newBalanceDest"}
    candidate.save_review(f"{folder}/review", "run-1", F.lit(AT).cast("timestamp_ntz"))
    assert read_grown(spark, f"{folder}/review/row_explanations").where("run_id = 'run-1'").count() > 0

    labels, known = features.label_table(gold), features.feature_table(gold)
    log = lifecycle.score_batch(labels, known, candidate.model, "7", AT, log_path=f"{folder}/log")
    assert log.count() == gold.count() and "split" not in log.columns
    stored = spark.read.parquet(f"{folder}/log").drop("day")
    assert {(r.model_version, r.inference_timestamp) for r in stored.select("model_version", "inference_timestamp").distinct().collect()} == {("7", AT)}
    shifted = stored.withColumn("inference_timestamp", F.col("inference_timestamp") + F.expr("INTERVAL 1 DAY")).withColumn("amount", F.col("amount") * 10)
    watched = lifecycle.watch(stored.unionByName(shifted), labels, features.baseline(features.with_labels(stored, labels)))
    assert watched.decision.first().retrain  # the amounts moved
    moved = {r.column_name for r in watched.drift.where("js_distance > 0.2").collect()}
    assert moved == {"amount"} and watched.baseline_drift.count() == 10


def test_attributions_of_the_fitted_linear_model_add_up(spark, gold):
    rows = learning_rows = features.with_features(gold, keep=["is_fraud"]).withColumn("is_fraud", F.col("is_fraud").cast("int"))
    model = learning.fit(learning_rows, LOGISTIC, ["type"], ["amount", "balance_orig_ratio"])
    found = lifecycle.explain(model, rows, rows, [])
    assert found.select("feature").distinct().count() == len(learning.feature_names(model)) == 7
    total = found.groupBy("transaction_id").agg(F.sum("value").alias("total"))
    margin = model.transform(rows).select(
        "transaction_id", F.expr("rawPrediction").alias("raw")
    )
    margin = margin.select("transaction_id", vector_to_array("raw")[1].alias("margin"))
    mean = margin.agg(F.avg("margin")).first()[0]
    off = total.join(margin, "transaction_id").where(F.abs(F.col("total") - (F.col("margin") - mean)) > 1e-6)
    assert off.count() == 0


def test_a_search_without_success_is_an_error(gold):
    broken = learning.Trial(0, "gbt", {"trees": 0, "depth": 3, "rate": 0.3, "bins": 32})
    with pytest.raises(RuntimeError, match="no trial"):
        lifecycle.train_and_judge(gold, [broken], AT)


def test_stream_scored_by_a_trained_model(spark, gold, folder):
    rows = features.with_features(gold, keep=["is_fraud"]).withColumn("is_fraud", F.col("is_fraud").cast("int"))
    model = learning.fit(rows, LOGISTIC, ["type"], ["amount"])
    rows.select("transaction_id").write.parquet(f"{folder}/requests")
    requests = spark.readStream.schema("transaction_id string").parquet(f"{folder}/requests")
    table = StreamTable(f"{folder}/scores")
    scores = score_requests(requests, rows.drop("is_fraud"), lambda df: learning.score(model, df, ["transaction_id"]))
    run_to_end(append_stream(scores, table))
    streamed = read_table(spark, table)
    batch = learning.score(model, rows, ["transaction_id"])
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0
