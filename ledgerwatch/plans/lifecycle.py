"""The jobs around one model, each as one call: train and judge, score in batch, watch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import protected_columns
from ledgerwatch.functions.risk import RISK_SCORE, BoundFunction
from ledgerwatch.operators import fairness, gates, metrics, monitor
from ledgerwatch.operators.monitor_tables import MonitorTables
from ledgerwatch.plans import attribution, features, learning
from ledgerwatch.sources.tables import append, append_lineage, scratch, staged

KEY = "transaction_id"
NOT_INPUTS = (KEY, "event_ts", "is_fraud", "split")


@dataclass
class Candidate:
    """A trained model with all that a reviewer needs."""

    model: PipelineModel
    path: str
    trials: DataFrame
    report: DataFrame
    slices: DataFrame
    gate: DataFrame
    attributions: DataFrame

    def importance(self, n: int = attribution.TOP_FEATURES) -> DataFrame:
        return attribution.global_importance(self.attributions, n)

    def save_review(self, folder: str, run_id: str, at: Column) -> None:
        """Append importance, row explanations and slices to their tables."""
        append_lineage(self.importance(), f"{folder}/global_importance", run_id, at)
        append_lineage(self.attributions, f"{folder}/row_explanations", run_id, at, "explained_at")
        append_lineage(self.slices, f"{folder}/fairness_metrics", run_id, at)


def explain(
    model: PipelineModel, rows: DataFrame, background: DataFrame, inputs: Sequence[str], percent: int = 100, most: int | None = None, draws: int = attribution.DRAWS
) -> DataFrame:
    """Exact attributions on all rows: of a linear model by place of its feature vector, of trees by input. Sampled ones of any other
    model by input, on `percent` of the rows and `most` of these, all if not said otherwise."""
    classifier = model.stages[-1]
    if isinstance(classifier, LogisticRegressionModel):
        names = learning.feature_names(model)
        prepared = PipelineModel(stages=model.stages[:-1]).transform(rows)
        return attribution.model_attribution(prepared, KEY, list(classifier.coefficients), names)
    if isinstance(classifier, (GBTClassificationModel, RandomForestClassificationModel)):
        return learning.explain_trees(model, rows, KEY)
    some = staged(attribution.explained_rows(rows, KEY, percent, most), "explained")
    return attribution.sampled_attribution(some, background, KEY, inputs, lambda df: learning.score(model, df), draws)


def train_and_judge(
    gold: DataFrame,
    trials: Sequence[learning.Trial],
    started_at: dt.datetime,
    event_ts: str = "event_ts",
    functions: Iterable[BoundFunction] = (RISK_SCORE,),
    path: str | None = None,
    parallelism: int = 4,
    percent: int = 100,
    rows: int | None = None,
    draws: int = attribution.DRAWS,
) -> Candidate:
    """Training set, search, refit of the best trial, metrics, explanations and the fairness gate.

    All training rows train. Explanations and fairness metrics use all test rows; only models without an exact form take `percent` and `rows` for fewer.
    """
    spark = gold.sparkSession
    labels, known = features.label_table(gold, event_ts), features.feature_table(gold, event_ts)
    training = staged(features.training_set(labels, known, functions, unique=True), "training")
    train, test = training.where("split = 'train'"), training.where("split = 'test'")
    categorical, numeric = learning.model_columns(training, NOT_INPUTS)

    log = learning.search(train, trials, categorical, numeric, started_at, parallelism=parallelism)
    best = gates.best_trial(log, "holdout_f1").first()  # one row
    if best is None:
        raise RuntimeError("no trial finished")
    path = path or scratch(spark, "model")
    fitted = learning.fit(train, learning.trial_from(best), categorical, numeric)
    model = learning.save_and_load(spark, fitted, path)

    scored = learning.score(model, test).withColumn("label", F.col("is_fraud"))
    # The refitted model's own score on the test rows, in the row of its trial.
    test_f1 = metrics.confusion(scored).select(metrics.f1(F.col("tp"), F.col("fp"), F.col("fn"))).scalar()
    log = log.withColumn("test_f1", F.when(F.col("run_id") == best.run_id, test_f1))
    slices = fairness.subgroup_metrics(scored, protected_columns(scored.columns))
    return Candidate(
        model=model,
        path=path,
        trials=log,
        report=learning.evaluate(model, training),
        slices=slices,
        gate=fairness.fairness_gate(slices),
        attributions=explain(model, test, train, [*numeric, *categorical], percent, rows, draws),
    )


def score_batch(
    ids: DataFrame,
    known: DataFrame,
    model: PipelineModel,
    version: str,
    at: Any,
    functions: Iterable[BoundFunction] = (RISK_SCORE,),
    log_path: str | None = None,
) -> DataFrame:
    """Ids with their time joined to the features known then, scored by an explicit model.

    With `log_path` the rows are also appended to the inference log, one folder per day.
    """
    joined = features.training_set(ids, known, functions, label=KEY)
    scored = learning.score(model, joined).drop("probability")
    log = features.inference_log(scored, F.lit(version), F.lit(at).cast("timestamp_ntz"))
    if log_path is not None:
        append(log, log_path, day_of="inference_timestamp")
    return log


@dataclass
class Watch:
    profile: DataFrame
    drift: DataFrame
    baseline_drift: DataFrame
    decision: DataFrame


def watch(
    log: DataFrame,
    labels: DataFrame,
    baseline: DataFrame,
    columns: Sequence[str] = ("amount", "balance_orig_ratio"),
    ts: str = "inference_timestamp",
    bins: Sequence[monitor.Bins] | None = None,
) -> Watch:
    """Profile and drift of an inference log with the labels known by now, and whether to train again.

    The baseline is a fixed table apart from the log; its bins are those stored with it, or are made from it.
    """
    labelled = staged(features.with_labels(log, labels), "labelled")
    bins = monitor.fix_bins(baseline) if bins is None else bins
    profile = staged(monitor.profile_metrics(labelled, columns, ts), "profile")
    drift = staged(monitor.drift_consecutive(labelled, bins, ts=ts), "drift")
    return Watch(
        profile,
        drift,
        monitor.drift_baseline(labelled, baseline, bins, ts=ts),
        monitor.retrain_decision(monitor.judged_profile(profile), monitor.judged_drift(drift)),
    )


def keep_watch(tables: MonitorTables, log: DataFrame, labels: DataFrame, until: dt.date, since: dt.date | None = None) -> Watch:
    """As `watch`, from tables that hold all earlier days: only the days from the last run, or from `since`, are read.

    `since` takes days in again whose labels came late. The baseline is the one the tables were made with.
    """
    tables.refresh(features.with_labels(log, labels), until, since)
    profile, drift = staged(tables.profile(), "profile"), staged(tables.drift_consecutive(), "drift")
    return Watch(profile, drift, tables.drift_baseline(), monitor.retrain_decision(monitor.judged_profile(profile), monitor.judged_drift(drift)))
