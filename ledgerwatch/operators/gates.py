"""Promotion of a challenger model over the champion, as joins of metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the promotion rules.
MIN_DESCRIPTION = 20
F1_TOLERANCE = 0.05
CHAMPION, CHALLENGER = "Champion", "Challenger"

CHECKS = ("has_description", "predicts", "metric_f1_passed", "business_metric_passed", "fairness_passed")


def promotion_gate(
    versions: DataFrame, metrics: DataFrame, decided_at: Column | None = None, manual_approval: bool = False
) -> DataFrame:
    """One row per challenger: every check, and `Approved` only if all hold.

    `versions` has model_name, model_version, alias, description, fairness_check and, for manual
    approval, approval. `metrics` has per version f1, value (dollars), scored and unscored rows.
    Without a champion the two comparisons hold; a missing fairness result does not.
    """
    keys = ["model_name", "model_version"]
    known = versions.join(metrics, keys, "left")
    champion = known.where(F.col("alias") == CHAMPION).select(
        "model_name",
        F.col("model_version").alias("champion_version"),
        F.col("f1").alias("champion_f1"),
        F.col("value").alias("champion_value"),
    )
    no_champion = F.col("champion_version").isNull()
    checks = {
        "has_description": F.length(F.col("description")) > MIN_DESCRIPTION,
        "predicts": (F.col("scored") > 0) & (F.col("unscored") == 0),
        "metric_f1_passed": no_champion | (F.col("f1") >= F.col("champion_f1") * (1 - F1_TOLERANCE)),
        "business_metric_passed": no_champion | (F.col("value") >= F.col("champion_value")),
        "fairness_passed": F.lower(F.col("fairness_check")) == "passed",
    }
    if manual_approval:
        checks["manually_approved"] = F.lower(F.col("approval")) == "approved"
    judged = (
        known.where(F.col("alias") == CHALLENGER)
        .join(champion, "model_name", "left")
        .withColumns({name: F.coalesce(check, F.lit(False)) for name, check in checks.items()})
    )
    passed = F.forall(F.array(*checks), lambda ok: ok)
    out = judged.select(
        *keys,
        "champion_version",
        *checks,
        passed.alias("promoted"),
        F.when(passed, "Approved").otherwise("Failed").alias("approval_check"),
    )
    return out if decided_at is None else out.withColumn("decided_at", decided_at)


def best_trial(trials: DataFrame, metric: str = "test_f1", started: str = "started_at") -> DataFrame:
    """The finished run with the best metric; of equals the newest, then the smallest id."""
    finished = trials.where(F.col("state") == "FINISHED")
    return finished.orderBy(F.desc_nulls_last(metric), F.desc_nulls_last(started), "run_id").limit(1)
