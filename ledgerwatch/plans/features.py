"""Feature, label, training and inference tables built from gold transactions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import truthy
from ledgerwatch.functions.risk import RISK_SCORE, BoundFunction
from ledgerwatch.operators.asof import asof_join
from ledgerwatch.operators.keyed import one_per_key
from ledgerwatch.operators.sampling import split_name

# Columns taken over from gold unchanged.
INPUTS = (
    "step", "amount", "type",
    "oldBalanceOrig", "newBalanceOrig", "oldBalanceDest", "newBalanceDest", "diffOrig", "diffDest",
    "age_group", "country",
    "countryOrig", "countryDest", "countryOrig_name", "countryDest_name",
    "countryLongOrig_long", "countryLatOrig_lat", "countryLongDest_long", "countryLatDest_lat",
)

# Fixed value: a deposit above this on an empty account is unusual.
LARGE_DEPOSIT = 100_000
# The rule that stands in for a model where results must be exact.
RULE_CUTOFF = 0.6


def _indicator(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it does not or is null."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def engineered() -> dict[str, Column]:
    had = F.col("oldBalanceOrig") > 0
    return {
        "balance_orig_ratio": F.when(had, F.col("amount") / F.col("oldBalanceOrig")).otherwise(F.lit(0.0)),
        "is_full_transfer": _indicator(had & (F.col("newBalanceOrig") == 0)),
        "is_cross_border": _indicator(F.col("countryOrig") != F.col("countryDest")),
        "dest_balance_anomaly": _indicator((F.col("oldBalanceDest") == 0) & (F.col("amount") > LARGE_DEPOSIT)),
    }


def with_features(gold: DataFrame, event_ts: str = "event_ts", keep: Iterable[str] = ()) -> DataFrame:
    """Keys, inputs and engineered features of every gold row, plus the columns named in `keep`."""
    inputs = [c for c in INPUTS if c in gold.columns]
    overdraft = F.col("isUnauthorizedOverdraft").cast("double").alias("is_unauthorized_overdraft")
    base = gold.select(
        F.col("id").alias("transaction_id"), F.col(event_ts).alias("event_ts"), *inputs, overdraft, *keep
    )
    return base.withColumns(engineered())


def feature_table(gold: DataFrame, event_ts: str = "event_ts") -> DataFrame:
    """One feature row per transaction, keyed by (transaction_id, event_ts)."""
    return one_per_key(with_features(gold, event_ts), ["transaction_id"], ["event_ts"])


def label_table(gold: DataFrame, event_ts: str = "event_ts") -> DataFrame:
    """Labels apart from the features, with a split that depends on the id alone."""
    labels = gold.select(
        F.col("id").alias("transaction_id"),
        F.col(event_ts).alias("event_ts"),
        truthy(F.col("is_fraud")).cast("int").alias("is_fraud"),
    )
    deduplicated = one_per_key(labels, ["transaction_id"], ["event_ts"])
    return deduplicated.withColumn("split", split_name(F.col("transaction_id")))


def training_set(
    labels: DataFrame,
    features: DataFrame,
    functions: Iterable[BoundFunction] = (RISK_SCORE,),
    label: str = "is_fraud",
    exclude: Iterable[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Labelled rows with the features known at label time and the on-demand columns.

    `unique` says that `features` has one row per transaction, as `feature_table` makes it.
    """
    known = labels.where(F.col(label).isNotNull())
    joined = asof_join(known, features, on=["transaction_id"], ts="event_ts", right_unique=unique)
    for function in functions:
        joined = function.add_to(joined)
    return joined.drop(*exclude)


def rule_prediction(score: Column, cutoff: float = RULE_CUTOFF) -> Column:
    # Compared as float: the score is one, and 0.6 has another value as double.
    return F.when(score >= F.lit(cutoff).cast("float"), 1).otherwise(0)


def rule_scored(gold: DataFrame) -> DataFrame:
    """Features, risk score, label (0/1), rule prediction (0/1) and a model version per row."""
    return (
        RISK_SCORE.add_to(with_features(gold, keep=["is_fraud"]))
        .withColumns(
            {
                "label": F.col("is_fraud").cast("int"),
                "prediction": rule_prediction(F.col("risk_score")),
                "model_version": F.when(F.col("transaction_id").cast("bigint") % 2 == 0, "1").otherwise("2"),
            }
        )
        .drop("is_fraud")
    )


def inference_log(scored: DataFrame, version: Column, scored_at: Column) -> DataFrame:
    """Predictions with lineage, ready to append; the training split is not part of the log."""
    return scored.drop("split").withColumns({"model_version": version, "inference_timestamp": scored_at})


def with_labels(log: DataFrame, labels: DataFrame) -> DataFrame:
    """The log with the label where one is known for the same (transaction_id, event_ts)."""
    keys = ["transaction_id", "event_ts"]
    known = labels.select(*keys, F.col("is_fraud").cast("double").alias("label"))
    return log.drop("label").join(known, keys, "left")


def baseline(labelled_log: DataFrame) -> DataFrame:
    """The labelled log without its identity and time columns."""
    return labelled_log.drop("transaction_id", "event_ts", "inference_timestamp")
