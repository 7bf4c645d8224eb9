"""Validation of a challenger against the champion on the same rows, and the promotion that follows from it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import PROTECTED_COLUMNS, protected_columns
from ledgerwatch.operators import fairness, gates, metrics
from ledgerwatch.sources.tables import VersionedTable, append, staged

KEYS = ("model_name", "model_version")
FORMER, REJECTED = "Former", "Rejected"
# Adds a 0/1 column `prediction` to its rows and keeps their number; null where it could not score.
Model = Callable[[DataFrame], DataFrame]


def predictions(rows: DataFrame, models: Mapping[str, Model], keep: Sequence[str]) -> DataFrame:
    """The columns `keep` of each row with (model_version, prediction) of every model: one scan for all of them.

    A model sees the rows as they are, whatever columns the models before it add.
    """
    given, held = rows.columns, []
    for number, score in enumerate(models.values()):
        name = f"__prediction_{number}"
        scored = score(rows)
        rows = scored.select(*given, *held, scored["prediction"].cast("int").alias(name))
        held.append(name)
    pairs = [F.struct(F.lit(version).alias("model_version"), F.col(name).alias("prediction")) for version, name in zip(models, held, strict=True)]
    return rows.select(*keep, F.inline(F.array(*pairs)))


def validate(
    rows: DataFrame,
    models: Mapping[str, Model],
    versions: DataFrame,
    model_name: str,
    decided_at: Any,
    label: str = "label",
    costs: metrics.Costs = metrics.CORRECTED,
    threshold: float = fairness.RATIO_THRESHOLD,
    manual_approval: bool = False,
) -> DataFrame:
    """The decision about each challenger in `versions` (model_name, model_version, alias, description, approval).

    Every version in `models` is applied to the same labelled rows. Counts, dollars and unscored rows are grouped by version; the fairness gate
    looks at each version's own predictions. Rows without a label count for what could be scored only.
    """
    keep = [label, *protected_columns(rows.columns)]
    scored = staged(predictions(rows, models, keep).withColumnRenamed(label, "label"), "validated")
    counts = [c.alias(n) for n, c in metrics.confusion_counts().items()]
    per_version = scored.groupBy("model_version").agg(*counts, F.count("prediction").alias("scored"), F.count_if(F.col("prediction").isNull()).alias("unscored"))
    measured = metrics.model_value(metrics.rates(per_version), costs).select(F.lit(model_name).alias("model_name"), "model_version", "f1", "value", "scored", "unscored")
    dimensions = [c for c in PROTECTED_COLUMNS if c in scored.columns]
    own = versions.where(F.col("model_name") == model_name)
    if dimensions:
        # The versions are named by the caller, so their number is known.
        gates_ = [
            fairness.fairness_gate(fairness.subgroup_metrics(scored.where(F.col("model_version") == version), dimensions), threshold).select(
                F.lit(version).alias("model_version"), F.when(F.col("passes"), "Passed").otherwise("Failed").alias("fairness_check")
            )
            for version in models
        ]
        checked = gates_[0]
        for more in gates_[1:]:
            checked = checked.unionByName(more)
        own = own.drop("fairness_check").join(checked, "model_version", "left")
    else:
        own = own.withColumn("fairness_check", F.lit(None).cast("string"))
    return gates.promotion_gate(own, measured, F.lit(decided_at).cast("timestamp_ntz"), manual_approval)


def promote(table: VersionedTable, decisions: DataFrame, log_path: str | None = None) -> DataFrame:
    """Gives the aliases that the decisions call for, as a new version of the table of model versions, which it returns.

    A promoted challenger becomes the champion and the champion before it `Former`; a challenger that failed is `Rejected`. Of several that
    pass for one model, the newest version by name is promoted and the others stay challengers. The decisions are appended to `log_path`.
    """
    decided = staged(decisions, "decisions")
    if log_path is not None:
        append(decided, log_path)
    chosen = decided.where("promoted").groupBy("model_name").agg(F.max("model_version").alias("chosen"))
    flags = decided.select(*KEYS, "promoted").dropDuplicates(list(KEYS))
    known = table.read()
    joined = known.join(flags, list(KEYS), "left").join(chosen, "model_name", "left")
    alias = (
        F.when(F.col("model_version") == F.col("chosen"), gates.CHAMPION)
        .when(F.col("chosen").isNotNull() & (F.col("alias") == gates.CHAMPION), FORMER)
        .when((F.col("alias") == gates.CHALLENGER) & ~F.col("promoted"), REJECTED)
        .otherwise(F.col("alias"))
    )
    table.replace(joined.withColumn("alias", alias).select(*known.columns))
    return table.read()
