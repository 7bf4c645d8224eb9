"""Classification metrics as aggregates. `label` and `prediction` are 0/1 columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import ratio
from ledgerwatch.operators.skew import HOT_ROWS, parts_for, running_totals
from ledgerwatch.sources.tables import staged

# Fixed value: loss booked for one missed positive.
MISSED_FRAUD = -200_000


@dataclass(frozen=True)
class Costs:
    """Dollar value of one row of each kind."""

    true_negative: int = 0
    false_positive: int = -500
    false_negative: int = -200_000
    true_positive: int = 199_500


# Missed fraud costs its amount.
CORRECTED = Costs()
# The figures as first published, where missed fraud counts as a gain.
AS_WRITTEN = Costs(false_negative=200_000)


def confusion_counts(label: str = "label", prediction: str = "prediction") -> dict[str, Column]:
    """tn, fp, fn, tp; each is 0 when its class is absent, rows without label or prediction count nowhere."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return {
        "tn": F.count_if((y == 0) & (p == 0)),
        "fp": F.count_if((y == 0) & (p == 1)),
        "fn": F.count_if((y == 1) & (p == 0)),
        "tp": F.count_if((y == 1) & (p == 1)),
    }


def confusion(df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction") -> DataFrame:
    counts = [c.alias(n) for n, c in confusion_counts(label, prediction).items()]
    return df.groupBy(*by).agg(*counts) if by else df.agg(*counts)


def model_value(counts: DataFrame, costs: Costs = CORRECTED, name: str = "value") -> DataFrame:
    """Dollar value of the four counts."""
    value = (
        F.col("tn") * costs.true_negative
        + F.col("fp") * costs.false_positive
        + F.col("fn") * costs.false_negative
        + F.col("tp") * costs.true_positive
    )
    return counts.withColumn(name, value)


def expected_loss(label: str = "label", prediction: str = "prediction", cost: int = MISSED_FRAUD) -> Column:
    """Mean over all rows of `cost` for each positive that was predicted otherwise; unlabelled rows add zero."""
    missed = (F.col(prediction) != F.col(label)) & (F.col(label).cast("int") == 1)
    return ratio(F.count_if(missed) * cost, F.count(F.lit(1)))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """2tp / (2tp + fp + fn), null when the class is neither present nor predicted."""
    return ratio(tp * 2, tp * 2 + fp + fn)


def macro_f1(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    """Mean F1 over the classes present in label or prediction."""
    scores = F.array_compact(F.array(f1(tp, fp, fn), f1(tn, fn, fp)))
    return F.try_divide(F.aggregate(scores, F.lit(0.0), lambda a, b: a + b), F.size(scores))


def rates(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, false_positive_rate, f1, f1_macro from the four counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tn + fp + fn + tp),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "false_positive_rate": ratio(fp, fp + tn),
            "f1": f1(tp, fp, fn),
            "f1_macro": macro_f1(tn, fp, fn, tp),
        }
    )


def score_points(
    df: DataFrame, score: str, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Labelled rows counted per distinct score and prediction: all a report needs, from one pass."""
    y = F.col(label).cast("int")
    keys = [F.col(score).cast("double").alias("score"), F.col(prediction).cast("int").alias("prediction")]
    return (
        df.where(y.isNotNull())
        .groupBy(*by, *keys)
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def curve_areas(points: DataFrame, by: Sequence[str] = (), window_rows: int = HOT_ROWS) -> DataFrame:
    """Exact ROC AUC (ties count half) and PR AUC (trapezoids, starting at precision 1) from `score_points`.

    `points` should be a stored table: its rows are counted first. The running counts over the scores are made by ranges of scores, so many
    that no window has more than `window_rows` rows.
    """
    parts = parts_for(points.count(), window_rows)
    per_score = points.where("score IS NOT NULL").groupBy(*by, "score")
    steps = per_score.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    walked = running_totals(steps, "score", ["pos", "neg"], by, descending=True, parts=parts)
    tp, fp = F.col("pos_before"), F.col("neg_before")
    pos, neg = F.col("pos"), F.col("neg")
    precision_before = F.coalesce(ratio(tp, tp + fp), F.lit(1.0))
    precision_after = ratio(tp + pos, tp + pos + fp + neg)
    areas = walked.groupBy(*by).agg(
        # As double: pairs of rows outgrow a 64-bit count.
        F.sum(neg.cast("double") * (tp * 2 + pos)).alias("__wins"),
        F.sum(pos * (precision_before + precision_after)).alias("__area"),
        F.sum(pos).alias("__pos"),
        F.sum(neg).alias("__neg"),
    )
    return areas.select(
        *by,
        ratio(F.col("__wins"), F.col("__pos").cast("double") * F.col("__neg") * 2).alias("roc_auc"),
        F.try_divide(F.col("__area"), F.col("__pos").cast("double") * 2).alias("pr_auc"),
    )


def classification_report(
    df: DataFrame,
    score: str,
    by: Sequence[str] = (),
    label: str = "label",
    prediction: str = "prediction",
    floor: float = 1e-15,
) -> DataFrame:
    """Counts, rates, log loss (probabilities clipped to [floor, 1 - floor]) and both curve areas per group.

    The rows are read once into counts per score, which are written out; the rest works on those.
    """
    points = staged(score_points(df, score, by, label, prediction), "scores")
    pos, neg, chosen = F.col("pos"), F.col("neg"), F.col("prediction") == 1
    p = F.least(F.greatest(F.col("score"), F.lit(floor)), F.lit(1 - floor))
    counts = {
        "tn": F.when(~chosen, neg),
        "fp": F.when(chosen, neg),
        "fn": F.when(~chosen, pos),
        "tp": F.when(chosen, pos),
    }
    known = F.when(F.col("score").isNotNull(), pos + neg)
    summary = points.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in counts.items()],
        ratio(F.sum(-(pos * F.ln(p) + neg * F.ln(F.lit(1.0) - p))), F.sum(known)).alias("log_loss"),
    )
    areas = curve_areas(points, by)
    if not by:
        summary, areas = summary.withColumn("__one", F.lit(1)), areas.withColumn("__one", F.lit(1))
    return rates(summary).join(areas, list(by) or ["__one"], "left").drop("__one")
