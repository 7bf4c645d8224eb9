"""Subgroup metrics, disparity ratios across slices and the fairness gate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions.columns import ratio
from ledgerwatch.operators.metrics import confusion_counts

# Smallest slice that counts, and the loose threshold for small samples.
MIN_SLICE_ROWS = 30
RATIO_THRESHOLD = 5.0

DISPARATE_IMPACT, CALIBRATION = "disparate_impact", "calibration"


def subgroup_metrics(
    df: DataFrame, dimensions: Sequence[str], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per (dimension, value): size, base rate, precision, recall, false positive and selection rate.

    All dimensions come from one pass with grouping sets. Null slice values are left out; values are text.
    """
    dimensions = list(dimensions)
    if not dimensions:
        raise ValueError("no dimension to slice by")
    # The grouping columns get names of their own, so that a dimension may also be the label.
    slices = {d: f"__slice_{i}" for i, d in enumerate(dimensions)}
    grouped = df.withColumns({s: F.col(d) for d, s in slices.items()}).groupingSets(
        [[F.col(s)] for s in slices.values()], *[F.col(s) for s in slices.values()]
    )
    counts = grouped.agg(
        *[F.grouping(s).alias(f"{s}_off") for s in slices.values()],
        *[c.alias(n) for n, c in confusion_counts(label, prediction).items()],
    )
    is_on = [(d, s, F.col(f"{s}_off") == 0) for d, s in slices.items()]
    dimension = reduce(lambda c, t: c.when(t[2], F.lit(t[0])), is_on[1:], F.when(is_on[0][2], F.lit(is_on[0][0])))
    value = F.coalesce(*[F.col(s).cast("string") for s in slices.values()])
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    return counts.select(
        dimension.alias("slice_dimension"),
        value.alias("slice_value"),
        n.alias("n"),
        ratio(tp + fn, n).alias("positive_rate"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(fp, fp + tn).alias("false_positive_rate"),
        ratio(tp + fp, n).alias("selection_rate"),
    ).where(F.col("slice_value").isNotNull())


def _measure(kind: str) -> Column:
    if kind == DISPARATE_IMPACT:
        return F.col("selection_rate")
    if kind == CALIBRATION:
        return F.when(F.col("positive_rate") > 0, F.col("selection_rate") / F.col("positive_rate"))
    raise ValueError(f"unknown ratio {kind!r}")


def dimension_ratios(slices: DataFrame, kind: str, min_n: int = MIN_SLICE_ROWS) -> DataFrame:
    """Greatest over smallest measure per dimension, over slices with at least `min_n` rows.

    Dimensions with fewer than two such slices, or a smallest measure of zero, give no row. Of slices
    with equal measure the alphabetically first is named.
    """
    rate = "base" if kind == CALIBRATION else None
    usable = slices.withColumn("__m", _measure(kind)).where((F.col("n") >= min_n) & F.col("__m").isNotNull())
    fields = [F.col("slice_value").alias("slice"), F.col("__m").alias("measure"), F.col("selection_rate").alias("rate")]
    if rate:
        fields.append(F.col("positive_rate").alias(rate))
    fields.append(F.col("n"))
    extremes = usable.groupBy("slice_dimension").agg(
        F.count(F.lit(1)).alias("__slices"),
        # Smallest (-measure, value) and smallest (measure, value): ties go to the first value.
        F.min(F.struct((-F.col("__m")).alias("o"), F.col("slice_value"), F.struct(*fields).alias("row"))).alias("__hi"),
        F.min(F.struct(F.col("__m").alias("o"), F.col("slice_value"), F.struct(*fields).alias("row"))).alias("__lo"),
    )
    high, low = F.col("__hi.row"), F.col("__lo.row")
    out = [F.col("slice_dimension").alias("dimension")]
    for side, row in (("max", high), ("min", low)):
        out.append(row["slice"].alias(f"{side}_slice"))
        if rate:
            out.append(row["measure"].alias(f"{side}_calibration"))
        out.append(row["rate"].alias(f"{side}_selection_rate"))
        if rate:
            out.append(row[rate].alias(f"{side}_positive_rate"))
        out.append(row["n"].alias(f"{side}_n"))
    out.append((high["measure"] / low["measure"]).alias("ratio"))
    return extremes.where((F.col("__slices") >= 2) & (low["measure"] != 0)).select(*out)


def worst_ratio(slices: DataFrame, kind: str, min_n: int = MIN_SLICE_ROWS) -> DataFrame:
    """The dimension with the greatest ratio (alphabetically first of equals), or no row."""
    return dimension_ratios(slices, kind, min_n).orderBy(F.desc("ratio"), "dimension").limit(1)


def fairness_gate(
    slices: DataFrame,
    threshold: float = RATIO_THRESHOLD,
    min_n: int = MIN_SLICE_ROWS,
    use_calibration: bool = True,
) -> DataFrame:
    """One row (passes, worst_ratio, detail). With nothing to compare it passes and detail is null."""
    worst = worst_ratio(slices, CALIBRATION if use_calibration else DISPARATE_IMPACT, min_n)
    detail = worst.agg(F.first(F.struct(*worst.columns)).alias("detail"))  # always one row
    return detail.select(
        F.coalesce(F.col("detail.ratio") <= threshold, F.lit(True)).alias("passes"),
        F.col("detail.ratio").alias("worst_ratio"),
        F.col("detail"),
    )


def ratios_by_dimension(slices: DataFrame, min_n: int = MIN_SLICE_ROWS) -> DataFrame:
    """Both ratios per dimension over the slices with enough rows and a positive base rate."""
    eligible = slices.where((F.col("n") >= min_n) & (F.col("positive_rate") > 0))
    calibration = _measure(CALIBRATION)
    return (
        eligible.groupBy(F.col("slice_dimension").alias("dimension"))
        .agg(
            F.count(F.lit(1)).alias("slices"),
            F.max(calibration).alias("__cmax"),
            F.min(calibration).alias("__cmin"),
            F.max("selection_rate").alias("__smax"),
            F.min("selection_rate").alias("__smin"),
        )
        .where("slices >= 2")
        .select(
            "dimension",
            "slices",
            F.try_divide("__cmax", "__cmin").alias("calibration_ratio"),
            F.try_divide("__smax", "__smin").alias("disparate_impact_ratio"),
        )
    )


SLICE_SCHEMA = T.StructType(
    [T.StructField("slice_dimension", T.StringType()), T.StructField("slice_value", T.StringType()),
     T.StructField("n", T.LongType())]
    + [T.StructField(c, T.DoubleType())
       for c in ("positive_rate", "precision", "recall", "false_positive_rate", "selection_rate")]
)
