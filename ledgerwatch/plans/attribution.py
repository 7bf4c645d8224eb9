"""Additive explanations of scores: exact for linear models, sampled Shapley values for any other."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators.sampling import hash_sample, hash_top_n

DRAWS = 8
TOP_FEATURES = 15


def explained_rows(df: DataFrame, key: str, percent: int = 100, rows: int | None = None) -> DataFrame:
    """All rows, or those of a sample by hash and at most so many of them."""
    some = df if percent >= 100 else hash_sample(df, key, percent)
    return some if rows is None else hash_top_n(some, key, rows)


def linear_attribution(df: DataFrame, key: str, weights: Mapping[str, float]) -> DataFrame:
    """(key, feature, value): weight x (value - mean of the feature), in the units of the linear score."""
    means = df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in weights])).scalar()
    cells = [
        F.struct(F.lit(c).alias("feature"), (F.lit(float(w)) * (F.col(c).cast("double") - means[c])).alias("value"))
        for c, w in weights.items()
    ]
    return df.select(key, F.inline(F.array(*cells)))


def model_attribution(prepared: DataFrame, key: str, coefficients: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(key, feature, value) of a linear model over a prepared `features` vector, in log-odds.

    `names` has one entry per place of the vector. The means are those of `prepared` itself.
    """
    means = prepared.agg(vector_to_array(Summarizer.mean(F.col("features")))).scalar()
    away = F.zip_with(vector_to_array("features"), F.col("means"), lambda x, m: x - m)
    weights = F.array(*[F.lit(float(w)) for w in coefficients])
    values = F.zip_with(away, weights, lambda d, w: d * w)
    cells = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), values.alias("value"))
    return prepared.withColumn("means", means).select(key, F.inline(cells))


def sampled_attribution(
    rows: DataFrame,
    background: DataFrame,
    key: str,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    permutations: int = DRAWS,
    background_rows: int = 500,
) -> DataFrame:
    """(key, feature, value, stderr): mean change of the score when a feature takes the row's value.

    For each row and draw the features switch, in an order decided by a hash, from those of a background
    row to the row's own, and every step is scored (Strumbelj and Kononenko, 2014). `score` adds a column
    `probability` to rows with a key and the features. A row itself and a background row are scored once for
    all draws, so there are rows x (draws x (features - 1) + 1) instances; the values of a row add up to its
    score minus the mean score of its background rows. Rows are dealt out by key once; their instances stay in that task.
    """
    pool = hash_top_n(background.select(key, *features), key, background_rows, "background")
    # The pool has a fixed size, so it is numbered as one list and sent to every task.
    listed = pool.agg(F.array_sort(F.collect_list(F.struct(key, F.struct(*features).alias("base")))).alias("pool"))
    numbered = listed.select(F.posexplode("pool").alias("place", "row")).select("place", "row.base")
    size = pool.agg(F.count(F.lit(1))).scalar()

    # Names of its own, so that any name may be a feature.
    draw, step, first, last, between = "__draw", "__step", "__first", "__last", "__between"
    bases = score(numbered.select(F.col("place").alias(step), "base.*"))
    bases = bases.select(F.col(step).alias("place"), F.struct(*features).alias("base"), F.col("probability").alias(first))
    # A number of parts of its own: the few bytes of a row become many instances, so parts must not be joined by their size.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owns = score(rows.select(key, *features).repartition(parts, key))
    owns = owns.select(key, F.struct(*features).alias("own"), F.col("probability").alias(last))
    draws = owns.withColumn(draw, F.explode(F.sequence(F.lit(1), F.lit(permutations))))
    place = F.pmod(F.xxhash64(F.col(key), F.col(draw), F.lit("background")), size).cast("int")
    shuffled = [F.struct(F.xxhash64(F.col(key), F.col(draw), F.lit(f)).alias("o"), F.lit(f).alias("f")) for f in features]
    order = F.transform(F.array_sort(F.array(*shuffled)), lambda s: s["f"])
    drawn = draws.withColumn("place", place).join(F.broadcast(bases), "place")
    inner = range(1, len(features))
    if inner:
        steps = drawn.withColumns({"order": order, step: F.explode(F.sequence(F.lit(1), F.lit(len(features) - 1)))})
        mixed = steps.select(
            key,
            draw,
            step,
            first,
            last,
            *[
                F.when(F.array_position("order", f) <= F.col(step), F.col("own")[f]).otherwise(F.col("base")[f]).alias(f)
                for f in features
            ],
        )
        scored = score(mixed).select(key, draw, step, first, last, "probability")
        drawn = scored.groupBy(key, draw).agg(
            F.max(first).alias(first),
            F.max(last).alias(last),
            *[F.max(F.when(F.col(step) == k, F.col("probability"))).alias(f"{between}{k}") for k in inner],
        )
    walk = F.array(first, *[f"{between}{k}" for k in inner], last)
    walks = drawn.select(key, order.alias("order"), walk.alias("walk"))
    changes = walks.select(key, *[_change(F.array_position("order", f).cast("int")).alias(f"{step}{i}") for i, f in enumerate(features)])
    found = changes.groupBy(key).agg(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.avg(f"{step}{i}").alias("value"),
                (F.stddev_samp(f"{step}{i}") / F.sqrt(F.count(F.lit(1)))).alias("stderr"),
            ).alias(f"{step}{i}")
            for i, f in enumerate(features)
        ]
    )
    return found.select(key, F.inline(F.array(*[f"{step}{i}" for i in range(len(features))])))


def _change(position: Column) -> Column:
    """What the score gains at a step of `walk`, counted from 1."""
    return F.get("walk", position) - F.get("walk", position - 1)


def global_importance(attributions: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """Features by mean absolute attribution, the greatest first."""
    means = attributions.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs_attribution"))
    return means.orderBy(F.desc("mean_abs_attribution"), "feature").limit(n)


def row_explanations(attributions: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """One row per key with one column per feature."""
    return attributions.groupBy(key).pivot("feature", list(features)).agg(F.first("value"))
