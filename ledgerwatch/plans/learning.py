"""Preparation, search, training and scoring with Spark ML. All rows train; nothing is pulled to the driver."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import split_by_type, to_number
from ledgerwatch.operators.metrics import classification_report, confusion, f1
from ledgerwatch.operators.sampling import hash_bucket
from ledgerwatch.plans import trees

# Most values of a column that is encoded one by one: their names lie on the driver and in the plan.
MOST_CATEGORIES = 1000
MISSING = "(missing)"
FEATURES = "features"

# Fixed values of the search: ranges of each family's settings.
SPACE: dict[str, dict[str, tuple[str, float, float]]] = {
    "logistic": {"C": ("log", 1e-2, 1.0), "tol": ("uniform", 1e-6, 1e-3)},
    "gbt": {
        "trees": ("logint", 10, 200),
        "depth": ("int", 3, 10),
        "rate": ("uniform", 1e-2, 0.9),
        "bins": ("int", 2, 256),
    },
    "forest": {"trees": ("logint", 10, 200), "depth": ("int", 3, 10), "bins": ("int", 2, 256)},
}
TRIALS = 8
SEED = 2025
HOLDOUT_PERCENT = 10
# Rows that one task of a fit holds; a stored table has as few parts as its files are small.
ROWS_A_TASK = 100_000


def _means(df: DataFrame, columns: Sequence[str]) -> Column:
    """Scalar subquery: a struct with the mean of every column, from one aggregate."""
    return df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])).scalar()


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by the column mean."""
    means = _means(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in columns})


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with mean 0 and population deviation 1; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_dev") for c in columns],
        )
    ).scalar()

    def scaled(c: str) -> Column:
        away = F.col(c).cast("double") - stats[f"{c}_mean"]
        return F.when(stats[f"{c}_dev"] == 0, F.when(away.isNotNull(), F.lit(0.0))).otherwise(
            away / stats[f"{c}_dev"]
        )

    return df.withColumns({c: scaled(c) for c in columns})


def numeric_stage(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> SQLTransformer:
    """A stage that converts, imputes and standardises the numeric columns and marks missing categories, empty texts among them.

    Means and deviations come from one aggregate; the stage is plain SQL with those numbers, so scoring
    needs no Python. The deviation is that of the imputed column, over all rows.
    """
    values = {c: to_number(F.col(c)) for c in numeric}
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(v).alias(f"n_{c}") for c, v in values.items()],
        *[F.avg(v).alias(f"mean_{c}") for c, v in values.items()],
        *[F.var_pop(v).alias(f"var_{c}") for c, v in values.items()],
    ).first()  # one row
    columns = []
    for c in numeric:
        mean = found[f"mean_{c}"] or 0.0
        variance = (found[f"var_{c}"] or 0.0) * found[f"n_{c}"] / max(found["rows"], 1)
        deviation = variance**0.5 or 1.0
        value = f"coalesce(try_cast(`{c}` AS DOUBLE), {mean!r}D)"
        columns.append(f"({value} - {mean!r}D) / {deviation!r}D AS `{c}_scaled`")
    columns += [f"coalesce(nullif(cast(`{c}` AS STRING), ''), '{MISSING}') AS `{c}_text`" for c in categorical]
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def check_categories(df: DataFrame, categorical: Sequence[str], most: int = MOST_CATEGORIES) -> None:
    """Refuses columns of many values before any of them reaches the driver: they are no categories."""
    if not categorical:
        return
    found = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in categorical]).first()  # one row
    many = [c for c in categorical if found[c] > 1.1 * most]
    if many:
        raise ValueError(f"more than {most} categories in {many}: leave these columns out, or hash them into fewer")


def preparation(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], most: int = MOST_CATEGORIES
) -> PipelineModel:
    """Fitted stages from raw columns to one feature vector. A category not seen in `df` encodes to all zeros."""
    check_categories(df, categorical, most)
    texts = [f"{c}_text" for c in categorical]
    stages: list[Any] = [numeric_stage(df, numeric, categorical)]
    if texts:
        stages += [
            StringIndexer(
                inputCols=texts,
                outputCols=[f"{c}_index" for c in categorical],
                handleInvalid="keep",
                stringOrderType="frequencyDesc",
            ),
            # The bucket of unseen values is the last one, and the one that is dropped.
            OneHotEncoder(
                inputCols=[f"{c}_index" for c in categorical],
                outputCols=[f"{c}_onehot" for c in categorical],
            ),
        ]
    inputs = [f"{c}_scaled" for c in numeric] + [f"{c}_onehot" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    return Pipeline(stages=stages).fit(df)


def onehot_totals(model: PipelineModel, df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Rows per column and category as encoded; what the fit did not see is counted as `(unseen)`."""
    labels = next(s for s in model.stages if hasattr(s, "labelsArray")).labelsArray
    encoded = model.transform(df)
    cells = []
    for c, names in zip(categorical, labels):
        bits = vector_to_array(F.col(f"{c}_onehot"))
        position = F.array_position(bits, F.lit(1.0))
        known = F.element_at(F.array(*[F.lit(n) for n in names]), F.greatest(position, F.lit(1)).cast("int"))
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"), F.when(position > 0, known).otherwise("(unseen)").alias("category")
            )
        )
    rows = encoded.select(F.inline(F.array(*cells)))
    return rows.groupBy("column_name", "category").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Trial:
    number: int
    family: str
    settings: Mapping[str, float] = field(default_factory=dict)

    def estimator(self, rows: int, label: str, seed: int = SEED):
        s = self.settings
        if self.family == "logistic":
            # The penalty counts once against the mean loss, C against its sum.
            return LogisticRegression(
                featuresCol=FEATURES, labelCol=label, regParam=1.0 / (s["C"] * max(rows, 1)), tol=s["tol"],
                standardization=False,
            )
        if self.family == "gbt":
            return GBTClassifier(
                featuresCol=FEATURES, labelCol=label, maxIter=int(s["trees"]), maxDepth=int(s["depth"]),
                stepSize=s["rate"], maxBins=int(s["bins"]), seed=seed,
            )
        if self.family == "forest":
            return RandomForestClassifier(
                featuresCol=FEATURES, labelCol=label, numTrees=int(s["trees"]), maxDepth=int(s["depth"]),
                maxBins=int(s["bins"]), seed=seed,
            )
        raise ValueError(f"unknown family {self.family!r}")


def draw_trials(n: int = TRIALS, seed: int = SEED, space: Mapping[str, Mapping] = SPACE) -> list[Trial]:
    """Seeded random draws: a family, then a value for each of its settings."""
    dice = random.Random(seed)

    def draw(kind: str, low: float, high: float) -> float:
        if kind.startswith("log"):
            value = low * (high / low) ** dice.random()
            return round(value) if kind == "logint" else value
        return dice.randint(int(low), int(high)) if kind == "int" else dice.uniform(low, high)

    trials = []
    for number in range(n):
        family = dice.choice(list(space))
        trials.append(Trial(number, family, {name: draw(*limits) for name, limits in space[family].items()}))
    return trials


TRIAL_SCHEMA = "run_id string, trial int, family string, settings map<string,double>, holdout_f1 double, state string, error string, started_at timestamp_ntz"  # noqa: E501


def validation_rows(key: Column, percent: int = HOLDOUT_PERCENT) -> Column:
    """Whether a row is held out inside the search; independent of the train/test split."""
    return hash_bucket(key, "holdout") < percent


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """The rows in parts of bounded size: every iteration of a fit reads its parts whole."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // ROWS_A_TASK)))


def different_inputs(rows: DataFrame) -> DataFrame:
    """One row: the places of the feature vector that no earlier place equals in every row, from one pass over the values that are not 0.

    Places that are 0 in every row are left out, unless there is no other. Equal means equal sums of 64-bit hashes of row and value.
    """
    values = rows.select(F.monotonically_increasing_id().alias("row"), vector_to_array(FEATURES).alias("values"))
    cells = values.select("row", F.posexplode("values").alias("place", "value")).where("value != 0")
    mark = F.sum(F.xxhash64("row", "value").cast("decimal(38,0)"))
    marks = cells.groupBy("place").agg(F.count(F.lit(1)).alias("n"), mark.alias("mark"))
    first = marks.groupBy("n", "mark").agg(F.min("place").alias("place"))
    places = F.sort_array(F.collect_list("place"))
    return first.agg(F.when(F.size(places) > 0, places).otherwise(F.array(F.lit(0))).alias("places"))


def search(
    train: DataFrame,
    trials: Sequence[Trial],
    categorical: Sequence[str],
    numeric: Sequence[str],
    started_at: Any,
    label: str = "is_fraud",
    key: str = "transaction_id",
    parallelism: int = 4,
) -> DataFrame:
    """One row per trial with its hold-out F1 of the positive class, best first.

    The preparation is fitted once on the rows that train; trials run as concurrent Spark jobs over the
    same prepared rows. A trial that fails is kept in the log with its state and the text of its error, and no score.
    Boosted trees look at every input at every split and take the first of equal ones, so their trials leave out inputs that
    repeat earlier ones in all rows that train: the trees are the same.
    """

    def value(df: DataFrame):
        return df.first()[0]  # an F1, or a number per input

    held_out = validation_rows(F.col(key))
    size = train.where(~held_out).count()
    prepared = preparation(train.where(~held_out), categorical, numeric).transform(_dealt(train, size))
    rows = prepared.select(F.col(label).cast("double").alias(label), FEATURES, held_out.alias("held_out")).persist()
    try:
        inputs = rows
        if any(t.family == "gbt" for t in trials):
            places = value(different_inputs(rows.where(~F.col("held_out"))))
            slicer = VectorSlicer(inputCol=FEATURES, outputCol="fewer", indices=places)
            inputs = slicer.transform(rows).drop(FEATURES).withColumnRenamed("fewer", FEATURES)

        def run(trial: Trial):
            try:
                mine = inputs if trial.family == "gbt" else rows
                model = trial.estimator(size, label).fit(mine.where(~F.col("held_out")))
                counts = confusion(model.transform(mine.where("held_out")), label=label)
                score = value(counts.select(f1(F.col("tp"), F.col("fp"), F.col("fn"))))
                return trial, score if score is not None else 0.0, "FINISHED", None
            except Exception as error:  # one failed trial must not end the search; its state says so
                return trial, None, "FAILED", f"{type(error).__name__}: {error}"

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            done = list(pool.map(run, trials))
    finally:
        rows.unpersist()
    spark = train.sparkSession
    log = [
        (f"trial-{t.number}", t.number, t.family, {k: float(v) for k, v in t.settings.items()}, score, state, error, started_at)
        for t, score, state, error in done
    ]
    return spark.createDataFrame(log, TRIAL_SCHEMA).orderBy(F.desc_nulls_last("holdout_f1"), "trial")


def fit(
    train: DataFrame, trial: Trial, categorical: Sequence[str], numeric: Sequence[str], label: str = "is_fraud"
) -> PipelineModel:
    """Preparation and classifier fitted on all training rows, as one model."""
    prepared, size = preparation(train, categorical, numeric), train.count()
    rows = prepared.transform(_dealt(train, size)).select(F.col(label).cast("double").alias(label), FEATURES).persist()
    try:
        classifier = trial.estimator(size, label).fit(rows)
    finally:
        rows.unpersist()
    return PipelineModel(stages=[*prepared.stages, classifier])


def model_columns(training: DataFrame, exclude: Sequence[str]) -> tuple[list[str], list[str]]:
    """Categorical and numeric inputs of a training frame without its keys, label and split."""
    return split_by_type(training.drop(*exclude))


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """`df` (or its columns `keep`) with the probability of fraud and the 0/1 prediction as double."""
    scored = model.transform(df)
    return scored.select(
        *(keep or df.columns), vector_to_array(F.col("probability"))[1].alias("probability"), F.col("prediction")
    )


def feature_names(model: PipelineModel) -> list[str]:
    """A name for every place of the feature vector: a numeric column, or column=category."""
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    indexer = next((s for s in model.stages if hasattr(s, "labelsArray")), None)
    labels = dict(zip(indexer.getInputCols(), indexer.labelsArray)) if indexer else {}
    names = []
    for column in inputs:
        plain = column.removesuffix("_scaled")
        if plain != column:
            names.append(plain)
        else:
            plain = column.removesuffix("_onehot")
            names += [f"{plain}={category}" for category in labels[f"{plain}_text"]]
    return names


def explain_trees(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """(key, feature, value) by input column: exact contributions to the score of a model of trees (see `trees`)."""
    forest = trees.fitted_forest(model, [name.split("=", 1)[0] for name in feature_names(model)])
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df)
    return trees.tree_attribution(prepared, key, vector_to_array(FEATURES), forest)


def trial_from(row: Any) -> Trial:
    """The trial that a row of the trial log describes."""
    return Trial(row.trial, row.family, dict(row.settings))


def evaluate(model: PipelineModel, df: DataFrame, by: Sequence[str] = ("split",), label: str = "is_fraud") -> DataFrame:
    """Classification report of a model, for example on train and test rows."""
    scored = score(model, df, [*by, label])
    return classification_report(scored, "probability", by, label)


def save_and_load(spark: SparkSession, model: PipelineModel, path: str) -> PipelineModel:
    """The model as read back from storage, free of its training session."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
