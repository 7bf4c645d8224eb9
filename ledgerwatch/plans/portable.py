"""Fitted models as plain SQL text, which any engine evaluates to the scores that the model itself gives."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame

from ledgerwatch.plans import trees

# How the sum becomes a probability: both are shares of one, or the sum is in log-odds.
LOG_ODDS, SHARE = "log-odds", "share"
_SCALED = re.compile(r"\(coalesce\(try_cast\(`([^`]+)` AS DOUBLE\), (\S+)D\) - \2D\) / (\S+)D AS `\1_scaled`")


def _name(column: str) -> str:
    if not re.fullmatch(r"[A-Za-z_]\w*", column):
        raise ValueError(f"{column!r} is no plain name")
    return column


def _text(value: str) -> str:
    if "\\" in value:
        raise ValueError(f"{value!r} has a backslash, which engines read in different ways")
    return "'" + value.replace("'", "''") + "'"


def number(value: float) -> str:
    """A literal that is a double, with all digits, in every engine."""
    return f"CAST('{value!r}' AS DOUBLE)"


def scaled(column: str, mean: float, deviation: float) -> str:
    """A numeric input: missing values are the mean."""
    return f"(coalesce(TRY_CAST({_name(column)} AS DOUBLE), {number(mean)}) - {number(mean)}) / {number(deviation)}"


def is_category(column: str, label: str, missing: str) -> str:
    """A category as 0 or 1; missing values are a category of their own."""
    return f"CASE WHEN coalesce(nullif(CAST({_name(column)} AS STRING), ''), {_text(missing)}) = {_text(label)} THEN {number(1.0)} ELSE {number(0.0)} END"


@dataclass(frozen=True)
class Portable:
    """A model over numbered places: their SQL, and a weighted sum of them or a forest."""

    places: tuple[str, ...]
    link: str
    weights: tuple[float, ...] = ()
    intercept: float = 0.0
    forest: trees.Forest | None = None

    def total(self) -> str:
        """The score as SQL over the places p0, p1, ...: a dot product, or a nested CASE per tree."""
        if self.forest is None:
            return " + ".join([number(self.intercept), *[f"{number(w)} * p{k}" for k, w in enumerate(self.weights) if w]])
        nodes = {(n.tree, n.node): n for n in self.forest.nodes}
        below = {(n.tree, c) for n in self.forest.nodes if n.left >= 0 for c in (n.left, n.right)}

        def case(node: trees.Node) -> str:
            if node.left < 0:
                return number(node.value)
            values = None if node.values is None else ", ".join(number(v) for v in node.values)
            test = f"p{node.place} <= {number(node.threshold)}" if values is None else f"p{node.place} IN ({values})"
            return f"CASE WHEN {test} THEN {case(nodes[node.tree, node.left])} ELSE {case(nodes[node.tree, node.right])} END"

        return " + ".join(case(n) for n in self.forest.nodes if (n.tree, n.node) not in below)

    def sql(self, table: str, keep: Sequence[str]) -> str:
        """`keep` with probability and prediction, for each row of `table`."""
        kept = ", ".join(_name(c) for c in keep)
        places = ", ".join(f"{expression} AS p{k}" for k, expression in enumerate(self.places))
        probability = f"1 / (1 + exp(-({self.total()})))" if self.link == LOG_ODDS else self.total()
        return (
            f"SELECT {kept}, probability, CASE WHEN probability > {number(0.5)} THEN {number(1.0)} ELSE {number(0.0)} END AS prediction "
            f"FROM (SELECT {kept}, {probability} AS probability FROM (SELECT {kept}, {places} FROM {table}) AS inputs) AS scored"
        )

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return df.sparkSession.sql(self.sql("{rows}", keep), rows=df)


def portable(model: PipelineModel) -> Portable:
    """What a fitted pipeline (see `learning.fit`) computes."""
    from ledgerwatch.plans import learning

    statement = next(s for s in model.stages if isinstance(s, SQLTransformer)).getStatement()
    numeric = {c: scaled(c, float(mean), float(deviation)) for c, mean, deviation in _SCALED.findall(statement)}
    indexer = next((s for s in model.stages if isinstance(s, StringIndexerModel)), None)
    labels = dict(zip(indexer.getInputCols(), indexer.labelsArray, strict=True)) if indexer else {}
    places = []
    for column in next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols():
        plain = column.removesuffix("_scaled")
        if plain != column:
            places.append(numeric[plain])
        else:
            plain = column.removesuffix("_onehot")
            places += [is_category(plain, label, learning.MISSING) for label in labels[f"{plain}_text"]]
    classifier = model.stages[-1]
    if isinstance(classifier, LogisticRegressionModel):
        return Portable(tuple(places), LOG_ODDS, tuple(float(w) for w in classifier.coefficients), float(classifier.intercept))
    if isinstance(classifier, (GBTClassificationModel, RandomForestClassificationModel)):
        link = LOG_ODDS if isinstance(classifier, GBTClassificationModel) else SHARE
        return Portable(tuple(places), link, forest=trees.fitted_forest(model, learning.feature_names(model)))
    raise TypeError(f"{type(classifier).__name__} has no SQL form")
