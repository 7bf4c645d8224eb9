"""Exact additive explanations of tree models, from flat tables of their nodes.

The value of a set of features is the score expected when the tests on these follow the row and every other test follows both sides
by their share of the training rows (Lundberg, Erion and Lee, 2018). A leaf of value w is reached by the product, over the features on its
path, of o (1 if the row passes all tests on the feature there) or of z (the shares of those tests). The Shapley
value of feature j at the leaf is w (o_j - z_j) times the integral over t in [0, 1] of the product, over the others, of t o + (1 - t) z
(Owen, 1972). That is a polynomial of lower degree than the path has features, so Gauss-Legendre points of half their number give it
exactly. Everything is array expressions over one array of leaves; no row leaves the JVM.

Leaves that together ask few tests have one contribution per feature for each outcome of these. A forest whose outcomes fit in tables of
`MOST_CELLS` numbers is explained by them: a row is tested and its outcomes are looked up, in expressions that Spark compiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.sources.tables import scratch

# Leaves of a model that may lie on the driver and in the plan.
MOST_LEAVES = 1 << 18
# Tests that leaves share a table for, if a path has no more; numbers in all tables of a plan, else the leaves are evaluated for each row.
TESTS, MOST_CELLS = 6, 1 << 16
_TEST = "struct<place:int,above:double,upto:double,in:array<double>,without:array<double>>"
_LEAF = f"leaf int, value double, factors array<struct<feature:int,share:double,tests:array<{_TEST}>>>"


@dataclass(frozen=True)
class Node:
    """A test of one place of the input (at most `threshold`, or one of `values`, goes left) or, without children, a leaf."""

    tree: int
    node: int
    value: float = 0.0
    cover: float = 0.0
    left: int = -1
    right: int = -1
    place: int = -1
    threshold: float | None = None
    values: tuple[float, ...] | None = None


@dataclass(frozen=True)
class Forest:
    """Nodes whose leaf values add up to the score, and the feature that each place of the input belongs to."""

    nodes: tuple[Node, ...]
    features: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return list(dict.fromkeys(self.features))

    def paths(self) -> Iterator[tuple[Node, list[tuple[Node, bool]]]]:
        """Every leaf with the tests above it and whether its side is the left one."""
        by_id = {(n.tree, n.node): n for n in self.nodes}
        below = {(n.tree, c) for n in self.nodes if n.left >= 0 for c in (n.left, n.right)}
        open_ = [(n, []) for n in self.nodes if (n.tree, n.node) not in below]
        while open_:
            node, above = open_.pop()
            if node.left < 0:
                yield node, above
            else:
                open_ += [(by_id[node.tree, c], [*above, (node, c == node.left)]) for c in (node.right, node.left)]

    def leaves(self) -> list[tuple]:
        """Rows of `_LEAF`: per leaf and feature the share of the training rows and what a row must pass."""
        cover = {(n.tree, n.node): n.cover for n in self.nodes}
        out = []
        for leaf, above in self.paths():
            factors: dict[int, list] = {}
            for node, left in above:
                factor = factors.setdefault(self.names.index(self.features[node.place]), [1.0, []])
                whole = cover[node.tree, node.node]
                factor[0] *= cover[node.tree, node.left if left else node.right] / whole if whole else 0.5
                at, listed = node.threshold, list(node.values) if node.values is not None else None
                numeric = listed is None
                factor[1].append((node.place, at if numeric and not left else None, at if numeric and left else None, listed if left else None, None if left else listed))
            out.append((len(out), float(leaf.value), [(f, share, tests) for f, (share, tests) in factors.items()]))
            if len(out) > MOST_LEAVES:
                raise ValueError(f"more than {MOST_LEAVES} leaves")
        return out

    def expected(self) -> float:
        """The score of no feature known: leaf values by their share of the training rows."""
        return math.fsum(value * math.prod(share for _, share, _ in factors) for _, value, factors in self.leaves())


def _passes(test: Column, x: Column) -> Column:
    own = F.get(x, test["place"])
    numeric = (test["above"].isNull() | (own > test["above"])) & (test["upto"].isNull() | (own <= test["upto"]))
    return numeric & (test["in"].isNull() | F.array_contains(test["in"], own)) & (test["without"].isNull() | ~F.array_contains(test["without"], own))


def _leaves(spark: SparkSession, forest: Forest) -> Column:
    """Scalar subquery: all leaves as one array."""
    rows = spark.createDataFrame(forest.leaves(), _LEAF)
    return rows.agg(F.sort_array(F.collect_list(F.struct("leaf", "value", "factors")))).scalar()


def _reached(leaf: Column, x: Column) -> Column:
    return F.forall(leaf["factors"], lambda f: F.forall(f["tests"], lambda t: _passes(t, x)))


def covered(forest: Forest, rows: DataFrame, inputs: Column) -> Forest:
    """The forest with the number of rows that reach each node as its cover."""
    found = rows.select(inputs.alias("x")).withColumn("leaves", _leaves(rows.sparkSession, forest))
    reached = F.transform(F.filter("leaves", lambda leaf: _reached(leaf, F.col("x"))), lambda leaf: leaf["leaf"])
    counts = {r["leaf"]: r["n"] for r in found.select(F.explode(reached).alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per leaf
    cover: dict[tuple[int, int], int] = {}
    for k, (leaf, above) in enumerate(forest.paths()):
        for node in [leaf, *(n for n, _ in above)]:
            cover[node.tree, node.node] = cover.get((node.tree, node.node), 0) + counts.get(k, 0)
    return Forest(tuple(Node(**{**n.__dict__, "cover": float(cover[n.tree, n.node])}) for n in forest.nodes), forest.features)


def raw_score(rows: DataFrame, inputs: Column, forest: Forest, name: str = "score") -> DataFrame:
    """`rows` with the sum of the values of the leaves they reach."""
    own = rows.withColumns({"__x": inputs, "__leaves": _leaves(rows.sparkSession, forest)})
    reached = F.filter("__leaves", lambda leaf: _reached(leaf, F.col("__x")))
    return own.withColumn(name, F.aggregate(reached, F.lit(0.0), lambda total, leaf: total + leaf["value"])).drop("__x", "__leaves")


def _outcome(place: int, above: float | None, upto: float | None, listed: list[float] | None, without: list[float] | None) -> tuple[tuple, bool]:
    """A test of a leaf as what goes left at its node, and whether the leaf is on that side."""
    if listed is None and without is None:
        return (place, above if upto is None else upto, None), upto is not None
    return (place, None, tuple(without if listed is None else listed)), listed is not None


def _tables(forest: Forest) -> list[tuple[list[tuple], dict[int, np.ndarray]]] | None:
    """Groups of leaves: the tests they ask, and per feature the contribution for every outcome of these, the first test the lowest bit.
    None if they have more than `MOST_CELLS` numbers."""
    leaves = [(value, [(f, share, [_outcome(*t) for t in tests]) for f, share, tests in factors]) for _, value, factors in forest.leaves()]
    groups: list[tuple[dict[tuple, int], list]] = []
    for leaf in leaves:
        asked = dict.fromkeys(test for _, _, tests in leaf[1] for test, _ in tests)
        if groups and len({**groups[-1][0], **asked}) <= TESTS:
            groups[-1][0].update(asked)
            groups[-1][1].append(leaf)
        else:
            groups.append((asked, [leaf]))
    features = [{f for _, factors in some for f, _, _ in factors} for _, some in groups]
    if sum(len(f) << len(tests) for f, (tests, _) in zip(features, groups, strict=True)) > MOST_CELLS:
        return None
    out = []
    for tests, some in groups:
        number = {test: k for k, test in enumerate(tests)}
        outcomes = np.arange(1 << len(number))
        totals: dict[int, np.ndarray] = {}
        for value, factors in some:
            z = np.array([share for _, share, _ in factors])
            o = np.array([np.all([(outcomes >> number[t] & 1) == left for t, left in asked], axis=0) for _, _, asked in factors], float)
            at, weight = np.polynomial.legendre.leggauss(max(1, -(-len(factors) // 2)))
            for k, (feature, share, _) in enumerate(factors):
                others = [j for j in range(len(factors)) if j != k]
                whole = sum(w / 2 * np.prod((1 + t) / 2 * o[others] + (1 - t) / 2 * z[others, None], axis=0) for t, w in zip(at, weight, strict=True))
                totals[feature] = totals.get(feature, 0.0) + value * (o[k] - share) * whole
        out.append((list(tests), totals))
    return out


def _sum_of(terms: Sequence[str]) -> str:
    """Nested in halves, so that no expression is deep."""
    half = len(terms) // 2
    return terms[0] if len(terms) == 1 else f"({_sum_of(terms[:half])} + {_sum_of(terms[half:])})"


def _looked_up(rows: DataFrame, key: str, inputs: Column, forest: Forest, tables: list[tuple[list[tuple], dict[int, np.ndarray]]]) -> DataFrame:
    def bit(k: int, place: int, threshold: float | None, values: tuple[float, ...] | None) -> str:
        own = f"get(__x, {place})"
        return f"{1 << k} * CAST({own} <= {threshold!r}D AS INT)" if values is None else f"{1 << k} * CAST({own} IN ({', '.join(f'{v!r}D' for v in values)}) AS INT)"

    def listed(numbers: np.ndarray) -> str:
        return f"array({', '.join(f'{v!r}D' for v in numbers.tolist())})"

    asked = [(k, tests, totals) for k, (tests, totals) in enumerate(tables) if tests]
    codes = [F.expr(_sum_of([bit(k, *test) for k, test in enumerate(tests)])).alias(f"__code{g}") for g, tests, _ in asked]
    tested = rows.select(key, inputs.alias("__x")).select(key, *codes)
    cells = []
    for number, name in enumerate(forest.names):
        terms = [f"get({listed(totals[number])}, __code{g})" for g, _, totals in asked if number in totals]
        cells.append(F.struct(F.lit(name).alias("feature"), F.expr(_sum_of(["0.0D", *terms])).alias("value")))
    return tested.select(key, F.inline(F.array(*cells)))


def tree_attribution(rows: DataFrame, key: str, inputs: Column, forest: Forest) -> DataFrame:
    """(key, feature, value): exact contributions; those of a row add up to its score minus the expected score.

    `inputs` is an array of doubles, one per place. Places of one feature (its categories) count as one.
    """
    tables = _tables(forest)
    if tables is not None:
        return _looked_up(rows, key, inputs, forest, tables)
    longest = max((len(factors) for _, _, factors in forest.leaves()), default=0)
    at, weight = np.polynomial.legendre.leggauss(max(1, -(-longest // 2)))
    points = F.array(*[F.struct(F.lit((1 + a) / 2).alias("t"), F.lit(w / 2).alias("w")) for a, w in zip(at.tolist(), weight.tolist(), strict=True)])
    own = rows.select(key, inputs.alias("x")).withColumn("leaves", _leaves(rows.sparkSession, forest))

    def mixed(t: Column, f: Column) -> Column:
        return t * f["o"] + (1 - t) * f["z"]

    def passed(f: Column) -> Column:
        o = F.forall(f["tests"], lambda t: _passes(t, F.col("x"))).cast("double")
        return F.struct(f["feature"].alias("feature"), f["share"].alias("z"), o.alias("o"))

    # Each step takes the array before it as an argument, so that it is evaluated once.
    cells = F.transform("leaves", lambda leaf: F.struct(leaf["value"].alias("value"), F.transform(leaf["factors"], passed).alias("factors")))

    def at_points(c: Column) -> Column:
        return F.transform(points, lambda q: F.struct(q["t"].alias("t"), F.aggregate(c["factors"], q["w"], lambda p, f: p * mixed(q["t"], f)).alias("p")))

    cells = F.transform(cells, lambda c: F.struct(c["value"].alias("value"), c["factors"].alias("factors"), at_points(c).alias("points")))

    def share(c: Column, f: Column) -> Column:
        # A factor that is zero at all points makes the difference o - z zero as well.
        others = F.aggregate(c["points"], F.lit(0.0), lambda total, q: total + F.coalesce(F.try_divide(q["p"], mixed(q["t"], f)), F.lit(0.0)))
        return F.struct(f["feature"].alias("feature"), (c["value"] * (f["o"] - f["z"]) * others).alias("value"))

    flat = F.flatten(F.transform(cells, lambda c: F.transform(c["factors"], lambda f: share(c, f))))
    numbers = F.array(*[F.lit(k) for k in range(len(forest.names))])
    totals = F.transform(
        F.array(flat),
        lambda all_: F.transform(numbers, lambda k: F.aggregate(all_, F.lit(0.0), lambda total, c: total + F.when(c["feature"] == k, c["value"]).otherwise(0.0))),
    )
    names = F.array(*[F.lit(n) for n in forest.names])
    return own.select(key, F.inline(F.arrays_zip(names.alias("feature"), F.get(totals, F.lit(0)).alias("value"))))


def fitted_forest(model: PipelineModel, names: Sequence[str]) -> Forest:
    """The trees of a fitted pipeline, read from its stored form; boosted trees in log-odds, a random forest in probability.

    `names` has the feature of each place of the vector.
    """
    trees = model.stages[-1]
    if not isinstance(trees, (GBTClassificationModel, RandomForestClassificationModel)):
        raise TypeError(f"{type(trees).__name__} has no trees")
    boosted = isinstance(trees, GBTClassificationModel)
    spark = SparkSession.active()
    path = scratch(spark, "trees")
    trees.write().save(path)
    weights = [2.0 * w for w in trees.treeWeights] if boosted else [w / sum(trees.treeWeights) for w in trees.treeWeights]
    nodes = []
    for row in spark.read.parquet(f"{path}/data").collect():  # the model itself
        n = row["nodeData"]
        own, split = n["prediction"] if boosted else n["impurityStats"][1] / sum(n["impurityStats"]), n["split"]
        listed = split["leftCategoriesOrThreshold"]
        numeric = split["numCategories"] == -1
        nodes.append(
            Node(
                row["treeID"], n["id"], weights[row["treeID"]] * own, float(n["rawCount"]), n["leftChild"], n["rightChild"], split["featureIndex"],
                listed[0] if numeric and listed else None, None if numeric else tuple(listed),
            )
        )
    return Forest(tuple(nodes), tuple(names))
