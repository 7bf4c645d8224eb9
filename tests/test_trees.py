"""Exact explanations of trees against the definition: the mean gain over all orders of the features."""

import itertools
import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerwatch.plans import learning, lifecycle, trees
from ledgerwatch.plans.trees import Forest, Node


def grown(rng, tree, places, depth):
    """A random tree with covers that add up."""
    nodes = []

    def grow(cover, left_depth):
        number = len(nodes)
        nodes.append(None)
        if left_depth == 0 or cover < 2 or rng.random() < 0.15:
            nodes[number] = Node(tree, number, round(rng.uniform(-1, 1), 3), cover)
            return number
        place, share = rng.randrange(places), rng.randrange(1, int(cover))
        left, right = grow(float(share), left_depth - 1), grow(cover - share, left_depth - 1)
        test = {"values": tuple(float(v) for v in rng.sample(range(5), 2))} if place == 0 else {"threshold": rng.randrange(10) / 2}
        nodes[number] = Node(tree, number, 0.0, cover, left, right, place, **test)
        return number

    grow(1000.0, depth)
    return nodes


def worth(forest, x, known):
    """The expected score when only the features in `known` follow the row."""
    nodes = {(n.tree, n.node): n for n in forest.nodes}

    def down(n):
        if n.left < 0:
            return n.value
        left, right = nodes[n.tree, n.left], nodes[n.tree, n.right]
        if forest.features[n.place] not in known:
            return (left.cover * down(left) + right.cover * down(right)) / n.cover
        own = x[n.place]
        return down(left if (own in n.values if n.values is not None else own <= n.threshold) else right)

    return sum(down(n) for n in forest.nodes if n.node == 0)


def shapley(forest, x):
    names = forest.names
    out = dict.fromkeys(names, 0.0)
    for order in itertools.permutations(names):
        for k, name in enumerate(order):
            out[name] += worth(forest, x, order[: k + 1]) - worth(forest, x, order[:k])
    return {name: total / math.factorial(len(names)) for name, total in out.items()}


# Places 1 and 2 are two categories of one feature.
FEATURES = ("kind", "b", "b", "c", "d", "e")


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_orders(spark, seed):
    rng = random.Random(seed)
    forest = Forest(tuple(n for t in range(3) for n in grown(rng, t, len(FEATURES), 6)), FEATURES)
    rows = [(str(k), [float(rng.randrange(6)), *[rng.randrange(12) / 2 for _ in FEATURES[1:]]]) for k in range(12)] + [("none", [math.nan] * 6)]
    df = spark.createDataFrame(rows, "id string, x array<double>")
    found = {(r["id"], r["feature"]): r["value"] for r in trees.tree_attribution(df, "id", F.col("x"), forest).collect()}
    scores = {r["id"]: r["score"] for r in trees.raw_score(df, F.col("x"), forest).collect()}
    assert len(found) == len(rows) * 5
    for key, x in rows:
        for name, value in shapley(forest, x).items():
            assert found[key, name] == pytest.approx(value, abs=1e-9)
        assert scores[key] == pytest.approx(worth(forest, x, FEATURES))
        assert sum(found[key, n] for n in forest.names) == pytest.approx(scores[key] - forest.expected(), abs=1e-9)
    assert forest.expected() == pytest.approx(worth(forest, rows[0][1], ()))


@pytest.mark.parametrize(("seed", "depth"), [(0, 4), (1, 6), (2, 8)])
def test_tables_and_leaves_explain_alike(spark, monkeypatch, seed, depth):
    """With room for tables no leaf is evaluated for a row; without it all are. Thresholds are met exactly, and some inputs are NaN."""
    rng = random.Random(seed)
    forest = Forest(tuple(n for t in range(5) for n in grown(rng, t, len(FEATURES), depth)), FEATURES)
    rows = [(k, [float(rng.randrange(6)), *[rng.choice([rng.randrange(12) / 2, math.nan]) for _ in FEATURES[1:]]]) for k in range(40)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    found = []
    for most in (1 << 30, 0):
        monkeypatch.setattr(trees, "MOST_CELLS", most)
        explained = trees.tree_attribution(df, "id", F.col("x"), forest)
        assert ("lambda" in explained._jdf.queryExecution().executedPlan().toString()) == (most == 0)
        found.append({(r["id"], r["feature"]): r["value"] for r in explained.collect()})
    assert len(found[0]) == 40 * 5 and found[0] == pytest.approx(found[1], abs=1e-9)


def test_single_leaves_and_branches_without_rows(spark):
    """A branch that no training row took weighs nothing, and a row in it is explained all the same."""
    forest = Forest((Node(0, 0, 0.5, 9.0), Node(1, 0, 0.0, 9.0, 1, 2, 0, 1.0), Node(1, 1, 1.0, 9.0), Node(1, 2, 3.0, 0.0)), ("a",))
    df = spark.createDataFrame([("in", [0.0]), ("out", [2.0])], "id string, x array<double>")
    assert {r["id"]: r["value"] for r in trees.tree_attribution(df, "id", F.col("x"), forest).collect()} == {"in": 0.0, "out": 2.0}
    assert forest.expected() == 1.5
    lone = Forest((Node(0, 0, 0.5, 9.0),), ("a",))
    assert [r["value"] for r in trees.tree_attribution(df, "id", F.col("x"), lone).collect()] == [0.0, 0.0]


def test_covers_are_counted(spark):
    forest = Forest((Node(0, 0, left=1, right=2, place=0, threshold=1.0), Node(0, 1, 1.0), Node(0, 2, left=3, right=4, place=0, threshold=2.0), Node(0, 3, 2.0), Node(0, 4, 3.0)), ("a",))
    rows = spark.createDataFrame([(float(k % 3 + 0.5),) for k in range(10)], "v double")
    covered = trees.covered(forest, rows, F.array("v"))
    assert [n.cover for n in covered.nodes] == [10.0, 4.0, 6.0, 3.0, 3.0]


@pytest.mark.parametrize("family", ["gbt", "forest"])
def test_fitted_models(spark, family):
    """The stored trees score as the model does, and the contributions add up to that score."""
    n = F.col("id")
    df = spark.range(800).select(n.cast("string").alias("transaction_id"), F.pmod(n * 7919, F.lit(1000)).cast("double").alias("amount"), F.when(n % 3 == 0, "A").when(n % 3 == 1, "B").alias("type"))
    df = df.withColumn("is_fraud", ((F.col("amount") > 600) & (F.coalesce("type", F.lit("C")) == "B") | (F.col("amount") > 900)).cast("int"))
    trial = learning.Trial(0, family, {"trees": 5, "depth": 4, "rate": 0.3, "bins": 32})
    model = learning.fit(df, trial, ["type"], ["amount"])
    forest = trees.fitted_forest(model, [x.split("=")[0] for x in learning.feature_names(model)])
    p = vector_to_array("probability")[1]
    scored = trees.raw_score(model.transform(df), vector_to_array("features"), forest).withColumn("own", F.log(p / (1 - p)) if family == "gbt" else p)
    assert scored.agg(F.max(F.abs(F.col("score") - F.col("own")))).first()[0] < 1e-9
    found = lifecycle.explain(model, df, df, [])
    assert {r[0] for r in found.select("feature").distinct().collect()} == {"amount", "type"}
    total = found.groupBy("transaction_id").agg(F.sum("value").alias("total")).join(scored, "transaction_id")
    assert total.count() == 800
    assert total.agg(F.max(F.abs(F.col("total") - F.col("own") + forest.expected()))).first()[0] < 1e-9


def test_no_python_and_no_collect_of_rows(spark):
    forest = Forest((Node(0, 0, 0.0, 9.0, 1, 2, 0, 1.0), Node(0, 1, 1.0, 4.0), Node(0, 2, 3.0, 5.0)), ("a",))
    plan = trees.tree_attribution(spark.range(5), "id", F.array(F.col("id").cast("double")), forest)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "CartesianProduct", "NestedLoop"))
