"""Preparation, training, search and explanations on data with a planted signal."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators.sampling import split_name
from ledgerwatch.plans import attribution, learning

CATEGORICAL, NUMERIC = ["type"], ["amount", "ratio"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Fraud is likely for large amounts of type B."""
    n = F.col("id")
    df = spark.range(4000).select(
        n.cast("string").alias("transaction_id"),
        (F.pmod(n * 7919, F.lit(1000)) / 10).alias("amount"),
        F.when(n % 50 != 0, F.pmod(n * 104729, F.lit(100)) / 100).alias("ratio"),
        F.when(n % 3 == 0, "A").when(n % 3 == 1, "B").otherwise(F.lit(None)).alias("type"),
    )
    risk = F.col("amount") / 100 + F.when(F.col("type") == "B", 0.5).otherwise(0.0)
    noise = F.pmod(F.xxhash64("transaction_id"), F.lit(1000)) / 1000
    path = str(tmp_path_factory.mktemp("planted") / "rows")
    df.withColumns(
        {"is_fraud": (risk + noise > 1.6).cast("int"), "split": split_name(F.col("transaction_id"))}
    ).write.parquet(path)
    return spark.read.parquet(path)


LOGISTIC = learning.Trial(0, "logistic", {"C": 1.0, "tol": 1e-6})
BOOSTED = learning.Trial(1, "gbt", {"trees": 10, "depth": 3, "rate": 0.3, "bins": 32})
FOREST = learning.Trial(2, "forest", {"trees": 10, "depth": 4, "bins": 32})


class Probe:
    """An estimator that notes how many rows it has, and how many of them its largest part."""

    def estimator(self, rows, label):
        self.rows = rows
        return self

    def fit(self, rows):
        parts = rows.groupBy(F.spark_partition_id()).count()
        self.seen, self.largest = parts.agg(F.sum("count"), F.max("count")).first()


def test_no_task_of_a_fit_holds_more_rows_with_a_larger_table(planted, monkeypatch):
    monkeypatch.setattr(learning, "ROWS_A_TASK", 100)
    probe = Probe()
    learning.fit(planted.coalesce(1), probe, CATEGORICAL, NUMERIC)
    assert probe.rows == probe.seen == 4000 and probe.largest <= 120


@pytest.mark.parametrize("trial", [LOGISTIC, BOOSTED, FOREST], ids=lambda t: t.family)
def test_every_family_finds_the_signal(spark, planted, folder, trial):
    model = learning.fit(planted.where("split = 'train'"), trial, CATEGORICAL, NUMERIC)
    model = learning.save_and_load(spark, model, folder)
    report = {r.split: r for r in learning.evaluate(model, planted).collect()}
    assert set(report) == {"train", "test"} and report["test"].roc_auc > 0.8
    scored = learning.score(model, planted, ["transaction_id"])
    assert scored.columns == ["transaction_id", "probability", "prediction"] and scored.count() == 4000
    assert scored.where("probability NOT BETWEEN 0 AND 1 OR prediction NOT IN (0, 1)").count() == 0


def test_prepared_columns(spark, planted):
    model = learning.preparation(planted, CATEGORICAL, NUMERIC)
    prepared = model.transform(planted)
    stats = prepared.agg(
        *[f(F.col(f"{c}_scaled")).alias(f"{c}_{f.__name__}") for c in NUMERIC for f in (F.avg, F.stddev_pop)]
    ).first()
    for c in NUMERIC:  # nulls were imputed before scaling
        assert stats[f"{c}_avg"] == pytest.approx(0, abs=1e-9) and stats[f"{c}_stddev_pop"] == pytest.approx(1)
    unseen = planted.limit(1).withColumn("type", F.lit("C"))
    vector = model.transform(unseen).first()["type_onehot"]
    assert vector.size == 3 and vector.numNonzeros() == 0
    totals = {r.category: r.n for r in learning.onehot_totals(model, planted.unionByName(unseen), CATEGORICAL).collect()}
    assert totals == {"A": 1334, "B": 1333, learning.MISSING: 1333, "(unseen)": 1}


def test_impute_and_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, None)], "a double, b double")
    assert sorted(r.a for r in learning.impute_mean(df, ["a"]).collect()) == [1.0, 2.0, 3.0]
    scaled = learning.standardize(df, ["a", "b"]).collect()
    assert [r.a for r in scaled] == [-1.0, None, 1.0] and [r.b for r in scaled] == [0.0, 0.0, None]


def test_trials_are_reproducible_and_in_range():
    trials = learning.draw_trials(50, seed=3)
    assert trials == learning.draw_trials(50, seed=3) != learning.draw_trials(50, seed=4)
    assert {t.family for t in trials} == set(learning.SPACE)
    for t in trials:
        for name, value in t.settings.items():
            _, low, high = learning.SPACE[t.family][name]
            assert low <= value <= high


def test_search_logs_every_trial(spark, planted):
    broken = learning.Trial(3, "gbt", {"trees": 0, "depth": 3, "rate": 0.3, "bins": 32})
    log = learning.search(
        planted.where("split = 'train'"), [LOGISTIC, BOOSTED, broken], CATEGORICAL, NUMERIC, dt.datetime(2024, 1, 1)
    ).collect()
    assert [r.state for r in log] == ["FINISHED", "FINISHED", "FAILED"] and log[2].run_id == "trial-3"
    assert log[0].holdout_f1 >= log[1].holdout_f1 > 0.5 and log[2].holdout_f1 is None
    assert log[0].error is None and "Exception" in log[2].error


def test_boosted_trials_leave_out_repeated_inputs(spark, planted, monkeypatch):
    """Every input twice under another name, and one that is nearly the same: the trees are those of all inputs."""
    near = F.when(F.col("transaction_id") != "17", F.col("ratio")).otherwise(0.5)
    twice = planted.withColumns({"kind": F.concat(F.lit("k"), F.coalesce("type", F.lit("?"))), "money": F.col("amount"), "near": near, "one": F.lit(1.0)})
    train, numeric, categorical = twice.where("split = 'train'"), [*NUMERIC, "money", "near", "one"], ["type", "kind"]
    seen = []

    def kept(self, rows, label, seed=learning.SEED, before=learning.Trial.estimator):
        made = before(self, rows, label, seed)
        fit = made.fit
        made.fit = lambda df: seen.append((fit(df), df)) or seen[-1][0]
        return made

    monkeypatch.setattr(learning.Trial, "estimator", kept)
    log = learning.search(train, [BOOSTED], categorical, numeric, dt.datetime(2024, 1, 1)).collect()
    model, rows = seen[0]
    monkeypatch.undo()
    fitted = train.where(~learning.validation_rows(F.col("transaction_id")))
    prepared = learning.preparation(fitted, categorical, numeric).transform(fitted)
    assert prepared.first()[learning.FEATURES].size == 11 and model.numFeatures == 6
    whole = BOOSTED.estimator(0, "is_fraud").fit(prepared.withColumn("is_fraud", F.col("is_fraud").cast("double")))
    places = learning.different_inputs(prepared).first()[0]
    assert len(places) == 6 and {0, 1, 3} <= set(places) and 2 not in places and 4 not in places
    assert [t.numNodes for t in model.trees] == [t.numNodes for t in whole.trees]
    assert log[0].state == "FINISHED" and log[0].holdout_f1 > 0.5


def test_inputs_that_are_nothing_in_every_row(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.sparse(3, {}),), (Vectors.sparse(3, {}),)], [learning.FEATURES])
    assert learning.different_inputs(rows).first()[0] == [0]


def test_columns_of_many_values_are_refused(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("name"), F.lit("a").alias("kind"))
    learning.check_categories(df, ["kind"])
    with pytest.raises(ValueError, match="name"):
        learning.preparation(df, ["name", "kind"], [])


def test_single_class_training_set(spark, planted):
    """Nothing to learn, but scoring still works."""
    model = learning.fit(planted.where("is_fraud = 0"), LOGISTIC, CATEGORICAL, NUMERIC)
    assert learning.score(model, planted).agg(F.max("prediction")).first()[0] == 0.0


def test_linear_attributions_add_up(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("b", 3.0, 30.0), ("c", 5.0, 20.0)], "id string, x double, y double")
    weights = {"x": 2.0, "y": -0.5}
    found = attribution.linear_attribution(df, "id", weights)
    total = {r.id: r.t for r in found.groupBy("id").agg(F.sum("value").alias("t")).collect()}
    base = 2 * 3 - 0.5 * 20
    for i, x, y in [("a", 1, 10), ("b", 3, 30), ("c", 5, 20)]:
        assert total[i] == pytest.approx(2 * x - 0.5 * y - base)
    wide = {r.id: (r.x, r.y) for r in attribution.row_explanations(found, "id", ["x", "y"]).collect()}
    assert wide["a"] == (-4.0, 5.0)
    ranking = [(r.feature, round(r.mean_abs_attribution, 6)) for r in attribution.global_importance(found).collect()]
    assert ranking == [("y", round(10 / 3, 6)), ("x", round(8 / 3, 6))]


def test_sampled_attributions(spark):
    """For an additive score every draw gives weight x difference; with one background row that is exact."""
    df = spark.createDataFrame([(str(i), float(i), float(i * i % 7)) for i in range(20)], "id string, x double, y double")

    def score(rows):
        return rows.withColumn("probability", F.col("x") * 2 - F.col("y"))

    base = df.where("id = '4'")
    found = attribution.sampled_attribution(df, base, "id", ["x", "y"], score, permutations=3)
    rows = {(r.id, r.feature): (r.value, r.stderr) for r in found.collect()}
    assert len(rows) == 40
    for i in range(20):
        assert rows[str(i), "x"] == (pytest.approx(2 * (i - 4)), pytest.approx(0, abs=1e-9))
        assert rows[str(i), "y"][0] == pytest.approx(-(i * i % 7) + 16 % 7)


def test_sampled_attributions_add_up_for_an_interaction(spark):
    df = spark.createDataFrame([(str(i), float(i % 5), float(i % 3)) for i in range(30)], "id string, x double, y double")

    def score(rows):
        return rows.withColumn("probability", F.col("x") * F.col("y"))

    found = attribution.sampled_attribution(df, df, "id", ["x", "y"], score, permutations=400, background_rows=30)
    totals = {r.id: (r.t, r.e) for r in found.groupBy("id").agg(F.sum("value").alias("t"), F.sum("stderr").alias("e")).collect()}
    mean = sum((i % 5) * (i % 3) for i in range(30)) / 30
    for i in range(30):
        value, error = totals[str(i)]
        assert math.isclose(value, (i % 5) * (i % 3) - mean, abs_tol=4 * error + 0.05)


def test_sampled_attributions_score_each_state_once_and_keep_rows_in_their_task(spark, no_broadcast):
    """A row and a background row are scored once, not in every draw, and only the rows themselves are shuffled, by key."""
    df = spark.range(20).select(F.col("id").cast("string").alias("id"), *[(F.col("id") * k % 7).cast("double").alias(f) for k, f in enumerate("xyz", 1)])
    scored = []

    def score(rows):
        scored.append(rows)
        return rows.withColumn("probability", F.col("x") * F.col("y") - F.col("z"))

    found = attribution.sampled_attribution(df, df, "id", ["x", "y", "z"], score, permutations=5, background_rows=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sum(rows.count() for rows in scored) == 4 + 20 + 20 * 5 * 2
    assert plan.count("Exchange hashpartitioning") == 1
    totals = {r.id: r.n for r in found.groupBy("id").agg(F.count("value").alias("n")).collect()}
    assert len(totals) == 20 and set(totals.values()) == {3}
    one = attribution.sampled_attribution(df, df.where("id = '3'"), "id", ["x"], lambda rows: rows.withColumn("probability", F.col("x") * 2), permutations=2)
    assert {r.id: r.value for r in one.collect()} == {str(i): 2.0 * (i % 7 - 3) for i in range(20)}


def test_the_registered_search_draws_from_the_whole_space(spark, small, monkeypatch):
    from ledgerwatch.queries import models
    from ledgerwatch.sources.binding import Bank

    seen = []
    monkeypatch.setattr(models.learning, "search", lambda rows, trials, *more: seen.extend(trials))
    models.hpo_trials(Bank(spark, small))
    assert seen == learning.draw_trials(space=learning.SPACE)


def test_sampled_explanations_take_all_test_rows(spark, small):
    from ledgerwatch.operators.sampling import split_name
    from ledgerwatch.plans import features
    from ledgerwatch.queries import models
    from ledgerwatch.sources.binding import Bank

    bank = Bank(spark, small)
    ids = features.with_features(bank.gold).where(split_name(F.col("transaction_id")) == "test").select("transaction_id").distinct()
    assert models.sampled_attribution(bank, draws=2).select("transaction_id").distinct().count() == ids.count()
    assert models.sampled_attribution(bank, rows=7, draws=2).select("transaction_id").distinct().count() == 7
