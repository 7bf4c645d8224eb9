"""Classification metrics against brute force and at their edges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import metrics
from ledgerwatch.operators.skew import running_totals

SCHEMA = "g string, score double, label int, prediction int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_confusion_with_one_class(spark):
    only_negatives = frame(spark, [("a", 0.1, 0, 0), ("a", 0.2, 0, 1)])
    assert tuple(metrics.confusion(only_negatives).first()) == (1, 1, 0, 0)


def test_confusion_ignores_unknown_rows_and_handles_empty(spark):
    assert tuple(metrics.confusion(frame(spark, [("a", 0.1, None, 1), ("a", 0.1, 1, None)])).first()) == (0, 0, 0, 0)
    assert tuple(metrics.confusion(frame(spark, [])).first()) == (0, 0, 0, 0)


def test_model_value_presets(spark):
    counts = spark.createDataFrame([(10, 2, 3, 4)], "tn long, fp long, fn long, tp long")
    assert metrics.model_value(counts).first().value == -1_000 - 600_000 + 798_000
    assert metrics.model_value(counts, metrics.AS_WRITTEN).first().value == -1_000 + 600_000 + 798_000


def test_expected_loss_counts_unlabelled_rows_as_zero(spark):
    df = frame(spark, [("a", 0.1, 1, 0), ("a", 0.1, None, 0), ("a", 0.1, 0, 1), ("a", 0.1, 1, 1)])
    assert df.agg(metrics.expected_loss()).first()[0] == -50_000.0


@pytest.mark.parametrize(
    "counts, expected",
    [((5, 0, 0, 0), 1.0), ((0, 0, 0, 5), 1.0), ((0, 0, 0, 0), None), ((4, 1, 2, 3), (6 / 9 + 8 / 11) / 2)],
)
def test_macro_f1_is_the_mean_over_present_classes(spark, counts, expected):
    df = spark.createDataFrame([counts], "tn long, fp long, fn long, tp long")
    found = metrics.rates(df).first().f1_macro
    assert found == (None if expected is None else pytest.approx(expected))


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_pr(rows):
    pos, area, recall, precision = sum(y for _, y in rows), 0.0, 0.0, 1.0
    for cut in sorted({s for s, _ in rows}, reverse=True):
        chosen = [y for s, y in rows if s >= cut]
        r, p = sum(chosen) / pos, sum(chosen) / len(chosen)
        area += (r - recall) * (p + precision) / 2
        recall, precision = r, p
    return area


@pytest.mark.parametrize("digits", [1, 6])
def test_curve_areas(spark, digits):
    dice = random.Random(digits)
    rows = []
    for g in "ab":
        for _ in range(200):
            y = int(dice.random() < 0.3)
            s = round(min(max(dice.gauss(0.4 + 0.2 * y, 0.2), 0.0), 1.0), digits)
            rows.append((g, s, y, int(s > 0.5)))
    found = {r.g: r for r in metrics.classification_report(frame(spark, rows), "score", ["g"]).collect()}
    for g in "ab":
        mine = [(s, y) for h, s, y, _ in rows if h == g]
        assert found[g].roc_auc == pytest.approx(brute_auc(mine))
        assert found[g].pr_auc == pytest.approx(brute_pr(mine))
        loss = [-math.log(min(max(s if y else 1 - s, 1e-15), 1 - 1e-15)) for s, y in mine]
        assert found[g].log_loss == pytest.approx(sum(loss) / len(loss), rel=1e-6)
        assert found[g].accuracy == pytest.approx(sum((s > 0.5) == (y == 1) for s, y in mine) / len(mine))


def test_report_of_one_class_has_no_areas(spark):
    found = metrics.classification_report(frame(spark, [("a", 0.1, 0, 0), ("a", 0.9, 0, 1)]), "score").first()
    assert found.roc_auc is None and found.pr_auc is None and found.accuracy == 0.5


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    dice = random.Random(5)
    rows = [(g, x, dice.randint(0, 5)) for g in "ab" for x in dice.sample(range(1000), 90)]
    df = spark.createDataFrame(rows, "g string, x int, v long")
    found = running_totals(df, "x", ["v"], ["g"], descending, parts=7).collect()
    for r in found:
        before = [v for g, x, v in rows if g == r.g and (x > r.x if descending else x < r.x)]
        assert r.v_before == sum(before)
    assert len(found) == len(rows)


def test_ranges_follow_the_number_of_scores(spark):
    """No window has more rows than it may, and the areas do not depend on the ranges."""
    from ledgerwatch.operators import skew

    assert [skew.parts_for(n, 1000) for n in (0, 1000, 1001, 10_000, 10**6)] == [1, 1, 2, 11, 1100]
    dice = random.Random(9)
    rows = [(g, round(dice.random(), 4), dice.randrange(2), dice.randrange(2)) for g in "ab" for _ in range(3000)]
    points = metrics.score_points(frame(spark, rows), "score", ["g"])
    whole = metrics.curve_areas(points, ["g"]).orderBy("g").collect()
    cut = metrics.curve_areas(points, ["g"], window_rows=200).orderBy("g").collect()
    for a, b in zip(whole, cut, strict=True):
        assert a.roc_auc == pytest.approx(b.roc_auc, abs=1e-12) and a.pr_auc == pytest.approx(b.pr_auc, abs=1e-12)
    parts = skew.parts_for(points.count(), 200)
    steps = points.groupBy("g", "score").agg(F.sum("pos").alias("pos"))
    cuts = steps.withColumn("cuts", skew.cut_points(steps, F.col("score"), parts))
    sizes = cuts.withColumn("range", skew.range_number(F.col("score"), F.col("cuts"), parts)).groupBy("range").count()
    assert sizes.agg(F.max("count")).first()[0] <= 200


def test_running_totals_on_empty(spark):
    df = spark.createDataFrame([], "x int, v long")
    assert running_totals(df, "x", ["v"], parts=4).withColumn("z", F.lit(1)).count() == 0
