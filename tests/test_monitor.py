"""Profile, drift and the retrain decision."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import monitor

DAY = dt.datetime(2024, 1, 1)
LOG = "inference_timestamp timestamp_ntz, model_version string, label double, prediction double, amount double, balance_orig_ratio double, is_cross_border double"


def log(spark, rows):
    """Rows (day, label, prediction, amount, cross border)."""
    return spark.createDataFrame(
        [(DAY + dt.timedelta(days=d, hours=1), "1", y, p, a, 0.5, c) for d, y, p, a, c in rows], LOG
    )


def distance(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a map<string,long>, b map<string,long>")
    return df.select(monitor.js_distance(F.col("a"), F.col("b"))).first()[0]


@pytest.mark.parametrize(
    "a, b, expected",
    [({"x": 3}, {"x": 7}, 0.0), ({"x": 1}, {"y": 1}, 1.0), ({"x": 1, "y": 1}, {"x": 1}, None)],
)
def test_js_distance(spark, a, b, expected):
    found = distance(spark, a, b)
    assert found == pytest.approx(distance(spark, b, a)) and 0 <= found <= 1
    if expected is None:  # p = (1/2, 1/2), q = (1, 0)
        expected = math.sqrt(0.5 * (0.5 * math.log2(0.5 / 0.75) + 0.5) + 0.5 * math.log2(1 / 0.75))
    assert found == pytest.approx(expected, abs=1e-12)


def test_profile_slices_and_unlabelled_rows(spark):
    rows = [(0, 1.0, 0.0, 10.0, 1.0), (0, None, 0.0, 20.0, 0.0), (0, 0.0, 0.0, None, None), (1, 1.0, 1.0, 5.0, 0.0)]
    found = monitor.profile_metrics(log(spark, rows), ["amount"]).collect()
    by = {(r.window.start.day, r.slice_value, r.column_name): r for r in found}
    whole = by[1, None, ":table"]
    assert (whole.n, whole.labelled, whole.fraud_catch_rate, whole.false_alarm_rate) == (3, 2, 0.0, 0.0)
    assert whole.expected_fraud_loss == pytest.approx(-200_000 / 3)
    assert whole.f1_score.macro == pytest.approx((0 + 2 / 3) / 2)
    amount = by[1, None, "amount"]
    assert (amount["count"], amount.num_nulls, amount.mean, amount.min, amount.max) == (2, 1, 15.0, 10.0, 20.0)
    # The row with an unknown slice value belongs to the whole only.
    assert by[1, "true", ":table"].n == 1 and by[1, "false", ":table"].n == 1
    assert by[2, None, ":table"].f1_score.macro == 1.0


def test_consecutive_drift_skips_empty_days(spark):
    rows = [(0, 0.0, 0.0, 1.0, 0.0)] * 4 + [(3, 0.0, 1.0, 1.0, 0.0)] * 4 + [(4, 0.0, 1.0, None, 0.0)] * 4
    whole = log(spark, rows)
    found = monitor.drift_consecutive(whole, monitor.fix_bins(whole))
    by = {(r.window.start.day, r.column_name): r.js_distance for r in found.collect()}
    assert len(by) == 2 * len(monitor.DRIFT_COLUMNS)  # the first day has nothing to compare with
    assert by[4, "prediction"] == pytest.approx(1.0) and by[5, "prediction"] == pytest.approx(0.0)
    assert by[5, "amount"] == pytest.approx(1.0)  # all values became null
    assert by[4, "label"] == pytest.approx(0.0)


def test_bins_of_a_baseline(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), None) for i in range(1, 101)] + [(float("nan"), float("inf"), None)], "a double, b double, c double")
    a, b, c = monitor.fix_bins(df, ["a", "b", "c"], by_value=["b"])
    assert a.edges == tuple(float(k) for k in range(10, 100, 10)) and b.values == (0.0, 1.0, 2.0) and c.edges == ()
    odd = spark.createDataFrame([(v, v) for v in (None, float("nan"), float("inf"), float("-inf"), 1.0, 55.0, 1e9)], "a double, b double")
    assert [tuple(r) for r in odd.select(a.label(), b.label()).collect()] == [
        ("null", "null"), ("NaN", "NaN"), ("9", "other"), ("0", "other"), ("0", "1.0"), ("5", "other"), ("9", "other")
    ]
    assert monitor.stored_bins(monitor.bins_table(spark, [a, b, c])) == [a, b, c]


@pytest.mark.parametrize("parts", [1, 7])
def test_edges_are_exact_beyond_the_accuracy(spark, monkeypatch, parts):
    """The tenths are those of the sorted values, also with more rows than approximate quantiles tell apart."""
    monkeypatch.setattr(monitor, "EDGE_ACCURACY", 100)
    values = [float(i * 7919 % 20_011) ** 1.5 for i in range(1, 20_008)]
    ties = [float(i % 13) for i in range(len(values))]
    df = spark.createDataFrame(list(zip(values, ties, strict=True)), "a double, b double").repartition(parts)
    for found, own in zip(monitor.fix_bins(df, ["a", "b"], by_value=[]), (values, ties), strict=True):
        ranked = sorted(own)
        assert found.edges == tuple(sorted({ranked[-(-k * len(own) // 10) - 1] for k in range(1, 10)}))


def test_too_many_values_are_refused(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("b"))
    with pytest.raises(ValueError, match="by ranges"):
        monitor.fix_bins(df, ["b"], by_value=["b"])


def test_one_value_does_not_switch_drift_off(spark):
    """Two days with disjoint amounts, then one NaN, one outlier, one infinite value on later days."""
    days = [(0, 0.0, 0.0, float(10 + k), 0.0) for k in range(20)] + [(1, 0.0, 0.0, float(100 + k), 0.0) for k in range(20)]
    first = log(spark, days[:20])
    bins = monitor.fix_bins(first)

    def second_day(rows):
        found = monitor.drift_consecutive(log(spark, rows), bins).where("column_name = 'amount'").collect()
        return {r.window.start.day: r.js_distance for r in found}[2]

    alone = second_day(days)
    assert alone > 0.8
    for odd in (float("nan"), 1e9, float("inf")):
        assert second_day([*days, (2, 0.0, 0.0, odd, 0.0)]) == alone
    with_nan = [*days, (1, 0.0, 0.0, float("nan"), 0.0)]
    assert second_day(with_nan) > 0.8


def test_baseline_drift(spark):
    rows = [(0, 0.0, 0.0, 1.0, 0.0)] * 4 + [(1, 0.0, 1.0, 1.0, 0.0)] * 4
    whole = log(spark, rows)
    reference = whole.where("prediction = 0")
    found = monitor.drift_baseline(whole, reference, monitor.fix_bins(reference))
    by = {(r.window.start.day, r.column_name): r.js_distance for r in found.collect()}
    assert by[1, "prediction"] == pytest.approx(0.0) and by[2, "prediction"] == pytest.approx(1.0)


PROFILE = "f1_macro double, fraud_catch_rate double, expected_fraud_loss double"


@pytest.mark.parametrize(
    "row, broken",
    [
        ((0.9, 0.9, 0.0), 0),
        ((0.4, 0.9, 0.0), 1),
        ((None, None, None), 0),
        ((None, 0.1, None), 1),
        ((0.9, None, -60_000.0), 1),
        ((0.5, 0.4, -50_000.0), 0),
    ],
)
def test_a_null_metric_breaks_no_rule(spark, row, broken):
    profile = spark.createDataFrame([row], PROFILE)
    drift = spark.createDataFrame([(0.2,), (None,), (0.21,)], "drift_metric double")
    found = monitor.retrain_decision(profile, drift).first()
    assert (found.performance_violations, found.drift_violations, found.total_violations) == (broken, 1, broken + 1)
    assert found.retrain


def test_no_rows_no_retraining(spark):
    found = monitor.retrain_decision(
        spark.createDataFrame([], PROFILE), spark.createDataFrame([], "drift_metric double")
    ).first()
    assert (found.total_violations, found.retrain) == (0, False)


def test_all_versions_and_columns_of_a_window_are_judged(spark):
    """Eleven versions in five columns: a limit of fifty rows would cut the newest window in the middle."""
    rows = [(d, 1.0, 1.0, 1.0, 1.0) for d in range(3)]
    whole = log(spark, rows).drop("model_version").crossJoin(spark.range(11).select(F.col("id").cast("string").alias("model_version")))
    bins = monitor.fix_bins(whole)
    assert monitor.judged_drift(monitor.drift_consecutive(whole, bins), windows=1).count() == 55
    assert monitor.judged_profile(monitor.profile_metrics(whole, ["amount"]), windows=2).count() == 22


def test_recent_rows_come_from_the_whole_log(spark):
    rows = [(d, 1.0, 1.0, 1.0, 1.0) for d in range(40)]
    profile = monitor.profile_metrics(log(spark, rows), ["amount"])
    recent = monitor.recent_profile(profile).collect()
    assert len(recent) == 30 and recent[0].time_window == DAY + dt.timedelta(days=39)
    assert monitor.recent_drift(monitor.drift_consecutive(log(spark, rows), monitor.fix_bins(log(spark, rows)))).count() == 50
