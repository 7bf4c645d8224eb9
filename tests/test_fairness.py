"""Slices, ratios and the gate, on frames small enough to check by hand."""

import pytest
from pyspark.sql import Row

from ledgerwatch.functions.columns import protected_columns
from ledgerwatch.operators import fairness

IMPACT, CALIBRATION = fairness.DISPARATE_IMPACT, fairness.CALIBRATION


def slices_of(spark, groups, labels, predictions):
    rows = list(zip(groups, labels, predictions))
    df = spark.createDataFrame(rows, "country string, label int, prediction int")
    return {r.slice_value: r for r in fairness.subgroup_metrics(df, ["country"]).collect()}


def slice_table(spark, *rows):
    """Rows (dimension, value, selection rate[, n[, positive rate]])."""
    full = []
    for dimension, value, selected, *more in rows:
        n = more[0] if more else 100
        base = more[1] if len(more) > 1 else None
        full.append((dimension, value, n, base, None, None, None, selected))
    return spark.createDataFrame(full, fairness.SLICE_SCHEMA)


def worst(spark, *rows, kind=IMPACT, **options):
    found = fairness.worst_ratio(slice_table(spark, *rows), kind, **options).collect()
    return found[0].ratio if found else None


TWO_GROUPS = ["US"] * 4 + ["UK"] * 4
ALTERNATING = [0, 1] * 4


@pytest.mark.parametrize(
    "predictions, precision, recall, alarms",
    [(ALTERNATING, 1.0, 1.0, 0.0), ([1 - y for y in ALTERNATING], 0.0, 0.0, 1.0)],
)
def test_always_right_and_always_wrong(spark, predictions, precision, recall, alarms):
    found = slices_of(spark, TWO_GROUPS, ALTERNATING, predictions)
    assert set(found) == {"US", "UK"}
    for r in found.values():
        assert (r.n, r.precision, r.recall, r.false_positive_rate) == (4, precision, recall, alarms)


def test_slice_without_positives_has_no_recall(spark):
    r = slices_of(spark, ["US"] * 4, [0] * 4, [0, 1, 0, 0])["US"]
    assert r.recall is None and r.false_positive_rate == 0.25


def test_slice_without_negatives_has_no_false_positive_rate(spark):
    r = slices_of(spark, ["US"] * 3, [1] * 3, [1, 0, 1])["US"]
    assert r.false_positive_rate is None and r.precision == 1.0


def test_groups_are_kept_apart(spark):
    found = slices_of(spark, ["US", "US", "UK", "UK"], [1, 0, 1, 0], [1, 0, 0, 1])
    assert (found["US"].precision, found["US"].recall) == (1.0, 1.0)
    assert (found["UK"].precision, found["UK"].recall) == (0.0, 0.0)


def test_null_slices_are_left_out_and_values_are_text(spark):
    df = spark.createDataFrame(
        [(6.0, "a", 1, 1), (None, "a", 0, 0), (6.0, None, 0, 1)],
        "age_group double, country string, label int, prediction int",
    )
    found = {(r.slice_dimension, r.slice_value): r.n for r in fairness.subgroup_metrics(df, ["age_group", "country"]).collect()}
    assert found == {("age_group", "6.0"): 2, ("country", "a"): 2}


def test_a_dimension_may_be_the_label(spark):
    df = spark.createDataFrame([(1, 1), (0, 1)], "label int, prediction int")
    found = {r.slice_value: r.positive_rate for r in fairness.subgroup_metrics(df, ["label"]).collect()}
    assert found == {"0": 0.0, "1": 1.0}


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("country", "US", 0.10), ("country", "UK", 0.10)], 1.0),
        ([("country", "US", 0.20), ("country", "UK", 0.05)], 4.0),
        (
            [("country", "US", 0.1), ("country", "UK", 0.1), ("age_group", "young", 0.2), ("age_group", "old", 0.04)],
            5.0,
        ),
        ([("country", "US", 0.10), ("country", "UK", 0.0)], None),
        ([("country", "US", 0.10, 500), ("country", "UK", 0.09, 500), ("country", "LKA", 0.5, 2)], 0.10 / 0.09),
        ([], None),
    ],
    ids=["balanced", "skewed", "worst of two", "zero minimum", "small slice", "empty"],
)
def test_disparate_impact(spark, rows, expected):
    found = worst(spark, *rows)
    assert found == (None if expected is None else pytest.approx(expected))


def test_ties_go_to_the_first_name(spark):
    rows = [("b", "x", 0.2), ("b", "y", 0.1), ("a", "q", 0.2), ("a", "p", 0.2), ("a", "s", 0.1), ("a", "r", 0.1)]
    found = fairness.worst_ratio(slice_table(spark, *rows), IMPACT).first()
    assert (found.dimension, found.max_slice, found.min_slice) == ("a", "p", "r")


def gate(spark, *rows, **options):
    return fairness.fairness_gate(slice_table(spark, *rows), **options).first()


def test_gate_on_selection_rates(spark):
    close = gate(spark, ("country", "US", 0.10), ("country", "UK", 0.09), threshold=1.25, use_calibration=False)
    assert close.passes and close.worst_ratio == pytest.approx(0.10 / 0.09)
    assert (close.detail.dimension, close.detail.max_slice, close.detail.min_slice) == ("country", "US", "UK")
    far = gate(spark, ("country", "US", 0.20), ("country", "UK", 0.05), threshold=1.25, use_calibration=False)
    assert not far.passes and far.worst_ratio == pytest.approx(4.0)
    assert (far.detail.max_selection_rate, far.detail.min_selection_rate) == (0.20, 0.05)


def test_gate_passes_with_nothing_to_compare(spark):
    assert gate(spark) == Row(passes=True, worst_ratio=None, detail=None)
    small = gate(spark, ("country", "US", 0.2, 5), ("country", "UK", 0.05, 5), threshold=1.25, use_calibration=False)
    assert small == Row(passes=True, worst_ratio=None, detail=None)


CALIBRATED = [("age_group", "9", 0.045, 199, 0.040), ("age_group", "3", 0.014, 217, 0.014)]


def test_calibrated_model_passes_where_selection_rates_fail(spark):
    fair = gate(spark, *CALIBRATED, threshold=1.5)
    assert fair.passes and fair.worst_ratio == pytest.approx(1.125, rel=1e-3)
    raw = gate(spark, *CALIBRATED, threshold=1.5, use_calibration=False)
    assert not raw.passes and raw.worst_ratio == pytest.approx(3.21, rel=1e-2)


def test_over_selected_slice_fails(spark):
    rows = [("age_group", "X", 0.10, 200, 0.02), ("age_group", "Y", 0.02, 200, 0.02)]
    found = gate(spark, *rows, threshold=1.5)
    assert not found.passes and found.worst_ratio == pytest.approx(5.0) and found.detail.max_slice == "X"


def test_calibration_needs_positives(spark):
    assert worst(spark, ("c", "a", 0.1, 100, 0.0), ("c", "b", 0.1, 100, 0.1), kind=CALIBRATION) is None


def test_ratios_by_dimension(spark):
    found = fairness.ratios_by_dimension(slice_table(spark, *CALIBRATED, ("country", "US", 0.1, 100, 0.1))).collect()
    assert [r.dimension for r in found] == ["age_group"]
    assert found[0].calibration_ratio == pytest.approx(1.125) and found[0].disparate_impact_ratio == pytest.approx(45 / 14)


@pytest.mark.parametrize(
    "columns, options, expected",
    [
        (["amount", "country", "age_group", "type"], {}, ["country", "age_group"]),
        (["amount", "type"], {}, []),
        (["region", "amount"], {"candidates": ("region",)}, ["region"]),
    ],
)
def test_protected_columns(columns, options, expected):
    assert protected_columns(columns, **options) == expected
