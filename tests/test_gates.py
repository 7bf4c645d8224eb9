"""Promotion rules and the choice of the best trial."""

import datetime as dt

import pytest

from ledgerwatch.operators import gates

VERSIONS = "model_name string, model_version string, alias string, description string, fairness_check string, approval string"
METRICS = "model_name string, model_version string, f1 double, value long, scored long, unscored long"
LONG = "A description of more than 20 characters"


def decide(spark, challenger, metrics, champion=None, manual=False):
    versions = [("m", "2", gates.CHALLENGER, *challenger)]
    measured = [("m", "2", *metrics)]
    if champion:
        versions.append(("m", "1", gates.CHAMPION, LONG, "Passed", None))
        measured.append(("m", "1", *champion, 10, 0))
    frames = spark.createDataFrame(versions, VERSIONS), spark.createDataFrame(measured, METRICS)
    return gates.promotion_gate(*frames, manual_approval=manual).first()


GOOD = (LONG, "Passed", None)


@pytest.mark.parametrize(
    "challenger, metrics, champion, failed",
    [
        (GOOD, (0.5, 10, 5, 0), None, None),
        (GOOD, (0.5, 10, 5, 0), (0.5, 10), None),
        (GOOD, (0.476, 10, 5, 0), (0.5, 10), None),
        (GOOD, (0.474, 10, 5, 0), (0.5, 10), "metric_f1_passed"),
        (GOOD, (0.5, 9, 5, 0), (0.5, 10), "business_metric_passed"),
        (GOOD, (None, 10, 5, 0), (0.5, 10), "metric_f1_passed"),
        (GOOD, (0.5, 10, 5, 1), None, "predicts"),
        (GOOD, (0.5, 10, 0, 0), None, "predicts"),
        (("exactly 20 character", "passed", None), (0.5, 10, 5, 0), None, "has_description"),
        ((None, "Passed", None), (0.5, 10, 5, 0), None, "has_description"),
        ((LONG, None, None), (0.5, 10, 5, 0), None, "fairness_passed"),
        ((LONG, "Failed", None), (0.5, 10, 5, 0), None, "fairness_passed"),
    ],
)
def test_checks(spark, challenger, metrics, champion, failed):
    found = decide(spark, challenger, metrics, champion)
    assert [c for c in gates.CHECKS if not found[c]] == ([failed] if failed else [])
    assert found.promoted == (failed is None) and found.approval_check == ("Failed" if failed else "Approved")


def test_a_failing_champion_metric_is_not_a_pass(spark):
    found = decide(spark, GOOD, (0.5, 10, 5, 0), (None, None))
    assert not found.metric_f1_passed and not found.business_metric_passed


@pytest.mark.parametrize("approval, promoted", [("APPROVED", True), ("no", False), (None, False)])
def test_manual_approval(spark, approval, promoted):
    assert decide(spark, (LONG, "Passed", approval), (0.5, 10, 5, 0), manual=True).promoted is promoted


def test_best_trial(spark):
    day = dt.datetime(2024, 1, 1)
    later = day + dt.timedelta(days=1)
    trials = spark.createDataFrame(
        [("a", 0.9, "FAILED", day), ("b", 0.8, "FINISHED", day), ("c", 0.8, "FINISHED", later),
         ("e", 0.8, "FINISHED", later), ("d", None, "FINISHED", later)],
        "run_id string, test_f1 double, state string, started_at timestamp_ntz",
    )
    assert gates.best_trial(trials).first().run_id == "c"
