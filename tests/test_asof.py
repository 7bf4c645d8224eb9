"""The point-in-time join against brute force, on the plain path and on the path for hot keys."""

import datetime as dt
import random

import pytest

from ledgerwatch.operators.asof import asof_join

START = dt.datetime(2024, 1, 1)
LEFT = "id int, k string, ts timestamp_ntz"
RIGHT = "k string, ts timestamp_ntz, v int, w string"

PATHS = {"plain": {}, "hot": {"hot_rows": 0, "range_rows": 30}, "mixed": {"hot_rows": 60, "range_rows": 12}, "one": {"hot_rows": 0, "range_rows": 10**9}}


def at(minute):
    return None if minute is None else START + dt.timedelta(minutes=minute)


def random_sides(seed):
    dice = random.Random(seed)

    def key():
        return dice.choice(["hot"] * 6 + ["a", "b", "c", None])

    def minute():
        # One moment holds many rows.
        return dice.choice([50, 50, 50, None] + [dice.randint(0, 100) for _ in range(16)])

    left = [(i, key(), at(minute())) for i in range(150)]
    right = [(key(), at(minute()), dice.randint(0, 9), dice.choice("xyz")) for _ in range(120)]
    return left, right


def brute_force(left, right, tolerance=None):
    out = []
    for i, k, t in left:
        best = None
        for rk, rt, v, w in right:
            if None in (k, t, rk, rt) or rk != k or rt > t:
                continue
            if best is None or (rt, v, w) > best:
                best = (rt, v, w)
        if best and tolerance and t - best[0] > tolerance:
            best = None
        out.append((i, k, t, *(best[1:] if best else (None, None)), best[0] if best else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, path, seed):
    left, right = random_sides(seed)
    found = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "ts", matched_ts="at", **PATHS[path]
    )
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_force(left, right)


@pytest.mark.parametrize("path", PATHS)
def test_tolerance(spark, path):
    left, right = random_sides(3)
    found = asof_join(
        spark.createDataFrame(left, LEFT),
        spark.createDataFrame(right, RIGHT),
        ["k"],
        "ts",
        tolerance="5 minutes",
        matched_ts="at",
        **PATHS[path],
    )
    expected = brute_force(left, right, dt.timedelta(minutes=5))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected


def test_right_time_may_have_another_name(spark):
    left = spark.createDataFrame([(1, "a", at(5))], LEFT)
    right = spark.createDataFrame([("a", at(5), 7)], "k string, seen timestamp_ntz, v int")
    assert asof_join(left, right, ["k"], "ts", right_ts="seen").first().v == 7


def test_one_right_row_per_key(spark):
    """The plain join gives what the other paths give, with fewer exchanges."""
    left, right = random_sides(4)
    once = list({k: (k, t, v, w) for k, t, v, w in right}.values())
    sides = spark.createDataFrame(left, LEFT), spark.createDataFrame(once, RIGHT)
    found = asof_join(*sides, ["k"], "ts", tolerance="20 minutes", matched_ts="at", right_unique=True)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_force(left, once, dt.timedelta(minutes=20))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Union" not in plan


def test_empty_right_keeps_the_left(spark):
    left = spark.createDataFrame([(1, "a", at(5)), (2, None, None)], LEFT)
    found = asof_join(left, spark.createDataFrame([], RIGHT), ["k"], "ts").collect()
    assert sorted((r.id, r.v) for r in found) == [(1, None), (2, None)]


def test_same_column_on_both_sides_is_refused(spark):
    left = spark.createDataFrame([(1, "a", at(5), 1)], LEFT + ", v int")
    with pytest.raises(ValueError, match="both sides"):
        asof_join(left, spark.createDataFrame([], RIGHT), ["k"], "ts")
