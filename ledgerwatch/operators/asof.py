"""Point-in-time join: for each left row the newest right row of the same key that is not later."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.operators.skew import HOT_ROWS, cut_points, hot_keys, range_number
from ledgerwatch.sources.tables import staged

_ROW, _TIME, _SIDE = "__row", "__time", "__side"
# Cut points that one sketch of the times gives; beyond, ranges grow.
MOST_RANGES = 8192
_RIGHT, _LEFT = 0, 1  # on equal times the right row comes first, so it is found


def _complete(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def _carry_forward(events: DataFrame, on: Sequence[str]) -> DataFrame:
    """Plain form: one sorted pass per key that carries the last right row to the left rows."""
    so_far = Window.partitionBy(*on).orderBy(_TIME, _SIDE, _ROW).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn(_ROW, F.last(_ROW, ignorenulls=True).over(so_far)).where(F.col(_SIDE) == _LEFT)


def _carry_forward_hot(left: DataFrame, right: DataFrame, on: Sequence[str], splits: int) -> DataFrame:
    """Form for heavy keys: the same result from time ranges of equal size.

    Rows are first reduced to one per (key, time), which bounds what one moment can hold. Ranges come
    from quantiles of the times, so each holds at most about 1/splits of the rows. Within a range the
    pass is as above; the state at the start of a range comes from one row per (key, range).
    """
    moments = (
        right.groupBy(*on, _TIME)
        .agg(F.max(_ROW).alias(_ROW))
        .withColumn(_SIDE, F.lit(_RIGHT))
        .unionByName(
            left.select(*on, _TIME).distinct().withColumn(_SIDE, F.lit(_LEFT)), allowMissingColumns=True
        )
    )
    # Quantiles of all rows: no shuffle, and a moment with many rows only repeats a cut.
    times = right.select(_TIME).unionByName(left.select(_TIME))
    cut = moments.withColumn("__cuts", cut_points(times, F.col(_TIME), splits))
    ranged = cut.withColumn("__range", range_number(F.col(_TIME), F.col("__cuts"), splits)).drop("__cuts")

    earlier = Window.partitionBy(*on).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        ranged.groupBy(*on, "__range")
        .agg(F.max(F.when(F.col(_SIDE) == _RIGHT, F.struct(_TIME, _ROW))).alias("__last"))
        .select(*on, "__range", F.last("__last", ignorenulls=True).over(earlier)[_ROW].alias("__opening"))
    )
    found = (
        _carry_forward(ranged, [*on, "__range"])
        .join(opening, [*on, "__range"], "left")
        .select(*on, _TIME, F.coalesce(_ROW, "__opening").alias(_ROW))
    )
    return left.join(found, [*on, _TIME])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    ts: str,
    right_ts: str | None = None,
    tolerance: str | None = None,
    matched_ts: str | None = None,
    hot_rows: int = HOT_ROWS,
    range_rows: int = HOT_ROWS,
    right_unique: bool = False,
) -> DataFrame:
    """Left rows, each with the columns of the newest right row of its key at or before its time.

    Every left row is kept once; without a match the right columns are null. `tolerance` is an interval
    text such as "2 hours" that limits how old a match may be. `matched_ts` names an output column for
    the time of the matched row. Of several right rows at one time the greatest by its columns counts.

    With `right_unique` the caller vouches for one right row per key, and a plain join with a test of the times
    does. Else keys with few rows take one union and one window, a single shuffle. A count per key finds
    those with more than `hot_rows` rows; they stay in a table, and their rows are
    processed by ranges of time of about `range_rows` rows instead.
    """
    right_ts = right_ts or ts
    values = [c for c in right.columns if c not in {*on, right_ts}]
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    usable = _complete([*on, _TIME])
    timed_right = right.select(
        *on, F.col(right_ts).alias(_TIME), F.struct(F.col(right_ts).alias("__at"), *values).alias(_ROW)
    ).where(usable)
    timed_left = left.withColumn(_TIME, F.col(ts))
    matchable = timed_left.where(usable)
    unmatchable = timed_left.where(~usable)

    def plain(some_left: DataFrame, some_right: DataFrame) -> DataFrame:
        events = some_left.withColumn(_SIDE, F.lit(_LEFT)).unionByName(
            some_right.withColumn(_SIDE, F.lit(_RIGHT)), allowMissingColumns=True
        )
        return _carry_forward(events, on).drop(_SIDE)

    if right_unique:
        one = timed_right.withColumnRenamed(_TIME, "__right_time")
        joined = timed_left.join(one, list(on), "left")
        row = F.when(F.col("__right_time") <= F.col(_TIME), F.col(_ROW))
        return _matched(joined.withColumn(_ROW, row), left.columns, values, tolerance, matched_ts)

    keys = timed_right.select(*on).unionByName(matchable.select(*on))
    hot = staged(hot_keys(keys, on, hot_rows), "hot-keys")
    rows = hot.agg(F.sum("__n")).first()[0]  # one number
    if rows:
        heavy, splits = hot.select(*on), min(MOST_RANGES, max(2, -(-rows // range_rows)))
        found = plain(
            matchable.join(heavy, list(on), "left_anti"), timed_right.join(heavy, list(on), "left_anti")
        ).unionByName(
            _carry_forward_hot(
                matchable.join(heavy, list(on), "left_semi"), timed_right.join(heavy, list(on), "left_semi"), on, splits
            )
        )
    else:
        found = plain(matchable, timed_right)

    found = found.unionByName(unmatchable, allowMissingColumns=True)
    return _matched(found, left.columns, values, tolerance, matched_ts)


def _matched(found: DataFrame, left: Sequence[str], values: Sequence[str], tolerance: str | None, matched_ts: str | None) -> DataFrame:
    row = F.col(_ROW)
    if tolerance is not None:
        row = F.when(F.col(_ROW)["__at"] + F.expr(f"INTERVAL {tolerance}") >= F.col(_TIME), row)
    out = [*left, *[row[c].alias(c) for c in values]]
    if matched_ts:
        out.append(row["__at"].alias(matched_ts))
    return found.select(*out)
