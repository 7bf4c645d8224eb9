"""Building blocks that keep one heavy value from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that one task sorts without effort; a key with more is hot, whatever its share of the table.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than `min_rows` rows, and `__n`, how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > min_rows)


def cut_points(df: DataFrame, value: Column, parts: int) -> Column:
    """Scalar subquery: parts-1 values that split `value` into ranges of about equal row count."""
    probabilities = [i / parts for i in range(1, parts)]
    return df.agg(F.percentile_approx(value, probabilities, parts * 20).alias("cuts")).scalar()


def range_number(value: Column, cuts: Column, parts: int) -> Column:
    """How many cut points are <= value, found by binary search in the sorted array `cuts` of at most `parts`."""
    jumps = [2**i for i in reversed(range(max(1, parts.bit_length())))]

    def jump(passed: Column, by: Column) -> Column:
        # Beyond the end of the array there is null, and no jump.
        return F.when(F.get(cuts, passed + by - 1) <= value, passed + by).otherwise(passed)

    return F.aggregate(F.array(*[F.lit(j) for j in jumps]), F.lit(0), jump)


def parts_for(rows: int, most: int = HOT_ROWS) -> int:
    """Ranges for so many rows, so that no range has more than `most` of them."""
    return max(1, -(-rows * 11 // (most * 10))) if rows > most else 1


def running_totals(
    df: DataFrame,
    order: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    parts: int = 1024,
) -> DataFrame:
    """For each row the sum of `values` over the rows before it, as `<value>_before`.

    `order` must be unique within `by`. The rows are cut into ranges of equal size, at most a tenth above the mean; only one row per
    range is totalled in a single window, and the windows over the rows cover one range each. See `parts_for` for their number.
    """
    direction = (lambda c: c.desc()) if descending else (lambda c: c.asc())
    if parts == 1:
        before = Window.partitionBy(*by).orderBy(direction(F.col(order))).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(before), F.lit(0)) for v in values})
    ranged = df.withColumn("__cuts", cut_points(df, F.col(order), parts))
    ranged = ranged.withColumn("__range", range_number(F.col(order), F.col("__cuts"), parts)).drop("__cuts")
    carried = Window.partitionBy(*by).orderBy(direction(F.col("__range"))).rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        Window.partitionBy(*by, "__range").orderBy(direction(F.col(order))).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = ranged.groupBy(*by, "__range").agg(*[F.sum(v).alias(v) for v in values])
    offsets = totals.select(
        *by, "__range", *[F.coalesce(F.sum(v).over(carried), F.lit(0)).alias(f"__{v}") for v in values]
    )
    return (
        ranged.join(offsets, [*by, "__range"])
        .withColumns({f"{v}_before": F.col(f"__{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
        .drop("__range", *[f"__{v}" for v in values])
    )
