"""The heuristic risk score and the way a function is bound to named columns of a frame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the score: (argument, lower bound, points). The first matching amount step counts.
AMOUNT_STEPS = ((200_000, 0.3), (100_000, 0.15))
OTHER_STEPS = (("full_transfer", 0, 0.25), ("balance_ratio", 0.9, 0.15), ("cross_border", 0, 0.1))


def transaction_risk_score(
    amount: Column, balance_ratio: Column, full_transfer: Column, cross_border: Column
) -> Column:
    """Points for size, emptied account, use of balance and border crossing, at most 1, as float."""
    given = {"full_transfer": full_transfer, "balance_ratio": balance_ratio, "cross_border": cross_border}
    (high, high_points), (middle, middle_points) = AMOUNT_STEPS
    size = F.when(amount > high, F.lit(high_points)).when(amount > middle, F.lit(middle_points)).otherwise(F.lit(0.0))
    points = [F.when(given[name] > above, F.lit(p)).otherwise(F.lit(0.0)) for name, above, p in OTHER_STEPS]
    return F.least(reduce(lambda a, b: a + b, points, size), F.lit(1.0)).cast("float")


def register_risk_score(spark: SparkSession, name: str = "transaction_risk_score") -> None:
    """The same score as a SQL function of this session, inlined by the optimizer."""
    (high, high_points), (middle, middle_points) = AMOUNT_STEPS
    others = " + ".join(f"CASE WHEN {arg} > {above} THEN {p}D ELSE 0D END" for arg, above, p in OTHER_STEPS)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(
              amount DOUBLE, balance_ratio DOUBLE, full_transfer DOUBLE, cross_border DOUBLE)
            RETURNS FLOAT
            RETURN CAST(least(
              CASE WHEN amount > {high} THEN {high_points}D WHEN amount > {middle} THEN {middle_points}D ELSE 0D END
              + {others}, 1D) AS FLOAT)"""
    )


@dataclass(frozen=True)
class BoundFunction:
    """A column function evaluated on named input columns when a frame is assembled."""

    function: Callable[..., Column]
    inputs: Mapping[str, str]
    output: str

    def add_to(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.output, self.function(**{arg: F.col(c) for arg, c in self.inputs.items()}))


RISK_SCORE = BoundFunction(
    transaction_risk_score,
    {
        "amount": "amount",
        "balance_ratio": "balance_orig_ratio",
        "full_transfer": "is_full_transfer",
        "cross_border": "is_cross_border",
    },
    "risk_score",
)
