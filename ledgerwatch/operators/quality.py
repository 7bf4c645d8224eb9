"""Named row expectations: keep, drop or fail, with counts of what passed."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Expectation:
    """A row predicate in SQL. A null result counts as failed."""

    name: str
    predicate: str
    policy: str = WARN

    def __post_init__(self):
        if self.policy not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown policy {self.policy!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


# The expectations of the bank tables.
CORRECT_SCHEMA = Expectation("correct_schema", "_rescued_data IS NULL")
CORRECT_DATA = Expectation("correct_data", "id IS NOT NULL")
CORRECT_CUSTOMER = Expectation("correct_customer_id", "customer_id IS NOT NULL")
AMOUNT_DECENT = Expectation("amount_decent", "amount > 10")

# Labels that `truthy` cannot read count as no fraud; this shows how many there are.
READABLE_LABEL = Expectation(
    "readable_label",
    "is_fraud IS NULL OR abs(try_cast(is_fraud AS DOUBLE)) < double('infinity') OR try_cast(is_fraud AS BOOLEAN) IS NOT NULL",
)


class ExpectationFailed(Exception):
    pass


def report(df: DataFrame, expectations: Iterable[Expectation]) -> DataFrame:
    """One row per expectation with passed and failed counts, from a single aggregate over `df`."""
    expectations = list(expectations)
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(e.holds()).alias(e.name) for e in expectations]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(e.name).alias("expectation"),
                F.lit(e.policy).alias("policy"),
                F.col(e.name).alias("passed"),
                (F.col("__rows") - F.col(e.name)).alias("failed"),
            )
            for e in expectations
        ]
    )
    return counts.select(F.inline(rows))


def enforce(df: DataFrame, expectations: Iterable[Expectation]) -> DataFrame:
    """Apply the policies: `drop` filters, `fail` raises on the first batch that breaks it, `warn` keeps."""
    expectations = list(expectations)
    fatal = [e for e in expectations if e.policy == FAIL]
    if fatal and not df.isStreaming:
        broken = report(df, fatal).where("failed > 0").collect()  # at most one row per expectation
        if broken:
            raise ExpectationFailed(", ".join(f"{r.expectation}: {r.failed} rows" for r in broken))
    keep = [e.holds() for e in expectations if e.policy == DROP]
    return df.where(reduce(lambda a, b: a & b, keep)) if keep else df
