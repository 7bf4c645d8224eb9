"""Column expressions shared by the plans. All of them stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money is added as an exact decimal, so a total does not depend on the order of the rows.
MONEY = "decimal(28,4)"

# Fixed value: candidate protected columns, in report order.
PROTECTED_COLUMNS = ("country", "age_group", "is_cross_border")

# Fixed value: numeric-looking columns that are categories all the same.
CATEGORY_COLUMNS = ("type", "countryOrig", "countryDest", "country")


def strip_dashes(code: Column) -> Column:
    """Country code without any `--`."""
    return F.replace(code, F.lit("--"), F.lit(""))


def truthy(flag: Column) -> Column:
    """Boolean from finite numbers, true/false or text of either; null and unreadable text are false."""
    number = flag.try_cast("double")
    return F.coalesce(F.when(F.abs(number) < float("inf"), number != 0), flag.try_cast("boolean"), F.lit(False))


def money_sum(amount: Column) -> Column:
    """The exact total; amounts that are no finite number, or of 24 digits before the point and more, are unknown."""
    return F.sum(amount.try_cast(MONEY)).cast("double")


def pair_key(a: Column, b: Column) -> Column:
    """`smaller-larger`, so that both directions of a flow share one key; null if either is null."""
    return F.concat(F.when(a < b, a).otherwise(b), F.lit("-"), F.when(a < b, b).otherwise(a))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient of two counts as double, null when undefined."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def to_number(value: Column) -> Column:
    """Lenient conversion: what does not parse becomes null."""
    return value.try_cast("double")


def split_by_type(df: DataFrame, extra: Iterable[str] = CATEGORY_COLUMNS) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names: text or listed columns, then the other numeric ones."""
    listed = set(extra)
    categorical = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) or f.name in listed]
    numeric = [
        f.name
        for f in df.schema
        if f.name not in categorical and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]
    return categorical, numeric


def protected_columns(columns: Iterable[str], candidates: Iterable[str] = PROTECTED_COLUMNS) -> list[str]:
    """The candidates that are present, in candidate order."""
    present = set(columns)
    return [c for c in candidates if c in present]
