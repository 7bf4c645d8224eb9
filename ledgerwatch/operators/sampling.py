"""Splits and samples decided by a hash of the key: the same rows on any layout and any engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 100


def hash_bucket(key: Column, salt: str = "", buckets: int = BUCKETS) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of md5(salt + key)."""
    salted = F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string")
    return F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("bigint") % buckets


def split_name(key: Column, train_percent: int = 80) -> Column:
    return F.when(hash_bucket(key) < train_percent, "train").otherwise("test")


def hash_sample(df: DataFrame, key: str, percent: int, salt: str = "sample") -> DataFrame:
    """About `percent` of the rows; a salt other than the split's keeps the two independent."""
    return df.where(hash_bucket(F.col(key), salt) < percent)


def hash_top_n(df: DataFrame, key: str, n: int, salt: str = "sample") -> DataFrame:
    """At most n rows, those smallest by hash of the key: each task keeps n rows, then one merge."""
    return df.orderBy(F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), key).limit(n)
