"""Operators on keyed frames: one row per key, snapshots, upserts, updates and change sets.

Reductions to one row per key are aggregates, not row numbers: the map side keeps one row per key,
so a key that holds a large share of the rows never lands in one task as raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _others(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(names)]


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Deduplicate on `keys`; the row smallest by `order`, then by the remaining columns, survives.

    With every column in the key this is a plain distinct.
    """
    rest = _others(df, keys)
    if not rest:
        return df.dropDuplicates(list(keys))
    ranked = [c for c in order if c in rest] + [c for c in rest if c not in order]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__row"))
    return kept.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def latest_snapshot(
    df: DataFrame, key: str | Sequence[str], ts: str, version: Column | None = None
) -> DataFrame:
    """The newest row of each key by `ts`, ties broken by the remaining columns, stamped with a version."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = _others(df, [*keys, ts])
    newest = df.groupBy(*keys).agg(F.max(F.struct(ts, *rest)).alias("__row"))
    out = newest.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])
    return out if version is None else out.withColumn("snapshot_version", version)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (without nulls) that occur more than once."""
    full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(full).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """Rows of `source` replace the rows of `target` with the same key, the others are added.

    A null key matches nothing. Two source rows with one key are an error, as in a merge statement.
    """
    if check and not duplicate_keys(source, keys).isEmpty():
        raise ValueError(f"source has several rows for one key {list(keys)}")
    if target is None:
        return source
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return source.unionByName(kept.select(*target.columns), allowMissingColumns=True)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Overwrite `values` where the key matches, also with null; rows without match stay as they are.

    Several source rows with one key end the query, as in a merge statement, so the row count never changes. A null key matches nothing.
    """
    full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    once = source.where(full).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.any_value(F.struct(*values)).alias("__new"))
    refused = F.raise_error(F.lit(f"several source rows for one key {list(keys)}"))
    patch = once.select(*keys, F.when(F.col("__rows") == 1, F.col("__new")).otherwise(refused).alias("__new"))
    joined = target.join(patch, list(keys), "left")
    found = F.col("__new").isNotNull()
    return joined.select(
        *[
            F.when(found, F.col("__new")[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in target.columns
        ]
    )


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level change set between two versions of a table with unique, non-null keys.

    One row per insert and delete, two per update (`update_pre`, `update_post`), none for equal rows. A column
    that only one version has is null in the rows of the other, so a new or dropped column with values is an update.
    """
    fields = [*_others(new, keys), *[c for c in _others(old, keys) if c not in new.columns]]
    types = {f.name: f.dataType for version in (old, new) for f in version.schema.fields}

    def whole(df: DataFrame) -> Column:
        return F.struct(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in fields])

    before = old.select(*keys, whole(old).alias("__old"))
    after = new.select(*keys, whole(new).alias("__new"))
    was, now = F.col("__old"), F.col("__new")

    def record(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), row.alias("row"))

    records = (
        F.when(was.isNull(), F.array(record("insert", now)))
        .when(now.isNull(), F.array(record("delete", was)))
        .otherwise(F.array(record("update_pre", was), record("update_post", now)))
    )
    return (
        before.join(after, list(keys), "full_outer")
        .where(~was.eqNullSafe(now))
        .select(*keys, F.explode(records).alias("__change"))
        .select(*keys, "__change.change_type", "__change.row.*")
    )

