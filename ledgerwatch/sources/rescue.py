"""JSON records against known columns: what does not fit is kept by field.

A record is parsed once as a variant. Beside the columns it gives `_rescued_data`: a JSON object of exactly those fields, at any depth, that
have no column of their name (case counts) or whose value is not of the column's type. Clean fields of the same record keep their values. In a
list of objects the clean ones stand as null; a list with an item of another kind is kept as a whole. A text that is no JSON object, or has a key twice, is kept whole and has no values.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUE = "_rescued_data"
_QUOTED = re.compile(r"(`(?:[^`]|``)*`)")
_FIELDS, _ITEMS = "map<string,variant>", "array<variant>"


def merged(known: T.DataType, seen: T.DataType) -> T.DataType:
    """The known type with what `seen` has beyond it, at any depth. A plain type stays as it is: values of another are rescued.

    Names that differ in case only are one name to Spark, so the first of them has the column.
    """
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        later = {f.name: f.dataType for f in seen.fields}
        fields = [T.StructField(f.name, merged(f.dataType, later.get(f.name, f.dataType)), f.nullable, f.metadata) for f in known.fields]
        taken = {f.name.lower() for f in fields}
        for f in seen.fields:
            if f.name.lower() not in taken:
                taken.add(f.name.lower())
                fields.append(T.StructField(f.name, _distinct(f.dataType)))
        return T.StructType(fields)
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(merged(known.elementType, seen.elementType), known.containsNull)
    return known


def _distinct(kind: T.DataType) -> T.DataType:
    """The type with one field per name, whatever its case."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_distinct(kind.elementType), kind.containsNull)
    return merged(T.StructType(), kind) if isinstance(kind, T.StructType) else kind


def _plain(kind: T.DataType) -> T.DataType | None:
    """A variant's type as a column's: decimals become doubles, mixed and empty ones text; objects without fields have none."""
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, plain) for f in kind.fields if (plain := _plain(f.dataType)) is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        inner = _plain(kind.elementType)
        return None if inner is None else T.ArrayType(inner)
    if isinstance(kind, T.DecimalType) and kind.scale > 0:
        return T.DoubleType()
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def records(spark: SparkSession, paths: list[str], multi_line: bool) -> DataFrame:
    """text, v: one row per JSON record of the files; the items of a list are records each."""
    lines = spark.read.text(paths, wholetext=multi_line).where(F.trim("value") != "")
    parsed = lines.select("value", F.try_parse_json("value").alias("whole"))
    items = F.try_variant_get("whole", "$", _ITEMS)
    listed = parsed.select("value", items.isNotNull().alias("listed"), F.explode_outer(F.coalesce(items, F.array("whole"))).alias("v"))
    return listed.where(~F.col("listed") | F.col("v").isNotNull()).select(F.when(F.col("listed"), F.to_json("v")).otherwise(F.col("value")).alias("text"), "v")


def found_columns(rows: DataFrame, typed: bool = True) -> T.StructType:
    """Columns of all records (see `records`), by one aggregate; all text if not `typed`."""
    objects = rows.where(F.try_variant_get("v", "$", _FIELDS).isNotNull())
    told = objects.agg(F.schema_of_variant_agg("v")).first()[0]  # one text
    if told is None or told == "VOID":
        return T.StructType()
    # Names in back quotes stay as they are.
    parts = [p if k % 2 else p.replace("OBJECT<", "STRUCT<") for k, p in enumerate(_QUOTED.split(told))]
    kind = _plain(T.DataType.fromDDL("".join(parts))) or T.StructType()
    return kind if typed else T.StructType([T.StructField(f.name, T.StringType()) for f in kind.fields])


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rest(value: Column, kind: T.DataType, own: Column) -> Column:
    """What of a variant did not come through as `own`, of type `kind`; null if all did."""
    if isinstance(kind, T.StructType):
        fields = F.try_variant_get(value, "$", _FIELDS)
        inner = _bound(_rest_of(fields, kind, own), lambda left: F.when(F.size(left) > 0, F.to_variant_object(left)))
        return F.when(fields.isNotNull(), inner).when(~F.is_variant_null(value), value)
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", _ITEMS)
        each = F.transform(items, lambda item, i: _rest(item, kind.elementType, F.get(own, i)))
        inner = _bound(each, lambda left: F.when(F.exists(left, lambda x: x.isNotNull()), F.to_variant_object(left)))
        return F.when(items.isNotNull(), inner).when(~F.is_variant_null(value), value)
    return F.when(own.isNull() & ~F.is_variant_null(value), value)


def _rest_of(fields: Column, kind: T.StructType, own: Column) -> Column:
    """The fields of an object that did not come through: those of unknown name, and the rest of the known ones."""
    nested = [f for f in kind.fields if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    plain = [f for f in kind.fields if f not in nested]
    # Plain columns without a value; a field of that name that has one is a misfit.
    empty = F.array(*[F.when(own[f.name].isNull(), F.lit(f.name)) for f in plain]) if plain else F.array(F.lit(None).cast("string"))
    names = F.array(*[F.lit(f.name) for f in plain]) if plain else F.array(F.lit(None).cast("string"))

    def left(entry: Column, missing: Column) -> Column:
        key, value = entry["key"], entry["value"]
        known = F.coalesce(F.array_contains(names, key), F.lit(False))
        misfit = F.coalesce(F.array_contains(missing, key), F.lit(False)) & ~F.is_variant_null(value)
        rest = F.when(known, F.when(misfit, value))
        for f in nested:
            rest = rest.when(key == f.name, _rest(value, f.dataType, own[f.name]))
        return F.struct(key.alias("key"), rest.otherwise(value).alias("value"))

    entries = _bound(empty, lambda missing: F.transform(F.map_entries(fields), lambda entry: left(entry, missing)))
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def with_rescue(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema` and `_rescued_data` of records (see `records`)."""
    if not schema.fields:
        return rows.select(F.col("text").alias(RESCUE))
    fields = F.try_variant_get("v", "$", _FIELDS)
    own = rows.select("text", fields.alias("fields"), F.when(fields.isNotNull(), F.from_json("text", schema)).alias("own"))
    left = own.withColumn("left", F.when(F.col("fields").isNotNull(), _rest_of(F.col("fields"), schema, F.col("own"))))
    kept = F.when(F.col("fields").isNull(), F.col("text")).when(F.size("left") > 0, F.to_json("left"))
    return left.select(*[F.col("own")[f.name].alias(f.name) for f in schema.fields], kept.alias(RESCUE))
