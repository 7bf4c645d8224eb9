"""Batch readers for raw files and format conversion."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.sources import rescue
from ledgerwatch.sources.rescue import RESCUE

TEXT_FORMATS = ("json", "csv")

# Text formats write milliseconds by default; a conversion must not lose the rest.
_FULL_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _options(fmt: str, multi_line: bool) -> dict[str, str]:
    options = {"multiLine": str(multi_line).lower()}
    if fmt == "csv":
        options["header"] = "true"
    return options


def infer_schema(
    spark: SparkSession, path: str | list[str], fmt: str, multi_line: bool = False, typed: bool = True
) -> T.StructType:
    """Columns and types found in the files; all text if not `typed`.

    Every record is looked at: a sample could miss a column, and its values with it.
    """
    reader = spark.read.format(fmt).options(**_options(fmt, multi_line))
    if fmt in TEXT_FORMATS:
        reader = reader.option("inferSchema", str(typed).lower())
    found = reader.load(path).schema
    return found if typed else T.StructType([T.StructField(f.name, T.StringType()) for f in found])


def grown(known: T.StructType, seen: T.StructType) -> T.StructType:
    """Known columns with their types, then what is new, at any depth. A value that no longer fits is rescued, not retyped."""
    return rescue.merged(known, seen)


def _plain_path(path: str) -> str:
    """A path as one form, whether it comes as given or, encoded, from the metadata of a scan."""
    return re.sub(r"^([a-z0-9]+):/{1,3}(?=[^/])", r"\1:/", unquote(path))


def _given_paths(paths: list[str]) -> dict[str, str]:
    """The paths by their plain forms; one without a file system also stands for that path on any."""
    return {form: path for path in paths for form in (_plain_path(path), _plain_path(quote(path, safe=":/")))}


def _by_header(spark: SparkSession, paths: list[str]) -> list[tuple[tuple[str, ...], list[str]]]:
    """CSV files by the text of their header, from one scan of them all; files without one hold no rows."""
    lines = spark.read.text(paths).select("value", "_metadata.file_path", F.monotonically_increasing_id().alias("at")).where(F.trim("value") != "")
    # The first line of each file, then the files of each header: at most one row per file.
    first = lines.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    found = first.groupBy("header").agg(F.collect_list("file_path").alias("files")).collect()
    given = _given_paths(paths)
    groups = []
    for row in found:
        plain = [_plain_path(file) for file in row["files"]]
        own = sorted(given[p] if p in given else given[re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", p)] for p in plain)
        if row["header"].count('"') % 2:  # a name goes on in the next line
            groups += [(tuple(spark.read.options(header="true", multiLine="true").csv(path).columns), [path]) for path in own]
        else:
            names = next(csv.reader([row["header"].removeprefix("\ufeff")]))
            groups.append((tuple(name or f"_c{k}" for k, name in enumerate(names)), own))
    return sorted(groups, key=lambda group: group[1])


def _numbered(header: tuple[str, ...]) -> list[tuple[str, bool]]:
    """The names of a header and whether each is its first of that name; later ones are numbered."""
    seen: dict[str, int] = {}
    out = []
    for name in header:
        seen[name.lower()] = nth = seen.get(name.lower(), 0) + 1
        out.append((name if nth == 1 else f"{name}#{nth}", nth == 1))
    return out


def read_files(
    spark: SparkSession,
    paths: list[str],
    fmt: str,
    known: T.StructType | None = None,
    multi_line: bool = False,
    typed: bool = True,
    grow: bool = True,
) -> tuple[DataFrame, T.StructType]:
    """The rows of exactly these JSON or CSV files, and the columns known so far with those the files add.

    Columns are matched by name, whatever their order in a file, and none is lost: what a file has beyond the
    known columns is added, in JSON also inside objects and lists. What does not fit is kept in `_rescued_data`: of JSON the
    fields in question (see `rescue`), of CSV the text of the record. Without `grow` known columns stay all there is of JSON
    files, and what is new is rescued.
    """
    known = known or T.StructType()
    if fmt == "json":
        records = rescue.records(spark, paths, multi_line)
        schema = known if known.fields and not grow else grown(known, rescue.found_columns(records, typed))
        return rescue.with_rescue(records, schema), schema
    schema, parts = known, []
    for header, own in _by_header(spark, paths):
        names = _numbered(header)
        # Columns are matched by place, so that a name that occurs twice is read twice.
        by_place = T.StructType([T.StructField(name, T.StringType()) for name, _ in names])
        seen = infer_schema(spark, own, fmt, multi_line, typed).fields if typed else by_place.fields
        schema = grown(schema, T.StructType([T.StructField(name, f.dataType) for (name, first), f in zip(names, seen, strict=True) if first]))
        types = {f.name.lower(): f for f in schema.fields}
        order = T.StructType([types[name.lower()] if first else T.StructField(name, T.StringType()) for name, first in names])
        parts.append((order, [name for name, first in names if not first], own))
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(RESCUE, T.StringType())])), schema
    frames = []
    for order, again, own in parts:
        rows = read_raw(spark, own, fmt, order, multi_line, rescue=True)
        if again:
            # The values of a repeated name have no column.
            more = F.when(F.coalesce(*again).isNotNull(), F.to_json(F.struct(*[F.col(f"`{name}`") for name in again])))
            rows = rows.withColumn(RESCUE, F.coalesce(RESCUE, more)).drop(*again)
        frames.append(rows)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.select(*schema.fieldNames(), RESCUE), schema


def rescue_options(schema: T.StructType, fmt: str, multi_line: bool) -> tuple[T.StructType, dict[str, str]]:
    """Schema and options that keep the raw text of a record that did not parse in `_rescued_data`.

    The text is that of the whole record; it is null for a clean one.
    """
    with_rescue = T.StructType([*schema.fields, T.StructField(RESCUE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUE, **_options(fmt, multi_line)}
    return with_rescue, options


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    schema: T.StructType | None = None,
    multi_line: bool = False,
    typed: bool = True,
    rescue: bool = False,
) -> DataFrame:
    """Scan JSON, CSV (with header) or Parquet files; text formats infer types unless given or `typed=False`."""
    if fmt not in TEXT_FORMATS:
        return spark.read.format(fmt).load(path)
    if schema is None:
        schema = infer_schema(spark, path, fmt, multi_line, typed)
    options = _options(fmt, multi_line)
    if rescue:
        schema, options = rescue_options(schema, fmt, multi_line)
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def convert(spark: SparkSession, source: str, fmt: str, target: str, files: int = 16) -> None:
    """Rewrite Parquet as `fmt` (CSV with header), spread over `files` files, replacing the target."""
    writer = spark.read.parquet(source).repartition(files).write.mode("overwrite")
    if fmt in TEXT_FORMATS:
        writer = writer.options(**_FULL_TIMES)
    if fmt == "csv":
        # Blanks around a value are part of it; the writer would strip them.
        writer = writer.options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    writer.format(fmt).save(target)


def with_coordinates(countries: DataFrame) -> DataFrame:
    """Country rows with numeric coordinates; text that is no number becomes null."""
    return countries.withColumns({c: F.col(c).try_cast("double") for c in ("long_avg", "lat_avg")})
