"""Incremental file ingest: every file once, in small batches, to a Parquet folder.

A batch is written to a folder of its own and then marked as committed. Whoever follows the table follows the marks, not the files: a batch
without a mark has been read by nobody and may be written again, one with a mark never is, so a repeated batch changes nothing downstream.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerwatch.operators.quality import DROP, FAIL, Expectation, enforce
from ledgerwatch.sources.readers import TEXT_FORMATS, _options, grown, infer_schema, read_files, rescue_options
from ledgerwatch.sources.tables import VersionedTable, make_folder, marked, matching_paths

# Files per batch where nothing else is said: their names reach the driver.
MAX_FILES = 1000
# A file source passes over files much older than the newest one it has seen; none may be lost for its time stamp.
_ANY_AGE = "36500d"
_FILES = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class StreamTable:
    """Where a streaming table keeps its rows, its progress and its quality counts.

    A generation is one life of the table: a full refresh starts the next one from nothing.
    """

    folder: str
    generation: int = 1

    @property
    def data(self) -> str:
        return f"{self.folder}/g={self.generation}/data"

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/g={self.generation}/checkpoint"

    @property
    def quality(self) -> str:
        return f"{self.folder}/g={self.generation}/quality"

    @property
    def schema(self) -> str:
        return f"{self.folder}/g={self.generation}/schema"

    @property
    def commits(self) -> str:
        return f"{self.folder}/g={self.generation}/commits"


def remembered(spark: SparkSession, folder: str) -> tuple[T.StructType, dt.datetime] | None:
    """The columns noted in a folder and when."""
    notes = VersionedTable(spark, folder)
    if not notes.exists():
        return None
    note = notes.read().first()  # one row
    return T.StructType.fromJson(json.loads(note.columns)), note.noted_at


def remember(spark: SparkSession, folder: str, schema: T.StructType, noted_at: dt.datetime) -> None:
    row = spark.createDataFrame([(schema.json(), noted_at)], "columns string, noted_at timestamp_ntz")
    VersionedTable(spark, folder).replace(row)


def raw_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | None = None,
    max_files: int | None = 1,
    multi_line: bool = False,
    typed: bool = True,
    rescue: bool = False,
) -> DataFrame:
    """File stream over a folder. A file source needs its columns up front: they are inferred by one batch read."""
    if schema is None:
        schema = infer_schema(spark, path, fmt, multi_line, typed)
    options = _options(fmt, multi_line) if fmt in TEXT_FORMATS else {}
    if rescue:
        schema, options = rescue_options(schema, fmt, multi_line)
    reader = spark.readStream.format(fmt).schema(schema).options(**options, maxFileAge=_ANY_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _note_columns(spark: SparkSession, table: StreamTable, columns: T.StructType) -> None:
    past = remembered(spark, table.schema)
    merged = columns if past is None else grown(past[0], columns)
    if past is None or past[0] != merged:
        remember(spark, table.schema, merged, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


def committed(spark: SparkSession, table: StreamTable) -> int | None:
    """The newest committed batch; batches are committed in order."""
    return max((int(path.getName()) for path in matching_paths(spark, f"{table.commits}/[0-9]*")), default=None)


def write_batch(rows: DataFrame, table: StreamTable, expectations: Iterable[Expectation], number: int) -> None:
    """One batch in a folder of its own, then its counts, then its mark. A batch that has its mark is left as it is.

    The rows are read once: they are counted while they are written. A broken `fail` expectation ends the write.
    """
    spark = rows.sparkSession
    if matching_paths(spark, f"{table.commits}/{number}"):
        return
    expectations = list(expectations)
    counted, fatal = Observation(), [e for e in expectations if e.policy == FAIL]
    for e in fatal:
        rows = rows.where(F.when(e.holds(), True).otherwise(F.raise_error(F.lit(f"expectation {e.name}"))))
    if expectations:
        names = [F.count_if(e.holds()).alias(f"e{k}") for k, e in enumerate(expectations)]
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"), *names)
    kept = enforce(rows, [e for e in expectations if e.policy == DROP])
    kept.write.mode("overwrite").parquet(f"{table.data}/batch_id={number}")
    if expectations:
        found = counted.get
        lines = [(e.name, e.policy, found[f"e{k}"], found["rows"] - found[f"e{k}"], number) for k, e in enumerate(expectations)]
        counts = spark.createDataFrame(lines, "expectation string, policy string, passed long, failed long, batch long")
        counts.coalesce(1).write.mode("overwrite").parquet(f"{table.quality}/batch_id={number}")
    marked(spark, f"{table.commits}/{number}")


def append_stream(
    stream: DataFrame, table: StreamTable, expectations: Iterable[Expectation] = ()
) -> StreamingQuery:
    """Append all that is available, then stop. The checkpoint makes each input row count once.

    With expectations each batch is written with its counts; without them the file sink is used.
    """
    expectations = list(expectations)
    _note_columns(stream.sparkSession, table, stream.schema)
    writer = stream.writeStream.option("checkpointLocation", table.checkpoint).trigger(availableNow=True)
    if not expectations:
        return writer.format("parquet").outputMode("append").option("path", table.data).start()
    return writer.foreachBatch(lambda batch, number: write_batch(batch, table, expectations, number)).start()


def ingest_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    table: StreamTable,
    expectations: Iterable[Expectation] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int | None = None,
    multi_line: bool = False,
    typed: bool = True,
    grow: bool = True,
) -> StreamingQuery:
    """Append the rows of all JSON or CSV files that are new in a folder, each file once, then stop.

    The stream carries file names only. Each batch reads exactly its files, takes new columns from them whatever
    their time stamps, matches columns by name and rescues what does not fit, so that a change of
    shape loses nothing. Without `grow` the first batch settles the columns of JSON files.
    """
    expectations = list(expectations)
    names = spark.readStream.format("binaryFile").schema(_FILES).options(maxFilesPerTrigger=max_files or MAX_FILES, maxFileAge=_ANY_AGE)

    def write(batch: DataFrame, number: int) -> None:
        paths = sorted(r.path for r in batch.select("path").collect())  # at most max_files
        if not paths:
            return
        past = remembered(spark, f"{table.folder}/g={table.generation}/raw_columns")
        rows, columns = read_files(spark, paths, fmt, past[0] if past else None, multi_line, typed, grow)
        if past is None or past[0] != columns:
            now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            remember(spark, f"{table.folder}/g={table.generation}/raw_columns", columns, now)
        rows = prepare(rows) if prepare else rows
        _note_columns(spark, table, rows.schema)
        write_batch(rows, table, expectations, number)

    stream = names.load(path).select("path")
    return stream.writeStream.option("checkpointLocation", table.checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def follow(
    spark: SparkSession,
    source: StreamTable,
    table: StreamTable,
    transform: Callable[[DataFrame], DataFrame],
    expectations: Iterable[Expectation] = (),
    max_batches: int = MAX_FILES,
) -> StreamingQuery:
    """Append what `transform` makes of the committed batches of another table, each batch once, then stop.

    The stream carries the marks. Each of its batches reads the folders of its marks with all columns known by then, so columns that
    came later upstream flow on.
    """
    expectations = list(expectations)
    names = spark.readStream.format("binaryFile").schema(_FILES).options(maxFilesPerTrigger=max_batches, maxFileAge=_ANY_AGE)

    def write(batch: DataFrame, number: int) -> None:
        marks = sorted(int(r.path.rsplit("/", 1)[1]) for r in batch.select("path").collect())  # at most max_batches
        if not marks:
            return
        schema = table_schema(spark, source)
        rows = transform(spark.read.schema(schema).parquet(*[f"{source.data}/batch_id={n}" for n in marks]))
        _note_columns(spark, table, rows.schema)
        write_batch(rows, table, expectations, number)

    make_folder(spark, source.commits)  # of a table that has no batch yet
    stream = names.load(source.commits).select("path")
    return stream.writeStream.option("checkpointLocation", table.checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a triggered query; a failure inside is raised here."""
    query.awaitTermination()


def table_schema(spark: SparkSession, table: StreamTable) -> T.StructType:
    """All columns the table ever had, as noted by its writers; no file is opened for them."""
    past = remembered(spark, table.schema)
    return past[0] if past else spark.read.parquet(table.data).schema


def _committed_rows(spark: SparkSession, table: StreamTable, reader: DataFrame) -> DataFrame:
    """Without the rows of a batch that is not committed; the file sink keeps a log of its own instead of marks."""
    newest = committed(spark, table)
    return reader if newest is None else reader.where(F.col("batch_id") <= newest)


def read_table(spark: SparkSession, table: StreamTable) -> DataFrame:
    """The rows so far. Columns that came later are null in older rows."""
    schema = table_schema(spark, table)
    if committed(spark, table) is None:
        return spark.read.schema(schema).parquet(table.data).select(*schema.fieldNames())
    placed = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return _committed_rows(spark, table, spark.read.schema(placed).parquet(table.data)).select(*schema.fieldNames())


def read_quality(spark: SparkSession, table: StreamTable) -> DataFrame:
    """Counts per expectation over all committed batches."""
    counts = _committed_rows(spark, table, spark.read.parquet(table.quality))
    return counts.groupBy("expectation", "policy").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def table_stream(spark: SparkSession, table: StreamTable, max_bytes: int = 64 << 30) -> DataFrame:
    """Stream of the rows of a folder that only the file sink or other writers of whole files append to, in batches of about `max_bytes`.

    A table written in batches is followed by its marks instead (see `follow`).
    """
    reader = spark.readStream.schema(table_schema(spark, table)).option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(table.data)
