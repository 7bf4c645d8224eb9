"""Parquet tables on shared storage: replace in place, append, grow columns, upsert."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators import keyed


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, named by `spark.checkpoint.dir`; a local run may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    """One temporary folder for a local session that names none."""
    return tempfile.mkdtemp(prefix="ledgerwatch-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once below the shared folder and read back, for plans that use it several times."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def bucketed(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """`df` stored in buckets by `key`, each one sorted file, and read back: a join by `key` moves only its other side.

    As many buckets as a shuffle has partitions, if no number is given; with fewer Spark may move both sides. The table is
    an entry of the session's catalog over a folder below the shared one. A join reads all buckets, of the columns it needs.
    """
    spark = df.sparkSession
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder, table = scratch(spark, name), f"{name}_{uuid.uuid4().hex}"
    df.repartition(number, key).write.bucketBy(number, key).sortBy(key).option("path", folder).saveAsTable(table)
    return spark.table(table)


def matching_paths(spark: SparkSession, pattern: str) -> list:
    """Paths that match a glob, on any file system Spark can read."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [found.getPath() for found in system.globStatus(glob) or []]


def make_folder(spark: SparkSession, path: str) -> None:
    """Creates a folder that is not there yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def claimed(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; false if it is there already."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(file.getParent())
    return bool(system.createNewFile(file))


def marked(spark: SparkSession, path: str) -> None:
    """Creates a file of one line, in one step: it is there whole or not at all."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    file = hadoop.Path(path)
    system = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    draft = hadoop.Path(file.getParent(), f".{file.getName()}-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.writeBytes("committed\n")
    out.close()
    if not system.rename(draft, file):
        raise OSError(f"{path} was not created")


class VersionedTable:
    """A table that is replaced as a whole while it may be read, also by the plan that replaces it.

    Each write goes to its own folder `v=<n>`. A version exists once its success marker does, which the
    committer writes last, so a failed write is never seen. The previous versions stay readable.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def versions(self) -> list[int]:
        found = matching_paths(self.spark, f"{self.path}/v=*/_SUCCESS")
        return sorted(int(marker.getParent().getName()[2:]) for marker in found)

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        if version is None:
            versions = self.versions()
            if not versions:
                raise FileNotFoundError(self.path)
            version = versions[-1]
        return self.spark.read.parquet(f"{self.path}/v={version}")

    def replace(self, df: DataFrame, sort_by: Sequence[str] = ()) -> int:
        """Write a new version, schema included. Sorting within files lets readers skip row groups.

        The number is claimed first by a file that only one writer can create, so two writers never share a version.
        """
        version = max(self.versions(), default=0) + 1
        while not claimed(self.spark, f"{self.path}/claims/{version}"):
            version += 1
        rows = df.sortWithinPartitions(*sort_by) if sort_by else df
        rows.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        return version

    def upsert(self, source: DataFrame, keys: Sequence[str]) -> int:
        """Merge rows by key, creating the table if it is missing."""
        return self.replace(keyed.upsert(self.read() if self.exists() else None, source, keys))

    def update_from(self, source: DataFrame, keys: Sequence[str], values: Sequence[str]) -> int:
        return self.replace(keyed.update_from(self.read(), source, keys, values))

    def changes(self, keys: Sequence[str], since: int, until: int | None = None) -> DataFrame:
        """Row-level changes between two versions."""
        return keyed.changes(self.read(since), self.read(until), keys)

    def snapshot(self, key: str | Sequence[str], ts: str) -> DataFrame:
        """The newest row per key, stamped with the version it was read from."""
        version = self.versions()[-1]
        return keyed.latest_snapshot(self.read(version), key, ts, F.lit(version))


def append(df: DataFrame, path: str, day_of: str | None = None) -> None:
    """Add rows to a Parquet folder, in one folder per day of `day_of` if given."""
    if day_of is None:
        df.write.mode("append").parquet(path)
    else:
        df.withColumn("day", F.to_date(day_of)).write.mode("append").partitionBy("day").parquet(path)


_MANIFEST = "folder string, version long, columns string"


def _manifest(spark: SparkSession, path: str) -> tuple[int | None, dict[str, int], T.StructType | None]:
    """The newest version of a partitioned table: which version each partition's folder is of, and the columns."""
    table = VersionedTable(spark, f"{path}/manifest")
    versions = table.versions()
    if not versions:
        return None, {}, None
    rows = table.read(versions[-1]).collect()  # one row per partition
    return versions[-1], {r.folder: r.version for r in rows}, T.StructType.fromJson(json.loads(rows[0].columns)) if rows else None


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that `upsert_partitions` keeps, as of its newest version."""
    newest, folders, columns = _manifest(spark, path)
    if newest is None or columns is None:
        raise FileNotFoundError(path)
    placed = T.StructType([*columns.fields, T.StructField("v", T.LongType())])
    paths = [f"{path}/data/v={version}/{folder}" for folder, version in folders.items()]
    return spark.read.schema(placed).option("basePath", f"{path}/data").parquet(*paths).select(*columns.fieldNames())


def upsert_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition: str
) -> None:
    """Merge rows by key into a table of one folder per value of `partition`, rewriting only the partitions `source` touches.

    `partition` must follow from the key, so that a row never has its match in another partition. The merged partitions are written
    beside the old ones; a manifest that names the folders that count, written last, switches to them all at once. Until
    then, and if the write stops on its way, readers see the old table whole. If another writer was faster, the write is refused and may be
    repeated. Rows without a partition value are a partition of their own. No column may be called `v`.
    """
    if "v" == partition or "v" in source.columns:
        raise ValueError("a column named v")
    incoming = staged(source, "upsert")
    base, folders, _ = _manifest(spark, path)
    if folders:
        stored = read_partitions(spark, path)
        # A join on the partition column: the scan skips every partition that is not touched.
        target = stored.join(incoming.select(partition).where(F.col(partition).isNotNull()).distinct(), partition, "left_semi")
        if not incoming.where(F.col(partition).isNull()).isEmpty():
            # A null matches nothing in a join, but the new folder replaces its partition all the same.
            target = target.unionByName(stored.where(F.col(partition).isNull()))
        merged = keyed.upsert(target, incoming, keys)
    else:
        merged = keyed.upsert(None, incoming, keys)
    version = (base or 0) + 1
    while not claimed(spark, f"{path}/claims/{version}"):
        version += 1
    merged.write.partitionBy(partition).parquet(f"{path}/data/v={version}")
    written = {found.getName(): version for found in matching_paths(spark, f"{path}/data/v={version}/{partition}=*")}
    columns = merged.schema.json()
    rows = [(folder, n, columns) for folder, n in {**folders, **written}.items()]
    manifest = VersionedTable(spark, f"{path}/manifest")
    if max(manifest.versions(), default=None) != base:
        raise RuntimeError(f"{path} was changed by another writer: repeat the upsert")
    if rows:
        manifest.replace(spark.createDataFrame(rows, _MANIFEST).coalesce(1))


def append_lineage(df: DataFrame, path: str, run_id: str, at: Column, at_name: str = "computed_at") -> None:
    """Append rows with the run they come from; new columns are allowed (see `read_grown`)."""
    append(df.withColumns({"run_id": F.lit(run_id), at_name: at}), path)


def read_grown(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder whose files may have gained columns; rows written before have nulls there."""
    return spark.read.option("mergeSchema", "true").parquet(path)
