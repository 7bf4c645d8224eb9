"""Raw files, rescue column, conversion and tables."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerwatch.sources import tables
from ledgerwatch.sources.readers import convert, infer_schema, read_raw, with_coordinates
from ledgerwatch.sources.tables import VersionedTable

ROWS = [(1, " a, \"b\"\nc ", 1.5, dt.datetime(2024, 1, 1, 1, 2, 3, 456789)), (2, None, None, None)]
SCHEMA = "id int, note string, v double, at timestamp_ntz"


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_conversion_round_trip(spark, folder, fmt):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{folder}/src")
    convert(spark, f"{folder}/src", fmt, f"{folder}/dst", files=2)
    back = read_raw(spark, f"{folder}/dst", fmt, multi_line=fmt == "csv")
    found = sorted((r.id, r.note, r.v, r["at"]) for r in back.select("id", "note", "v", F.col("at").cast("timestamp_ntz")).collect())
    assert found == ROWS
    convert(spark, f"{folder}/src", fmt, f"{folder}/dst", files=1)  # replaces
    assert read_raw(spark, f"{folder}/dst", fmt, multi_line=fmt == "csv").count() == 2


def test_sixteen_files(spark, folder, tmp_path):
    spark.range(1000).write.parquet(f"{folder}/src")
    convert(spark, f"{folder}/src", "json", f"{folder}/dst")
    assert len(spark.read.json(f"{folder}/dst").inputFiles()) == 16


def write(folder, name, text):
    from pathlib import Path

    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text(text)


def test_untyped_read_is_all_text(spark, folder):
    write(folder, "c.csv", "alpha3_code,country,long_avg,lat_avg\nFRA,France,2.5,46\nATA,Antarctica,none,\n")
    raw = read_raw(spark, folder, "csv", typed=False)
    assert {t for _, t in raw.dtypes} == {"string"}
    placed = {r.alpha3_code: (r.long_avg, r.lat_avg) for r in with_coordinates(raw).collect()}
    assert placed == {"FRA": (2.5, 46.0), "ATA": (None, None)}


@pytest.mark.parametrize("multi_line", [False, True])
def test_rescue_column(spark, folder, multi_line):
    write(folder, "good.csv", "id,age_group\n1,2.0\n2,3.0\n")
    schema = infer_schema(spark, folder, "csv", multi_line)
    write(folder, "more.csv", "id,age_group\n3,4.0\nx4,five\n")
    found = read_raw(spark, folder, "csv", schema=schema, multi_line=multi_line, rescue=True).collect()
    rescued = [r._rescued_data for r in found if r._rescued_data is not None]
    assert len(found) == 4 and rescued == ["x4,five"]


def test_rescue_column_json(spark, folder):
    write(folder, "a.json", '{"id": 1, "v": 2}\n{"id": "x", "v": 3}\n')
    found = read_raw(spark, folder, "json", schema=spark.createDataFrame([], "id long, v long").schema, rescue=True)
    assert {r.id: r._rescued_data for r in found.cache().collect()} == {1: None, None: '{"id": "x", "v": 3}'}


def test_table_may_be_replaced_from_itself(spark, folder):
    table = VersionedTable(spark, folder)
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.replace(spark.range(3).toDF("id")) == 1
    assert table.replace(table.read().withColumn("id", F.col("id") + 10).withColumn("x", F.lit("new"))) == 2
    assert sorted(r.id for r in table.read().collect()) == [10, 11, 12] and table.read().columns == ["id", "x"]
    assert sorted(r.id for r in table.read(1).collect()) == [0, 1, 2]


def test_unfinished_version_is_not_seen(spark, folder):
    table = VersionedTable(spark, folder)
    table.replace(spark.range(3).toDF("id"))
    write(f"{folder}/v=2", "part-0.parquet", "half")
    assert table.versions() == [1] and table.read().count() == 3
    assert table.replace(spark.range(5).toDF("id")) == 2 and table.read().count() == 5


def test_keyed_table(spark, folder):
    table = VersionedTable(spark, folder)
    schema = "id int, ts int, v string"
    table.upsert(spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], schema), ["id", "ts"])
    table.upsert(spark.createDataFrame([(1, 2, "B"), (2, 1, "c")], schema), ["id", "ts"])
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, 1, "a"), (1, 2, "B"), (2, 1, "c")]
    kinds = sorted((r.id, r.ts, r.change_type) for r in table.changes(["id", "ts"], since=1).collect())
    assert kinds == [(1, 2, "update_post"), (1, 2, "update_pre"), (2, 1, "insert")]
    latest = sorted((r.id, r.v, r.snapshot_version) for r in table.snapshot("id", "ts").collect())
    assert latest == [(1, "B", 2), (2, "c", 2)]
    table.update_from(spark.createDataFrame([(2, 1, None)], schema), ["id", "ts"], ["v"])
    assert {r.id: r.v for r in table.read().where("ts = 1").collect()} == {1: "a", 2: None}


def test_append_with_new_columns(spark, folder):
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    tables.append_lineage(spark.createDataFrame([(1, "x")], "n int, feature string"), folder, "run-1", at)
    tables.append_lineage(spark.createDataFrame([(2, "y", 0.5)], "n int, feature string, err double"), folder, "run-2", at)
    grown = {r.run_id: (r.n, r.err) for r in tables.read_grown(spark, folder).collect()}
    assert grown == {"run-1": (1, None), "run-2": (2, 0.5)}


def test_log_is_kept_by_day(spark, folder):
    log = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2024-01-01 10:00:00'), (2, timestamp_ntz'2024-01-02') AS t(id, at)")
    tables.append(log, folder, day_of="at")
    tables.append(log, folder, day_of="at")
    day = spark.read.parquet(folder).where("day = date'2024-01-02'")
    assert day.count() == 2 and "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().toString()


def test_two_writers_never_share_a_version(spark, folder):
    table = VersionedTable(spark, folder)
    assert tables.claimed(spark, f"{folder}/claims/1")  # another writer is at work on it
    assert table.replace(spark.range(3).toDF("id")) == 2 and table.versions() == [2]


def test_upsert_keeps_rows_without_partition(spark, folder):
    schema = "id int, day string, text string"
    tables.upsert_partitions(spark, folder, spark.createDataFrame([(1, None, "a"), (2, "d1", "b")], schema), ["id"], "day")
    tables.upsert_partitions(spark, folder, spark.createDataFrame([(3, None, "c"), (1, None, "A")], schema), ["id"], "day")
    tables.upsert_partitions(spark, folder, spark.createDataFrame([(2, "d1", "B")], schema), ["id"], "day")
    found = sorted((r.id, r.day, r.text) for r in tables.read_partitions(spark, folder).collect())
    assert found == [(1, None, "A"), (2, "d1", "B"), (3, None, "c")]


def test_shared_folder_comes_from_the_session(spark):
    assert tables.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_upsert_rewrites_only_touched_partitions(spark, folder):
    schema = "id int, day string, text string"
    first = [(1, "d1", "a"), (2, "d1", "b"), (3, "d2", "c")]
    tables.upsert_partitions(spark, folder, spark.createDataFrame(first, schema), ["id", "day"], "day")
    untouched = [f for f in tables.read_partitions(spark, folder).inputFiles() if "day=d2" in f]
    later = [(2, "d1", "B"), (4, "d1", "d"), (5, "d3", "e")]
    tables.upsert_partitions(spark, folder, spark.createDataFrame(later, schema), ["id", "day"], "day")
    found = tables.read_partitions(spark, folder)
    assert sorted((r.id, r.day, r.text) for r in found.collect()) == [
        (1, "d1", "a"), (2, "d1", "B"), (3, "d2", "c"), (4, "d1", "d"), (5, "d3", "e")
    ]
    assert [f for f in found.inputFiles() if "day=d2" in f] == untouched


def test_partitions_switch_at_once(spark, folder, monkeypatch):
    """A writer that stops between its partitions and the manifest changes nothing; its work may be repeated."""
    schema = "id int, day string, v_ string"
    tables.upsert_partitions(spark, folder, spark.createDataFrame([(1, "1", "a"), (2, "2", "b")], schema), ["id"], "day")
    later = spark.createDataFrame([(1, "1", "A"), (3, "3", "c")], schema)

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(tables.VersionedTable, "replace", stop)
        with pytest.raises(OSError, match="stopped"):
            tables.upsert_partitions(spark, folder, later, ["id"], "day")
    # One of the new partitions is there, the other is not.
    assert {r["day"] for r in spark.read.parquet(f"{folder}/data/v=2").collect()} == {1, 3}
    shutil.rmtree(f"{folder}/data/v=2/day=3")
    old = tables.read_partitions(spark, folder)
    assert sorted((r.id, r.day, r.v_) for r in old.collect()) == [(1, "1", "a"), (2, "2", "b")]
    tables.upsert_partitions(spark, folder, later, ["id"], "day")
    found = tables.read_partitions(spark, folder)
    assert sorted((r.id, r.day, r.v_) for r in found.collect()) == [(1, "1", "A"), (2, "2", "b"), (3, "3", "c")]
    # Who reads the old version still can.
    assert sorted(r.v_ for r in old.collect()) == ["a", "b"]


def test_a_faster_writer_is_not_overwritten(spark, folder, monkeypatch):
    schema = "id int, day string"
    one = spark.createDataFrame([(1, "a")], schema)
    tables.upsert_partitions(spark, folder, one, ["id"], "day")
    whole = tables.claimed

    def claimed(session, path):
        # Another writer comes in between.
        monkeypatch.setattr(tables, "claimed", whole)
        tables.upsert_partitions(spark, folder, spark.createDataFrame([(2, "a")], schema), ["id"], "day")
        return whole(session, path)

    monkeypatch.setattr(tables, "claimed", claimed)
    with pytest.raises(RuntimeError, match="repeat"):
        tables.upsert_partitions(spark, folder, spark.createDataFrame([(3, "a")], schema), ["id"], "day")
    assert {r.id for r in tables.read_partitions(spark, folder).collect()} == {1, 2}


def test_headers_of_many_files_take_one_job_per_header(spark, folder):
    """Names in any order, blank lines before the header, quoted names, a byte order mark, odd file names."""
    from ledgerwatch.sources.readers import read_files

    names = [f"{k} %20ü#{'+' * (k % 3)}.csv" for k in range(60)]
    for k, name in enumerate(names):
        write(folder, name, ("id,name\n" if k % 2 else "\n\ufeffname,id\n" if k % 4 else '"name",id\n') + (f"{k},n{k}\n" if k % 2 else f"n{k},{k}\n"))
    write(folder, "none.csv", "\n\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    found, schema = read_files(spark, [f"file:{folder}/{name}" for name in [*names, "none.csv"]], "csv")
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs <= 12
    assert {(r.id, r.name) for r in found.collect()} == {(k, f"n{k}") for k in range(60)} and found.count() == 60


def test_a_name_that_occurs_twice(spark, folder):
    from ledgerwatch.sources.readers import read_files

    write(folder, "a.csv", "id,name,Name\n1,Ann,Lee\n2,Bo,\n")
    write(folder, "b.csv", '"id","two\nlines"\n3,x\n')
    found, schema = read_files(spark, [f"{folder}/a.csv", f"{folder}/b.csv"], "csv", multi_line=True)
    assert schema.fieldNames() == ["id", "name", "two\nlines"]
    assert {r.id: (r.name, r._rescued_data) for r in found.collect()} == {1: ("Ann", '{"Name#2":"Lee"}'), 2: ("Bo", None), 3: (None, None)}
