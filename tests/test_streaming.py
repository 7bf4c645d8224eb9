"""Streams give what the batch functions give, also after a restart with new files."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerwatch.functions.risk import RISK_SCORE
from ledgerwatch.operators.quality import DROP, FAIL, Expectation
from ledgerwatch.plans import layers
from ledgerwatch.queries import models
from ledgerwatch.sources.tables import bucketed
from ledgerwatch.streaming.flows import Lake, score_requests
from ledgerwatch.streaming.ingest import (
    StreamTable,
    append_stream,
    committed,
    follow,
    ingest_files,
    raw_stream,
    read_quality,
    read_table,
    run_to_end,
    table_stream,
    write_batch,
)
from tests.bank import frames


def files(folder, **contents):
    Path(folder).mkdir(parents=True, exist_ok=True)
    for name, text in contents.items():
        (Path(folder) / f"{name}.json").write_text(text)


def test_each_file_once(spark, folder):
    files(f"{folder}/raw", a='{"id": 1, "v": 1.5}\n{"id": 2, "v": 2.5}\n', b='{"id": 3, "v": 3.5}\n')
    table = StreamTable(f"{folder}/t")

    def run():
        query = ingest_files(spark, f"{folder}/raw", "json", table, max_files=1)
        run_to_end(query)
        return len([p for p in query.recentProgress if p["numInputRows"]])

    assert run() == 2  # one file per batch
    assert run() == 0  # nothing new
    files(f"{folder}/raw", c='{"id": 4, "v": 4.5, "extra": "x"}\n')
    assert run() == 1
    assert sorted((r.id, r.v, r.extra) for r in read_table(spark, table).collect()) == [(1, 1.5, None), (2, 2.5, None), (3, 3.5, None), (4, 4.5, "x")]


def test_quality_on_a_stream(spark, folder):
    files(f"{folder}/raw", a='{"id": 1}\n{"id": null}\n', b='{"id": 3}\n')
    table = StreamTable(f"{folder}/t")
    kept, seen = Expectation("known", "id IS NOT NULL", DROP), Expectation("small", "id < 3")
    run_to_end(append_stream(raw_stream(spark, f"{folder}/raw", "json"), table, [kept, seen]))
    assert sorted(r.id for r in read_table(spark, table).collect()) == [1, 3]
    counts = {r.expectation: (r.passed, r.failed) for r in read_quality(spark, table).collect()}
    assert counts == {"known": (2, 1), "small": (1, 2)}


def test_failing_expectation_stops_the_stream(spark, folder):
    files(f"{folder}/raw", a='{"id": null, "v": 1}\n')
    table = StreamTable(f"{folder}/t")
    query = append_stream(raw_stream(spark, f"{folder}/raw", "json"), table, [Expectation("known", "id IS NOT NULL", FAIL)])
    with pytest.raises(Exception, match="known"):
        run_to_end(query)


def write_raw(spark, folder, parts, mode="overwrite"):
    transactions, reports, countries, customers = parts
    transactions.drop("_rescued_data").coalesce(2).write.mode(mode).json(f"{folder}/transactions")
    csv = {"header": "true"}
    customers.drop("_rescued_data").coalesce(1).write.mode(mode).options(**csv).csv(f"{folder}/customers")
    countries.coalesce(1).write.mode(mode).options(**csv).csv(f"{folder}/country_code")
    reports.drop("_rescued_data").coalesce(1).write.mode(mode).options(**csv).csv(f"{folder}/fraud_report")


def test_lake_equals_batch_and_grows(spark, folder):
    parts = frames(spark)
    transactions, reports, countries, customers = parts
    early = reports.where("id <> 't1'")
    write_raw(spark, f"{folder}/raw", (transactions.where("step < 3"), early, countries, customers))
    lake = Lake(spark, f"{folder}/raw", f"{folder}/lake").refresh()

    def rows(df):
        return sorted((r.id, r.amount, r.is_fraud, r.countryDest, r.firstname, r.address) for r in df.collect())

    def batch(t, f):
        return rows(layers.gold(layers.silver(t, f), countries, customers))

    assert rows(lake.gold.read()) == batch(transactions.where("step < 3"), early)

    # New files: the late report on t1 does not revise the row that silver already has.
    later = transactions.where("step >= 3").drop("_rescued_data")
    later.coalesce(1).write.mode("append").json(f"{folder}/raw/transactions")
    reports.where("id = 't1'").drop("_rescued_data").coalesce(1).write.mode("append").option("header", "true").csv(f"{folder}/raw/fraud_report")
    lake.refresh()
    assert rows(lake.gold.read()) == batch(transactions, early) and lake.gold.versions() == [1, 2]
    counts = {r.expectation: (r.passed, r.failed) for r in lake.gold_quality.read().collect()}
    assert counts == {"amount_decent": (2, 2)}
    quality = read_quality(spark, lake.stream_table("silver_transactions")).collect()
    assert {(r.expectation, r.passed) for r in quality} == {
        ("correct_data", 6), ("correct_customer_id", 6), ("readable_label", 6)
    }
    customers_ok = read_quality(spark, lake.stream_table("banking_customers")).first()
    assert (customers_ok.expectation, customers_ok.passed, customers_ok.failed) == ("correct_schema", 2, 0)

    # A full refresh sees all reports.
    fresh = lake.refresh(full=True)
    assert rows(fresh.gold.read()) == batch(transactions, reports)
    assert Lake(spark, f"{folder}/raw", f"{folder}/lake").generation == fresh.generation == 2


def test_scores_on_a_stream(spark, folder):
    snapshot = spark.createDataFrame(
        [("a", 300_000.0, 0.95, 1.0, 1.0)],
        "transaction_id string, amount double, balance_orig_ratio double, is_full_transfer double, is_cross_border double",
    )
    files(f"{folder}/raw", r='{"transaction_id": "a"}\n{"transaction_id": "unknown"}\n')
    requests = raw_stream(spark, f"{folder}/raw", "json")
    table = StreamTable(f"{folder}/scores")
    run_to_end(append_stream(score_requests(requests, snapshot, RISK_SCORE.add_to), table))
    found = {r.transaction_id: (r.amount, round(r.risk_score, 6)) for r in read_table(spark, table).collect()}
    assert found == {"a": (300_000.0, 0.8), "unknown": (None, 0.0)}


def test_a_batch_leaves_the_bucketed_snapshot_where_it_is(spark, folder, no_broadcast):
    rows = [(str(k), k) for k in range(500)] + [(None, -1), ("7", -7)]
    snapshot = bucketed(spark.createDataFrame(rows, "key string, value long"), "key", "snapshot")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 0 < len(snapshot.inputFiles()) <= parts
    files(f"{folder}/raw", r='{"key": "3"}\n{"key": "7"}\n{"key": "none"}\n{"other": 1}\n')
    requests = raw_stream(spark, f"{folder}/raw", "json").select("key")
    joined = score_requests(requests, snapshot, lambda df: df.select("key", "value"), "key")
    stream = joined.writeStream.queryName("asked").format("memory").option("checkpointLocation", f"{folder}/marks").trigger(availableNow=True).start()
    stream.awaitTermination()
    plan = stream._jsq.explainInternal(False)
    plan = plan.split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan
    found = [(r.key, r.value) for r in spark.table("asked").collect()]
    assert sorted(found, key=repr) == sorted([("3", 3), ("7", 7), ("7", -7), ("none", None), (None, None)], key=repr)


def test_chained_stream(spark, folder):
    spark.range(10).write.parquet(f"{folder}/up/g=1/data")
    up, down = StreamTable(f"{folder}/up"), StreamTable(f"{folder}/down")
    run_to_end(append_stream(table_stream(spark, up).withColumn("x", F.col("id") * 2), down))
    assert read_table(spark, down).agg(F.sum("x")).first()[0] == 90


def ingested(spark, folder, fmt="json", **options):
    table = StreamTable(f"{folder}/t")
    run_to_end(ingest_files(spark, f"{folder}/raw", fmt, table, **options))
    return read_table(spark, table)


def test_columns_grow_and_keep_their_type(spark, folder):
    files(f"{folder}/raw", a='{"id": 1}\n')
    assert ingested(spark, folder).schema.simpleString() == "struct<id:bigint,_rescued_data:string>"
    files(f"{folder}/raw", b='{"id": "x", "v": 1.5}\n')
    found = ingested(spark, folder)
    assert dict(found.dtypes) == {"id": "bigint", "v": "double", "_rescued_data": "string"}
    # The field that does not fit is rescued, the other one keeps its column.
    assert {r.id: (r.v, r._rescued_data) for r in found.collect()} == {1: (None, None), None: (1.5, '{"id":"x"}')}


def test_an_old_file_brings_its_columns(spark, folder):
    """A file with an old time stamp is taken in, with a field that no other file has."""
    import os

    files(f"{folder}/raw", a='{"id": 1}\n')
    ingested(spark, folder)
    files(f"{folder}/raw", b='{"id": 2, "fee": 0.5}\n')
    os.utime(f"{folder}/raw/b.json", (1_000_000_000, 1_000_000_000))
    assert {r.id: r.fee for r in ingested(spark, folder).collect()} == {1: None, 2: 0.5}
    assert ingested(spark, folder).count() == 2


def test_csv_columns_are_matched_by_name(spark, folder):
    raw = Path(f"{folder}/raw")
    raw.mkdir(parents=True)
    (raw / "a.csv").write_text("id,name,city\n1,Ann,Oslo\n")
    (raw / "b.csv").write_text("id,city,name\n2,Paris,Cid\n")
    ingested(spark, folder, "csv")
    (raw / "c.csv").write_text("id,name,mail,City\n3,Dan,d@x,Rome\n4,only,two\n")
    (raw / "empty.csv").write_text("")
    found = {r.id: (r.name, r.city, r.mail, r._rescued_data) for r in ingested(spark, folder, "csv").collect()}
    assert found == {1: ("Ann", "Oslo", None, None), 2: ("Cid", "Paris", None, None), 3: ("Dan", "Rome", "d@x", None), 4: ("only", None, "two", "4,only,two")}


def test_a_repeated_batch_replaces_itself(spark, folder):
    table, seen = StreamTable(f"{folder}/t"), [Expectation("small", "id < 3")]
    for _ in range(2):
        write_batch(spark.range(5).toDF("id"), table, seen, 0)
    assert spark.read.parquet(table.data).count() == 5
    assert [(r.passed, r.failed) for r in read_quality(spark, table).collect()] == [(3, 2)]


def chained(spark, up, down):
    run_to_end(follow(spark, up, down, lambda rows: rows.withColumn("x", F.col("id") * 2), [Expectation("small", "id < 3")]))
    return sorted(r.x for r in read_table(spark, down).collect())


def test_a_batch_repeated_after_it_was_read_changes_nothing_downstream(spark, folder):
    up, down = StreamTable(f"{folder}/up"), StreamTable(f"{folder}/down")
    write_batch(spark.range(5).toDF("id"), up, [], 0)
    assert chained(spark, up, down) == [0, 2, 4, 6, 8]
    write_batch(spark.range(5).toDF("id"), up, [], 0)
    write_batch(spark.range(5, 7).toDF("id"), up, [], 1)
    assert chained(spark, up, down) == [0, 2, 4, 6, 8, 10, 12]
    assert [(r.passed, r.failed) for r in read_quality(spark, down).collect()] == [(3, 4)]


def test_a_batch_without_its_mark_is_seen_by_nobody(spark, folder):
    """The writer stopped between the rows and the mark; the batch comes again, with other files."""
    up, down = StreamTable(f"{folder}/up"), StreamTable(f"{folder}/down")
    write_batch(spark.range(2).toDF("id"), up, [], 0)
    spark.range(2, 5).toDF("id").write.parquet(f"{up.data}/batch_id=1")
    assert chained(spark, up, down) == [0, 2]
    assert read_table(spark, up).count() == 2
    write_batch(spark.range(2, 5).toDF("id").repartition(3), up, [], 1)
    assert chained(spark, up, down) == [0, 2, 4, 6, 8] and read_table(spark, up).count() == 5


@pytest.mark.parametrize("marked", [True, False])
def test_a_follower_that_stopped_takes_its_batch_up_again(spark, folder, marked):
    """The checkpoint does not know the last batch as done; its mark may have been set or not."""
    up, down = StreamTable(f"{folder}/up"), StreamTable(f"{folder}/down")
    write_batch(spark.range(3).toDF("id"), up, [], 0)
    assert chained(spark, up, down) == [0, 2, 4]
    for name in ("commits/0", "commits/.0.crc"):
        Path(f"{down.checkpoint}/{name}").unlink(missing_ok=True)
    if not marked:
        Path(f"{down.commits}/0").unlink()
        assert committed(spark, down) is None
    write_batch(spark.range(3, 4).toDF("id"), up, [], 1)
    assert chained(spark, up, down) == [0, 2, 4, 6]


def test_columns_that_come_later_upstream_flow_on(spark, folder):
    up, down = StreamTable(f"{folder}/up"), StreamTable(f"{folder}/down")
    for k, record in enumerate(('{"id": 1}', '{"id": 2, "fee": {"now": 0.5}}')):
        files(f"{folder}/raw", **{f"f{k}": record + "\n"})
        run_to_end(ingest_files(spark, f"{folder}/raw", "json", up))
        chained(spark, up, down)
    assert {r.id: r.fee and r.fee.now for r in read_table(spark, down).collect()} == {1: None, 2: 0.5}


def test_following_a_table_without_batches(spark, folder):
    up, down = StreamTable(f"{folder}/up"), StreamTable(f"{folder}/down")
    run_to_end(follow(spark, up, down, lambda rows: rows))
    assert committed(spark, down) is None


def test_no_task_of_the_silver_chain_writes_a_fixed_share(spark, small, tmp_path, monkeypatch):
    """As many raw files as a shuffle has parts, still in two batches."""
    monkeypatch.setattr(models, "scratch", lambda spark, name: str(tmp_path / name))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = queries()["stream_silver"](spark, small).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows == spark.read.parquet(f"{small}/orders.parquet").count()
    assert len(list((tmp_path / "silver" / "raw").glob("*.json"))) == 7
    assert len(list((tmp_path / "silver" / "bronze" / "g=1" / "commits").glob("[0-9]*"))) == 2
