"""Tables that runs keep up to date say what one pass over the whole log says."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import monitor
from ledgerwatch.operators.monitor_tables import MonitorTables
from ledgerwatch.sources.tables import append

COLUMNS = ["amount", "balance_orig_ratio"]
DAY = dt.date(2024, 1, 1)


def days(n):
    return DAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    n = F.col("id")
    df = spark.range(2000).select(
        (F.lit(DAY).cast("timestamp_ntz") + F.make_interval(hours=(n % 240).cast("int"))).alias("inference_timestamp"),
        (n % 2).cast("string").alias("model_version"),
        F.when(n % 11 != 0, (n % 7 == 0).cast("int")).alias("label"),
        (n % 5 == 0).cast("int").alias("prediction"),
        F.when(n % 13 != 0, F.pmod(n * 7919, F.lit(1000)) * 1000.0 + 1e6).alias("amount"),
        F.when(n > 1990, float("nan")).otherwise(F.pmod(n * 31, F.lit(10)) / 10).alias("balance_orig_ratio"),
        F.when(n % 17 != 0, (n % 3 == 0).cast("double")).alias("is_cross_border"),
    )
    path = str(tmp_path_factory.mktemp("log") / "rows")
    append(df, path, day_of="inference_timestamp")
    return spark.read.parquet(path)


def lines(df, digits=6):
    def plain(x):
        return str(round(x, digits)) if isinstance(x, float) else str(x)

    return sorted([plain(x) for x in r] for r in df.select(*sorted(df.columns)).collect())


def same(tables, log, baseline, window):
    bins = monitor.fix_bins(baseline)
    assert lines(tables.profile(window)) == lines(monitor.profile_metrics(log, COLUMNS, window=window))
    assert lines(tables.drift_consecutive(window)) == lines(monitor.drift_consecutive(log, bins, window=window))
    assert lines(tables.drift_baseline(window)) == lines(monitor.drift_baseline(log, baseline, bins, window=window))


def tables_of(spark, folder, log):
    tables = MonitorTables(spark, folder, COLUMNS)
    baseline = log.where(F.col("inference_timestamp") < F.lit(days(3)).cast("timestamp_ntz"))
    tables.fix_baseline(baseline)
    return tables, baseline


@pytest.mark.parametrize("window", ["1 day", "3 days"])
def test_runs_equal_one_pass(spark, folder, log, window):
    tables, baseline = tables_of(spark, folder, log)
    assert tables.until() is None
    for end in (2, 3, 7, 12):
        assert tables.refresh(log, days(end)) is not None
    assert tables.refresh(log, days(12)) is None and tables.until() == days(12)
    same(tables, log, baseline, window)


def test_days_taken_again(spark, folder, log):
    """Labels that came late, a day without rows left, and a run inside another."""
    tables, baseline = tables_of(spark, folder, log)
    unlabelled = log.withColumn("label", F.lit(None).cast("int"))
    tables.refresh(unlabelled, days(6))
    gone = log.where(F.to_date("inference_timestamp") != F.lit(days(4)))
    tables.refresh(log, days(12))
    tables.refresh(log, days(3), since=days(0))
    tables.refresh(gone, days(6), since=days(3))
    same(tables, gone, baseline, "1 day")
    same(tables, gone, baseline, "3 days")


def test_a_run_that_stopped_does_not_count(spark, folder, log):
    tables, baseline = tables_of(spark, folder, log)
    tables.refresh(log, days(5))
    # Rows are there, the mark is not.
    tables._profile_state(log).write.parquet(f"{folder}/profile/run=2")
    open(f"{folder}/claims/2", "w").close()
    tables.refresh(log, days(12))
    assert [n for n, _, _ in tables.runs()] == [1, 3]
    same(tables, log, baseline, "1 day")


def test_only_new_days_are_read(spark, folder, log, monkeypatch):
    tables, _ = tables_of(spark, folder, log)
    tables.refresh(log, days(9))
    seen = []
    monkeypatch.setattr(tables, "_profile_state", lambda rows: seen.append(rows) or MonitorTables._profile_state(tables, rows))
    tables.refresh(log, days(10))
    assert seen[0].count() == log.where(F.col("day") == F.lit(days(9))).count()
    assert "PartitionFilters: [isnotnull(day" in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_bins_are_fixed_first(spark, folder, log):
    tables, baseline = tables_of(spark, folder, log)
    tables.refresh(log, days(2))
    with pytest.raises(ValueError, match="first run"):
        tables.fix_baseline(baseline)
    with pytest.raises(FileNotFoundError):
        MonitorTables(spark, f"{folder}/none", COLUMNS).profile()
