"""Monitor tables kept up to date: each run reads the new days of the log only.

A run takes whole days, from the end of the runs before it. It appends, per day, what profile and drift metrics are made of: counts, means
with their sums of squared differences, extremes, and rows per bin. These merge over days, so the metrics of any window of whole days are
read from them without the log. A run over days that were taken before, such as after labels came late, replaces these days. What a run has written
counts once its mark is set; a run that stopped is as if it had not been.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.operators import monitor
from ledgerwatch.operators.metrics import MISSED_FRAUD, confusion_counts
from ledgerwatch.sources.tables import claimed, marked, matching_paths

_COUNTS = ("n", "labelled", "tn", "fp", "fn", "tp", "missed")
_FIRST = dt.date(1, 1, 1)


class MonitorTables:
    """The stored state of a monitored log below `folder`. `columns` are profiled; drift needs a baseline (`fix_baseline`)."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        columns: Sequence[str],
        ts: str = "inference_timestamp",
        version: str = "model_version",
        slices: Mapping[str, str] = monitor.SLICES,
    ):
        self.spark, self.folder, self.columns = spark, folder.rstrip("/"), list(columns)
        self.ts, self.version, self.slices = ts, version, slices

    def runs(self) -> list[tuple[int, dt.date, dt.date]]:
        """Number, first day and end of every finished run; one per refresh."""
        names = [path.getName().split("_") for path in matching_paths(self.spark, f"{self.folder}/runs/[0-9]*")]
        return sorted((int(n), dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for n, a, b in names)

    def until(self) -> dt.date | None:
        """The day that the next run begins with."""
        return max((end for _, _, end in self.runs()), default=None)

    def fix_baseline(self, baseline: DataFrame, columns: Sequence[str] = monitor.DRIFT_COLUMNS) -> None:
        """Stores the bins of a baseline and its rows per bin. States of other bins do not compare, so this comes before the first run."""
        if self.runs():
            raise ValueError("the bins are fixed before the first run")
        bins = monitor.fix_bins(baseline, columns)
        monitor.bins_table(self.spark, bins).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/bins")
        monitor.bin_counts(baseline, bins, []).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/reference")

    def bins(self) -> list[monitor.Bins]:
        fixed = matching_paths(self.spark, f"{self.folder}/bins/_SUCCESS")
        return monitor.stored_bins(self.spark.read.parquet(f"{self.folder}/bins")) if fixed else []

    def refresh(self, log: DataFrame, until: dt.date, since: dt.date | None = None) -> int | None:
        """Takes in the days from `since` (the end of the runs so far, if not given) up to `until`, which is not included.

        A log in folders by `day` is read in these folders only.
        """
        since = since or self.until() or _FIRST
        if since >= until:
            return None
        first, end = (F.lit(day.isoformat()).cast("date") for day in (since, until))
        rows = log.where((F.col(self.ts) >= first.cast("timestamp_ntz")) & (F.col(self.ts) < end.cast("timestamp_ntz")))
        if "day" in log.columns:
            rows = rows.where((F.col("day") >= first) & (F.col("day") < end))
        run = max((n for n, _, _ in self.runs()), default=0) + 1
        while not claimed(self.spark, f"{self.folder}/claims/{run}"):
            run += 1
        self._profile_state(rows).write.parquet(f"{self.folder}/profile/run={run}")
        if bins := self.bins():
            counted = monitor.bin_counts(rows, bins, [F.to_date(self.ts).alias("__day"), F.col(self.version)])
            counted.write.parquet(f"{self.folder}/histograms/run={run}")
        marked(self.spark, f"{self.folder}/runs/{run}_{since}_{until}")
        return run

    def _profile_state(self, rows: DataFrame) -> DataFrame:
        missed = (F.col("prediction") != F.col("label")) & (F.col("label").cast("int") == 1)
        values = [F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), *[c.alias(k) for k, c in confusion_counts().items()], F.count_if(missed).alias("missed")]
        for i, c in enumerate(self.columns):
            value = F.col(c).cast("double")
            away = F.var_pop(value) * F.count(value)
            values += [F.count(value).alias(f"__count_{i}"), F.avg(value).alias(f"__mean_{i}"), away.alias(f"__away_{i}"), F.min(value).alias(f"__min_{i}"), F.max(value).alias(f"__max_{i}")]
        return monitor.by_slice(rows, {"__day": F.to_date(self.ts), self.version: F.col(self.version)}, self.slices, values)

    def _state(self, name: str) -> DataFrame:
        """The states that count: those of finished runs, but for days that a later run has taken again."""
        runs = self.runs()
        if not runs:
            raise FileNotFoundError(f"{self.folder} has no finished run")
        states = self.spark.read.option("basePath", f"{self.folder}/{name}").parquet(*[f"{self.folder}/{name}/run={n}" for n, _, _ in runs])
        again = [(n, a, b) for n, a, b in runs if any(m < n and a < end and first < b for m, first, end in runs)]
        if again:
            listed = self.spark.createDataFrame(again, "run int, since date, until date").agg(F.collect_list(F.struct("run", "since", "until"))).scalar()
            taken = F.exists("__again", lambda r: (r["run"] > F.col("run")) & (r["since"] <= F.col("__day")) & (F.col("__day") < r["until"]))
            states = states.withColumn("__again", listed).where(~taken).drop("__again")
        return states.drop("run")

    def _windows(self, states: DataFrame, window: str) -> DataFrame:
        return states.withColumn("window", F.window(F.col("__day").cast("timestamp_ntz"), window))

    def profile(self, window: str = "1 day") -> DataFrame:
        """As `monitor.profile_metrics` over the days taken in, for windows of whole days."""
        parts = [F.collect_list(F.struct(F.col(f"__count_{i}").alias("n"), F.col(f"__mean_{i}").alias("mean"), F.col(f"__away_{i}").alias("away"))).alias(f"__parts_{i}") for i, _ in enumerate(self.columns)]
        extremes = [f(f"__{s}_{i}").alias(f"__{s}_{i}") for i, _ in enumerate(self.columns) for f, s in ((F.sum, "count"), (F.min, "min"), (F.max, "max"))]
        # A list has an entry per day of the window.
        merged = self._windows(self._state("profile"), window).groupBy("window", self.version, "slice_key", "slice_value").agg(*[F.sum(c).alias(c) for c in _COUNTS], *extremes, *parts)

        def total(i: int, value) -> Column:
            some = F.filter(f"__parts_{i}", lambda p: p["n"] > 0)
            return F.aggregate(some, F.lit(0.0), lambda sum_, p: sum_ + value(p))

        means = {f"__mean_{i}": F.try_divide(total(i, lambda p: p["n"] * p["mean"]), F.col(f"__count_{i}")) for i, _ in enumerate(self.columns)}
        merged = merged.withColumns(means)
        spread = {}
        for i, _ in enumerate(self.columns):
            mean, count = F.col(f"__mean_{i}"), F.col(f"__count_{i}")
            away = total(i, lambda p, mean=mean: p["away"] + p["n"] * (p["mean"] - mean) * (p["mean"] - mean))
            spread[f"__stddev_{i}"] = F.when(count > 1, F.sqrt(away / F.greatest(count - 1, F.lit(1))))
        lost = F.try_divide(F.col("missed") * MISSED_FRAUD, F.col("n"))
        return monitor.profile_lines(merged.withColumns({**spread, "expected_fraud_loss": lost.cast("double")}), self.version, self.columns)

    def _histograms(self, window: str) -> DataFrame:
        counted = self._windows(self._state("histograms"), window).groupBy("window", self.version, "column_name", "bin").agg(F.sum("rows").alias("rows"))
        return monitor.as_maps(counted, ["window", self.version])

    def drift_consecutive(self, window: str = "1 day") -> DataFrame:
        """As `monitor.drift_consecutive` over the days taken in."""
        return monitor.consecutive_distance(self._histograms(window), self.version)

    def drift_baseline(self, window: str = "1 day") -> DataFrame:
        """As `monitor.drift_baseline` over the days taken in."""
        reference = monitor.as_maps(self.spark.read.parquet(f"{self.folder}/reference"), [])
        return monitor.baseline_distance(self._histograms(window), reference, self.version)
