"""Daily profile and drift metrics of an inference log, violations and the retrain decision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import ratio
from ledgerwatch.operators.metrics import confusion_counts, expected_loss, macro_f1
from ledgerwatch.operators.windows import top

# Names and thresholds of the monitoring rules.
TABLE_ROW = ":table"
INPUT = "INPUT"
CONSECUTIVE, BASELINE = "CONSECUTIVE", "BASELINE"
DRIFT_COLUMNS = ("prediction", "label", "amount", "balance_orig_ratio", "is_cross_border")
SLICES = {"is_cross_border = 1.0": "is_cross_border = 1.0D"}
F1_FLOOR = 0.5
CATCH_FLOOR = 0.4
LOSS_FLOOR = -50_000
DRIFT_CEILING = 0.2

# Newest windows that are judged.
JUDGED_WINDOWS = 30

# How the columns are compared: these by value, the others by ranges.
VALUE_COLUMNS = ("prediction", "label", "is_cross_border")
RANGE_BINS = 10
# Approximate quantiles are off by one in so many rows; the exact ones are looked for this many times as far on either side of them.
EDGE_ACCURACY = 100_000
EDGE_REACH = 4
# The most values of a column compared by value.
MAX_VALUES = 100


def by_slice(log: DataFrame, keys: Mapping[str, Column], slices: Mapping[str, str], values: Sequence[Column]) -> DataFrame:
    """`values` per group of `keys`, for the whole (`slice_key` null) and for each slice expression, true and false apart.

    All come from one pass with grouping sets.
    """
    flags = {f"__slice_{i}": (name, F.expr(condition)) for i, (name, condition) in enumerate(slices.items())}
    base = log.withColumns({**keys, **{f: c for f, (_, c) in flags.items()}})
    key_columns, flag_columns = [F.col(k) for k in keys], [F.col(f) for f in flags]
    grouped = base.groupingSets([key_columns, *[[*key_columns, f] for f in flag_columns]], *key_columns, *flag_columns).agg(
        *values, *[F.grouping(f).alias(f"{f}_off") for f in flags]
    )
    # A row belongs to the slice whose grouping column is on, to the whole when all are off.
    slice_key = F.coalesce(*[F.when(F.col(f"{f}_off") == 0, F.lit(name)) for f, (name, _) in flags.items()], F.lit(None))
    slice_value = F.coalesce(*flag_columns, F.lit(None).cast("boolean")).cast("string")
    named = grouped.withColumns({"slice_key": slice_key, "slice_value": slice_value}).drop(*[n for f in flags for n in (f, f"{f}_off")])
    return named.where(F.col("slice_key").isNull() | F.col("slice_value").isNotNull())


def profile_lines(grouped: DataFrame, version: str, columns: Sequence[str]) -> DataFrame:
    """One `:table` row with model quality, and one row per column with statistics, of each group of counts and statistics."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    nothing = F.lit(None).cast("double")

    def line(name: str, count: Column, quality: Sequence[Column], stats: Sequence[Column]) -> Column:
        macro, catch, alarm, loss = quality
        mean, low, high, deviation = stats
        return F.struct(
            F.lit(name).alias("column_name"),
            count.alias("count"),
            (F.col("n") - count).alias("num_nulls"),
            F.struct(macro.alias("macro")).alias("f1_score"),
            catch.alias("fraud_catch_rate"),
            alarm.alias("false_alarm_rate"),
            loss.alias("expected_fraud_loss"),
            mean.alias("mean"),
            low.alias("min"),
            high.alias("max"),
            deviation.alias("stddev"),
        )

    quality = [macro_f1(tn, fp, fn, tp), ratio(tp, tp + fn), ratio(fp, fp + tn), F.col("expected_fraud_loss")]
    lines = [line(TABLE_ROW, F.col("n"), quality, [nothing] * 4)]
    for i, c in enumerate(columns):
        stats = [F.col(f"__{s}_{i}") for s in ("mean", "min", "max", "stddev")]
        lines.append(line(c, F.col(f"__count_{i}"), [nothing] * 4, stats))
    rows = grouped.withColumn("log_type", F.lit(INPUT))
    return rows.select("window", version, "log_type", "slice_key", "slice_value", "n", "labelled", F.inline(F.array(*lines)))


def profile_metrics(
    log: DataFrame,
    columns: Sequence[str],
    ts: str = "inference_timestamp",
    version: str = "model_version",
    slices: Mapping[str, str] = SLICES,
    window: str = "1 day",
) -> DataFrame:
    """Per window, model version and slice: one `:table` row with model quality, one row per column with statistics.

    `slice_key` is null for the whole.
    """
    statistics = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        statistics += [
            F.count(value).alias(f"__count_{i}"),
            F.avg(value).alias(f"__mean_{i}"),
            F.min(value).alias(f"__min_{i}"),
            F.max(value).alias(f"__max_{i}"),
            F.stddev(value).alias(f"__stddev_{i}"),
        ]
    counts = [F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), *[c.alias(k) for k, c in confusion_counts().items()]]
    values = [*counts, expected_loss().alias("expected_fraud_loss"), *statistics]
    grouped = by_slice(log, {"window": F.window(ts, window), version: F.col(version)}, slices, values)
    return profile_lines(grouped, version, columns)


@dataclass(frozen=True)
class Bins:
    """How one column is binned: by the values that the baseline has, or by edges taken from its quantiles.

    Bins are fixed once, with the baseline, so that later rows never change an earlier distance.
    """

    column: str
    values: tuple[float, ...] | None = None
    edges: tuple[float, ...] = ()

    def label(self) -> Column:
        """The bin of a row. Nulls and NaN are bins of their own, infinite values lie in the end bins, and a
        value that the baseline does not have is `other`."""
        value = F.col(self.column).cast("double")
        if self.values is not None:
            known = F.when(value.isin(*self.values), value.cast("string")) if self.values else F.lit(None).cast("string")
            place = F.coalesce(known, F.lit("other"))
        else:
            place = F.lit(0)
            for edge in self.edges:
                place = place + F.when(value >= edge, 1).otherwise(0)
            place = place.cast("string")
        return F.when(value.isNull(), "null").when(F.isnan(value), "NaN").otherwise(place)


def _finite(c: str) -> Column:
    value = F.col(c).cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def exact_edges(baseline: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column_name` and `edges`: the exact tenths of the finite values of each column, equal ones once, however the rows are dealt.

    Approximate quantiles bound every tenth. The few values between the bounds are counted one by one, all others by range.
    """
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), _finite(c).alias("value")) for c in columns]))
    values, value = baseline.select(cells).where("value IS NOT NULL"), F.col("value")
    tenths, reach = range(1, RANGE_BINS), EDGE_REACH / EDGE_ACCURACY
    bounds = [max(k / RANGE_BINS - reach, 0.0) for k in tenths] + [min(k / RANGE_BINS + reach, 1.0) for k in tenths]
    near = values.groupBy("column_name").agg(F.count("value").alias("n"), F.percentile_approx("value", bounds, EDGE_ACCURACY).alias("bounds"))
    low, high = F.slice("bounds", 1, len(tenths)), F.slice("bounds", len(tenths) + 1, len(tenths))
    close = F.exists(F.arrays_zip(low.alias("low"), high.alias("high")), lambda b: (b["low"] <= value) & (value <= b["high"]))
    place = F.size(F.filter(low, lambda b: b <= value))
    placed = values.join(F.broadcast(near), "column_name").select("column_name", "n", place.alias("place"), F.when(close, value).alias("value"))
    counted = placed.groupBy("column_name", "n", "place", "value").agg(F.count(F.lit(1)).alias("rows"))
    # Within a place the values beyond its bounds come after those between them.
    until = F.sum("rows").over(Window.partitionBy("column_name").orderBy("place", F.asc_nulls_last("value")))
    ranks = F.array(*[F.expr(f"({k} * n + {RANGE_BINS - 1}) div {RANGE_BINS}") for k in tenths])
    hit = counted.withColumn("until", until).where(F.exists(ranks, lambda r: (r <= F.col("until")) & (r > F.col("until") - F.col("rows"))))
    found = F.coalesce(value, F.raise_error(F.lit("a tenth lies outside of its bounds")).cast("double"))
    return hit.groupBy("column_name").agg(F.sort_array(F.collect_set(found)).alias("edges"))


def fix_bins(baseline: DataFrame, columns: Sequence[str] = DRIFT_COLUMNS, by_value: Sequence[str] = VALUE_COLUMNS) -> list[Bins]:
    """The bins of a baseline: one per value for the columns named in `by_value`, else tenths of its finite values.

    A column by value with more than MAX_VALUES of them is refused; it belongs among the ranges.
    """
    few, ranged = [c for c in columns if c in by_value], [c for c in columns if c not in by_value]
    listed = F.map_from_entries(F.collect_list(F.struct("column_name", "edges")))
    edges = exact_edges(baseline, ranged).agg(listed.alias("edges")).first()["edges"] if ranged else {}
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), _finite(c).alias("value")) for c in few]))
    seen = baseline.select(cells).distinct().where("value IS NOT NULL").limit(MAX_VALUES * len(few) + 1).collect() if few else []
    values = {c: tuple(sorted(r.value for r in seen if r.column == c)) for c in few}
    for c, found in values.items():
        if len(found) > MAX_VALUES:
            raise ValueError(f"{c} has more than {MAX_VALUES} values: compare it by ranges")
    return [Bins(c, values[c]) if c in few else Bins(c, None, tuple(edges.get(c, ()))) for c in columns]


def bins_table(spark: SparkSession, bins: Sequence[Bins]) -> DataFrame:
    """The bins as rows, to be stored beside their baseline."""
    rows = [(b.column, None if b.values is None else list(b.values), list(b.edges)) for b in bins]
    return spark.createDataFrame(rows, "column_name string, bin_values array<double>, edges array<double>")


def stored_bins(table: DataFrame) -> list[Bins]:
    rows = table.orderBy("column_name").collect()  # one row per column
    return [Bins(r.column_name, None if r.bin_values is None else tuple(r.bin_values), tuple(r.edges)) for r in rows]


def histograms(df: DataFrame, bins: Sequence[Bins], by: Sequence[Column]) -> DataFrame:
    """Per group and column one map bin -> rows, from one pass. A map has as many entries as there are bins."""
    return as_maps(bin_counts(df, bins, by), [*df.select(*by).columns])


def bin_counts(df: DataFrame, bins: Sequence[Bins], by: Sequence[Column]) -> DataFrame:
    """Rows per group, column and bin, from one pass."""
    cells = F.inline(F.array(*[F.struct(F.lit(b.column).alias("column_name"), b.label().alias("bin")) for b in bins]))
    names = [*df.select(*by).columns]
    return df.select(*by, cells).groupBy(*names, "column_name", "bin").agg(F.count(F.lit(1)).alias("rows"))


def as_maps(counted: DataFrame, names: Sequence[str]) -> DataFrame:
    entry = F.struct("bin", "rows")
    return counted.groupBy(*names, "column_name").agg(F.map_from_entries(F.collect_list(entry)).alias("histogram"))


def js_distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two maps bin -> rows: 0 for equal shapes, 1 for disjoint ones."""

    def total(m: Column) -> Column:
        return F.aggregate(F.map_values(m), F.lit(0.0), lambda s, x: s + x)

    def share(m: Column, key: Column) -> Column:
        return F.coalesce(F.try_element_at(m, key), F.lit(0)) / total(m)

    def term(p: Column, middle: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / middle)).otherwise(F.lit(0.0))

    def step(s: Column, key: Column) -> Column:
        p, q = share(a, key), share(b, key)
        middle = (p + q) / 2
        return s + (term(p, middle) + term(q, middle)) / 2

    divergence = F.aggregate(F.array_union(F.map_keys(a), F.map_keys(b)), F.lit(0.0), step)
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def _drift_row(kind: str, version: str, distance: Column) -> list[Column]:
    return [
        F.col("window"),
        F.col(version),
        F.col("column_name"),
        F.lit(None).cast("string").alias("slice_key"),
        F.lit(kind).alias("drift_type"),
        distance.alias("js_distance"),
    ]


def drift_consecutive(
    log: DataFrame,
    bins: Sequence[Bins],
    ts: str = "inference_timestamp",
    version: str = "model_version",
    window: str = "1 day",
) -> DataFrame:
    """Distance of each column between a window and the last one that has rows, per model version.

    The rows are read into histograms once; what is ordered per version is one row per window.
    """
    return consecutive_distance(histograms(log, bins, [F.window(ts, window).alias("window"), F.col(version)]), version)


def consecutive_distance(found: DataFrame, version: str) -> DataFrame:
    """Distances of the histograms per window, version and column to those of the window before."""
    earlier = Window.partitionBy(version, "column_name").orderBy("window.start")
    with_previous = found.withColumn("previous", F.lag("histogram").over(earlier)).where("previous IS NOT NULL")
    distance = js_distance(F.col("histogram"), F.col("previous"))
    return with_previous.select(*_drift_row(CONSECUTIVE, version, distance))


def drift_baseline(
    log: DataFrame,
    baseline: DataFrame,
    bins: Sequence[Bins],
    ts: str = "inference_timestamp",
    version: str = "model_version",
    window: str = "1 day",
) -> DataFrame:
    """Distance of each column between a window and the baseline that the bins were fixed with."""
    found = histograms(log, bins, [F.window(ts, window).alias("window"), F.col(version)])
    return baseline_distance(found, histograms(baseline, bins, []), version)


def baseline_distance(found: DataFrame, reference: DataFrame, version: str) -> DataFrame:
    """Distances of the histograms per window, version and column to those of the baseline, one row per column."""
    reference = F.broadcast(reference.withColumnRenamed("histogram", "reference"))
    distance = js_distance(F.col("histogram"), F.col("reference"))
    return found.join(reference, "column_name").select(*_drift_row(BASELINE, version, distance))


def _whole_profile(profile: DataFrame, version: str) -> DataFrame:
    return profile.where(
        (F.col("log_type") == INPUT) & (F.col("column_name") == TABLE_ROW) & F.col("slice_key").isNull()
    ).select(
        F.col("window.start").alias("time_window"),
        F.col("f1_score.macro").alias("f1_macro"),
        "fraud_catch_rate",
        "false_alarm_rate",
        "expected_fraud_loss",
        version,
    )


def _consecutive(drift: DataFrame, columns: Sequence[str], version: str) -> DataFrame:
    return drift.where(
        F.col("column_name").isin(*columns) & F.col("slice_key").isNull() & (F.col("drift_type") == CONSECUTIVE)
    ).select(
        F.col("window.start").alias("time_window"), "column_name", F.col("js_distance").alias("drift_metric"), version
    )


def recent_profile(profile: DataFrame, n: int = 30, version: str = "model_version") -> DataFrame:
    """Model quality of the newest windows, whole log only, as a report of n rows."""
    return top(_whole_profile(profile, version), n, F.desc("time_window"), ties=[version])


def recent_drift(
    drift: DataFrame, n: int = 50, columns: Sequence[str] = DRIFT_COLUMNS, version: str = "model_version"
) -> DataFrame:
    """Consecutive drift of the newest windows, as a report of n rows."""
    return top(_consecutive(drift, columns, version), n, F.desc("time_window"), ties=[version, "column_name"])


def _newest(rows: DataFrame, windows: int) -> DataFrame:
    """All rows of the newest windows, however many versions and columns they hold."""
    first = rows.select("time_window").distinct().orderBy(F.desc("time_window")).limit(windows).agg(F.min("time_window"))
    return rows.where(F.col("time_window") >= first.scalar())


def judged_profile(profile: DataFrame, windows: int = JUDGED_WINDOWS, version: str = "model_version") -> DataFrame:
    """Model quality in the windows that the decision to retrain looks at."""
    return _newest(_whole_profile(profile, version), windows)


def judged_drift(
    drift: DataFrame, windows: int = JUDGED_WINDOWS, columns: Sequence[str] = DRIFT_COLUMNS, version: str = "model_version"
) -> DataFrame:
    """Consecutive drift in the windows that the decision to retrain looks at."""
    return _newest(_consecutive(drift, columns, version), windows)


def violations(profile_rows: DataFrame, drift_rows: DataFrame) -> DataFrame:
    """One row: broken performance rules, broken drift rules and their total. A null metric breaks no rule."""
    poor = (
        (F.col("f1_macro") < F1_FLOOR)
        | (F.col("fraud_catch_rate") < CATCH_FLOOR)
        | (F.col("expected_fraud_loss") < LOSS_FLOOR)
    )
    checks = profile_rows.select(
        F.coalesce(poor, F.lit(False)).alias("performance"), F.lit(False).alias("drift")
    ).unionByName(
        drift_rows.select(
            F.lit(False).alias("performance"),
            F.coalesce(F.col("drift_metric") > DRIFT_CEILING, F.lit(False)).alias("drift"),
        )
    )
    return checks.agg(
        F.count_if("performance").alias("performance_violations"), F.count_if("drift").alias("drift_violations")
    ).withColumn("total_violations", F.col("performance_violations") + F.col("drift_violations"))


def retrain_decision(profile_rows: DataFrame, drift_rows: DataFrame) -> DataFrame:
    """The violations and whether they call for training again."""
    return violations(profile_rows, drift_rows).withColumn("retrain", F.col("total_violations") > 0)
